import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import trade, trades, ts

from tradelake import confirmations, jobs
from tradelake.schemas import ENVELOPE

HEADER = "TRADE_ID,OUR_REF,ISIN,NOTIONAL,CURRENCY,TRADE_DATE,SETTLEMENT_DATE,LEI,PRICE,DIRECTION\n"
ROW = "007,r1,XS1,100.5,USD,2024-01-02,2024-01-04,LEI1,99.5,BUY\n"
NS = "http://www.fpml.org/FpML-5/confirmation"
LEI = "http://www.gleif.org/data/schema/leiData"


def fpml(prefix=""):
    p = f"{prefix}:" if prefix else ""
    xmlns = f'xmlns:{prefix}="{NS}"' if prefix else f'xmlns="{NS}"'
    return f"""<?xml version="1.0"?>
<{p}dataDocument {xmlns}>
<{p}trade id="t1"><{p}tradeHeader><{p}partyTradeIdentifier><{p}tradeId>001</{p}tradeId>
<{p}tradeId partyReference="party1">ref &amp; 1</{p}tradeId></{p}partyTradeIdentifier>
<{p}tradeDate>2024-01-02</{p}tradeDate></{p}tradeHeader>
<{p}swap><{p}leg><{p}notionalAmount><{p}currency>EUR</{p}currency><{p}amount>12.5</{p}amount>
</{p}notionalAmount></{p}leg><{p}buyerPartyReference href="p2"/>
<{p}settlementDate>2024-01-09</{p}settlementDate></{p}swap>
<{p}initialPrice><{p}cleanPrice>1.25</{p}cleanPrice></{p}initialPrice>
<{p}party><{p}partyId partyIdScheme="{LEI}">LEI9</{p}partyId></{p}party></{p}trade>
<{p}wrapper><{p}trade><{p}tradeHeader></{p}tradeHeader></{p}trade></{p}wrapper>
<{p}trade><{p}notionalAmount><{p}amount>many</{p}amount></{p}notionalAmount></{p}trade>
<{p}trade><{p}notionalAmount><{p}amount></{p}amount></{p}notionalAmount></{p}trade>
</{p}dataDocument>
"""


@pytest.fixture
def put(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.write_bytes(text.encode("utf-8"))
        return str(path)
    return write


def envelope(path, fmt="CSV", file_id=None, at=ts(1), checksum=None, sender="S1"):
    if checksum is None:
        with open(path, "rb") as f:
            checksum = hashlib.sha256(f.read()).hexdigest()
    return (file_id or path.rsplit("/", 1)[1], sender, sender, "US", "TRADE_CONFIRM", at,
            checksum, fmt, path)


def envelopes(spark, *rows):
    return spark.createDataFrame(list(rows), ENVELOPE)


def read(spark, *rows, mapping=None):
    got, rejects = confirmations.read_all(spark, envelopes(spark, *rows), mapping)
    return got.collect(), {r.file_id: r.reason for r in rejects.collect()}


def test_csv_layouts_in_one_pass(spark, put):
    a = put("a b+c.csv", HEADER + ROW)
    b = put("b.csv", "DIRECTION,TRADE_ID,NOTIONAL\nSELL,0001,5\n")
    rows, _ = read(spark, envelope(a), envelope(b))
    by_file = {r.source_file_id: r for r in rows}
    one, two = by_file["a b+c.csv"], by_file["b.csv"]
    assert (one.trade_id, one.notional, one.price, one.direction) == (
        "007", Decimal("100.5000"), Decimal("99.5000"), "BUY")
    assert (two.trade_id, two.notional, two.direction, two.currency, two.price, two.error) == (
        "0001", Decimal("5.0000"), "SELL", "", Decimal("0.0000"), None)


def test_d23_bad_number_marks_the_row_only(spark, put):
    path = put("x.csv", HEADER + ROW + ROW.replace("100.5", "") + ROW.replace("99.5", "n/a")
               + "short,row\n")
    rows, _ = read(spark, envelope(path))
    assert sorted((r.trade_id, r.error) for r in rows if r.error) == [
        ("007", "Bad number: notional"), ("007", "Bad number: price"),
        ("short", "Bad number: notional, price")]
    assert len(rows) == 4


def test_quotes_commas_and_line_breaks(spark, put):
    path = put("q.csv", "TRADE_ID,NOTIONAL,OUR_REF\n\"a,\"\"1\"\"\",1,\"two\nlines\"\n")
    rows, _ = read(spark, envelope(path))
    assert [(r.trade_id, r.our_ref) for r in rows] == [('a,"1"', "two\nlines")]


def test_empty_file_and_header_only(spark, put):
    rows, rejects = read(spark, envelope(put("e.csv", "")), envelope(put("h.csv", HEADER)))
    assert rows == [] and rejects == {}


def test_mapping_per_sender(spark, put):
    path = put("m.csv", "Their Id,Amount\nz9,7\n")
    other = put("n.csv", HEADER + ROW)
    mapping = spark.createDataFrame([("S2", "trade_id", "Their Id"), ("S2", "notional", "Amount")],
                                    "sender_duns string, column string, source_name string")
    rows, _ = read(spark, envelope(path, sender="S2"), envelope(other), mapping=mapping)
    assert sorted((r.trade_id, r.notional) for r in rows) == [
        ("007", Decimal("100.5000")), ("z9", Decimal("7.0000"))]


@pytest.mark.parametrize("prefix", ["", "f"])
def test_fpml(spark, put, prefix):
    path = put("t.xml", fpml(prefix))
    rows, rejects = read(spark, envelope(path, "FPML"))
    assert rejects == {} and len(rows) == 4
    full = next(r for r in rows if r.trade_id)
    assert (full.trade_id, full.our_ref, full.notional, full.currency, full.trade_date,
            full.settlement_date, full.counterparty_lei, full.price, full.direction) == (
        "001", "ref & 1", Decimal("12.5000"), "EUR", "2024-01-02", "2024-01-09", "LEI9",
        Decimal("1.2500"), "p2")
    empty = next(r for r in rows if not r.trade_id and not r.error)
    assert (empty.notional, empty.price, empty.direction) == (Decimal(0), Decimal(0), "BUY")
    assert [r.error for r in rows if r.error] == ["Bad number: notional"] * 2


def test_malformed_xml_is_rejected_whole(spark, put):
    bad = put("bad.xml", fpml().replace("</swap>", ""))
    odd = put("odd.xml", fpml().replace("wrapper>", "othertrade>"))
    good = put("good.xml", fpml())
    rows, rejects = read(spark, envelope(bad, "FPML"), envelope(good, "FPML"),
                         envelope(odd, "FPML"))
    assert rejects == {"bad.xml": "MALFORMED_XML"}
    assert {r.source_file_id for r in rows} == {"good.xml", "odd.xml"}
    assert len(rows) == 8  # an element that only ends in "trade" is no trade


def test_truncated_xml_is_rejected(spark, put):
    path = put("cut.xml", fpml().replace("</dataDocument>", ""))
    _, rejects = read(spark, envelope(path, "FPML"), envelope(put("g.xml", fpml()), "FPML"),
                      envelope(put("none.xml", ""), "FPML"), envelope(put("j.xml", "hi"), "FPML"))
    assert rejects == {n: "MALFORMED_XML" for n in ("cut.xml", "none.xml", "j.xml")}


def test_unknown_formats(spark, put):
    p = put("x.csv", HEADER)
    _, rejects = read(spark, envelope(p, "MT518", "a"), envelope(p, "FIX", "b"),
                      envelope(p, None, "c"))
    assert rejects == {"a": "Format not implemented: MT518", "b": "Unsupported file format: FIX",
                       "c": "Unsupported file format: none"}


def test_d24_duplicates_in_ledger_and_batch(spark, put):
    p = put("x.csv", HEADER)
    env = envelopes(spark, envelope(p, file_id="done"), envelope(p, file_id="twice", at=ts(3)),
                    envelope(p, file_id="twice", at=ts(2)), envelope(p, file_id="seen"))
    ledger = spark.createDataFrame([("done", "COMPLETED"), ("seen", "RECEIVED")],
                                   "file_id string, state string")
    fresh, again = confirmations.new_files(env, ledger)
    assert sorted((r.file_id, r.received_at) for r in fresh.collect()) == [
        ("seen", ts(1)), ("twice", ts(2))]
    assert sorted((r.file_id, r.copies) for r in again.collect()) == [("done", 1), ("twice", 1)]


def test_intake_job_and_replay(spark, put, new_path):
    env = envelopes(
        spark, envelope(put("ok.csv", HEADER + ROW)), envelope(put("part.csv", HEADER + ROW +
                                                                   ROW.replace("100.5", "x"))),
        envelope(put("wrong.csv", HEADER + ROW), checksum="00"),
        envelope("/nowhere/gone.csv", checksum="00"),
        envelope(put("t.xml", fpml()), "FPML"), envelope(put("m.txt", "x"), "MT518"))
    ledger, out = new_path("ledger"), new_path("out")

    def run():
        got = jobs.run_confirmations(spark, env, ledger, out, "GATEWAY", at=ts(9))
        return {r.file_id: (r.status, r.processed, r.failed) for r in got.collect()}

    assert run() == {
        "ok.csv": ("COMPLETE", 1, 0), "part.csv": ("PARTIAL", 1, 1),
        "wrong.csv": ("REJECTED", 0, 0), "gone.csv": ("REJECTED", 0, 0),
        "t.xml": ("PARTIAL", 2, 2), "m.txt": ("REJECTED", 0, 0)}
    messages = spark.read.parquet(out)
    assert messages.count() == 4
    heads = {h.key: bytes(h.value).decode() for h in
             messages.filter("key = '001'").first().headers}
    assert heads == {"sourceSystem": "GATEWAY", "senderDuns": "S1", "sourceFileId": "t.xml",
                     "schemaVersion": "v1"}
    again = run()
    assert {k for k, v in again.items() if v[0] == "DUPLICATE"} == {"ok.csv", "part.csv", "t.xml"}
    assert spark.read.parquet(out).count() == 4


def test_reconcile(spark):
    confirms = spark.createDataFrame(
        [("c1", "a", Decimal(10), "USD"), ("c2", "a", Decimal(11), "EUR"), ("c3", "", None, None),
         ("c4", "zz", Decimal(1), "USD"), ("c5", "n", None, "USD")],
        "trade_id string, our_ref string, notional decimal(20,4), currency string")
    ours = trades(spark, trade("a", at=ts(2)), trade("a", "AMEND", at=ts(1), currency="XXX"),
                  trade("b"), trade("n"), trade(None))
    got = {(r.our_ref, r.their_ref): (r.status, r.breaks)
           for r in confirmations.reconcile(confirms, ours).collect()}
    assert got == {
        ("a", "c1"): ("MATCHED", ""), ("a", "c2"): ("BREAK", "notional,currency"),
        (None, "c3"): ("MISSING_OURS", ""), ("zz", "c4"): ("MISSING_OURS", ""),
        ("n", "c5"): ("BREAK", "notional"), ("b", None): ("MISSING_THEIRS", "")}
    near = confirmations.reconcile(confirms.filter("trade_id = 'c2'"), ours, tolerance="1")
    assert {r.breaks for r in near.collect() if r.their_ref} == {"currency"}
    assert dt.date and F


def test_reconcile_without_ties_moves_only_what_is_compared(spark):
    confirms = spark.createDataFrame([("c1", "a", Decimal(10), "USD")],
                                     "trade_id string, our_ref string, notional decimal(20,4), currency string")
    ours = trades(spark, trade("a", at=ts(2)), trade("a", "AMEND", at=ts(1), currency="XXX"), trade("b"))
    unread = ours.withColumn("book_id", F.raise_error(F.col("book_id")).cast("string"))
    got = {(r.our_ref, r.their_ref, r.status) for r in confirmations.reconcile(confirms, unread, ties=[]).collect()}
    assert got == {("a", "c1", "MATCHED"), ("b", None, "MISSING_THEIRS")}
