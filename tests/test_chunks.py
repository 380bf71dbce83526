"""Confirmation files read in chunks: every way to cut a file gives the same rows."""

import csv
import gzip
import hashlib
import io
import random
import xml.etree.ElementTree as ET
from urllib.parse import unquote

import pyarrow.parquet as pq
import pytest

from tradelake import confirmations
from tradelake.schemas import FPML_DEFAULTS
from tradelake.sources import checksums, chunks, csv_files, fpml

XML_ODD = ["<!-- </trade> <trade> -->", "<![CDATA[</trade><trade>]]>", "<?pi </trade> ?>", "<subtrade>7</subtrade>", "<f:trade/>",
           "<trade/>", '<leg note="</trade>"/>'.replace("</trade>", "a>trade>"), "<trade x='1'><trade><tradeHeader/></trade></trade>",
           "<f:trade id='n'><swap/></f:trade>", "text &amp; more", "<!-- > -- -->".replace(" -- ", " "), "é日", "<othertrade><trade/></othertrade>"]


def element(r, depth=0):
    name = r.choice(["trade", "swap", "f:trade", "subtrade", "tradeHeader", "notionalAmount"])
    inner = "".join(r.choice(XML_ODD) if r.random() < 0.4 or depth > 3 else element(r, depth + 1) for _ in range(r.randrange(4)))
    if name == "notionalAmount":
        inner += f"<amount>{r.randrange(9)}</amount>"
    return f"<{name}{r.choice(['', ' a=\"1>2\"', chr(10)])}>{inner}</{name}>"


def document(seed):
    r = random.Random(seed)
    root = r.choice(["dataDocument", "dataDocument", "trade"])
    head = r.choice(['<?xml version="1.0"?>\n', "", '<?xml version="1.0" encoding="UTF-8"?>\n<!-- <trade> -->\n<!DOCTYPE dataDocument>\n'])
    return (f'{head}<{root} xmlns:f="x">' + "\n".join(element(r) for _ in range(r.randrange(6))) + f"</{root}>"
            + r.choice(["", "\n<!-- end -->\n", "<?end?>"])).encode()


def expected_trades(data):
    root = ET.fromstring(data)
    for e in root.iter():
        e.tag = e.tag.rpartition("}")[2] if isinstance(e.tag, str) else e.tag
    return sorted(fpml.fields_of(t) for t in root.findall(".//trade"))


def cut(r, data, mark, leading):
    """The file in chunks at some of its marks, and those in splits."""
    places = [i + (not leading) for i in range(1 if leading else 0, len(data)) if data[i:i + 1] == mark]
    ends = sorted(r.sample(places, min(len(places), r.randrange(0, 12)))) + [len(data)]
    chunks, start, block, seq = [], 0, 0, 0
    for end in ends:
        if end > start:
            chunks.append({"path": "p", "block": block, "seq": seq, "data": data[start:end]})
        if r.random() < 0.4:
            block, seq = end, 0
        else:
            seq += 1
        start = end
    return chunks


def put_together(rows):
    owners = {}
    for row in rows:
        if row.get("data") is not None:
            owners.setdefault((row["owner"]["block"], row["owner"]["seq"]), []).append(((row["block"], row["seq"]), row))
    return [b"".join(x["data"] for _, x in sorted(parts, key=lambda p: p[0])) for _, parts in sorted(owners.items())]


def read_chunks(module, chunks, usual):
    said = module.follow([module.summary(c["data"]) for c in chunks])
    rows = []
    for c, s in zip(chunks, said):
        owner = None if s["owner"] is None else {k: chunks[s["owner"]][k] for k in ("block", "seq")}
        rows += module.parse({**c, **({k: None for k in s} if usual(s) else s), "owner": None if usual(s) else owner, "unusual": not usual(s) or None})
    return said, rows


def usual_xml(s):
    return s["state"] == "T" and s["depth"] == 0 and s["level"] > 0 and not s["ends"] and s["sound"] and s["encoding"] is None


@pytest.mark.parametrize("seed", range(300))
def test_xml_cut_anywhere_gives_the_same_trades(seed):
    r, data = random.Random(seed), document(seed)
    said, rows = read_chunks(fpml, cut(r, data, b"<", True), usual_xml)
    assert all(s["sound"] for s in said) and not any(x.get("broken") for x in rows)
    across = [f for whole in put_together(rows) for f in fpml.trades_in(whole, None)]
    assert sorted([x["fields"] for x in rows if x.get("fields")] + across) == expected_trades(data)


BROKEN = ["<a><trade></a></trade>", "<a>", "", "hi", "<a></a><b></b>", "<a></a>junk", "junk<a></a>", "<a><trade x=1/></a>", "<a><!-- </a>",
          "<a><![CDATA[</a>", "</a>", "<a/><a/>", "<a><trade>&nope;</trade></a>", "<a>< b/></a>", "<a></a", "<a></a b='1'>",
          "<!DOCTYPE a [<!ENTITY x 'y'>]><a><trade/></a>", "<a><trade><swap></trade></swap></a>", "<a b='<'/>", "<f:a></g:a>"]


@pytest.mark.parametrize("text", BROKEN)
@pytest.mark.parametrize("seed", range(6))
def test_xml_that_is_not_well_formed_is_seen_however_it_is_cut(text, seed):
    chunks = cut(random.Random(seed), text.encode(), b"<", True)
    if not chunks:
        return
    said, rows = read_chunks(fpml, chunks, usual_xml)
    across = [fpml.trades_in(whole, None) for whole in put_together(rows)]
    assert not said[0]["sound"] or any(x.get("broken") for x in rows) or None in across


def test_encodings_and_defaults():
    text = '<?xml version="1.0" encoding="ISO-8859-1"?><a><trade><instrumentId>é</instrumentId><notionalAmount><amount/></notionalAmount></trade></a>'
    _, rows = read_chunks(fpml, [{"path": "p", "block": 0, "seq": 0, "data": text.encode("iso-8859-1")}], usual_xml)
    fields = rows[0]["fields"]
    assert fields[2:4] == ["é", ""] and fields[-2:] == [FPML_DEFAULTS["price"], FPML_DEFAULTS["direction"]]


def table(seed):
    r = random.Random(seed)
    cells = ["a", "", "x,y", 'say "hi"', "two\nlines", '"', "\n", '5" pipe', "é", "a\r\nb", '""\n""']
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=r.choice(["\n", "\r\n"]), quoting=r.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
    for _ in range(r.randrange(1, 25)):
        writer.writerow([r.choice(cells) for _ in range(r.randrange(1, 5))])
        if r.random() < 0.2:
            out.write('un"quoted,5" x,"q"tail"\n')
    return out.getvalue().encode()


@pytest.mark.parametrize("seed", range(300))
def test_csv_cut_at_any_line_gives_the_same_records(seed):
    data = table(seed) + b"\n"
    _, rows = read_chunks(csv_files, cut(random.Random(seed), data, b"\n", False), lambda s: not s["quoted"])
    across = [c for whole in put_together(rows) for c in csv_files.cells_of(whole)]
    want = [x for x in csv.reader(io.StringIO(data.decode(), newline="")) if x]
    assert sorted([x["cells"] for x in rows if x.get("cells")] + across) == sorted(want)
    heads = [x for x in rows if x.get("head")]
    assert len(heads) == 1 and (heads[0].get("cells") or csv_files.cells_of(b"".join(put_together(rows)[:1]))[0]) == want[0]


def test_quotes_count_at_the_beginning_of_a_field_alone():
    assert [csv_files.quoted_after(x, q) for x, q in [
        (b'a"b', False), (b'"a', False), (b'a,"', False), (b'"a""', False), (b'"a"""', False), (b'b"', True), (b'b",x,"', True), (b'""', True), (b"", True)
    ]] == [False, True, True, True, False, False, True, True, True]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_in_many_splits(spark, tmp_path, small_splits):
    want, paths = [], []
    for seed in range(40):
        path = tmp_path / f"f {seed}+é.xml"
        path.write_bytes(document(seed))
        paths.append(str(path))
        want += [(str(path), f) for f in expected_trades(document(seed))]
    for i, text in enumerate(BROKEN):
        (tmp_path / f"bad{i}.xml").write_text(text)
        paths.append(str(tmp_path / f"bad{i}.xml"))
    rows, malformed = confirmations.read_fpml(spark, paths)
    assert sorted(r.path.rpartition("/")[2] for r in malformed.collect()) == sorted(f"bad{i}.xml" for i in range(len(BROKEN)))
    got = rows.select("path", "trade_id", "trade_date", "direction", "error").collect()
    assert sorted((r.path, r.trade_id, r.trade_date, r.direction) for r in got) == sorted((p, f[0], f[5], f[9]) for p, f in want)


def test_a_quoted_line_break_leaves_all_files_in_splits(spark, tmp_path, small_splits):
    rows = [[f"t{i}", "x" * 20, str(i)] for i in range(200)]
    for name, extra in (("plain.csv", []), ("odd.csv", [["t", "two\nlines, " * 40, "0"]])):
        with open(tmp_path / name, "w", newline="") as f:
            csv.writer(f).writerows([["A", "B", "C"], *rows[:100], *extra, *rows[100:]])
    paths = [str(tmp_path / "plain.csv"), str(tmp_path / "odd.csv")]
    assert spark.read.option("lineSep", "\n").text(paths).rdd.getNumPartitions() > 20
    got = csv_files.read_csv(spark, paths).collect()
    assert {tuple(r.names) for r in got} == {("A", "B", "C")}
    assert sorted(tuple(r["values"]) for r in got) == sorted(tuple(x) for x in [*rows, *rows, ["t", "two\nlines, " * 40, "0"]])


def counted_tags(monkeypatch):
    seen, tags = [], fpml.tags

    def counting(data, state):
        for tag in tags(data, state):
            seen.append(tag)
            yield tag

    monkeypatch.setattr(fpml, "tags", counting)
    return seen


def test_whole_trades_are_not_followed_tag_by_tag(monkeypatch):
    seen = counted_tags(monkeypatch)
    data = b"<f:trade><!-- </f:trade> --><f:tradeHeader><f:tradeDate>d</f:tradeDate></f:tradeHeader></f:trade>" * 200
    ends = fpml.summary(data)["ends"]
    assert [(e["state"], e["closes"], e["opens"], e["broken"]) for e in ends[:2]] == [
        ("T", [], [], False), ("T", ["f:tradeHeader", "f:trade"][1:], [], False)]
    rows = fpml.parse({"path": "p", "block": 1, "seq": 0, "data": data, "encoding": None, "unusual": None})
    assert len(rows) == 200 and all(r["fields"][5] == "d" for r in rows)
    assert len(seen) < 50


def test_names_that_begin_with_a_colon_are_still_broken():
    data = b"<trade><:x/></trade>"
    assert fpml.passed(data, fpml.TEXT)["broken"]
    rows = fpml.parse({"path": "p", "block": 1, "seq": 0, "data": data, "encoding": None, "unusual": None})
    assert not [r for r in rows if r.get("fields")]


@pytest.mark.parametrize("target", [1, 40, 1000])
def test_files_are_cut_at_trades_and_nothing_is_lost(spark, new_path, monkeypatch, target):
    from tradelake.sources import chunks
    monkeypatch.setattr(chunks, "TARGET", target)
    monkeypatch.setattr(chunks, "LIMIT", 4 * target)
    path = new_path()
    texts = ["<a>" + "".join(f"<f:trade n='{i}{j}'><subtrade/></f:trade>" for i in range(20)) + "</a>" for j in range(2)]
    spark.createDataFrame([(t,) for t in texts], "value string").repartition(2).write.text(path, lineSep=" ")
    for mark, leading, find in (("<", True, fpml.next_trade), ("\n", False, csv_files.next_line)):
        cut = chunks.cut(spark, [path], mark, leading, find, lambda data: {"n": len(data)}, "struct<n: int>", "t").collect()
        files = {}
        for row in sorted(cut, key=lambda r: (r["path"], r["block"], r["seq"])):
            files[row["path"]] = files.get(row["path"], b"") + bytes(row["data"])
        assert sorted(f.strip() for f in files.values()) == sorted(t.encode() for t in texts)
        assert all(len(r["data"]) <= 4 * target + 60 for r in cut if leading)


def test_lines_without_quotes_are_not_read_one_by_one(monkeypatch):
    """Only records that hold a quote go through the csv reader; all records are the same."""
    seen = []
    one_by_one = csv_files.cells_of
    monkeypatch.setattr(csv_files, "cells_of", lambda data: seen.append(data) or one_by_one(data))
    for end in (b"\n", b"\r\n"):
        lines = [b"a,,b", b"", b'"x\ny",2', b"\xff,\xc3\xa9", b",", b'1,"p, q"', b" "]
        data = end.join([*lines, b""])
        seen.clear()
        rows = csv_files.parse({"path": "p", "block": 0, "seq": 0, "data": data, "quoted": None, "owner": None})
        assert b"".join(seen) == end.join([lines[2], lines[5], b""])
        assert sorted(r["cells"] for r in rows) == sorted(one_by_one(data))
        assert [r["cells"] for r in rows if r["head"]] == [["a", "", "b"]]
    assert [r["cells"] for r in csv_files.parse({"path": "p", "block": 0, "seq": 0, "data": b'a\rb,c\n\n"d"\n', "quoted": None, "owner": None})] == [["a"], ["b", "c"], ["d"]]


def test_chunks_lie_in_small_row_groups(spark, tmp_path):
    path = tmp_path / "long.xml.gz"  # one split, so one task writes all its chunks
    path.write_bytes(gzip.compress(b"<r>" + b"<trade>%s</trade>" % (b"x" * 1000) * 21_000 + b"</r>"))
    kept = chunks.cut(spark, [str(path)], "<", True, fpml.next_trade, fpml.summary, fpml.SUMMARY, "groups")
    assert kept.count() > chunks.GROUP_ROWS
    files = [pq.ParquetFile(unquote(f.removeprefix("file://"))).metadata for f in kept.inputFiles()]
    assert max(m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)) <= chunks.GROUP_ROWS


def test_checksums_of_large_files(spark, tmp_path):
    r, want = random.Random(5), {}
    lines = b"\n".join(bytes(r.randrange(32, 126) for _ in range(r.randrange(60))) for _ in range(30_000))
    contents = {"ended.csv": lines + b"\n", "open.csv": lines, "marked.csv": checksums.BOM + lines + b"\n",
                "marked open.csv": checksums.BOM + lines, "breaks.csv": b"\n\r\n\n" + lines + b"\n\n", "bytes.csv": lines + b"\n\xff\xfe\x00",
                "packed.csv.gz": gzip.compress(lines), "small.csv": b"a"}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
        want[name] = hashlib.sha256(data).hexdigest()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        files = checksums.with_sha256(spark.read.format("binaryFile").load(str(tmp_path)), whole=1000)
        got = {f["path"].rpartition("/")[2]: f["sha256"] for f in files.select("path", "sha256").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == want
    scans = [line for line in files._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan binaryFile" in line]
    assert any("LessThanOrEqual(length,1000)" in line for line in scans)  # contents of the large ones are not read
