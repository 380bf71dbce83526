import datetime as dt
import json
import time
from decimal import Decimal

from pyspark.sql import functions as F

from tradelake import parse, sources, streaming, windows

ONCE = {"availableNow": True}
START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def event(i, seconds, inst="I1", **over):
    row = {"tradeId": f"E{i}", "instrumentId": inst, "notional": "1.5", "currency": "USD",
           "eventTimestamp": int((START.timestamp() + seconds) * 1000), "eventType": "NEW"}
    return json.dumps({**row, **over})


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    time.sleep(0.01)


def valid_stream(spark, folder):
    events = sources.read_event_stream(spark, "text", str(folder), {"maxFilesPerTrigger": "1"})
    return parse.split_valid(parse.parse_events(events))


def run(query):
    query.awaitTermination()
    return query


def counts(spark, path):
    return {(r.instrument_id, int((r.window_start - dt.datetime(2024, 1, 1)).total_seconds())):
            (r.trade_count, r.total_notional) for r in spark.read.parquet(path).collect()}


def test_window_bounds_and_event_time_in_batch(spark):
    df = spark.createDataFrame([(event(1, 0),), (event(2, 299.999),), (event(3, 300),)],
                               "value string").withColumn("_record_ts", F.lit(dt.datetime(2024, 2, 1)))
    got = windows.flat(windows.notional_5m(parse.parse_events(df))).orderBy("window_start").collect()
    assert [(r.trade_count, r.total_notional) for r in got] == [
        (2, Decimal("3.0000")), (1, Decimal("1.5000"))]


def test_merge_of_halves_is_the_whole(spark):
    df = spark.createDataFrame([(f"I{i % 3}", dt.datetime(2024, 1, 1, 0, i % 20), Decimal(i))
                                for i in range(90)],
                               "instrument_id string, event_ts timestamp, notional decimal(20,4)")
    whole = windows.notional_5m(df)
    halves = windows.notional_5m(df.filter("notional < 40")).union(
        windows.notional_5m(df.filter("notional >= 40")))
    merged = halves.groupBy("window", "instrument_id").agg(
        F.sum("total_notional").cast("decimal(20,4)").alias("total_notional"),
        F.sum("trade_count").alias("trade_count"))
    assert sorted(merged.collect()) == sorted(whole.select(*merged.columns).collect())


def test_t04_late_row_is_left_out_of_the_window_but_landed(spark, tmp_path, new_path):
    seen = streaming.LateRows(spark, new_path("late"))
    assert seen.totals().collect() == []
    spark.streams.addListener(seen)
    src, raw, out = tmp_path / "in", new_path("raw"), new_path("win")
    c_raw, c_win = new_path("c"), new_path("c")

    def drain():
        valid, _ = valid_stream(spark, src)
        run(streaming.write_raw(valid, raw, c_raw, ONCE))
        return run(streaming.write_metrics(streaming.windowed_notional(valid), out, c_win, ONCE))

    put(src, "1", event(1, 10), event(2, 290))
    put(src, "2", event(3, 311))                      # watermark 301: first window closes
    put(src, "2b", event(8, 312))                     # Spark drops late rows one batch later
    put(src, "3", event(4, 299), event(5, 301))       # 4 is late, 5 is late but still in time
    query = drain()
    put(src, "4", event(6, 700))
    put(src, "5", event(7, 100, "I2"))
    late = drain()
    assert counts(spark, out) == {("I1", 0): (2, Decimal("3.0000")),
                                  ("I1", 300): (3, Decimal("4.5000"))}
    assert spark.read.parquet(raw).count() == 8
    assert seen.wait(query) and seen.wait(late)
    spark.streams.removeListener(seen)
    # another listener on the same table, after a restart; and a batch that is reported twice
    again = streaming.LateRows(spark, seen.path)
    spark.read.parquet(seen.path).limit(1).write.mode("append").parquet(seen.path)
    assert [r.dropped for r in again.totals().collect()] == [2]


def test_restart_gives_no_duplicates_and_fan_out_is_complete(spark, tmp_path, new_path):
    src = tmp_path / "in"
    paths = {n: new_path(n) for n in ("dead_letters", "raw", "metrics")}
    checkpoints = new_path("c")
    dim = spark.createDataFrame([("I1", "one", "FX", True)],
                                "instrument_id string, instrument_name string, "
                                "asset_class string, is_active boolean")
    cps = spark.createDataFrame([("L", "bank")], "lei_code string, counterparty_name string")

    def drain():
        events = sources.read_event_stream(spark, "text", str(src))
        for q in streaming.start_all(events, dim, cps, paths, checkpoints, ONCE):
            run(q)

    put(src, "1", event(1, 10), "{bad", event(2, 20, "I9"), event(3, 400, eventTimestamp="soon"))
    drain()
    drain()
    put(src, "2", event(4, 30))
    drain()
    raw = {r.trade_id: r for r in spark.read.parquet(paths["raw"]).collect()}
    assert set(raw) == {"E1", "E2", "E3", "E4"}
    assert (raw["E1"].instrument_name, raw["E2"].instrument_name) == ("one", "INSTRUMENT_I9")
    assert raw["E1"].hour == 0 and raw["E3"].event_ts.year > 2024
    dead = spark.read.schema("key string, value string").json(paths["dead_letters"]).collect()
    assert [json.loads(r.value) for r in dead] == [
        {"valid": False, "reason": "Malformed JSON", "raw": "{bad"}]
    lo, hi = "2024-01-01 00:00:15", "2024-01-01 00:00:30"
    assert [r.trade_id for r in sources.replay(spark, paths["raw"], lo, hi).collect()] == ["E2"]


def test_the_source_is_read_by_one_query(spark, tmp_path, new_path):
    src, paths, checkpoints = tmp_path / "in", {n: new_path(n) for n in ("dead_letters", "raw", "metrics")}, new_path("c")
    dim = spark.createDataFrame([], "instrument_id string, instrument_name string, asset_class string, is_active boolean")
    cps = spark.createDataFrame([], "lei_code string, counterparty_name string")
    put(src, "1", event(1, 10), "{bad")

    def start(trigger):
        return streaming.start_all(sources.read_event_stream(spark, "text", str(src)), dim, cps, paths, checkpoints, trigger)

    for q in start(ONCE):
        run(q)
    put(src, "2", event(2, 20), "{worse")
    # a stop between two sinks: the first has landed what the others have not read
    for q in (queries := start({"processingTime": "1 second"})):
        q.processAllAvailable() if q is queries[0] else q.stop()
    queries[0].stop()
    last = [run(q) for q in start(ONCE)]
    read = [{s["description"] for s in q.lastProgress["sources"]} if q.lastProgress else set() for q in last]
    assert [any(str(src) in d for d in r) for r in read[1:]] == [False] * 3
    assert sorted(r.trade_id for r in spark.read.parquet(paths["raw"]).collect()) == ["E1", "E2"]
    assert spark.read.text(paths["dead_letters"]).count() == 2


def test_upsert_from_a_stream_is_repeatable(spark, tmp_path, new_path):
    src, table = tmp_path / "in", new_path("table")
    put(src, "1", event(1, 10), event(1, 10, notional="2"), event(2, 20))
    put(src, "2", event(1, 50, notional="9"), event(2, 5, notional="7"))
    for checkpoint in (new_path("c"), new_path("c")):  # the second run repeats every batch
        valid, _ = valid_stream(spark, src)
        rows = valid.withColumn("asset_class", F.lit("FX"))
        run(streaming.upsert_to_table(rows, table, checkpoint, ONCE))
        got = {r.trade_id: r.notional for r in spark.read.parquet(table).collect()}
        assert got == {"E1": Decimal("9.0000"), "E2": Decimal("1.5000")}


def test_rows_without_a_key_are_set_aside(spark, tmp_path, new_path):
    src, table = tmp_path / "in", new_path("table")
    put(src, "1", event(1, 10), event(2, 20), event(3, 30))
    valid, _ = valid_stream(spark, src)
    rows = valid.withColumns({"asset_class": F.lit("FX"),
                              "event_type": F.when(F.col("trade_id") != "E2", F.lit("NEW"))})
    for checkpoint in (new_path("c"), new_path("c")):
        run(streaming.upsert_to_table(rows, table, checkpoint, ONCE))
        assert {r.trade_id for r in spark.read.parquet(table).collect()} == {"E1", "E3"}
        assert [r.trade_id for r in spark.read.parquet(f"{table}-keyless").collect()] == ["E2"]


def test_redelivered_events_are_dropped(spark, tmp_path, new_path):
    src, out = tmp_path / "in", new_path("once")
    put(src, "1", event(1, 10), event(1, 10), event(1, 11))
    put(src, "2", event(1, 10), event(2, 12))
    valid, _ = valid_stream(spark, src)
    run(streaming.drop_redelivered(valid).select("trade_id", "event_ts").writeStream
        .format("parquet").option("path", out).option("checkpointLocation", new_path("c"))
        .trigger(**ONCE).start())
    assert spark.read.parquet(out).count() == 3
