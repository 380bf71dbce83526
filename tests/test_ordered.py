"""Passes along the order of a key's rows: however the ranges fall, the result is that of one sorted list."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tradelake import dims, enrich
from tradelake.operators import ordered

START = dt.datetime(2024, 1, 1)


@pytest.fixture(params=[(1, 10_000), (4, 7), (13, 1)])
def ranges(request, spark):
    """Numbers of ranges, and of rows in a batch within a range."""
    partitions, rows = request.param
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def changes(seed, n, values):
    """A hot key inside one day, others, and keys or times that are null."""
    r = random.Random(seed)
    keys = ["hot"] * 8 + list("abcdefgh") + [None]
    return [(r.choice(keys), START + dt.timedelta(minutes=r.randrange(1440)) if r.random() < 0.97 else None, r.choice(values), r.randrange(2))
            for _ in range(n)]


def scd2_by_hand(rows):
    out, by_key = [], {}
    for k, t, v, w in rows:
        if k is not None and t is not None:
            at = by_key.setdefault(k, {})
            at[t] = max(at.get(t, (v, w)), (v, w), key=lambda s: (s[0] is not None, s[0] or "", s[1]))
    for k, at in by_key.items():
        states = [(t, at[t]) for i, t in enumerate(sorted(at)) if i == 0 or at[sorted(at)[i - 1]] != at[t]]
        for i, (t, (v, w)) in enumerate(states):
            end = states[i + 1][0] if i + 1 < len(states) else None
            out.append((k, v, w, t, end, end is None))
    return sorted(out, key=str)


@pytest.mark.parametrize("n, values", [(400, ["x", "y", None]), (300, ["x"]), (3, ["x", "y"]), (0, ["x"])])
def test_versions_equal_one_sorted_list(spark, ranges, n, values):
    rows = changes(n, n, values)
    df = spark.createDataFrame(rows, "k string, changed_at timestamp, v string, w int")
    got = dims.build_scd2(df, "k", ["v", "w"])
    assert sorted(map(tuple, got.collect()), key=str) == scd2_by_hand(rows)


def test_one_state_over_many_ranges_is_one_version(spark, ranges):
    rows = [("k", START + dt.timedelta(minutes=i), "x", 0) for i in range(200)] + [("k", START + dt.timedelta(days=1), "y", 0)]
    df = spark.createDataFrame(rows, "k string, changed_at timestamp, v string, w int")
    assert sorted(map(tuple, dims.build_scd2(df, "k", ["v"]).collect())) == [
        ("k", "x", START, START + dt.timedelta(days=1), False), ("k", "y", START + dt.timedelta(days=1), None, True)]


def test_next_rows(spark, ranges):
    rows = sorted({(k, t) for k, t, _, _ in changes(5, 300, ["x"]) if t is not None}, key=str)
    df = spark.createDataFrame([(t, k, i) for i, (k, t) in enumerate(rows)], "t timestamp, k string, n int")
    want = {(t, k, i, min((u for key, u in rows if key == k and u > t), default=None)) for i, (k, t) in enumerate(rows)}
    got = ordered.with_next(df, "k", "t", "after")
    assert got.columns == ["t", "k", "n", "after"] and {tuple(r) for r in got.collect()} == want


def test_places_have_no_gaps(spark, ranges):
    rows = [(k, t, v) for k, t, v, _ in changes(6, 500, ["x", "y"])] + [("hot", START, "z")] * 150 + [(None, None, "z")] * 50
    df = spark.createDataFrame(rows, "k string, t timestamp, v string")
    got = ordered.with_place(df, "k", ["t"], "place").collect()
    assert sorted(((r.k, r.t, r.v) for r in got), key=str) == sorted(rows, key=str)
    by_key = {}
    for r in got:
        by_key.setdefault(r.k, []).append((r.place, r.t))
    for places in by_key.values():
        assert sorted(p for p, _ in places) == list(range(1, len(places) + 1))
        times = [(t is not None, t or START) for _, t in sorted(places, key=lambda p: p[0])]
        assert times == sorted(times)


def asof_by_hand(facts, versions):
    out = []
    for k, t, n in facts:
        found = [(f, v) for key, f, u, v in versions if key is not None and key == k and t is not None and f <= t and (u is None or t < u)]
        out.append((k, t, n, found[0][1] if found else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("n_facts, n_versions", [(500, 60), (300, 0), (0, 50), (50, 900)])
def test_as_of(spark, ranges, n_facts, n_versions):
    r = random.Random(n_facts)
    keys = ["hot"] * 6 + list("abcde") + [None]
    minute = lambda: START + dt.timedelta(minutes=r.randrange(2000))
    facts = [(r.choice(keys), r.choice([START, START + dt.timedelta(days=1), minute(), minute(), None]), i) for i in range(n_facts)]
    starts = sorted({(r.choice(keys), minute()) for _ in range(n_versions)}, key=str)
    versions = []
    for k, f in starts:
        after = min((g for key, g in starts if key == k and g > f), default=None)
        end = r.choice([after, after, f + dt.timedelta(minutes=1) if after is None or after > f + dt.timedelta(minutes=1) else after])
        versions.append((k, f, end, f"v{len(versions)}"))
    df = spark.createDataFrame(facts, "k string, t timestamp, n int")
    dim = spark.createDataFrame(versions, "id string, valid_from timestamp, valid_to timestamp, name string")
    want = asof_by_hand(facts, versions)
    carried = enrich.asof_carried(df, dim, "k", "t", ["name"], dim_key="id")
    assert sorted(map(tuple, carried.collect()), key=str) == want
    assert sorted(map(tuple, enrich.asof_dim(df, dim, "k", "t", ["name"], dim_key="id", small=True).collect()), key=str) == want


@pytest.mark.parametrize("n, m", [(300, 40), (0, 20), (50, 0), (40, 400)])
def test_full_match(spark, ranges, n, m):
    r = random.Random(n + m)
    keys = ["hot"] * 200 + [f"k{i}" for i in range(60)] + [None]
    facts = [(r.choice(keys), r.randrange(5)) for _ in range(n)]
    known = sorted({(r.choice(["hot", *(f"k{i}" for i in range(500))]), i) for i in range(m)})
    known = [(k, i) for j, (k, i) in enumerate(known) if j == 0 or known[j - 1][0] != k] + [(None, -1)] * (m > 0)
    out = ordered.full_match(spark.createDataFrame(facts, "k string, a int"), "k", spark.createDataFrame(known, "id string, b int"), "id")
    by_key = {k: b for k, b in known if k is not None}
    want = [((k, a), (k, by_key[k]) if k in by_key else None) for k, a in facts]
    want += [(None, (k, b)) for k, b in known if k is None or k not in {f for f, _ in facts}]
    got = [(x.row and tuple(x.row), x.found and tuple(x.found)) for x in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def task_rows(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_a_key_with_many_versions_and_a_third_of_all_facts(spark):
    """100,000 versions of one key: no range has more than its share, and every fact meets one version."""
    second = F.timestamp_seconds(F.lit(1704067200) + F.col("id"))
    dim = spark.range(100_000).select(F.lit("HOT").alias("k"), second.alias("valid_from"),
                                      (second + F.expr("INTERVAL 1 SECOND")).alias("valid_to"), F.col("id").alias("v"))
    facts = spark.range(150_000).select(F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("I"), F.col("id") % 97)).alias("k"),
                                        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 90_000).alias("t"), "id")
    got = enrich.asof_carried(facts, dim, "k", "t", ["v"])
    assert got.filter("k = 'HOT' AND v = id % 90000").count() == 50_000 and got.filter("v IS NULL").count() == 100_000
    rows = ordered.in_ranges(facts.select("k", "t").union(dim.select("k", "valid_from")), ["k", "t"])
    assert max(task_rows(rows)) < 2 * 250_000 / 4


def test_hot_key_inside_one_day_is_spread(spark):
    df = spark.range(40_000).select(F.lit("HOT").alias("k"), F.timestamp_millis(F.lit(1704067200000) + F.col("id")).alias("changed_at"),
                                    F.floor(F.col("id") / 3).alias("v"))
    versions = dims.build_scd2(df, "k", ["v"])
    assert versions.count() == 13_334 and versions.filter("is_active").count() == 1
    assert max(task_rows(ordered.in_ranges(df, ["k", "changed_at"]))) < 2 * 40_000 / 4
    plan = versions._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") <= 3
