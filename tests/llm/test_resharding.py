import itertools
import random
import zlib
from collections import Counter

import pytest
from brute import SF
from pyspark.sql import functions as F

from tradelake.llm import queries, resharding


@pytest.mark.parametrize("seed", range(30))
def test_flow_moves_the_fewest_bytes(seed):
    r = random.Random(seed)
    n, m = r.randrange(1, 6), r.randrange(1, 6)
    supply = [r.randrange(0, 100) for _ in range(n)]
    capacity = [r.randrange(0, 60) for _ in range(m)]
    capacity[0] += max(0, sum(supply) - sum(capacity))
    flow = resharding.min_cost_flow(supply, capacity)
    assert all(sum(f for (a, _), f in flow.items() if a == i) == s for i, s in enumerate(supply))
    assert all(sum(f for (_, b), f in flow.items() if b == j) <= c for j, c in enumerate(capacity))
    stay = sum(min(s, c) for s, c in zip(supply, capacity))  # nothing can keep more in place
    assert sum(f for (i, j), f in flow.items() if i != j) == sum(supply) - stay


def dealt(df, *more):
    size = resharding.size_of(F.col("text")).alias("size")
    return resharding.slots(df.select("doc_id", "text", size, "old_shard", "shard", "block", "base"), "doc_id", "text").collect()


def test_odd_rows(odd_docs, odd_rows):
    docs = odd_docs.withColumn("old_shard", F.when(F.col("n_chars") % 5 == 0, None).otherwise(F.col("n_chars") % 3))
    got = dealt(resharding.reshard(docs, 4))
    assert Counter((r.doc_id, r.text) for r in got) == Counter(odd_rows)
    assert all(r.size == len((r.text or "").encode()) + 1 for r in got)
    for j in range(4):
        assert sorted(r.slot for r in got if r.shard == j) == list(range(sum(r.shard == j for r in got)))
    load = [sum(r.size for r in got if r.shard == j) for j in range(4)]
    assert max(load) - min(load) <= max(r.size for r in got)


def test_shards_that_do_not_change_are_not_written(spark, odd_docs, new_path):
    docs = odd_docs.withColumn("old_shard", F.col("n_chars") % 3)
    size = {r.old_shard: r.s for r in docs.groupBy("old_shard").agg(F.sum(resharding.size_of(F.col("text"))).alias("s")).collect()}
    path = new_path()
    got = dealt(resharding.reshard(docs, 3, [size[0], size[1], size[2]], path=path))
    assert all(r.shard == r.old_shard for r in got) and len(got) == docs.count()
    path = new_path()
    moved = dealt(resharding.reshard(docs, 4, [size[0], size[1], size[2] // 2, size[2] - size[2] // 2], path=path))
    assert spark.read.parquet(path).select("shard").distinct().count() < 4 and len(moved) == len(got)


@pytest.mark.parametrize("old", [9, 10, 12])
def test_more_old_shards_than_new_with_one_untouched(spark, old, new_path):
    docs = spark.range(old * 40).select(F.col("id").alias("doc_id"), F.lpad(F.col("id").cast("string"), 9, "x").alias("text"),
                                        (F.col("id") % old).alias("old_shard"))
    share, more = divmod((old - 1) * 400, 7)  # 40 rows of 10 bytes a shard; the first one is at its capacity
    path = new_path()
    got = dealt(resharding.reshard(docs, 8, [400, *(share + (j < more) for j in range(7))], path=path))
    assert sorted(r.doc_id for r in got) == list(range(old * 40))
    assert {r.doc_id for r in got if r.shard == 0} == set(range(0, old * 40, old))
    assert {r.shard for r in spark.read.parquet(path).select("shard").distinct().collect()} == set(range(1, 8))


def test_equal_rows_are_dealt_evenly(spark):
    docs = spark.range(1600).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same text").alias("text"), F.lit(0).alias("old_shard"))
    got = resharding.slots(resharding.reshard(docs, 8), "doc_id", "text").collect()
    shards = {j: sorted(r.slot for r in got if r.shard == j) for j in range(8)}
    assert all(abs(len(s) - 200) <= 1 and s == list(range(len(s))) for s in shards.values())


def test_columns_of_files_and_names_that_clash(spark, new_path):
    path = new_path()
    spark.range(200).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("p").alias("path"), F.lit(7).alias("old_shard"),
                            F.lit("x").alias("PATH_")).repartition(3).write.parquet(path)
    docs = resharding.file_shards(spark.read.parquet(path))
    assert docs.count() == 200 and {r.old_shard for r in docs.collect()} == {0, 1, 2}
    assert docs.select("path").distinct().collect() == [("p",)]
    got = resharding.reshard(docs, 4, row=resharding.ROW_IN_FILE).collect()
    assert len(got) == 200 and len({r.shard for r in got}) == 4


def test_very_many_old_shards(spark):
    """The flow has as many nodes as there are new shards, however many old ones there are."""
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lpad(F.col("id").cast("string"), 9, "x").alias("text"),
                                      (F.col("id") % 15_000).alias("old_shard"))
    got = resharding.reshard(docs, 8, row="doc_id")
    sizes = {r.shard: r.n for r in got.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    assert sum(sizes.values()) == 30_000 and max(sizes.values()) - min(sizes.values()) <= 2


def test_empty_table(no_docs):
    assert resharding.slots(resharding.reshard(no_docs.withColumn("old_shard", F.lit(0)), 8), "doc_id").collect() == []


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op4_resharding(spark, SF).collect()
    assert Counter(r.doc_id for r in got) == Counter(list(texts))
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
    shards = {j: list(g) for j, g in itertools.groupby(sorted(got, key=lambda r: (r.shard, r.slot)), key=lambda r: r.shard)}
    assert list(shards) == list(range(8)) and all([r.slot for r in g] == list(range(len(g))) for g in shards.values())
    load = [sum(r.size for r in g) for g in shards.values()]
    assert max(load) - min(load) <= max(r.size for r in got)
