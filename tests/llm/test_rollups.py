from collections import Counter

import public_tokenizers as public
import pytest
import tiktoken
from brute import SF
from pyspark.sql import functions as F

from tradelake.llm import bpe, queries, rollups

VERSIONS = {n: (public.path(n), public.PATTERN) for n in queries.TOKENIZERS}


def library(name):
    ranks = bpe.Vocabulary(bpe.read_ranks(public.path(name))).ranks
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def brute(rows):
    docs, tokens = Counter(), Counter()
    for name in VERSIONS:
        own = library(name)
        for source, lang, text in rows:
            docs[source, lang, name] += 1
            tokens[source, lang, name] += len(own.encode_ordinary(text or ""))
    return {(*k, docs[k], tokens[k]) for k in docs}


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("source", "lang", "text").collect()]
    whole = brute(rows)
    gone = {x for x in whole if x[0] == "src1" and x[1] != "de"}
    renamed = {x for x in whole if x[0] == "src0" and x[2] == queries.TOKENIZERS[0]}
    assert gone and renamed
    want = (whole - gone - renamed) | {("renamed", *x[1:]) for x in renamed}
    assert {tuple(r) for r in queries.op5_token_counts(spark, SF).collect()} == want


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    docs = odd_docs.withColumn("source", F.when(F.col("n_chars") % 3 == 0, None).otherwise(F.col("source")))
    totals = rollups.Rollup(spark)
    assert totals.totals().collect() == []
    assert totals.commit("none", rollups.inserted(rollups.count_tokens(no_docs, VERSIONS)))
    assert totals.totals().collect() == []
    assert totals.commit("all", rollups.inserted(rollups.count_tokens(docs, VERSIONS)))
    want = brute([(None if n % 3 == 0 else "s", "en", t) for n, (_, t) in enumerate(odd_rows)])
    assert {tuple(r) for r in totals.totals().collect()} == want


def test_batches_count_once(spark):
    def change(*rows):
        return spark.createDataFrame(rows, "doc_id long, source string, lang string, version string, n_tokens long")

    totals = rollups.Rollup(spark)
    assert totals.commit("a", rollups.inserted(change((1, "s", "en", "v", 5), (2, "s", "en", "v", 7))))
    assert not totals.commit("a", rollups.inserted(change((1, "s", "en", "v", 5), (2, "s", "en", "v", 7))))
    # an attempt that broke off before its entry in the log leaves files that nobody reads
    change((9, "s", "en", "v", 99)).write.parquet(f"{totals.path}/deltas/broken")
    assert totals.commit("b", rollups.revised(change((2, "s", "en", "v", 7)), change((2, "t", "en", "w", 8))))
    want = {("s", "en", "v", 1, 5), ("t", "en", "w", 1, 8)}
    assert {tuple(r) for r in totals.totals().collect()} == want
    totals.compact()
    assert {tuple(r) for r in totals.totals().collect()} == want
    assert not totals.commit("b", rollups.deleted(change((1, "s", "en", "v", 5))))
    assert totals.commit("c", rollups.deleted(change((1, "s", "en", "v", 5))))
    assert {tuple(r) for r in totals.totals().collect()} == {("t", "en", "w", 1, 8)}


def test_a_compacted_rollup_is_the_same_for_all_who_open_it(spark, monkeypatch):
    def change(*rows):
        return rollups.inserted(spark.createDataFrame(rows, "doc_id long, source string, lang string, version string, n_tokens long"))

    one = rollups.Rollup(spark)
    one.commit("a", change((1, "s", "en", "v", 5)))
    one.compact()
    one.commit("b", change((2, "s", "en", "v", 7)))
    other = rollups.Rollup(spark, one.path)
    assert other.committed("a") and other.committed("b") and not other.commit("b", change((2, "s", "en", "v", 7)))
    assert [tuple(r) for r in other.totals().collect()] == [("s", "en", "v", 2, 12)]
    # a break before the new generation is made current: it counts for nobody, and the next one takes its place
    with monkeypatch.context() as m:
        m.setattr(rollups.Rollup, "_make_current", lambda *a: (_ for _ in ()).throw(OSError()))
        with pytest.raises(OSError):
            other.compact()
    one.commit("c", change((3, "t", "en", "v", 1)))
    other.compact()
    one.commit("d", change((4, "t", "en", "v", 1)))
    assert {tuple(r) for r in rollups.Rollup(spark, one.path).totals().collect()} == {("s", "en", "v", 2, 12), ("t", "en", "v", 2, 2)}
