from collections import Counter

import brute
import numpy as np
import pyarrow as pa
from brute import SF
from pyspark.sql import functions as F

from tradelake.llm import minhash, queries


def test_sketch_estimates_probability_jaccard():
    a = " ".join(f"w{i % 70}" for i in range(300))
    b = " ".join(f"w{i % 70 if i < 240 else i}" for i in range(310))
    s = minhash.Shingles(pa.array([a, b, "", a, None, "one"]))
    exact = brute.probability_jaccard(brute.shingles(a), brute.shingles(b))
    own = minhash.similarity(minhash.Shingles(pa.array([a, a, ""])), minhash.Shingles(pa.array([b, a, ""])))
    assert abs(own[0] - exact) < 1e-9 and abs(own[1] - 1) < 1e-9 and own[2] == 0
    sig = minhash.signatures(s, 4096)
    assert abs((sig[0] == sig[1]).mean() - exact) < 4 * np.sqrt(exact * (1 - exact) / 4096)
    assert (sig[0] == sig[3]).all() and not sig[2].any() and not sig[4].any() and sig[5].all()


def test_against_brute_force(odd_docs, odd_rows):
    got = minhash.near_duplicates(odd_docs).collect()
    assert Counter((r.doc_id, r.class_id, r.copies) for r in got) == Counter(brute.groups(odd_rows))
    firsts = Counter((r.doc_id, r.class_id) for r in got if r.first)
    assert {c for _, c in firsts} == {r.class_id for r in got} and all(d == c for d, c in firsts)


def test_empty_table(no_docs):
    assert minhash.near_duplicates(no_docs).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(500, 300), (300, 400), (-5, 500)]
    got = {r.key: r.group for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 160)}, 500: -5, 300: -5, 400: -5, -5: -5}
    assert got == want


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op2_minhash_dedup(spark, SF)
    assert Counter(tuple(r) for r in got.select("doc_id", "class_id", "copies").collect()) == Counter(brute.groups(rows))
    assert got.filter("first").count() == got.agg(F.countDistinct("class_id")).first()[0]
