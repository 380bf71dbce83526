from collections import Counter

import brute
import numpy as np
import pyarrow as pa
from brute import SF

from tradelake.llm import bytetext as bt
from tradelake.llm import queries, substrings

def found(df):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept, tuple((s.start, s.end) for s in r.spans))
                   for r in df.collect())

def test_against_brute_force(odd_docs, odd_rows):
    want = Counter((i, n, k, t, tuple(s)) for i, n, k, t, s in brute.substrings(odd_rows))
    got = found(substrings.repeated_windows(odd_docs))
    assert got == want
    assert sum(x[2] > 0 for x in got) > 10

def test_empty_table(no_docs):
    assert substrings.repeated_windows(no_docs).collect() == []

def test_other_window(odd_docs, odd_rows):
    want = Counter((i, n, k, t, tuple(s)) for i, n, k, t, s in brute.substrings(odd_rows, 4))
    assert found(substrings.repeated_windows(odd_docs, 4)) == want

def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = {(i, n, k, brute.sha(t)) for i, n, k, t, _ in brute.substrings(rows)}
    assert {tuple(r) for r in queries.op6_substring_dedup(spark, SF).collect()} == want


def test_hashes_of_ranges(monkeypatch):
    """Equal bytes have equal hashes wherever they lie, and the sums are those of the definition."""
    r = np.random.default_rng(3)
    data = r.integers(0, 256, 300_000).astype(np.uint8)
    cuts = np.unique(np.concatenate((r.integers(0, 200_000, 3000), [0, 210_000, 300_000])))
    starts, ends = cuts[:-1], cuts[1:]
    got = bt.range_hashes(data, starts, ends)
    assert len(set(got.tolist())) == len({data[i:j].tobytes() for i, j in zip(starts, ends)})
    for k in range(0, len(starts), 97):
        raw = data[starts[k]:ends[k]]
        if len(raw) <= bt.LONG_RANGE:
            assert int(got[k]) == sum((int(c) + 1) * pow(bt.BASE, i, bt.PRIME) for i, c in enumerate(raw)) % bt.PRIME
        moved = np.concatenate((data[:777], raw, data[:50]))
        assert bt.range_hashes(moved, np.array([3, 777]), np.array([777, 777 + len(raw)]))[1] == got[k]
    assert (ends - starts).max() > bt.LONG_RANGE
    monkeypatch.setattr(bt, "SEGMENT", 1000)
    assert (bt.range_hashes(data, starts, ends) == got).all()


def test_words_that_collide_modulo_a_power_of_two():
    odd = ["".join("ab"[bin(i).count("1") % 2 ^ turn] for i in range(1024)) for turn in (0, 1)]
    assert len(set(bt.Words(pa.array(odd)).hashes().tolist())) == 2
