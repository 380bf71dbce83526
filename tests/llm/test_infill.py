import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from brute import SF, sha
from pyspark.sql import functions as F

from tradelake.llm import bytetext as bt
from tradelake.llm import infill, queries

P, S, M = "<P>", "<S>", "<M>"


def by_hand(doc_id, text, rate=100):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(lines)
    if not text or P in text or S in text or M in text or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h4 % 100 < 50:
        return doc_id, n, "spm", len(prefix), len(middle), S + suffix + P + prefix + M + middle
    return doc_id, n, "psm", len(prefix), len(middle), P + prefix + S + suffix + M + middle


def texts():
    r = random.Random(5)
    line = lambda: "".join(r.choice("ab é日😀<>PSM ") for _ in range(r.randrange(0, 90)))
    shared = "\n".join(line() for _ in range(60))
    out = ["", "\n", "a", "a\n", "\n\na", "<P", "a<S>b\nc", "\n<M>", "é" * 9000 + "\nx", "\n" * 5000, "<P><" * 40, "x" * 64 + "<S" + ">", None]
    out += ["\n".join(line() for _ in range(r.randrange(1, 50))) for _ in range(150)]
    out += [f"{line()}\n{shared}\n{line()}" for _ in range(30)]
    return out + ["y" * k + "<M>" + "z" * 70 for k in range(50, 150)]  # marks at every place of a border


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_equals_cuts_by_hand_and_restores(spark):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    out = infill.infilled(docs)
    assert rows(out) == Counter(by_hand(i, t) for i, t in enumerate(texts()))
    whole = out.select("doc_id", infill.restored(F.col("output"), F.col("form")).alias("t")).collect()
    assert {r.doc_id: r.t for r in whole} == {i: t or "" for i, t in enumerate(texts())}
    assert {r[2] for r in rows(out)} == {"psm", "spm", "plain"}


def test_a_rate_leaves_texts_plain(spark):
    docs = spark.createDataFrame([(i, "a\nb\nc") for i in range(300)], "doc_id long, text string")
    got = rows(infill.infilled(docs, rate=30))
    assert got == Counter(by_hand(i, "a\nb\nc", 30) for i in range(300))
    assert 50 < sum(r[2] != "plain" for r in got) < 130


def test_odd_rows(odd_docs, odd_rows):
    assert rows(infill.infilled(odd_docs)) == Counter(by_hand(i, t) for i, t in odd_rows)


def test_empty_table(no_docs):
    assert infill.infilled(no_docs).collect() == []


def test_marks_that_cannot_be_told_apart():
    with pytest.raises(ValueError):
        infill.infilled(None, marks=("<P>", "<P>", "<M>"))


def test_shared_passages_give_shared_chunks():
    r = random.Random(1)
    noise = lambda n: "".join(r.choice("abcdefgh \n") for _ in range(n))
    passage = noise(20_000)
    data, offsets = bt.text_bytes(pa.array([noise(777) + passage, noise(1234) + passage + noise(50)]))
    ends = infill.chunk_ends(data, offsets)
    cut = [{data[i:j].tobytes() for i, j in zip([int(start), *own], own)} for start, own in zip(offsets, ends)]
    assert sum(map(len, cut[0] & cut[1])) > 18_000
    lengths = np.diff([0, *ends[0]])
    assert lengths[:-1].min() >= infill.LEAST and lengths.max() <= infill.MOST


def test_equal_hashes_are_compared_and_the_cache_is_bounded(monkeypatch):
    cache = infill.Cache([b"<P>"])
    a, b = cache.of(1, b"x\ny\n"), cache.of(1, b"<P>z")
    assert (a.line_ends.tolist(), a.marked) == ([2, 4], False) and (b.points, b.marked) == (4, True)
    assert cache.of(1, b"x\ny\n") is a
    monkeypatch.setattr(infill, "CACHED_BYTES", 1000)
    for i in range(50):
        cache.of(i, b"%d" % i)
    assert len(cache.known) < 10


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = {(*(r := by_hand(i, t))[:5], sha(r[5]), sha(t or "")) for i, t in docs}
    assert {tuple(r) for r in queries.op11_infill(spark, SF).collect()} == want
