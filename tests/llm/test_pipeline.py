from collections import Counter

import brute
import numpy as np
import public_tokenizers
import tiktoken
from brute import SF
from pyspark.sql import functions as F

import corpus_pipeline
from tradelake.llm import bpe, queries


def expected(rows, items):
    """(doc_id, lang, source, ids) after all stages, for rows of (doc_id, text, lang, source, n_chars)."""
    def good(row):
        _, n, chars, symbols, lines, _, failed = brute.counts(row)
        return not (failed or symbols > n or 10 * lines > n or chars < 2 * n or chars > 20 * n)

    rows = [r for r in rows if good(r)]
    heads, seen, kept = brute.groups([r[:2] for r in rows]), set(), []
    texts = {}
    for row, (doc_id, class_id, _) in zip(rows, heads):
        texts.setdefault(class_id, set()).add(row[1] or "") if doc_id == class_id else None
    for row, (doc_id, class_id, _) in zip(rows, heads):
        if doc_id == class_id and class_id not in seen:
            seen.add(class_id)
            kept.append(row)
    cut = brute.substrings([r[:2] for r in kept])
    rows = [(i, text if n else row[1], *row[2:]) for row, (i, words, n, text, _) in zip(kept, cut) if not (n and n == words)]
    rows = [r for r in rows if not brute.contamination(r[:2], items)[4]]
    own = bpe.Vocabulary(bpe.read_ranks(queries.ranks_path()))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    return Counter((r[0], r[2], r[3], tuple(library.encode_ordinary(r[1] or ""))) for r in rows)


def found(df):
    got = df.collect()
    assert all(r.ids_sha256 == brute.sha(np.array(r.tokens, "<u4").tobytes()) and r.n_tokens == len(r.tokens) for r in got)
    return Counter((r.doc_id, r.lang, r.source, tuple(r.tokens)) for r in got)


def test_against_brute_force(spark):
    columns = corpus_pipeline.COLUMNS
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*columns).collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = expected(rows, items)
    assert found(corpus_pipeline.run(spark, SF)) == want and 0 < len(want) < len(rows)


def test_stages_on_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for n, (name, function) in enumerate(corpus_pipeline.STAGES):
            out = function(spark, docs, SF)
            assert n == 4 or out.columns == corpus_pipeline.COLUMNS, name
            assert (out.count() > 0) == (docs is odd_docs), name


def test_stages_keep_rows_that_nothing_speaks_against(spark):
    texts = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(20)]
    docs = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for name, function in corpus_pipeline.STAGES[:4]:
        assert sorted(map(tuple, function(spark, docs, SF).collect())) == sorted(map(tuple, docs.collect())), name
    out = corpus_pipeline.STAGES[4][1](spark, docs, SF)
    assert out.join(docs, "doc_id").filter(F.col("decoded_sha256") == F.sha2("text", 256)).count() == 20
