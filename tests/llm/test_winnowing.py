from collections import Counter

import brute
import pytest
from brute import SF
from compare import compare, duck

from tradelake.llm import queries, winnowing


@pytest.fixture
def items(spark, odd_rows):
    text = [t for _, t in odd_rows if t and len(t) > 300][0]
    w = text.split()
    rows = [(1, " ".join(w[:40])), (10, " ".join(w[20:60]).upper()), (2, "edit"), (3, "l0, M"), (4, None), (5, "!!"), (6, ""),
            (None, " ".join(w[5:30])), (7, "a b c d e f"), (7, "a b c d e f"), (8, "É é日本 x")]
    return spark.createDataFrame(rows, "item_id long, text string")


def found(df):
    return Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids), r.contaminated, tuple((s.start, s.end) for s in r.hits))
                   for r in df.collect())


def test_against_brute_force(odd_docs, odd_rows, items):
    known = [tuple(r) for r in items.collect()]
    got = found(winnowing.contamination(odd_docs, items))
    assert got == Counter(brute.contamination(r, known) for r in odd_rows)
    assert sum(x[2] > 0 for x in got) > 5


def test_empty_tables(odd_docs, no_docs, items):
    assert winnowing.contamination(no_docs, items).collect() == []
    assert all(r.n_hit == 0 and not r.contaminated for r in winnowing.contamination(odd_docs, items.limit(0)).collect())


def test_query_against_sql(spark):
    assert compare("op3", queries.op3_decontamination(spark, SF), duck(SF), queries.OP3_SQL) is None


def test_no_python(odd_docs, items):
    plan = winnowing.contamination(odd_docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
