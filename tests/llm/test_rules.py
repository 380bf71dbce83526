from collections import Counter

import brute
from brute import SF
from compare import compare, duck
from pyspark.sql import functions as F

from tradelake.llm import queries, rules


def test_counts_against_brute_force(odd_docs, odd_rows):
    got = Counter(tuple(r)[:-1] for r in rules.counted(odd_docs).drop("kept").collect())
    assert Counter(tuple(r) for r in rules.counted(odd_docs).drop("kept").collect()) == Counter(brute.counts(r) for r in odd_rows)
    assert len(got) > 10


def test_query_against_sql(spark):
    assert compare("op9", queries.op9_quality_rules(spark, SF), duck(SF), queries.OP9_SQL) is None


def test_order_changes_the_cost_not_the_verdict(odd_docs):
    text = rules.from_text(F.col("text"))
    one, other = rules.cascade(text, rules.DEFAULT), rules.cascade(text, rules.DEFAULT[::-1])
    got = odd_docs.select(one.alias("a"), other.alias("b")).collect()
    assert all((r.a is None) == (r.b is None) for r in got)
    assert {r.a for r in got} >= {None, "few_words", "repeated_words"}


def test_rules_run_by_rejections_per_cost():
    cheap, dear, idle = (rules.Measured(rules.Rule(n, None), s, r) for n, s, r in
                         (("cheap", 1.0, 0.1), ("dear", 10.0, 0.5), ("idle", 0.1, 0.0)))
    assert [r.name for r in rules.ordered([idle, dear, cheap])] == ["cheap", "dear", "idle"]


def test_judged_keeps_columns_and_empty_tables(odd_docs, no_docs):
    assert rules.judged(odd_docs).columns == [*odd_docs.columns, "rejected_by"]
    assert rules.judged(no_docs).collect() == [] and rules.counted(no_docs).collect() == []


def test_no_python(odd_docs):
    plan = rules.judged(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
