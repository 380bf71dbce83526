"""Every registered query against its SQL in DuckDB, on the smallest test tables."""

import os

import pytest
from compare import compare, duck

import __spark_entry__ as entry
from tradelake import session
from tradelake.plans import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    """All but the text operators, which have tests of their own."""
    assert set(entry.QUERIES) == set(entry.ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.ORACLE))
def test_query(spark, con, name):
    assert compare(name, entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


def test_entry_and_no_python_workers(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan[plan.index("== Physical Plan =="):]


def test_compaction_table_is_written_by_more_tasks_for_more_input(spark, monkeypatch):
    from tradelake.plans import queries
    monkeypatch.setattr(queries, "COMPACT_TASK_BYTES", 10_000)
    files = entry.queries()["compact_preserves_rows"](spark, SF).inputFiles()
    assert len({f.rpartition("/")[2][:10] for f in files if "trade_date=1995" in f}) > 6


def test_quarantine_is_computed_once_for_both_writes(spark, monkeypatch):
    from tradelake import sinks
    read, write = [], sinks.write_quarantine
    monkeypatch.setattr(sinks, "write_quarantine", lambda df, *rest: read.append(df.inputFiles()) or write(df, *rest))
    assert entry.queries()["quarantine_layout"](spark, SF).count() > 0
    assert len(read) == 2 and read[0] == read[1] and not [f for f in read[0] if "lineitem" in f]


def test_the_fact_is_moved_for_large_tables_before_small_ones_widen_it(spark):
    plan = entry.queries()["fct_trades"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("c_name#") < plan.index("p_brand#") < plan.index("s_name#")  # the side of the first lookup comes first


def _staged(spark, name, monkeypatch):
    """The result of a query on small tables, and the names of what it stores on its way."""
    names = []
    monkeypatch.setattr(queries, "stage", lambda df, name="stage", *rest, do=queries.stage: names.append(name) or do(df, name, *rest))
    return queries.QUERIES[name](spark, SF), names


@pytest.mark.parametrize("name", ["fct_trades", "fct_trades_current_dims"])
def test_fact_is_looked_up_from_stored_trades(spark, name, monkeypatch):
    fact, names = _staged(spark, name, monkeypatch)
    plan = fact._jdf.queryExecution().analyzed().toString()
    assert names == ["trades"] and "Window" not in plan  # the dedup and its shuffles are over


@pytest.mark.parametrize("name, stored", [("sorted_layout", ["trades", "fact"]), ("bucketed_layout", ["trades", "fact", "bucketed"]),
                                          ("compact_preserves_rows", ["trades"])])
def test_layouts_store_rows_between_their_moves(spark, name, stored, monkeypatch):
    assert _staged(spark, name, monkeypatch)[1] == stored


def test_ledger_packs_what_it_stores(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    queries.QUERIES["confirmation_ledger"](spark, SF)
    for name in ("csv-chunks", "csv-records", "confirmations", "messages"):
        files = [f.name for f in tmp_path.glob(f"{name}-[0-9a-f]*/*.parquet")]
        assert files and all(".zstd." in f for f in files), name
