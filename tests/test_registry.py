"""Every registered query against its SQL counterpart, on whole tables of the smallest data set."""

import pytest

import __spark_entry__ as entry
import oracle
from sluiceway.registry import all_queries, base, state

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_query_has_sql():
    assert set(all_queries()) <= set(entry.queries()) & set(entry.oracle_sql())


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert rows and {"_BATCH_ID", "metric", "passed"} <= set(rows[0].asDict())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_matches_sql(spark, con, name):
    result = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in result.collect()]
    assert rows, "no rows to compare"
    assert oracle.compare(rows, result.columns, entry.oracle_sql()[name], con) is None


@pytest.mark.parametrize(("name", "files"), [("quoted_comma_headers", 6), ("header_only_files", 4)])
def test_preparation_writes_in_parallel(spark, con, monkeypatch, name, files):
    table, load, seen = base.table, state.load_csv, []
    monkeypatch.setattr(base, "table", lambda *a: table(*a).repartition(3))
    monkeypatch.setattr(state, "load_csv", lambda spark, mirror, paths, *a, **k: seen.append(len(paths)) or load(spark, mirror, paths, *a, **k))
    result = entry.queries()[name](spark, SF)
    assert oracle.compare([tuple(r) for r in result.collect()], result.columns, entry.oracle_sql()[name], con) is None
    assert seen == [files]


def test_a_profile_meets_repeated_keys(spark):
    rows = entry.queries()["batch_profile_repeats"](spark, SF).collect()
    assert rows and all(0 < r["distinct_keys"] < r["total_rows"] for r in rows)
