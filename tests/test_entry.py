import importlib
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_stands_without_the_subpackage(monkeypatch):
    monkeypatch.setitem(sys.modules, "lectern.llm", None)
    try:
        alone = importlib.reload(entry)
        assert "p3_found" in alone.queries() and "p1_found" not in alone.queries()
    finally:
        monkeypatch.undo()
        importlib.reload(entry)


@pytest.mark.skipif(not DATA.exists(), reason="no test data here")
@pytest.mark.parametrize("name", ["token_counts", "page_base", "latest_versions", "vector_topk", "structured_rollup", "chunk_statistics", "time_budgets", "activity_islands"])
def test_results_equal_sql(spark, name):
    db = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        db.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    expected = db.sql(entry.oracle_sql()[name])
    got = entry.queries()[name](spark, str(DATA))
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    plain = lambda rows: sorted([tuple(str(round(v, 6) if isinstance(v, float) else v) for v in r) for r in rows])
    assert plain(got.select(*columns).collect()) == plain(expected.project(", ".join(columns)).fetchall())
