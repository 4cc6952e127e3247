"""Every catalogue query that has SQL, against DuckDB on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

from folioscope.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "documents labels benchmark events conversations orders pages".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain(df: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or (not isinstance(v, str) and pd.isna(v)):
            return None
        return int(v) if isinstance(v, float) and v == int(v) else str(v) if isinstance(v, pd.Timestamp) else v

    return sorted((tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(catalog.ORACLE_SQL[name]).df()
    got = catalog.QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_texts_go_to_python_once(spark):
    """quote_found composes documents in one Python step, not in a filter and again for its columns."""
    plan = catalog.QUERIES["quote_found"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    above = [i for i, line in enumerate(plan.splitlines()) if "ArrowEvalPython" in line]
    documents = next(i for i, line in enumerate(plan.splitlines()) if "Relation [doc_id" in line)
    assert sum(i < documents for i in above) == 1


def test_entry_module(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
