"""Every registered query of the engine against DuckDB on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from stratafold.plans import all_queries, all_sql
from stratafold.plans.registry import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    one = lambda x: "" if pd.isna(x) else round(float(x), 6) if isinstance(x, (int, float)) or hasattr(x, "dtype") else str(x)
    return sorted((tuple(one(x) for x in r) for r in df[cols].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_matches_oracle(spark, duck, name):
    got, want = all_queries()[name](spark, SF).toPandas(), duck.execute(all_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(all_queries()) - set(all_sql())))
def test_folds_have_rows(spark, name):
    assert all_queries()[name](spark, SF).count() > 0
