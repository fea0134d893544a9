"""Every registered query against its DuckDB SQL on the sf0.001 tables."""

import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF0001

SQL = E.oracle_sql()
NAMES = [n for n in E.queries() if n in SQL]


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = pd.to_datetime(df[c]).astype("datetime64[us]")
        elif df[c].dtype == object:
            df[c] = df[c].astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    got = E.queries()[name](spark, SF0001).toPandas()
    want = duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    a, b = _norm(got), _norm(want)
    for c in a.columns:
        x, y = a[c], b[c]
        same = (x.isna() == y.isna()) & ((x == y) | x.isna())
        assert same.all(), f"{name}.{c}: {(~same).sum()} differences"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 48
    assert df.count() > 0
