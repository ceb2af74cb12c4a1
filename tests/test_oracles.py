"""Every registered query of the library itself against its DuckDB twin, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from gridflume.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> list[str]:
    def one(v):
        if pd.isna(v):
            return None
        if isinstance(v, (bool,)) or type(v).__name__ == "bool":
            return bool(v)
        return v if isinstance(v, str) else round(float(v), 6) + 0.0

    return sorted(str([one(v) for v in r]) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    found = registry.queries()[name](spark, SF).toPandas()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert len(found)
        return
    want = duck.execute(sql).df()
    assert sorted(found.columns) == sorted(want.columns)
    assert canonical(found) == canonical(want)
