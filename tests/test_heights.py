"""Hours of stations so high that their air at sea level leaves the physical domain."""

import duckdb
import pytest

from gridflume.plans import registry
from test_oracles import SF, canonical


@pytest.mark.parametrize("name", ["bun03_finalize_target_state", "bun06_assemble_hour", "bun07_add_precipitation"])
def test_query_of_high_stations(spark, tmp_path, name):
    con = duckdb.connect()
    con.execute(f"copy (select * replace (user_id + 7500 as user_id) from '{SF}/events.parquet') to '{tmp_path}/events.parquet' (format parquet)")
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet'")
    found = registry.queries()[name](spark, str(tmp_path)).toPandas()
    assert canonical(found) == canonical(con.execute(registry.oracle_sql()[name]).df())
