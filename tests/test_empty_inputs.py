"""Every registered query runs over empty tables (same schemas, no rows)."""

import pytest

from conftest import SF_SMALL, have
from regiostat.plans.catalog import QUERIES
from regiostat.session import scratch_path

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def empty_dir(spark):
    d = scratch_path(spark, "empty-tables")
    for t in TABLES:
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(0).write.parquet(f"{d}/{t}.parquet")
    return d


@pytest.mark.skipif(not have(SF_SMALL), reason="test tables absent")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query_on_empty_tables(spark, empty_dir, name):
    rows = QUERIES[name](spark, empty_dir).collect()
    if name == "profile":
        assert [r["count"] for r in rows] == [0, 0, 0, 0]
    elif name not in ("clean_headers", "climate_silver_summary", "climate_trend_profile"):
        assert rows == []
