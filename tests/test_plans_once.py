"""What the final plans read: the input of a query is scanned once, or its exchange is used again."""

import re

import pytest

from tripmart.showcase import queries
from tripmart.showcase.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def scans(plan: str) -> int:
    return len(re.findall(r"FileScan parquet", plan))


@pytest.mark.parametrize(
    "name", ["mart_station_anomaly", "q_anomalies_by_station", "previous_per_user", "drop_per_user"]
)
def test_history_is_evaluated_once(spark, name):
    plan = final_plan(QUERIES[name](spark, SF_DIR))
    assert "isFinalPlan=true" in plan
    assert scans(plan) == 1 or "ReusedExchange" in plan, plan


def test_sketches_and_exact_counts_read_the_fact_as_written(spark):
    result = QUERIES["distinct_stations_sketch"](spark, SF_DIR)
    assert not [f for f in result.inputFiles() if "lineitem" in f]


def test_both_loads_read_the_staged_rows_as_written(spark, monkeypatch):
    cleaned = []
    monkeypatch.setattr(queries, "clean_trips", lambda df, real=queries.clean_trips: cleaned.append(df) or real(df))
    assert QUERIES["mart_user_type_incremental"](spark, SF_DIR).count() == 2
    assert len(cleaned) == 2
    assert not [f for df in cleaned for f in df.inputFiles() if "lineitem" in f]
