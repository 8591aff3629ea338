"""Registered queries against their DuckDB oracles on the smallest driver tables."""
import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from sensorlake.plans import oracle, registry

SF = "/root/testdata/sf0.001"
SAMPLE = ["raw_line_parse", "reject_counts", "history_epoch_to_lines", "batch_labels", "minute_rollup",
          "dds_end_to_end", "ml_features", "keep_first_dedupe", "anti_join_append", "constraint_violations",
          "storage_cast", "completeness_monitor", "job_minutes", "job_marts", "minute_table_stream", "history_load",
          "reject_reasons", "device_export", "hour_stream", "batch_quantiles", "time_series_report", "interpolate_per_device",
          "job_minutes_clean", "minute_table_stream_clean", "file_ledger", "stream_late_rows", "landing_stream_batches",
          "completeness_calendar", "table_lifecycle", "hour_change_stream", "mart_publication", "minute_fed_marts", "minute_fed_report"]


def _canon(df):
    cols = sorted(df.columns)
    def norm(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
            return None
        if hasattr(v, "to_pydatetime"):
            return v.to_pydatetime()
        if hasattr(v, "item"):
            v = v.item()
        return float(v) if v.__class__.__name__ == "Decimal" else v
    rows = [tuple(norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    return con


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = duck.execute(E.oracle_sql()[name]).df()
    assert _canon(got) == _canon(want)


def test_every_query_has_an_oracle():
    own = set(registry.queries())
    assert own == set(oracle.oracle_sql()) and own <= set(E.queries())


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == [
        "timestamp", "device_id", "co", "humidity", "lpg", "smoke", "temperature", "light"]
