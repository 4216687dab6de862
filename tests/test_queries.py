"""Registered queries against their checking SQL at the smallest scale.

A sample of each family by default; LODEWATCH_ALL_QUERIES=1 runs all of them.
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from check_queries import compare, connect

SF_DIR = driver.FLAGSHIP_DATA
SAMPLE = [
    "entry_profile_union", "a2_scan_csv_by_period", "a6_write_csv_indexed", "a13_write_observations", "b10_split_by_key",
    "c1_resolve_refs", "c4_orphan_anti_join", "d1_describe_numeric", "d1_describe_numeric_ranked", "d2_describe_categorical",
    "d6_profile_temporal", "d8_profile_string", "d11_field_running_metrics", "e1_sort_fields", "f1_concat", "g5_qualified_name",
    "h2_lineage_extra", "h5_lineage_id", "h10_observed_write", "h12_app_run_rows", "i4_statement_tables",
    "j2_stream_schema_growth", "j5_stream_schema_violations", "k3_predict_linear", "k8_chart_observation", "l1_metric_registry",
]
NAMES = list(driver.oracle_sql()) if os.environ.get("LODEWATCH_ALL_QUERIES") else SAMPLE

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_every_checked_query_is_registered():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).columns == ["field", "stat", "value"]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    verdict, _ = compare(spark, connect(SF_DIR), driver.queries()[name], driver.oracle_sql()[name], SF_DIR)
    assert verdict == "ok"
