"""Registered queries: a spread of them is compared with its oracle on the smallest data."""

import os

import duckdb
import pytest
from check_oracles import TABLES, compare

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
PICK = [
    "a12_weighted_health_fusion", "a15_true_alert_matrix", "a24_resample_grid", "c3_strict_row_validation", "f1_pluggable_window_scorer",
    "j3_alert_traceback", "j4_nearest_road", "m10_fault_augmentation_noise", "p4_timestamp_parsing", "s8_upsert_table", "t4_top5_weighted_features",
    "w12_persistence_escalation", "w14_smart_attribution", "w22_driver_score", "x4_stream_health_windows", "x15_malformed_json",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data absent")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES.split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", PICK)
def test_matches_oracle(spark, con, name):
    message, ok = compare(spark, con, name, SF_DIR)
    assert ok, message


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
