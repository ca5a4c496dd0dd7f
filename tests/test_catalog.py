"""Registered queries against their SQL; ``FULL_ORACLE=1`` runs them all."""

import os

import pytest

import __spark_entry__ as registered
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
SAMPLE = (
    "A1_value_statistics_by_event_type A2_delta_statistics A5_merge_stats A14_paired_effects A23_split_counts "
    "J7_split_leakage J12_expert_window P3_explode_joints P16_plan_decisions S6_scan_metric_csv S12_write_frames "
    "T3_split_goal_stratified T9_retention_plan U2_append_split_roots V2_validate_tasks W3_detect_plateaus W4_donor_derangement "
    "W11_split_names W18_temporal_delta"
).split()
NAMES = sorted(registered.oracle_sql()) if os.environ.get("FULL_ORACLE") else SAMPLE


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, con, name):
    assert compare(registered.queries()[name](spark, SF_DIR), con, registered.oracle_sql()[name]) == []


def test_every_oracle_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).count() == 64
