"""Registered queries against their SQL in DuckDB.

By default one or two queries per area run; ``ALL_QUERIES=1`` runs every one.
"""

import os

import pytest

import __spark_entry__ as entry_point
from compare import connect, differences
from trialspark.plans import load_all

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
SAMPLE = (
    "partition_replacement", "changed_group_detection", "check_flag_by_selector", "specific_then_default_config", "nearest_points",
    "totals_beside_breakouts", "accuracy_per_trial", "top_rows_per_key", "wide_with_several_values", "mixed_tests_in_one_table",
    "parent_check_flags", "head_to_head_advancement", "line_with_coefficient_tests", "maturity_calibration", "tester_rule_cascade",
    "weighted_group_evidence", "similarity_to_benchmark", "regional_aggregates", "ranks_by_environment", "quantile_bins",
    "repaired_stage_history", "precision_recall_area", "fitted_pipeline", "product_lifecycle", "replacement_candidates", "top_influencers",
)
ORACLES = entry_point.oracle_sql()
NAMES = sorted(ORACLES) if os.environ.get("ALL_QUERIES") else [n for n in SAMPLE if n in ORACLES]


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(FOLDER):
        pytest.skip(f"{FOLDER} is not there")
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    _, diff = differences(entry_point.queries()[name](spark, FOLDER), con, ORACLES[name])
    assert not diff, "\n".join(diff)


def test_every_plan_names_the_operators_it_covers():
    assert all(p.covers for p in load_all().values())


def test_entry_has_rows(spark):
    if os.path.isdir("/root/testdata/sf0.001"):
        assert entry_point.entry(spark).limit(1).count() == 1
