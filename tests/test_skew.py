"""Queries on tables where one key holds a third of the rows."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect
from tests.skewed import write_skewed

NAMES = [
    "lag_delta", "running_total", "status_duration", "forward_fill", "backward_fill", "sequence_number_in_group", "dense_rank_group", "median_stddev", "asof_scd2_join",
    "interval_overlap_load", "listagg_ordered", "topk_per_group", "incremental_merge", "retention_episodes", "customer_lifecycle", "order_series", "purchase_order_increments",
    "bid_behaviour", "review_iterations", "batch_on_time_rate", "qc_risk_score",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    return write_skewed("/root/testdata/sf0.001", str(tmp_path_factory.mktemp("skewed")))


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys(spark, skewed, name):
    problems, n = compare(entry.queries()[name](spark, skewed), entry.oracle_sql()[name], connect(skewed))
    assert n and not problems, problems
