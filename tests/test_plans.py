"""What the optimiser makes of the queries."""
import io
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()

# These join or walk in stages that run while the query is being built; their final plans are covered too.
EAGER_AND_SLOW = {"density_cluster", "nearest_neighbours", "stream_bucket"}
# Queries of the optional subpackage have tests of their own.
EAGER_AND_SLOW |= set(QUERIES) - set(entry.QUERIES)


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("key", sorted(set(QUERIES) - EAGER_AND_SLOW))
def test_no_query_compares_all_pairs(spark, sf_dir, key):
    text = plan(QUERIES[key](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text  # no row-at-a-time Python


@pytest.mark.parametrize(
    "key,needles",
    [
        ("filter", ["PushedFilters: [IsNotNull(l_shipdate)", "LessThan(l_quantity,24.0)"]),
        ("join_filtered_agg", ["TakeOrderedAndProject", "EqualTo(c_mktsegment,BUILDING)", "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double,l_discount:double,l_shipdate:timestamp_ntz>"]),
        ("topk", ["TakeOrderedAndProject"]),
        ("topk_per_group", ["WindowGroupLimit"]),
        ("agg_group", ["partial_sum"]),
        ("scan_partition_pruning", ["PartitionFilters: [isnotnull(p_date", "p_date"]),
        ("scan_dynamic_pruning", ["dynamicpruning", "p_date"]),
        ("project_none", ["ReadSchema: struct<>"]),
    ],
)
def test_plan_shape(spark, sf_dir, key, needles):
    text = plan(QUERIES[key](spark, sf_dir))
    for needle in needles:
        assert needle in text, text


@pytest.mark.parametrize(
    "key,fact,group",
    [("approx_quantiles", "lineitem", "l_returnflag"), ("win_percentile", "events", "event_type"), ("job_vector_angles", "embeddings", "label")],
)
def test_fact_table_is_not_shuffled_for_a_few_groups(spark, sf_dir, key, fact, group):
    """The group rows are written first; their size is known to be small."""
    text = plan(QUERIES[key](spark, sf_dir))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_text_mining_has_no_exchange_of_texts(spark, sf_dir):
    text = plan(QUERIES["job_text_mine"](spark, sf_dir))
    assert "RoundRobinPartitioning" not in text


def test_calendar_has_no_join_on_a_constant(spark, sf_dir):
    assert "one#" not in plan(QUERIES["job_calendar_fill"](spark, sf_dir))
