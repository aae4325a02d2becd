"""What the plans must and must not contain."""

import pytest
from conftest import SF_DIR

from closepass.operators import aggregates as agg
from closepass.operators import cleaning, ranking, reports, sampling
from closepass.plans import inputs
from closepass.plans.catalog import QUERIES
from closepass.sinks.files import save_by_year
from closepass.sources.files import read_parquet


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, approaches, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "t")
    save_by_year(approaches, path)
    return read_parquet(spark, path)


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(agg.filtered_count(stored))
    assert "PushedFilters: [IsNotNull(h), LessThan(h,20.0)]" in text
    assert "ReadSchema: struct<h:double>" in text


def test_year_range_prunes_partitions(stored):
    text = plan(agg.partition_scan(stored, 1996, 1998))
    assert "PartitionFilters: [isnotnull(approach_year" in text
    assert "ReadSchema: struct<>" in text


@pytest.mark.parametrize(
    "operator",
    [reports.risky_objects, reports.dangerous_objects, reports.nearest_with_category, reports.nearest],
)
def test_lists_are_top_k(stored, operator):
    assert "TakeOrderedAndProject" in plan(operator(stored))


@pytest.mark.parametrize(
    "operator", [ranking.best_per_object, ranking.discovery_sample]
)
def test_group_limits_before_the_shuffle(stored, operator):
    assert "WindowGroupLimit" in plan(operator(stored))


def test_key_dedupe_limits_before_the_shuffle(stored):
    assert "WindowGroupLimit" in plan(cleaning.dedupe_by_key(stored, order=["dist"]))


def test_percent_rank_has_no_global_sort_of_the_table(stored):
    text = plan(ranking.distance_rank_with_size_percentile(stored))
    assert "percent_rank" not in text and "rangepartitioning" not in text
    ranked = ranking.distance_rank_with_size_percentile(stored)
    ranked._jdf.collectToPython()
    final = plan(ranked).split("== Initial Plan ==")[0]
    assert final.count("TakeOrderedAndProject") == 1 and "ReusedSubquery" in final


def nodes(logical) -> list[str]:
    """Names of a plan's nodes, those of its subqueries left out."""
    below = logical.children()
    return [logical.nodeName(), *(n for i in range(below.size()) for n in nodes(below.apply(i)))]


@pytest.mark.parametrize(
    "rows",
    [lambda df: sampling.sample_random(df, 100), lambda df: reports.source_window(df, "1900-01-01", "2100-01-01", 0.5, 100)],
)
def test_rows_before_the_cut_off_leave_the_scan_untouched(stored, rows):
    logical = rows(stored)._jdf.queryExecution().optimizedPlan()
    while logical.nodeName() != "Union":
        logical = logical.children().apply(0)
    below, at_cut = (nodes(logical.children().apply(i)) for i in range(2))
    assert set(below) <= {"Project", "Filter", "LogicalRelation"}
    assert "Aggregate" in at_cut and "Window" in at_cut


def test_lists_do_not_shuffle_for_names(spark):
    text = plan(QUERIES["risky_objects"](spark, SF_DIR))
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_counts_read_no_columns(spark):
    text = plan(QUERIES["simple_count"](spark, SF_DIR))
    assert "ReadSchema: struct<>" in text and "Join" not in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cartesian(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for word in ("Python", "CartesianProduct", "ObjectHashAggregate(keys=[], functions=[percentile"):
        assert word not in text, word


def test_names_are_not_read_without_need(spark):
    assert "p_name" not in plan(agg.yearly_trends(inputs.approaches(spark, SF_DIR)))
