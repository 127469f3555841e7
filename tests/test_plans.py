"""What the plans must look like to hold at scale."""

import pytest
from making import SF_SMALL

from meterlake.plans.catalogue import QUERIES, readings
from meterlake.plans.dashboard import meters_with_status
from meterlake.plans.views import VIEWS, fleet_summary
from meterlake.session import shared_dir, size_settings

WRITES_FIRST = {"s17_arriving_files", "s18_materialised_views", "s09_merge_same_day"}
COSTLY = ("CartesianProduct", "BroadcastNestedLoopJoin", "Expand", "SortAggregate", "BatchEvalPython", "ArrowEvalPython")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES_FIRST))
def test_no_costly_operator(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    assert [word for word in COSTLY if word in text] == []


def test_views_read_only_their_columns(spark):
    text = plan(fleet_summary(readings(spark, SF_SMALL)))
    schema = text[text.index("ReadSchema") :]
    assert "meter_id" in schema and "feeder_id" not in schema and "current" not in schema


def test_distinct_meters_are_folded_per_key_first(spark):
    """A group with a third of all rows is spread over tasks by meter before it is counted."""
    for build in (VIEWS["state_health_summary"], VIEWS["geographic_health"]):
        text = plan(build(readings(spark, SF_SMALL)))
        assert text.count("Exchange hashpartitioning") == 2
        assert "meter_id" in text[text.rindex("Exchange hashpartitioning") :].split("\n")[0]
    assert "meter_id" in plan(meters_with_status(readings(spark, SF_SMALL), "discom")).split("Exchange")[-1].split("\n")[0]


def test_shuffle_sizes_are_bounded():
    tiny, huge = size_settings(1 << 20), size_settings(100 * 10**12)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert (tiny[key], huge[key]) == ("200", "40000")
    assert 128 << 20 < int(huge["spark.sql.files.maxPartitionBytes"]) <= 1 << 30


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir", shared_dir(spark)).rstrip("/")
