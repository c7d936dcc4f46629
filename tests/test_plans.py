"""What the physical plans must and must not hold."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from gridsky.operators.buckets import energy_weather_wide
from gridsky.plans import dashboard
from gridsky.registry import views
from gridsky.registry.queries import Tables, all_queries
from gridsky.sources.tables import read_serving, write_serving

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables not present")

BATCH = sorted(n for n in all_queries() if not n.startswith(("stream_", "serving_", "batch_")))


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_pairwise_joins_or_row_udfs(spark, name):
    plan = plan_of(all_queries()[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "Window "):
        assert operator not in plan
    assert ("ArrowEvalPython" in plan) == (name == "relay_json_hook")


@pytest.mark.parametrize("name", BATCH)
def test_groups_are_combined_before_the_shuffle(spark, name):
    """Reading a plan from the leaf up, an aggregate comes before each hash exchange."""
    lines = plan_of(all_queries()[name](spark, SF)).split("\n")
    for above, below in zip(lines, lines[1:], strict=False):
        if "Exchange hashpartitioning" in above:
            assert re.search(r"(Hash|Sort)Aggregate", below), above


def test_only_used_columns_are_read(spark):
    plan = plan_of(dashboard.generator_ids(Tables(spark, SF).point_data))
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"ts", "user_id", "event_type"}


def test_filters_reach_the_stored_table(spark, tmp_path):
    path = str(tmp_path / "point_data")
    write_serving(Tables(spark, SF).point_data, path, "point_data")
    stored = read_serving(spark, path, "point_data")
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan_of(dashboard.recent_days(stored))).group(1)
    assert "EqualTo(place,hydro)" in pushed and "EqualTo(id,GENERADOR 2)" in pushed
    plan = plan_of(dashboard.consumption_by_time(stored))
    assert "Not(EqualTo(generation,true))" in plan
    assert "ReadSchema: struct<time_stamp:timestamp,generation:boolean,kwh:double>" in plan


def test_large_sides_are_merged_on_their_aggregates_partitioning(spark):
    t = Tables(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(energy_weather_wide(t.energy, t.weather))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_hot_place_and_instant_give_the_right_sums(spark):
    """A third of the rows in one instant, against a sum taken another way."""
    events = views.events(spark, SF)
    hot = events.limit(1).select(
        "event_id",
        "ts",
        F.lit(2).cast("bigint").alias("user_id"),
        F.lit("purchase").alias("event_type"),
        F.lit(0.5).alias("value"),
        "props",
    )
    copies = hot.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("copy")
    energy = views.energy_record(events.unionByName(copies))
    total = energy.filter("place = 'mall'").agg(F.sum("value")).first()[0]
    by_time = dashboard.consumption_by_time(
        energy.withColumnsRenamed({"ts": "time_stamp_", "value": "kwh"})
        .drop("time_stamp")
        .withColumnRenamed("time_stamp_", "time_stamp")
    )
    assert by_time.agg(F.sum("sum")).first()[0] == pytest.approx(total)
    assert by_time.agg(F.max("sum")).first()[0] >= 250.0
