"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tillmart.operators import marts
from tillmart.plans.registry import QUERIES, queries, star_of

def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df) -> str:
    """Plan after the adaptive planner is done with it."""
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_no_python_no_forced_broadcast(spark, name):
    df = queries()[name](spark, SF_DIR)
    text = df._jdf.queryExecution().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "strategy=broadcast", "ObjectHashAggregate(keys=[])"):
        assert bad not in text, bad


def test_marts_read_only_their_columns(spark):
    plan = plan_of(queries()["int_customers"](spark, SF_DIR))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>?", plan)
    assert schemas and all("item_description" not in s and "item_uuid" not in s for s in schemas)
    assert "PushedFilters: [IsNotNull(customer_id)]" in plan


def test_single_distinct_count_needs_no_expand(spark):
    for name in ("int_customers", "int_items", "int_invoices", "sales_monthly", "category_monthly", "invoice_first"):
        plan = plan_of(queries()[name](spark, SF_DIR))
        assert "Expand" not in plan and "SortAggregate" not in plan, name
    general = plan_of(marts.int_customers(star_of(spark, SF_DIR).transactions))
    assert "Expand" in general


def test_top_of_group_is_cut_before_the_shuffle(spark):
    for name in ("favorite_category", "int_customers", "sample_one_per_key"):
        plan = plan_of(queries()[name](spark, SF_DIR))
        assert re.search(r"WindowGroupLimit.*Partial", plan) and re.search(r"WindowGroupLimit.*Final", plan), name


def test_flag_lists_are_hash_sets(spark):
    text = queries()["dim_items"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" in text


def test_fact_is_not_shuffled(spark):
    assert "Exchange hashpartitioning" not in plan_of(queries()["fact_transactions"](spark, SF_DIR))
    assert "Exchange hashpartitioning" not in plan_of(queries()["stg_transactions"](spark, SF_DIR))


def test_hot_item_is_split(spark, conf):
    """Without a broadcast, the adaptive planner cuts the hot item's partition."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "200k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.shuffle.partitions", "16")
    star = star_of(spark, SF_DIR)
    hot = star.items.orderBy("item_uuid").first().item_uuid
    pieces = spark.range(20).withColumnRenamed("id", "copy")
    fact = star.fact.join(pieces).drop("copy").repartition(8)
    fact = fact.withColumn("item_uuid", F.when(F.rand(1) < 0.34, hot).otherwise(F.col("item_uuid")))
    # Written, so that the drawn rows are the same in both runs below.
    path = star.path("hot")
    fact.write.parquet(path)
    fact = spark.read.parquet(path)
    joined = marts.int_transactions(fact, star.items, star.families, star.dates, star.places)
    assert "skew=true" in final_plan_of(joined.select("item_uuid", "item_variant", "country_name"))
    assert joined.count() == fact.count()
    assert joined.filter(F.col("item_uuid") == hot).count() == fact.filter(F.col("item_uuid") == hot).count()


def test_quality_report_reads_each_table_once(spark):
    plan = plan_of(queries()["quality_report"](spark, SF_DIR))
    # fact, families, dates and locations once, items once per key
    assert plan.count("FileScan parquet") == 6 and plan.count("FileScan csv") == 1
    assert len(re.findall("SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin", plan)) == 2


def test_numbering_joins_few_starts(spark):
    """Only groups that go on from an earlier piece have a start, so the planner need not sort all rows for the join."""
    assert "SortMergeJoin" not in final_plan_of(star_of(spark, SF_DIR).ordered_texts)
