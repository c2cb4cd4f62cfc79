"""Rows that are moved once only, hot keys, ids without a copy, and deliveries of many files."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tests.feed import sales
from tests.test_plans import plan_of
from tillmart.functions import columns as fn
from tillmart.operators import colocated, grouped, marts
from tillmart.plans import registry
from tillmart.plans.registry import star_of
from tillmart.schemas import RAW_SALES
from tillmart.session import shared_dir, shuffles_removed
from tillmart.sources import tables
from tillmart.sources.landing import Landing
from tillmart.streaming import following, incremental


def moves(df):
    return moves_of(plan_of(df))


@pytest.fixture(scope="module")
def star(spark):
    return star_of(spark, SF_DIR)


def test_marts_move_their_lines_once(star):
    assert moves(star.lake.plan("int_invoices")) == 1
    sales_only = marts.int_items(star.fact, star.items.limit(5), star.families.limit(5), True)
    assert "customer_id" not in " ".join(re.findall(r"Exchange hashpartitioning\([^)]*\)", plan_of(sales_only)))


def test_partial_rows_are_moved_once(star):
    fact = marts.with_packed_item(star.fact)
    assert moves(following.ITEM_SALES.partial(fact, following.by_hash("item_uuid"))) == 1


def test_hot_keys_are_counted_whole(spark):
    rows = [(None, i % 7, i) for i in range(300)] + [("a", None if i % 2 else i, 1) for i in range(300)] + [(f"k{i % 150}", i % 4, 2) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, v int, q int")
    assert set(grouped.hot_values(df, "k")) == {None, "a"}
    salted_rows, salted = grouped.with_salt(df, "k", "v")
    assert salted and salted_rows.filter("k = 'a'").select("_salt").distinct().count() > 1
    assert salted_rows.filter("k like 'k%' and _salt <> 0").isEmpty()
    found = grouped.totals(salted_rows, ["k"], "v", "n", {"q": (F.sum("q"), F.sum)}, ["k"], salted)
    want = df.groupBy("k").agg(F.sum("q").alias("q"), F.countDistinct("v").alias("n"))
    assert sorted(map(repr, found.select("k", "q", "n").collect())) == sorted(map(repr, want.collect()))
    assert grouped.hot_values(df.limit(0), "k") == []


def test_flags_in_bits_are_bool_or(spark):
    choices = [True, False, None]
    rows = [(k, choices[k // 3 % 3], choices[(k + j) % 3]) for k in range(9) for j in range(k % 3)]
    df = spark.createDataFrame(rows, "k int, a boolean, b boolean")
    bits = df.groupBy("k").agg(F.bit_or(fn.flag_bits(["a", "b"])).alias("f")).select("k", fn.flag_of(F.col("f"), 0).alias("a"), fn.flag_of(F.col("f"), 1).alias("b"))
    want = df.groupBy("k").agg(F.bool_or("a").alias("a"), F.bool_or("b").alias("b"))
    assert sorted(map(repr, bits.collect())) == sorted(map(repr, want.collect()))


def test_ids_of_a_load_need_no_copy(spark, monkeypatch):
    where, names = shared_dir(spark, "no-copy"), []
    taken = incremental.written
    monkeypatch.setattr(incremental, "written", lambda df, name, under=None: names.append(name) or taken(df, name, under))
    for load in range(2):
        sales(spark, *[{"InvoiceNo": str(i)} for i in range(20)]).repartition(3).write.mode("append").parquet(f"{where}/drops")
        incremental.load_new(spark, f"{where}/drops", RAW_SALES, f"{where}/staged", f"{where}/check")
    assert "load" not in names
    assert sorted(r.transaction_id for r in spark.read.parquet(f"{where}/staged").collect()) == list(range(40))


def test_shuffle_files_go_with_the_block(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with shuffles_removed(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == before


def test_items_without_salts_are_summed_in_their_bucket(spark, star):
    hot = star.items.select("item_uuid").first()[0]
    fact = star.fact.withColumn("item_uuid", F.when(F.col("transaction_id") % 3 == 0, hot).otherwise(F.col("item_uuid")))
    name = "moves_" + star.root[-8:]
    with tables.in_database(spark, name, shared_dir(spark, "moves")):
        colocated.write_colocated(fact, star.items, star.families, ("f", "i"), shared_dir(spark, "buckets"))
    salts = {r.item_uuid == hot: (r.least, r.most) for r in spark.table(f"{name}.f").groupBy("item_uuid").agg(F.min("salt").alias("least"), F.max("salt").alias("most")).collect()}
    assert salts == {True: (1, colocated.SALTS), False: (0, 0)}
    plan = plan_of(colocated.items_mart(spark.table(f"{name}.f"), star.items, star.families))
    moved = [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(item_uuid#\d+, customer_id", line)]
    assert len(moved) <= 1


def test_a_delivery_is_a_folder(spark, star, tmp_path):
    landing = Landing(spark, str(tmp_path / "drops"), str(tmp_path / "manifest"), RAW_SALES, by_folder=True)
    rows = sales(spark, *[{"InvoiceNo": str(i)} for i in range(20)])
    for name, parts in (("a", 3), ("b", 5)):
        rows.repartition(parts).write.parquet(str(tmp_path / "drops" / name))
    told = sorted((r["path"].rsplit("/", 1)[1], r["status"], r["n_rows"]) for r in landing.check(0).collect())
    assert told == [("a", "new", 20), ("b", "redelivered", 20)]
    assert landing.take(0).count() == 20
    assert {r["status"] for r in landing.check(1).collect()} == {"unchanged"}
    registry.landing_manifest(star).collect()
    written = spark.read.parquet(f"{star.path('landing_manifest')}/drops/a")
    assert written.count() > 0 and len(written.inputFiles()) == star.raw.rdd.getNumPartitions()


def test_the_month_layout_moves_keys_in_bytes(star, monkeypatch):
    plans = []
    taken = registry.files.write_partitions
    monkeypatch.setattr(registry.files, "write_partitions", lambda df, *columns, **how: plans.append(plan_of(df)) or taken(df, *columns, **how))
    monthly = registry.monthly_fact(star)
    assert "unhex(item_uuid" in plans[0] and moves_of(plans[0]) == 1
    assert monthly.select("transaction_id", "item_uuid").exceptAll(star.fact.select("transaction_id", "item_uuid")).isEmpty()
    assert monthly.count() == star.fact.count()


def moves_of(plan):
    return len(re.findall(r"(?<!Broadcast)Exchange hashpartitioning", plan))
