"""Loads that read the feed once, leave old items alone, count rows where they are transactions, and write few files."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tests.feed import families, sales
from tests.test_following import files_under, follower
from tests.test_plans import plan_of
from tillmart.operators import grouped, staging
from tillmart.plans import registry
from tillmart.plans.registry import Star
from tillmart.session import hashed_joins, shared_dir, unsorted_writes
from tillmart.streaming import following


def drops_of(spark, monkeypatch, *dates):
    """What each of the three loads finds, and how often the feed was read."""
    raw, reads, found = sales(spark, *[{"InvoiceNo": str(i), "InvoiceDate": date} for i, date in enumerate(dates)]), [], []
    monkeypatch.setattr(Star, "raw", property(lambda self: reads.append(1) or raw))
    for name in ("families", "dates", "places"):
        monkeypatch.setattr(Star, name, None)
    found_by = lambda spark, source, *more, **named: found.append(sorted(r.InvoiceNo for r in spark.read.parquet(source).collect()))
    monkeypatch.setattr(registry.incremental, "load_new", found_by)
    Star(spark, SF_DIR).followed  # noqa: B018
    return found, len(reads)


def test_the_feed_is_read_once(spark, monkeypatch):
    dates = ("1/1/13 8:26", "1/1/10 8:26", "1/1/11 8:26", None, "none", "1/1/1996 8:26", "12/31/12 8:26")
    found, reads = drops_of(spark, monkeypatch, *dates)
    assert found == [["0", "5"], ["0", "1", "4", "5"], ["0", "1", "2", "3", "4", "5", "6"]]
    assert reads == 1


def test_a_drop_without_rows_is_a_delivery(spark, monkeypatch):
    assert drops_of(spark, monkeypatch, "1/1/11 8:26", None)[0] == [[], [], ["0", "1"]]


def test_items_of_earlier_loads_are_not_written_again(spark, monkeypatch):
    monkeypatch.setattr(following, "BUCKETS", 1)
    follow = follower(spark, families(spark, ("85123", "HEART", "DECORATION")))
    where = shared_dir(spark, "seen")
    staged = [staging.stg_transactions(sales(spark, *[{"StockCode": code, "Description": text} for code, text in items])) for items in ([("1", "A"), ("2", None)], [("1", "A"), ("2", "B")], [("1", "A")])]
    follow._items(staged[0], 0, f"{where}-0")
    before = files_under(f"{follow.root}/dim_items")
    for load_id in (1, 1, 2):
        follow._items(staged[load_id], load_id, shared_dir(spark, "seen"))
    assert follow.touched["dim_items"] == []
    assert before and before.items() <= files_under(f"{follow.root}/dim_items").items()
    assert sorted((r.item_id, str(r.item_description)) for r in follow.table("dim_items").collect()) == [("1", "A"), ("2", "B"), ("2", "None")]


def test_rows_are_counted_where_they_are_transactions(spark):
    rows = [(i, i % 3 or None, "FR" if i % 2 else None, str(i % 5), i * 1.5, i, i % 4 == 0) for i in range(40)]
    df = spark.createDataFrame(rows, "transaction_id long, customer_id int, country_name string, invoice_id string, total_price_eur double, quantity_amount int, is_return boolean")
    df = df.withColumn("total_price_eur", F.col("total_price_eur").cast("decimal(18,2)"))
    measures, bucket = following.CUSTOMERS, following.by_hash("customer_id")
    assert "distinct" in plan_of(measures.partial(df, bucket))
    assert "distinct" not in plan_of(measures.of_rows().partial(df, bucket))
    lines = lambda found: sorted(map(repr, found.select(sorted(found.columns)).collect()))
    assert lines(measures.partial(df, bucket)) == lines(measures.of_rows().partial(df, bucket))
    # of one load, values are counted as rows
    part = measures.of_rows().partial(df, bucket).withColumn("load_id", F.lit(0))
    once, several = (measures.totals(part, "total_invoices", once) for once in (True, False))
    assert "distinct" not in plan_of(once) and lines(once) == lines(several)


def test_buckets_of_one_load(spark):
    state = following.State(spark, shared_dir(spark, "state"), following.STATES["customers_seen"])
    row = spark.sql("select 1 customer_id, 'x' country_name, cast(null as timestamp_ntz) first_seen")
    for load_id, buckets in enumerate(([-1, 3], [-1], [5])):
        assert state.replace(row.select("*", F.explode(F.lit(buckets)).alias("bucket")), load_id) == buckets
    assert state.by_loads([-1, 3, 5, 7]) == [([3, 5], True), ([-1, 7], False)]
    assert state.by_loads([3]) == [([3], True)] and state.by_loads([]) == []


@pytest.mark.parametrize("partitions, parts", [(4, 1), (40, 3), (600, 16)])
def test_parts_fit_the_shuffle(spark, conf, partitions, parts):
    conf("spark.sql.shuffle.partitions", str(partitions))
    assert {r.p for r in spark.range(500).select(following.part_of("id").alias("p")).distinct().collect()} == set(range(parts))


def test_hot_values_of_one_hash(spark, monkeypatch):
    monkeypatch.setattr(grouped, "HASHES", 1)
    df = spark.createDataFrame([("a",)] * 300 + [(None,)] * 300 + [(f"k{i}",) for i in range(400)], "k string")
    assert set(grouped.hot_values(df, "k")) == {"a", None}


def test_settings_come_back(spark, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
    names = ("spark.sql.maxConcurrentOutputFileWriters", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold")
    before = [spark.conf.get(name) for name in names]
    with unsorted_writes(spark), hashed_joins(spark):
        assert [spark.conf.get(name) for name in names] == ["32", "8m"]
    assert [spark.conf.get(name) for name in names] == before
