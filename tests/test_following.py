"""Tables that follow the loads equal a full build, whatever the order of the drops, and touch no more than they must."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tests.feed import families, sales
from tillmart.operators import dimensions as dim, staging
from tillmart.plans.batch import Lake
from tillmart.plans.registry import star_of
from tillmart.session import shared_dir
from tillmart.streaming import following
from tillmart.streaming.following import FOLLOWED, Following


@pytest.fixture(scope="module")
def star(spark):
    return star_of(spark, SF_DIR)


def rows_of(df):
    plain = df.drop("transaction_id")
    return sorted(map(repr, plain.select(sorted(plain.columns)).collect()))


def follower(spark, raw_families):
    root = shared_dir(spark, "following")
    return Following(spark, root, dim.dim_item_family(raw_families), dim.dim_date(spark), dim.dim_location(spark))


def load(follow, raw, load_id):
    staged = staging.stg_transactions(raw).withColumn("transaction_id", F.col("transaction_id") + F.lit(load_id << 50))
    path = f"{follow.root}/staged/load_id={load_id}"
    staged.write.mode("overwrite").parquet(path)
    follow(follow.spark.read.parquet(path), load_id)


def assert_same_as_build(follow, raw, raw_families):
    lake = Lake(follow.spark, raw, raw_families, shared_dir(follow.spark, "whole"))
    for name in FOLLOWED:
        assert rows_of(follow.table(name)) == rows_of(lake.table(name)), name


LINES = [
    {"InvoiceNo": "1", "InvoiceDate": "12/1/10 8:26", "CustomerID": "1", "Country": "France"},
    {"InvoiceNo": "1", "InvoiceDate": "12/1/10 8:26", "CustomerID": "1", "Country": "France", "StockCode": "22423", "Description": "CAKE"},
    {"InvoiceNo": "2", "InvoiceDate": "12/9/10 8:26", "CustomerID": "2", "Country": "Germany", "Quantity": "-3"},
    {"InvoiceNo": "3", "InvoiceDate": "1/1/09 0:00", "CustomerID": "1", "Country": "Spain", "StockCode": "POST"},
    {"InvoiceNo": "2", "InvoiceDate": "11/9/10 8:26", "CustomerID": "2", "Country": "Italy", "UnitPrice": "x"},
    {"InvoiceNo": "4", "InvoiceDate": "none", "CustomerID": None, "Country": "Nowhere", "Description": None},
    {"InvoiceNo": "1", "InvoiceDate": "12/1/10 8:26", "CustomerID": "1", "Country": "France", "StockCode": "22423", "Description": "CAKE"},
    {"InvoiceNo": "5", "InvoiceDate": "none", "CustomerID": "7", "Country": "Spain"},
    {"InvoiceNo": "6", "InvoiceDate": "5/5/11 9:00", "CustomerID": "7", "Country": "France"},
]
FAMILIES = [("85123", "HEART", "DECORATION"), ("85123", "HEARTS", "GIFTS"), ("22423", "CAKE", "KITCHEN")]


def test_after_each_drop_as_a_full_build(spark):
    raw_families = families(spark, *FAMILIES)
    follow, backwards = follower(spark, raw_families), follower(spark, raw_families)
    for load_id, stop in enumerate((3, 6, 9)):
        load(follow, sales(spark, *LINES[stop - 3 : stop]), load_id)
        assert_same_as_build(follow, sales(spark, *LINES[:stop]), raw_families)
        load(backwards, sales(spark, *LINES[9 - stop : 12 - stop]), load_id)
    want = {name: rows_of(follow.table(name)) for name in FOLLOWED}
    assert {name: rows_of(backwards.table(name)) for name in FOLLOWED} == want
    # a load that is run again, and a compaction, change nothing
    load(follow, sales(spark, *LINES[6:]), 2)
    follow.compact()
    assert {state.generation for state in follow.states.values()} == {1}
    load(follow, sales(spark, *LINES[6:]), 2)
    assert {name: rows_of(follow.table(name)) for name in FOLLOWED} == want


def test_an_earlier_line_changes_the_first_country(spark):
    raw_families = families(spark, *FAMILIES)
    follow = follower(spark, raw_families)
    names = []
    for load_id, (day, country) in enumerate([("12/1/10 8:26", "France"), ("12/1/09 8:26", "Germany"), ("12/1/11 8:26", "Spain")]):
        load(follow, sales(spark, {"CustomerID": "5", "InvoiceDate": day, "Country": country}), load_id)
        names.append(follow.table("dim_customers").first().customer_name)
        assert follow.touched["dim_customers"] != []
    pool = {(r.country_name, r.customer_name) for r in dim.name_pool(spark).collect()}
    assert ("France", names[0]) in pool and ("Germany", names[1]) in pool and names[2] == names[1]
    load(follow, sales(spark, {"CustomerID": "5", "InvoiceDate": "12/1/12 8:26", "Country": "Spain"}), 3)
    assert follow.touched["dim_customers"] == [] and follow.touched["dim_items"] == []


def files_under(path):
    return {os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns for folder, _, names in os.walk(path) for name in names if name.startswith("part")}


def test_untouched_buckets_are_neither_read_nor_written(spark, star, monkeypatch):
    follow = follower(spark, star.raw_families)
    load(follow, star.raw.filter("CustomerID is not null"), 0)
    before = {name: files_under(f"{follow.root}/{name}") for name in FOLLOWED}
    states = {name: files_under(f"{follow.root}/state/{name}") for name in follow.states}
    read = {}
    taken = following.State.read

    def reads(state, buckets=None, but=None):
        rows = taken(state, buckets, but)
        if buckets:
            plan = rows._jdf.queryExecution().executedPlan().toString()
            assert "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
        read.setdefault(os.path.basename(state.path), []).append(buckets)
        return rows

    monkeypatch.setattr(following.State, "read", reads)
    load(follow, sales(spark, {"InvoiceNo": "999999", "CustomerID": "999999", "StockCode": "99999", "InvoiceDate": "3/1/11 8:26"}), 1)
    assert all(buckets is not None and len(buckets) <= 1 for lists in read.values() for buckets in lists) and len(read) == 6
    for name in ("dim_customers", "dim_items", "int_customers", "int_invoices"):
        after = files_under(f"{follow.root}/{name}")
        bucket = f"/bucket={follow.touched[name][0]}/"
        assert len(follow.touched[name]) == 1
        for path, time in before[name].items():
            assert bucket in path or after[path] == time
        assert any(bucket in path for path in set(after) - set(before[name]))
    for name, old in states.items():
        assert old.items() <= files_under(f"{follow.root}/state/{name}").items()


def test_compaction(spark, monkeypatch):
    """One that fails half-way changes nothing, and loads go on after a whole one."""
    raw_families = families(spark, *FAMILIES)
    follow = follower(spark, raw_families)
    for load_id in range(2):
        load(follow, sales(spark, *LINES[3 * load_id : 3 * load_id + 3]), load_id)
    with monkeypatch.context() as patch:
        patch.setattr(following, "create", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            follow.compact()
    follow.compact()
    load(follow, sales(spark, *LINES[6:]), 2)
    assert_same_as_build(follow, sales(spark, *LINES), raw_families)
