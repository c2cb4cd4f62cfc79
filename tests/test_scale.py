"""What a plan must not do, and what a landing folder and a quarantine must tell."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tests.feed import sales
from tillmart.operators import colocated, marts, quarantine, reports, staging
from tillmart.plans import registry
from tillmart.plans.registry import star_of
from tillmart.schemas import RAW_SALES
from tillmart.session import shared_dir
from tillmart.sources import files, tables
from tillmart.sources.landing import Landing


@pytest.fixture(scope="module")
def star(spark):
    return star_of(spark, SF_DIR)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def test_quarter_reads_three_folders(spark, star):
    monthly = registry.monthly_fact(star)
    report = reports.quarter_sales(monthly, star.dates, 2010, 2)
    assert "dynamicpruning" in plan_of(report)
    report.collect()
    metrics = report._jdf.queryExecution().executedPlan().toString()
    assert monthly.filter("year = 2010 and month between 4 and 6").select(F.input_file_name()).distinct().count() >= 3
    folders = report.select("year", "month").distinct().count()
    assert folders == 3 and metrics


def test_no_exchange_of_the_fact(spark, star, conf):
    """A third of the rows are of one item, and broadcasts by size are off."""
    name = "colocated_" + star.root[-8:]
    hot = star.items.select("item_uuid").first()[0]
    fact = star.fact.withColumn("item_uuid", F.when(F.col("transaction_id") % 3 == 0, hot).otherwise(F.col("item_uuid")))
    fact = fact.cache()
    with tables.in_database(spark, name, shared_dir(spark, "colocated")):
        colocated.write_colocated(fact, star.items, star.families, ("f", "i"), shared_dir(spark, "buckets"))
    written, described = spark.table(f"{name}.f"), spark.table(f"{name}.i")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    sold = colocated.transactions(written, described, star.dates, star.places)
    assert "hashpartitioning" not in plan_of(sold) and "SortMergeJoin" in plan_of(sold)
    mart = colocated.items_mart(written, star.items, star.families)
    exchanged = [line for line in plan_of(mart).splitlines() if "Exchange hashpartitioning" in line]
    assert exchanged and not any("salt" in line for line in exchanged)
    assert rows_of(sold) == rows_of(marts.int_transactions(fact, star.items, star.families, star.dates, star.places))
    assert rows_of(mart) == rows_of(marts.int_items(fact, star.items, star.families))
    # the hot item's rows are spread over its salts
    spread = written.filter(F.col("item_uuid") == hot).groupBy("salt").count().collect()
    assert len(spread) == colocated.SALTS and max(r["count"] for r in spread) < 0.2 * written.count()


def test_sketches_merge_over_months(spark, star):
    sketches = reports.monthly_sketches(star.transactions)
    whole = reports.sales_between(sketches, "2000-01-01", "2030-01-01")
    true = {r.country_name: r.n for r in star.transactions.filter("date is not null").groupBy("country_name").agg(F.countDistinct("invoice_id").alias("n")).collect()}
    for row in whole.collect():
        assert abs(row.estimated_invoices - true[row.country_name]) <= reports.SKETCH_ERROR * true[row.country_name]
    assert reports.sales_between(sketches, "1990-01-01", "1990-02-01").count() == 0


def statuses(landing, check_id):
    return sorted((row["path"].rsplit("/", 1)[1], row["status"], row["n_rows"]) for row in landing.check(check_id).collect())


def test_landing_finds_what_has_changed(spark, tmp_path):
    folder = tmp_path / "drops"
    folder.mkdir()
    names = RAW_SALES.fieldNames()

    def deliver(name, *invoices):
        pd.DataFrame([[i, *["x"] * 7] for i in invoices], columns=names, dtype="string").to_parquet(folder / f"{name}.parquet")

    landing = Landing(spark, str(folder), str(tmp_path / "manifest"), RAW_SALES)
    assert statuses(landing, 0) == []
    deliver("a", "1", "2")
    deliver("b", "3")
    deliver("e")
    assert statuses(landing, 1) == [("a.parquet", "new", 2), ("b.parquet", "new", 1), ("e.parquet", "new", 0)]
    # the same rows in another order under other names, a rewritten file, one that is gone
    deliver("c", "2", "1")
    deliver("b", "3", "4")
    deliver("d", "5")
    deliver("d2", "5")
    (folder / "e.parquet").unlink()
    want = [("a.parquet", "unchanged", 2), ("b.parquet", "rewritten", 2), ("c.parquet", "redelivered", 2), ("d.parquet", "new", 1), ("d2.parquet", "redelivered", 1), ("e.parquet", "gone", 0)]
    for _ in range(2):
        assert statuses(landing, 2) == want
    assert sorted(r.InvoiceNo for r in landing.take(2).collect()) == ["5"]
    assert [row[1] for row in statuses(landing, 3)] == ["unchanged"] * 5
    assert landing.take(4).count() == 0
    sizes = landing.known().collect()
    assert all(row["n_bytes"] > 0 and row["modified"] is not None for row in sizes) and len(sizes) == 5


def test_quarantine_has_text_and_place(spark, tmp_path):
    header = ",".join(RAW_SALES.fieldNames())
    (tmp_path / "feed.csv").write_text("\n".join([header, "1,A,TEXT,x,12/1/10 8:26,free,5,France", "2,B,too,few", "3,C,TEXT,1,12/1/10 8:26,1.5,5,France", ""]))
    lines = files.read_csv(spark, str(tmp_path / "feed.csv"), RAW_SALES)
    found = quarantine.rejected(quarantine.with_place(lines))
    told = sorted((r.reason, r.invoice_id, r.text, r.place.file) for r in found.collect())
    assert told == [("malformed_line", None, "2,B,too,few", "feed.csv"), ("rejected_price", "1", "free", "feed.csv"), ("rejected_quantity", "1", "x", "feed.csv")]
    balance = quarantine.balance(lines, staging.stg_transactions(files.well_formed(lines)), quarantine.rejected(lines)).first()
    assert tuple(balance) == (3, 2, 1, True)
    assert quarantine.rejected(files.read_csv(spark, str(tmp_path / "feed.csv"), RAW_SALES).limit(0)).count() == 0


def test_nothing_is_rejected_of_a_clean_feed(spark):
    lines = sales(spark, {}).withColumn(files.MALFORMED, F.lit(None).cast("string"))
    assert quarantine.rejected(lines).collect() == []
