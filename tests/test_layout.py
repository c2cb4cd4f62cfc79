"""How the feed and the tables are laid out, so that less is written and shuffled."""

import os

from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tests.test_plans import plan_of
from tillmart.functions import columns as fn
from tillmart.operators import marts
from tillmart.plans.registry import star_of
from tillmart.session import scratch, written
from tillmart.sources import files, order_tables


def test_lines_of_a_part_are_together(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    lines = order_tables._lines_by_part(spark, SF_DIR).withColumn("task", F.spark_partition_id())
    places = lines.withColumn("place", F.monotonically_increasing_id()).groupBy("l_partkey").agg(
        F.countDistinct("task").alias("tasks"), (F.max("place") - F.min("place") + 1 - F.count("*")).alias("gaps")
    )
    assert places.filter("tasks > 1 or gaps > 0").isEmpty()


def test_lines_are_moved_as_numbers(spark):
    """Texts are made after the last shuffle of the lines."""
    moved = order_tables._lines_by_part(spark, SF_DIR)
    assert [name for name, kind in moved.dtypes if kind == "string"] == ["l_returnflag"] and len(moved.columns) == 8


def test_compressed_csv_is_cut_and_read_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "CSV_ROWS", 40)
    rows = spark.range(100).selectExpr("CAST(id AS STRING) AS a", "concat('x\"', id) AS b").coalesce(1)
    files.write_csv(rows, f"{tmp_path}/t", compressed=True)
    assert len([name for name in os.listdir(tmp_path / "t") if name.endswith(".csv.gz")]) == 3
    back = files.well_formed(files.read_csv(spark, f"{tmp_path}/t", rows.schema))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_tables_are_written_in_the_small_codec(spark):
    star = star_of(spark, SF_DIR)
    star.fact  # noqa: B018
    assert all(name.endswith(".zstd.parquet") for name in os.listdir(star.lake.folder("fact_transactions")) if name.endswith("parquet"))


def test_packed_texts_are_one_to_one(spark):
    texts = ["", "0", "00", "ab", "AB", "Ab", "abc", "äb", "ab" * 32, "AB" * 32, "x" * 64, " ab", "\x01«", "\x00", None]
    df = spark.createDataFrame([(text,) for text in texts], "t string")
    df = df.withColumn("p", fn.packed(F.col("t"))).withColumn("u", fn.unpacked(F.col("p")))
    rows = df.collect()
    assert [row.u for row in rows] == texts
    assert len({bytes(row.p) for row in rows if row.p is not None}) == len(texts) - 1
    assert len(rows[8].p) == 33


def test_items_are_shuffled_in_bytes(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    star = star_of(spark, SF_DIR)
    for df in (star.lake.plan("int_transactions"), star.lake.plan("int_items"), star.lake.plan("int_invoices")):
        assert "unhex(item_uuid" in plan_of(df)
    assert marts.with_packed_item(star.fact).schema["item_uuid"].dataType.simpleString() == "binary"


def test_scratch_goes_with_its_block(spark):
    with scratch(spark, "held") as path:
        assert written(spark.range(5), "rows", path).count() == 5 and files.exists(spark, f"{path}/rows")
    assert not files.exists(spark, path)
