import pytest
from pyspark.sql import functions as F

from tests.feed import sales
from tillmart.operators import quality
from tillmart.schemas import RAW_SALES, TABLES
from tillmart.session import application_dir, written
from tillmart.sources import files, tables

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


def read(spark, path):
    return files.read_csv(spark, str(path), RAW_SALES, files.RETAIL_ENCODING)


def test_quotes_and_encoding(spark, tmp_path):
    path = tmp_path / "retail.csv"
    body = '1,2,"SET, ""RED"" BOX",3,12/1/10 8:26,2.55,17850,France\n2,3,Gift Voucher £100.00,1,,,,\n'
    path.write_bytes((HEADER + body).encode("ISO-8859-1"))
    rows = read(spark, path).collect()
    assert rows[0].Description == 'SET, "RED" BOX'
    assert rows[1].Description == "Gift Voucher £100.00" and rows[1].CustomerID is None


def test_other_header_is_refused(spark, tmp_path):
    path = tmp_path / "retail.csv"
    path.write_text(HEADER.replace("StockCode", "Code") + "1,2,3,4,5,6,7,8\n")
    with pytest.raises(Exception, match="StockCode|header"):
        read(spark, path).collect()


def test_csv_there_and_back(spark, tmp_path):
    texts = ['SET, "RED"', " padded ", None, "£ é", "a,b", "back\\slash", '"', "'"]
    df = sales(spark, *[{"Description": text, "InvoiceNo": str(i)} for i, text in enumerate(texts)])
    files.write_csv(df, str(tmp_path / "out"), files.RETAIL_ENCODING)
    back = {r.InvoiceNo: r.Description for r in read(spark, tmp_path / "out").collect()}
    assert back == {str(i): text for i, text in enumerate(texts)}


def test_partition_overwrite_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, 2010, 1), (2, 2010, 2), (3, 2011, 1), (4, None, None)]
    df = spark.createDataFrame(rows, "v int, year int, month int")
    files.write_partitions(df, path, "year", "month")
    files.write_partitions(df.filter("v = 2").withColumn("v", F.lit(20)), path, "year", "month")
    assert {(r.v, r.year, r.month) for r in spark.read.parquet(path).collect()} == {
        (1, 2010, 1), (20, 2010, 2), (3, 2011, 1), (4, None, None),
    }
    files.write_partitions(df.filter("v = 1"), path, "year", "month", dynamic=False)
    assert spark.read.parquet(path).count() == 1


def test_month_filter_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).select("id", (F.col("id") % 2 + 2010).alias("year"), (F.col("id") % 12 + 1).alias("month"))
    files.write_partitions(df, path, "year", "month")
    hit = spark.read.parquet(path).filter("year = 2010 AND month = 3")
    assert len(hit.inputFiles()) >= 1
    assert "PartitionFilters: [isnotnull(year" in hit._jdf.queryExecution().toString()


def test_typed_load_is_repeatable_and_strict(spark, tmp_path):
    path = str(tmp_path / "families")
    df = spark.createDataFrame([("1", "A", "X")], "item_family_id string, item_family_description string, item_category string")
    df.write.parquet(path)
    schema = TABLES["dim_item_family"]
    before = spark.catalog.currentDatabase()
    with tables.in_database(spark, "strict_db", str(tmp_path / "db")):
        for _ in range(2):
            tables.load_typed(spark, path, "dim_item_family", schema)
        assert spark.catalog.currentDatabase() == "strict_db"
        assert spark.table("dim_item_family").count() == 1
        df.withColumn("item_family_id", F.lit("no number")).write.mode("overwrite").parquet(path)
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            tables.load_typed(spark, path, "dim_item_family", schema)
    assert spark.catalog.currentDatabase() == before
    assert spark.table("strict_db.dim_item_family").schema == schema


def test_replace_and_publish(spark, tmp_path):
    money = spark.sql("SELECT 1 AS k, CAST(2.50 AS DECIMAL(18,2)) AS total")
    with tables.in_database(spark, "publish_db", str(tmp_path / "db")):
        tables.create_or_replace(spark.range(5), "int_t")
        tables.create_or_replace(money, "int_t")
        tables.publish_table(spark, "int_t", "etl_t")
        tables.create_or_replace(spark.table("int_t").withColumn("more", F.lit(1)).drop("more"), "int_t")
        assert spark.table("int_t").columns == ["k", "total"]
        assert dict(spark.table("etl_t").dtypes)["total"] == "double"
        assert spark.table("etl_t").first().total == 2.5
        folder = f"{tmp_path}/db/int_t"
        assert len(files.folders(spark, folder)) == tables.KEPT_VERSIONS
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            tables.create_or_replace(spark.sql("SELECT CAST('x' AS INT) AS k"), "int_t")
        assert spark.table("int_t").columns == ["k", "total"]


def test_rows_per_file(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "a.parquet"))
    spark.range(7).repartition(3).write.parquet(str(tmp_path / "b.parquet"))
    found = files.rows_per_file(spark, str(tmp_path), ["a", "b"]).collect()
    assert {(r.file, r.n_rows) for r in found} == {("a.parquet", 5), ("b.parquet", 7)}


TORN = '1,2,"TWO\nLINES",3,12/1/10 8:26,2.55,17850,France\n'


def test_malformed_lines_are_seen(spark, tmp_path):
    path = tmp_path / "retail.csv"
    path.write_text(HEADER + TORN + "2,2,GOOD,3,12/1/10 8:26,2.55,17850,France\n3,2,SURPLUS,3,12/1/10 8:26,2.55,17850,France,more\n")
    lines = read(spark, path)
    assert [r.InvoiceNo for r in files.well_formed(lines).collect()] == ["2"]
    assert files.well_formed(lines).columns == RAW_SALES.fieldNames()
    found = {r.check_name: r.n_rows for r in quality.feed_checks(lines).collect()}
    assert found["feed_lines"] == 4 and found["malformed_lines"] == 3
    assert found["rejected_quantity"] == found["rejected_price"] == found["missing_quantity"] == 0
    # columns that are not asked for are still counted
    assert files.well_formed(lines).select("Country").collect() == [("France",)]


def test_records_of_several_lines(spark, tmp_path):
    path = tmp_path / "retail.csv"
    path.write_text(HEADER + TORN)
    lines = files.read_csv(spark, str(path), RAW_SALES, multi_line=True)
    assert [r.Description for r in files.well_formed(lines).collect()] == ["TWO\nLINES"]


def test_feed_checks(spark):
    raw = sales(
        spark, {}, {"Quantity": "x"}, {"UnitPrice": "x"}, {"CustomerID": "x"}, {"InvoiceDate": "x"},
        {"Description": None}, {"CustomerID": None}, {"Quantity": None, "InvoiceDate": None}, {"UnitPrice": None, "Quantity": "1e3"},
    )
    assert {r.check_name: r.n_rows for r in quality.feed_checks(raw).collect()} == {
        "feed_lines": 9, "malformed_lines": 0, "rejected_quantity": 2, "rejected_price": 1, "rejected_customer": 1,
        "rejected_date": 1, "missing_description": 1, "missing_customer": 1, "missing_quantity": 1,
        "missing_price": 1, "missing_date": 1,
    }


def test_working_tables_are_removed(spark):
    rows = written(spark.range(3), "some")
    assert rows.count() == 3 and files.exists(spark, application_dir(spark))


def test_key_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    twice = df.withColumn("l", F.lit(3))
    assert {tuple(r) for r in quality.repeated_key_checks(twice, "k", "l").collect()} == {("repeated_k", 1), ("repeated_l", 1)}
    assert not quality.keys_unique((df, "k")) and quality.keys_unique((df.distinct(), "k"))


def test_dimension_checks(spark):
    items = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", None)], "item_uuid string, item_family_id int")
    families = spark.createDataFrame([(1,), (1,), (3,), (None,), (None,)], "item_family_id int")
    assert {tuple(r) for r in quality.family_checks(items, families).collect()} == {
        ("items_without_family", 2), ("repeated_item_family_id", 1),
    }
    fact = spark.sql(
        "SELECT u AS item_uuid, 1 AS quantity_amount, 2.5 AS unit_price_eur, CAST(NULL AS DECIMAL(18,2)) AS total_price_eur,"
        " CAST(NULL AS TIMESTAMP_NTZ) AS event_timestamp_invoiced_at, CAST(NULL AS INT) AS date_id, 1 AS country_id"
        " FROM VALUES ('a'), ('a'), ('z') AS v(u)"
    )
    assert {r.check_name: r.n_rows for r in quality.fact_checks(fact, items).collect()} == {
        "fact_without_time": 3, "fact_outside_calendar": 0, "fact_without_country": 0, "fact_total_too_large": 3,
        "fact_without_item": 1, "repeated_item_uuid": 1,
    }
