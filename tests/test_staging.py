import datetime
import decimal
import hashlib

from pyspark.sql import functions as F

from tests.feed import sales
from tillmart.functions import columns as fn
from tillmart.operators import dimensions as dim, staging
from tillmart.schemas import TABLES

D = decimal.Decimal


def staged(spark, *rows, **options):
    return staging.stg_transactions(sales(spark, *rows), **options)


def test_contract(spark):
    stg = staged(spark, {})
    assert [(f.name, f.dataType) for f in stg.schema] == [(f.name, f.dataType) for f in TABLES["stg_transactions"]]
    row = stg.first()
    assert row.event_timestamp_invoiced_at == datetime.datetime(2010, 12, 1, 8, 26)
    assert row.date == datetime.date(2010, 12, 1)
    assert row.unit_price_eur == D("2.55") and row.quantity_amount == 6
    assert row.item_uuid == hashlib.sha256(b"85123A_WHITE HANGING HEART").hexdigest()


def test_customer_texts(spark):
    texts = ["17850.0", "17850", "", "x", None, "9999999999", "1.99999", "1e3", "2.7", "-3.", " 4 ", "+5", ".5", "1.2.3"]
    stg = staged(spark, *[{"CustomerID": text, "InvoiceNo": f"{i:02}"} for i, text in enumerate(texts)])
    found = [row.customer_id for row in stg.orderBy("invoice_id").collect()]
    assert found == [17850, 17850, None, None, None, None, 1, None, 2, -3, 4, 5, None, None]


def test_unreadable_values_are_null(spark):
    row = staged(spark, {"Quantity": "n/a", "UnitPrice": "free", "InvoiceDate": "soon"}).first()
    assert row.quantity_amount is None and row.unit_price_eur is None
    assert row.event_timestamp_invoiced_at is None and row.date is None
    assert row.raw_invoice_date == "soon"


def test_four_digit_year_needs_its_own_pattern(spark):
    rows = [{"InvoiceDate": "12/1/2010 8:26"}, {"InvoiceDate": "1/2/95 0:05"}]
    assert [r.date for r in staged(spark, rows[0]).collect()] == [None]
    both = staged(spark, *rows, patterns=("M/d/yy H:mm", "M/d/yyyy H:mm")).select("date").collect()
    assert {r.date for r in both} == {datetime.date(2010, 12, 1), datetime.date(2095, 1, 2)}


def test_clock_change_moves_no_time(spark, conf):
    conf("spark.sql.session.timeZone", "Europe/London")
    stg = staged(spark, {"InvoiceDate": "3/27/11 1:30"}, {"InvoiceDate": "12/1/10 8:26"})
    texts = stg.select(F.col("event_timestamp_invoiced_at").cast("string").alias("t"), "date").collect()
    assert {(r.t, str(r.date)) for r in texts} == {
        ("2011-03-27 01:30:00", "2011-03-27"),
        ("2010-12-01 08:26:00", "2010-12-01"),
    }


def test_item_key_without_description(spark):
    assert staged(spark, {"Description": None}).first().item_uuid == hashlib.sha256(b"85123A").hexdigest()
    md5 = staged(spark, {}, algorithm="md5").first().item_uuid
    assert md5 == hashlib.md5(b"85123A_WHITE HANGING HEART").hexdigest()


def test_fact_keeps_rows_without_match(spark):
    stg = staged(
        spark,
        {"InvoiceNo": "1"},
        {"InvoiceNo": "2", "InvoiceDate": "1/1/26 0:00"},
        {"InvoiceNo": "3", "InvoiceDate": "?"},
        {"InvoiceNo": "4", "Country": "Narnia"},
        {"InvoiceNo": "5", "Quantity": "-2", "UnitPrice": "1.005"},
    )
    fact = staging.fact_transactions(stg, dim.dim_date(spark), dim.dim_location(spark))
    rows = {row.invoice_id: row for row in fact.collect()}
    assert len(rows) == 5
    assert rows["1"].date_id == 700 and rows["1"].country_id == 225
    assert rows["1"].total_price_eur == D("15.30")
    assert rows["2"].date_id is None and rows["2"].event_timestamp_invoiced_at is not None
    assert rows["3"].date_id is None
    assert rows["4"].country_id is None
    assert rows["5"].total_price_eur == D("-2.01")
    assert [f.name for f in fact.schema] == TABLES["fact_transactions"].fieldNames()


def test_all_uppercase(spark):
    texts = ["ABC 1", "abc", "Abc", "123", "", None, "É!", "A?"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", fn.is_all_uppercase(F.col("t")).alias("u"))
    assert {r.t: r.u for r in df.collect()} == {t: (None if t is None else t.isupper()) for t in texts}
