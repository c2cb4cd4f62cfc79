import datetime
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.feed import families, sales
from tillmart.functions import columns as fn
from tillmart.functions.places import COUNTRY_LOCALES, FEED_COUNTRIES, LOCATIONS, NAMES
from tillmart.functions.vocabulary import CATEGORIES, CATEGORY_RULES, FLAG_TEXTS
from tillmart.operators import dimensions as dim, staging
from tillmart.schemas import FLAGS, TABLES


def items_of(spark, *rows):
    return dim.dim_items(staging.stg_transactions(sales(spark, *rows)))


def item(spark, code="85123A", text="WHITE HANGING HEART"):
    return items_of(spark, {"StockCode": code, "Description": text}).first()


def flags(row):
    return {flag for flag in FLAGS if row[flag]}


@pytest.mark.parametrize(
    "code, operational, family, variant",
    [
        ("22423", False, 22423, None),
        ("85123A", False, 85123, "A"),
        ("POST", True, None, "POST"),
        ("gift_0001_20", True, None, ""),
        ("DCGSSGIFT", True, None, "DCGSSGIFT"),
        ("9999999999999A", False, None, "A"),
        ("15056-7", False, 15056, ""),
        (None, False, None, ""),
    ],
)
def test_item_code(spark, code, operational, family, variant):
    row = item(spark, code)
    assert (row.is_operational_item, row.item_family_id, row.item_variant) == (operational, family, variant)


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, set()),
        ("?", {"is_unknown_item"}),
        ("label mix up", {"is_error_item", "is_modification_item"}),
        ("sold as set by dotcom", {"is_special_item", "is_modification_item"}),
        ("damaged", {"is_error_item"}),
        ("DAMAGED", {"is_error_item"}),
        ("dAmaged", set()),
        ("Dotcomgiftshop Gift Voucher £100.00", {"is_special_item"}),
        ("mailout ", {"is_modification_item"}),
    ],
)
def test_flags(spark, text, expected):
    assert flags(item(spark, text=text)) == expected


def test_vocabulary_sizes():
    assert {flag: len(texts) for flag, texts in FLAG_TEXTS.items()} == {
        "is_unknown_item": 6,
        "is_special_item": 38,
        "is_modification_item": 31,
        "is_error_item": 113,
    }
    assert len(CATEGORIES) == 31
    assert {category for _, category in CATEGORY_RULES} <= set(CATEGORIES)


def test_flag_variants(spark):
    items = items_of(spark, {"Description": None}, {"Description": "dAmaged"}, {"Description": "FBA"})
    unknown = dim.null_text_is_unknown(items).filter("is_unknown_item").collect()
    assert [row.item_description for row in unknown] == [None]
    ignoring = {r.item_description: flags(r) for r in dim.flags_ignoring_case(items).collect()}
    assert ignoring == {None: set(), "dAmaged": {"is_error_item"}, "FBA": set()}


def test_masked_flags(spark):
    rows = [
        {"StockCode": "POST", "Description": "damaged"},
        {"StockCode": "15056-7", "Description": "damaged"},
        {"StockCode": "15056-7", "Description": "BOX"},
    ]
    masked = {(r.item_id, r.item_description): r for r in dim.mask_operational(items_of(spark, *rows)).collect()}
    post = masked["POST", "damaged"]
    assert flags(post) == {"is_operational_item"} and post.item_variant is None
    assert masked["15056-7", "damaged"].item_variant is None
    assert masked["15056-7", "BOX"].item_variant == ""


def test_family(spark):
    raw = families(spark, ("22423", "CAKE STAND", "X"), ("22423", "CAKE STAND", "X"), ("", "NONE", "Y"))
    rows = {tuple(row) for row in dim.dim_item_family(raw).collect()}
    assert rows == {(22423, "CAKE STAND", "X"), (None, "NONE", "Y")}


def test_calendar(spark):
    dates = dim.dim_date(spark)
    assert [(f.name, f.dataType) for f in dates.schema] == [(f.name, f.dataType) for f in TABLES["dim_date"]]
    rows = dates.orderBy("date").collect()
    assert [row.date_id for row in rows] == list(range(1, 6210))
    first = datetime.date(2009, 1, 1)
    for offset, row in enumerate(rows):
        day = first + datetime.timedelta(days=offset)
        assert row == (day, offset + 1, day.year, day.month, day.day, day.strftime("%A"), day.weekday() >= 5)


def test_locations(spark):
    places = dim.dim_location(spark)
    rows = {row.country_name: row for row in places.collect()}
    assert len(rows) == 244 and sorted(row.country_id for row in rows.values()) == list(range(1, 245))
    assert tuple(rows["Hong Kong"]) == (96, "HK", "Hong Kong", "HONG KONG")
    assert tuple(rows["Vietnam"]) == (232, "VN", "Vietnam", "VIET NAM")
    assert tuple(rows["EIRE"]) == (240, "IE", "EIRE", "EIRE")
    assert set(COUNTRY_LOCALES) == {name for _, _, name, _ in FEED_COUNTRIES}
    fewer = dim.dim_location(spark, LOCATIONS[:3])
    assert fewer.count() == 3 and fewer.schema == places.schema == TABLES["dim_location"]


def test_sale_in_hong_kong(spark):
    stg = staging.stg_transactions(sales(spark, {"Country": "Hong Kong"}))
    assert staging.fact_transactions(stg, dim.dim_date(spark), dim.dim_location(spark)).first().country_id == 96


def test_customers(spark):
    stg = staging.stg_transactions(
        sales(
            spark,
            {"CustomerID": "1", "Country": "France", "InvoiceDate": "1/2/11 0:00"},
            {"CustomerID": "1", "Country": "EIRE", "InvoiceDate": "1/1/11 0:00"},
            {"CustomerID": "2", "Country": "Narnia"},
            {"CustomerID": "3", "Country": None, "InvoiceDate": "1/1/11 0:00"},
            {"CustomerID": "3", "Country": "Italy", "InvoiceDate": "1/3/11 0:00"},
            {"CustomerID": None},
        )
    )
    country = {row.customer_id: row.country_name for row in dim.first_country(stg).collect()}
    assert country == {1: "EIRE", 2: "Narnia", 3: "Italy"}
    pool = dim.name_pool(spark)
    customers = {row.customer_id: row.customer_name for row in dim.dim_customers(stg, pool).collect()}
    assert set(customers) == {1, 2, 3} and customers[2] == "Unknown"
    slot = (2654435761 + dim.POOL_SEED) % dim.POOL_SIZE
    assert customers[1] == pool.filter((F.col("country_name") == "EIRE") & (F.col("idx") == slot)).first().customer_name
    assert pool.count() == pool.distinct().count() == 37 * 30
    assert pool.select("country_name", "customer_name").distinct().count() == 37 * 30
    assert {locale[:2] for locale in COUNTRY_LOCALES.values()} <= set(NAMES)


def test_locales(spark):
    df = spark.createDataFrame([("Japan",), ("Narnia",), (None,)], "country_name string")
    assert {r.country_name: r.locale for r in dim.country_locale(df).collect()} == {
        "Japan": "ja_JP",
        "Narnia": "en_US",
        None: "en_US",
    }


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="019AZaz_ -gift", max_size=14), min_size=50, max_size=80))
def test_item_codes_like_regular_expressions(spark, codes):
    df = spark.createDataFrame([(code,) for code in codes], "c string")
    code = F.col("c")
    rows = df.select(
        "c", fn.leading_digits(code).alias("d"), fn.variant(code).alias("v"), fn.is_operational(code).alias("o")
    )
    for row in rows.collect():
        digits = re.match("[0-9]+", row.c)
        letters = re.search("[A-Za-z]+$", row.c)
        assert row.d == (digits and digits[0])
        assert row.v == (None if digits and digits[0] == row.c else letters[0] if letters else "")
        assert row.o == (len(row.c) < 5 or "gift" in row.c.lower())
