"""Dimension tables: calendar, location, item family, items, customers."""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillmart.functions import columns as fn
from tillmart.functions.places import COUNTRY_LOCALES, DEFAULT_LOCALE, LOCATIONS, NAMES
from tillmart.functions.vocabulary import FLAG_TEXTS
from tillmart.schemas import FLAGS, TABLES, conform

CALENDAR_START = "2009-01-01"
CALENDAR_END = "2025-12-31"
POOL_SIZE = 30
POOL_SEED = 17


def literal_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """Rows held in the plan; the planner knows their size and can broadcast them."""
    return spark.createDataFrame(pa.table({name: list(values) for name, values in zip(names, zip(*rows))}))


def dim_item_family(raw: DataFrame) -> DataFrame:
    return raw.select(
        fn.lenient_int(F.col("item_family")).alias("item_family_id"),
        F.col("item_family_description").cast("string"),
        F.col("category").cast("string").alias("item_category"),
    ).dropDuplicates()


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """Attributes of each day; the id counts days, so no window over all rows is needed."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    days = spark.range(1).select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date"))
    date = F.col("date")
    return days.select(
        date,
        (F.datediff(date, first) + 1).alias("date_id"),
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.day(date).alias("day"),
        F.date_format(date, "EEEE").alias("day_of_week"),
        F.dayofweek(date).isin(1, 7).alias("is_weekend"),
    )


def dim_location(spark: SparkSession, rows: list[tuple] = LOCATIONS) -> DataFrame:
    schema = TABLES["dim_location"]
    return conform(literal_table(spark, rows, schema.fieldNames()), schema)


def dim_items(stg: DataFrame) -> DataFrame:
    """One row per item text, with family, variant and the five flags."""
    return described_items(stg.select("item_uuid", "item_id", "item_description").distinct())


def described_items(items: DataFrame) -> DataFrame:
    """Item texts, each of which is one row, with family, variant and the five flags."""
    item_id, description = F.col("item_id"), F.col("item_description")
    return items.select(
        "item_uuid",
        "item_id",
        fn.family_id(item_id).alias("item_family_id"),
        "item_description",
        fn.variant(item_id).alias("item_variant"),
        fn.is_operational(item_id).alias("is_operational_item"),
        *[fn.in_texts(description, texts).alias(flag) for flag, texts in FLAG_TEXTS.items()],
    )


def null_text_is_unknown(items: DataFrame) -> DataFrame:
    """Variant of the flags in which a missing description counts as unknown."""
    return items.withColumn(
        "is_unknown_item", F.col("is_unknown_item") | F.col("item_description").isNull()
    )


def flags_ignoring_case(items: DataFrame) -> DataFrame:
    """Variant in which the lower-cased description is compared with the lists as they are."""
    lowered = F.lower("item_description")
    return items.withColumns({flag: fn.in_texts(lowered, texts) for flag, texts in FLAG_TEXTS.items()})


def mask_operational(items: DataFrame) -> DataFrame:
    """Operational items lose variant and other flags; flagged items have NULL for empty text."""
    operational = F.col("is_operational_item")
    others = [flag for flag in FLAGS if flag != "is_operational_item"]
    cleared = items.withColumns(
        {
            "item_variant": F.when(~operational, F.col("item_variant")),
            **{flag: ~operational & F.col(flag) for flag in others},
        }
    )
    flagged = F.lit(False)
    for flag in others:
        flagged = flagged | F.col(flag)
    texts = ["item_id", "item_description", "item_variant"]
    return cleared.withColumns(
        {text: F.when(flagged, F.nullif(F.col(text), F.lit(""))).otherwise(F.col(text)) for text in texts}
    )


def name_pool(spark: SparkSession, locales: dict[str, str] = COUNTRY_LOCALES, size: int = POOL_SIZE) -> DataFrame:
    """``size`` numbered names per country, built from the name lists of its language."""
    rows = []
    for country, locale in locales.items():
        first, last = NAMES[locale[:2]]
        for idx in range(size):
            name = f"{first[idx % len(first)]} {last[idx // len(first) % len(last)]}"
            rows.append((country, idx, name))
    return literal_table(spark, rows, ["country_name", "idx", "customer_name"])


def country_locale(countries: DataFrame) -> DataFrame:
    return countries.select(
        "country_name", fn.lookup(F.col("country_name"), COUNTRY_LOCALES, DEFAULT_LOCALE).alias("locale")
    )


def first_country(stg: DataFrame) -> DataFrame:
    """Country of each customer's earliest dated line; ties go to the first name.

    The first grouping keeps one row per customer and country on the map side,
    so a customer with very many lines is not gathered in one task.
    """
    seen = (
        stg.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "country_name")
        .agg(F.min("event_timestamp_invoiced_at").alias("first_seen"))
    )
    order = F.struct(F.col("country_name").isNull(), F.col("first_seen").isNull(), "first_seen", "country_name")
    return seen.groupBy("customer_id").agg(F.min_by("country_name", order).alias("country_name"))


def dim_customers(stg: DataFrame, pool: DataFrame, size: int = POOL_SIZE, seed: int = POOL_SEED) -> DataFrame:
    """Customers with a name drawn from their country's pool by a hash of the id."""
    slot = F.pmod(F.col("customer_id").cast("bigint") * F.lit(2654435761) + F.lit(seed), F.lit(size))
    return (
        first_country(stg)
        .withColumn("idx", slot)
        .join(pool, ["country_name", "idx"], "left")
        .withColumn("customer_name", F.coalesce("customer_name", F.lit("Unknown")))
        .drop("country_name", "idx")
    )
