"""Raw sales lines to typed staging rows and the transaction fact."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from tillmart.functions import columns as fn


def with_transaction_id(df: DataFrame) -> DataFrame:
    """Unique, not dense, and only fixed once the rows are written."""
    return df.withColumn("transaction_id", F.monotonically_increasing_id())


def typed_sales(
    raw: DataFrame, algorithm: str = "sha256", patterns: Iterable[str] = (fn.INVOICE_TIME_PATTERN,)
) -> DataFrame:
    """Raw text columns cast, dated and keyed; an unreadable value becomes NULL."""
    item_id, description = F.col("StockCode"), F.col("Description")
    return raw.select(
        F.col("InvoiceNo").alias("invoice_id"),
        item_id.alias("item_id"),
        description.alias("item_description"),
        fn.lenient_int(F.col("Quantity")).alias("quantity_amount"),
        fn.lenient_price(F.col("UnitPrice")).alias("unit_price_eur"),
        fn.lenient_int(F.col("CustomerID")).alias("customer_id"),
        F.col("Country").alias("country_name"),
        F.col("InvoiceDate").alias("raw_invoice_date"),
        fn.wall_clock(F.col("InvoiceDate"), patterns).alias("event_timestamp_invoiced_at"),
        fn.joined_hash(item_id, description, algorithm=algorithm).alias("item_uuid"),
    ).withColumn("date", F.to_date("event_timestamp_invoiced_at"))


# Columns of the staging table.
STAGING_COLUMNS = [
    "invoice_id",
    "item_id",
    "item_description",
    "quantity_amount",
    "unit_price_eur",
    "customer_id",
    "country_name",
    "raw_invoice_date",
    "event_timestamp_invoiced_at",
    "transaction_id",
    "item_uuid",
    "date",
]


def stg_transactions(
    raw: DataFrame, algorithm: str = "sha256", patterns: Iterable[str] = (fn.INVOICE_TIME_PATTERN,)
) -> DataFrame:
    return with_transaction_id(typed_sales(raw, algorithm, patterns)).select(STAGING_COLUMNS)


def fact_transactions(stg: DataFrame, dim_date: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Staging rows with calendar and country keys; a row without a match stays.

    Nothing is forced into a broadcast: the planner does that with a calendar
    and locations because it knows their size.
    """
    days = dim_date.select("date", "date_id")
    places = dim_location.select("country_name", "country_id")
    return (
        stg.join(days, "date", "left")
        .join(places, "country_name", "left")
        .select(
            "transaction_id",
            "invoice_id",
            "event_timestamp_invoiced_at",
            "date_id",
            "item_uuid",
            "item_id",
            "quantity_amount",
            "unit_price_eur",
            fn.line_total(F.col("quantity_amount"), F.col("unit_price_eur")).alias("total_price_eur"),
            "customer_id",
            "country_id",
        )
    )
