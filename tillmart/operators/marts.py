"""Marts over the star schema.

Money stays decimal with two places in here, so sums are exact and do not
depend on the order of the rows; ``schemas.as_published`` turns it into double.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillmart.functions import columns as fn
from tillmart.operators import grouped
from tillmart.schemas import FLAGS, MONEY_SUM

INVOICE_FLAGS = ["is_return", *FLAGS]
INT_MAX = 2**31 - 1
TIME = "event_timestamp_invoiced_at"


def _transactions(unique: bool) -> Column:
    """Number of transactions; a row is one if no dimension key is repeated."""
    return F.count(F.lit(1)) if unique else F.countDistinct("transaction_id")


def int_items(fact: DataFrame, items: DataFrame, families: DataFrame, transactions_unique: bool = False) -> DataFrame:
    """Sales per item that has a family.

    The fact is summed per item before the joins. That is exact: an output row
    belongs to one item row and one family row, so a fact row counts in it once,
    even where a family has two descriptions. ``transactions_unique``: see ``int_customers``; the fact's rows are then moved once only.
    """
    if transactions_unique:
        lines, salted = grouped.with_salt(fact.select("item_uuid", "customer_id", "total_price_eur", "quantity_amount"), "item_uuid", "customer_id")
        measures = {
            "total_sales_amount": money("total_price_eur"),
            "total_quantity": (F.sum("quantity_amount"), F.sum),
            "total_transactions": (F.count(F.lit(1)), F.sum),
        }
        sales = grouped.totals(with_packed_item(lines), ["item_uuid"], "customer_id", "total_customers", measures, ["item_uuid"], salted)
    else:
        sales = with_packed_item(fact).groupBy("item_uuid").agg(
            F.sum("total_price_eur").cast(MONEY_SUM).alias("total_sales_amount"),
            F.countDistinct("customer_id").alias("total_customers"),
            F.sum("quantity_amount").alias("total_quantity"),
            _transactions(transactions_unique).alias("total_transactions"),
        )
    found = described_sales(sales, with_packed_item(items), families)
    return found.withColumn("item_uuid", fn.unpacked(F.col("item_uuid")))


def money(column: str) -> tuple[Column, Callable[[str], Column]]:
    """A sum of money, and how such sums are summed (``grouped.totals``)."""
    return F.sum(column).cast(MONEY_SUM), lambda name: F.sum(name).cast(MONEY_SUM)


def with_packed_item(rows: DataFrame) -> DataFrame:
    """Rows with the item's key in bytes, for joins and groupings that shuffle many of them."""
    return rows.withColumn("item_uuid", fn.packed(F.col("item_uuid")))


def described_sales(sales: DataFrame, items: DataFrame, families: DataFrame) -> DataFrame:
    """Sales by item with the item's and its family's columns; items without a family go."""
    described = items.select("item_uuid", "item_description", "item_family_id", *FLAGS).join(
        families, "item_family_id"
    )
    return sales.join(described, "item_uuid").select(
        "item_uuid",
        "item_description",
        "item_family_id",
        "item_family_description",
        "item_category",
        *FLAGS,
        "total_sales_amount",
        "total_customers",
        "total_quantity",
        "total_transactions",
    )


def int_transactions(
    fact: DataFrame, items: DataFrame, families: DataFrame, dim_date: DataFrame, dim_location: DataFrame, *also: str
) -> DataFrame:
    """Every fact row with its item, family, place and day, and the columns ``also`` of the fact.

    Items take their family first, so the fact is shuffled at most once.
    """
    described = with_packed_item(items).join(families, "item_family_id", "left").select(
        "item_uuid",
        F.col("item_id").alias("known_item_id"),
        "item_description",
        "item_family_description",
        "item_category",
        "item_variant",
        *FLAGS,
    )
    places = dim_location.select(F.col("country_id").alias("place_id"), "country_name")
    days = dim_date.select(F.col("date_id").alias("day_id"), "date", "day_of_week")
    return (
        with_packed_item(fact).join(described, "item_uuid", "left")
        .join(places, F.col("country_id") == F.col("place_id"), "left")
        .join(days, F.col("date_id") == F.col("day_id"), "left")
        .select(
            "transaction_id",
            "invoice_id",
            fn.unpacked(F.col("item_uuid")).alias("item_uuid"),
            F.col("known_item_id").alias("item_id"),
            "item_description",
            "item_family_description",
            "item_category",
            "item_variant",
            *FLAGS,
            F.round("unit_price_eur", 2).alias("unit_price_eur"),
            "total_price_eur",
            "quantity_amount",
            "customer_id",
            F.col("place_id").alias("country_id"),
            "country_name",
            F.col("day_id").alias("date_id"),
            "date",
            "day_of_week",
            fn.is_return(F.col("quantity_amount"), F.col("total_price_eur")).alias("is_return"),
            *also,
        )
    )


def _invoice_measures() -> list[Column]:
    return [
        F.sum("total_price_eur").cast(MONEY_SUM).alias("total_invoice_amount"),
        F.sum("quantity_amount").alias("total_quantity"),
        F.countDistinct(fn.packed(F.col("item_uuid"))).alias("total_items"),
    ]


def has(flag: str) -> str:
    return flag.replace("is_", "has_", 1)


def named_invoices(rolled: DataFrame, dim_date: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Grouped rows with the names of day and place, looked up by their keys."""
    days = dim_date.select("date_id", "date", "day_of_week")
    return (
        rolled.join(days, "date_id", "left")
        .join(dim_location.select("country_id", "country_name"), "country_id", "left")
        .select(
            "invoice_id",
            "date_id",
            "date",
            "customer_id",
            "country_name",
            "day_of_week",
            "country_id",
            "total_invoice_amount",
            "total_quantity",
            "total_items",
            *[has(flag) for flag in INVOICE_FLAGS],
        )
    )


def int_invoices(transactions: DataFrame, dim_date: DataFrame, dim_location: DataFrame, short_items: bool = False) -> DataFrame:
    """One row per invoice, day, customer and country; the transactions are moved once.

    ``short_items`` says that no two of the items' keys share a hash (``Lake.keys_unique`` tells), so that hashes are counted in place of keys.
    """
    keys = ["invoice_id", "date_id", "customer_id", "country_id"]
    item = F.col("item_uuid")
    lines = transactions.select(
        *keys,
        (fn.short(item) if short_items else fn.packed(item)).alias("item"),
        "total_price_eur",
        "quantity_amount",
        fn.flag_bits(INVOICE_FLAGS).alias("flags"),
    )
    lines, salted = grouped.with_salt(lines, "invoice_id", "item")
    measures = {
        "total_invoice_amount": money("total_price_eur"),
        "total_quantity": (F.sum("quantity_amount"), F.sum),
        "flags": (F.bit_or("flags"), F.bit_or),
    }
    rolled = grouped.totals(lines, keys, "item", "total_items", measures, ["invoice_id"], salted)
    rolled = rolled.withColumns({has(flag): fn.flag_of(F.col("flags"), place) for place, flag in enumerate(INVOICE_FLAGS)})
    return named_invoices(rolled, dim_date, dim_location)


def _of_first_line(column: str) -> Column:
    """Known value of an int column on the earliest line that has one; the smallest of lines at the same time.

    Time and value are packed into one decimal, so the minimum is kept in a hash
    table; a minimum over a struct would sort every task's rows first.
    """
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(TIME))
    late = F.lit(2**62)
    packed = F.coalesce(micros, late).cast("decimal(19,0)") * F.lit(10**10).cast("decimal(11,0)") + (
        F.col(column).cast("bigint") + INT_MAX + 1
    ).cast("decimal(10,0)")
    value = F.pmod(F.min(packed), F.lit(10**10).cast("decimal(11,0)")).cast("bigint") - (INT_MAX + 1)
    return value.cast("int").alias(column)


def invoice_first(timed: DataFrame, dim_date: DataFrame, dim_location: DataFrame) -> DataFrame:
    """One row per invoice: day, customer and country of the first line that has one, missing flags as false.

    ``timed`` are the transactions with the time of each (``int_transactions``, also ``TIME``).
    """
    rolled = (
        timed.filter(F.col("invoice_id").isNotNull())
        .groupBy("invoice_id")
        .agg(
            _of_first_line("date_id"),
            _of_first_line("customer_id"),
            _of_first_line("country_id"),
            *_invoice_measures(),
            *[F.coalesce(F.bool_or(flag), F.lit(False)).alias(has(flag)) for flag in INVOICE_FLAGS],
        )
    )
    return named_invoices(rolled, dim_date, dim_location)


def category_counts(transactions: DataFrame, *keys: str) -> DataFrame:
    return transactions.groupBy(*keys, "item_category").agg(F.count("*").alias("category_count"))


def top_category(counts: DataFrame, *keys: str) -> DataFrame:
    """Most frequent category per key; ties go to the first in order, NULL last."""
    order = Window.partitionBy(*keys).orderBy(
        F.desc("category_count"), F.asc_nulls_last("item_category")
    )
    return counts.withColumn("category_rank", F.row_number().over(order)).filter("category_rank = 1")


def favorite_category(transactions: DataFrame) -> DataFrame:
    return top_category(category_counts(transactions, "customer_id"), "customer_id")


def _customer_measures(transactions_unique: bool) -> list[Column]:
    return [
        F.sum("total_price_eur").cast(MONEY_SUM).alias("amount"),
        F.sum("quantity_amount").alias("total_quantity"),
        _transactions(transactions_unique).alias("total_transactions"),
        F.countDistinct("invoice_id").alias("total_invoices"),
        F.count_if("is_return").alias("total_returns"),
    ]


def _rolled_customers(transactions: DataFrame) -> DataFrame:
    """``_customer_measures`` by customer and country, where each transaction is one row."""
    lines = transactions.select("customer_id", "country_name", "invoice_id", "total_price_eur", "quantity_amount", "is_return")
    lines, salted = grouped.with_salt(lines, "customer_id", "invoice_id")
    measures = {
        "amount": money("total_price_eur"),
        "total_quantity": (F.sum("quantity_amount"), F.sum),
        "total_transactions": (F.count(F.lit(1)), F.sum),
        "total_returns": (F.count_if("is_return"), F.sum),
    }
    return grouped.totals(lines, ["customer_id", "country_name"], "invoice_id", "total_invoices", measures, ["customer_id"], salted)


def _customer_columns() -> list[Column]:
    return [
        F.col("amount").alias("total_sales_amount"),
        F.col("total_quantity"),
        F.col("total_transactions"),
        F.col("total_invoices"),
        F.col("total_returns"),
        F.col("favorite_category"),
        fn.ratio(F.col("amount"), F.col("total_transactions")).alias("avg_sales_per_transaction"),
    ]


def int_customers(transactions: DataFrame, transactions_unique: bool = False) -> DataFrame:
    """One row per customer and country, with the customer's favourite category.

    ``transactions_unique`` says that no dimension key is repeated, so that each
    transaction is one row and needs no distinct count (``quality.keys_unique``
    tells). Anonymous sales form one group per country, without a favourite.
    The favourite joins the grouped rows, not the transactions, which are moved once for the sums if ``transactions_unique``.
    """
    if transactions_unique:
        rolled = _rolled_customers(transactions)
    else:
        rolled = transactions.groupBy("customer_id", "country_name").agg(*_customer_measures(transactions_unique))
    return with_favorites(rolled, category_counts(transactions.filter(F.col("customer_id").isNotNull()), "customer_id"))


def with_favorites(rolled: DataFrame, counts: DataFrame) -> DataFrame:
    """Rolled-up customers with the category each has most often in ``counts``."""
    favorites = top_category(counts, "customer_id").select("customer_id", F.col("item_category").alias("favorite_category"))
    return rolled.join(favorites, "customer_id", "left").select("customer_id", "country_name", *_customer_columns())


def customer_mode_category(transactions: DataFrame, transactions_unique: bool = False) -> DataFrame:
    """Known customers per country, with key and the most frequent known category there."""
    keys = ["customer_id", "country_name"]
    known = transactions.dropna(subset=keys)
    modes = top_category(
        category_counts(known.filter(F.col("item_category").isNotNull()), *keys), *keys
    ).select(*keys, F.col("item_category").alias("favorite_category"))
    rolled = _rolled_customers(known) if transactions_unique else known.groupBy(*keys).agg(*_customer_measures(transactions_unique))
    return (
        rolled.join(modes, keys, "left")
        .select(
            fn.joined_hash(F.col("customer_id"), F.col("country_name"), algorithm="md5").alias("customer_uuid"),
            *keys,
            *_customer_columns(),
        )
    )
