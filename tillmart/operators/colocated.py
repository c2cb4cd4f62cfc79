"""Fact and items in buckets of the item, so that no join to items moves the fact.

Both are written once in as many buckets, by item and salt. The salt is 0, but for hot items: their fact rows
have the salts from 1 to ``SALTS``, and their item row is there once for each. So a bucket is of bounded size however many
of the fact's rows one item has, and joins and sums by item need no shuffle of the fact.
"""

from pyspark.sql import DataFrame, functions as F

from tillmart.functions import columns as fn
from tillmart.operators import marts
from tillmart.schemas import FLAGS, MONEY_SUM

BUCKETS, SALTS = 32, 16
#: An item is hot if it has more than this share of the fact's rows, so there are at most 50 hot items.
HOT_SHARE = 0.02
#: Rows of calendar and locations that are sent to all tasks; larger ones are joined as the planner likes.
SENT = 100_000


def hot_items(fact: DataFrame) -> DataFrame:
    """Items with more than ``HOT_SHARE`` of the rows; at most 1 / ``HOT_SHARE`` of them."""
    counts = fact.groupBy("item_uuid").agg(F.count("*").alias("n"))
    total = fact.agg((F.count("*") * F.lit(HOT_SHARE)).alias("most"))
    return counts.join(F.broadcast(total), F.col("n") > F.col("most")).filter(F.col("item_uuid").isNotNull()).select("item_uuid", F.lit(SALTS).alias("salts"))


def write_buckets(df: DataFrame, table: str, path: str) -> None:
    """``df`` as a catalog table over ``path``, in buckets by item and salt; one file a bucket."""
    (
        df.repartition(BUCKETS, "item_uuid", "salt")
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(BUCKETS, "item_uuid", "salt")
        .sortBy("item_uuid", "salt")
        .saveAsTable(table)
    )


def write_colocated(fact: DataFrame, items: DataFrame, families: DataFrame, tables: tuple[str, str], path: str) -> None:
    """``tables``: the fact with a salt, and the items with their families."""
    hot = F.broadcast(hot_items(fact))
    salt = F.coalesce(F.pmod(F.xxhash64("transaction_id"), F.col("salts")).cast("int") + 1, F.lit(0))
    salted = fact.join(hot, "item_uuid", "left").withColumn("salt", salt)
    write_buckets(salted.drop("salts"), tables[0], f"{path}/fact")
    described = items.join(families, "item_family_id", "left").join(hot, "item_uuid", "left")
    salts = F.when(F.col("salts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(1), F.col("salts")))
    write_buckets(described.withColumn("salt", F.explode(salts)).drop("salts"), tables[1], f"{path}/items")


def _sent(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(SENT + 1).count() <= SENT else df


def transactions(fact: DataFrame, described: DataFrame, dim_date: DataFrame, dim_location: DataFrame, send: bool = True) -> DataFrame:
    """``marts.int_transactions`` of tables that ``write_colocated`` has written: buckets are merged in place.

    Without ``send``, the planner sends calendar and locations to all tasks or does not, as their sizes say.
    """
    places = dim_location.select(F.col("country_id").alias("place_id"), "country_name")
    days = dim_date.select(F.col("date_id").alias("day_id"), "date", "day_of_week")
    if send:
        places, days = _sent(places), _sent(days)
    known = described.withColumnsRenamed({"item_id": "known_item_id"}).drop("item_family_id")
    return (
        fact.join(known, ["item_uuid", "salt"], "left")
        .join(places, F.col("country_id") == F.col("place_id"), "left")
        .join(days, F.col("date_id") == F.col("day_id"), "left")
        .select(
            "transaction_id",
            "invoice_id",
            "item_uuid",
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
        )
    )


def items_mart(fact: DataFrame, items: DataFrame, families: DataFrame) -> DataFrame:
    """``marts.int_items``: summed within the buckets; of hot items the sums by salt and customer are shuffled, of others nothing but the item's row."""
    measures = [
        F.sum("total_price_eur").cast(MONEY_SUM).alias("total_sales_amount"),
        F.sum("quantity_amount").alias("total_quantity"),
        F.countDistinct("transaction_id").alias("total_transactions"),
    ]
    names = ["total_sales_amount", "total_quantity", "total_transactions"]
    # an item without salts has all of its rows in one bucket
    by_customer = fact.groupBy("item_uuid", "salt", "customer_id").agg(*measures)
    cold = _summed(by_customer.filter("salt = 0"), names, "item_uuid", "salt").drop("salt")
    hot = by_customer.filter("salt > 0").groupBy("item_uuid", "customer_id").agg(*[F.sum(name).alias(name) for name in names])
    return marts.described_sales(cold.unionByName(_summed(hot, names, "item_uuid")), items, families)


def _summed(by_customer: DataFrame, names: list[str], *keys: str) -> DataFrame:
    sums = [F.sum(name).alias(name) for name in names]
    sales = by_customer.groupBy(*keys).agg(*sums, F.count("customer_id").alias("total_customers"))
    return sales.withColumn("total_sales_amount", F.col("total_sales_amount").cast(MONEY_SUM))
