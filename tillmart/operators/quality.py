"""Quality counts over the feed, the fact and the dimension keys."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tillmart.functions import columns as fn
from tillmart.sources.files import MALFORMED


def _named(counts: DataFrame) -> DataFrame:
    """One row of counts turned into rows of name and count."""
    return counts.unpivot([], counts.columns, "check_name", "n_rows")


def feed_checks(lines: DataFrame) -> DataFrame:
    """Lines, malformed ones, missing values and values that could not be read, in one pass.

    ``lines`` may have the column ``MALFORMED``; values are those of well-formed lines.
    """
    good = F.col(MALFORMED).isNull() if MALFORMED in lines.columns else F.lit(True)

    def rejected(column, parsed):
        return F.count_if(good & F.col(column).isNotNull() & parsed.isNull())

    def missing(column):
        return F.count_if(good & F.col(column).isNull())

    return _named(
        lines.agg(
            F.count("*").alias("feed_lines"),
            F.count_if(~good).alias("malformed_lines"),
            rejected("Quantity", fn.lenient_int(F.col("Quantity"))).alias("rejected_quantity"),
            rejected("UnitPrice", fn.lenient_price(F.col("UnitPrice"))).alias("rejected_price"),
            rejected("CustomerID", fn.lenient_int(F.col("CustomerID"))).alias("rejected_customer"),
            rejected("InvoiceDate", fn.wall_clock(F.col("InvoiceDate"))).alias("rejected_date"),
            missing("Description").alias("missing_description"),
            missing("CustomerID").alias("missing_customer"),
            missing("Quantity").alias("missing_quantity"),
            missing("UnitPrice").alias("missing_price"),
            missing("InvoiceDate").alias("missing_date"),
        )
    )


def _total(column: str):
    return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")


def fact_checks(fact: DataFrame, items: DataFrame) -> DataFrame:
    """Fact rows whose keys found no dimension row, totals that do not fit, and repeated item keys.

    Both tables are grouped by item first, so each is read once and a hot item is one row.
    """
    known = F.col("quantity_amount").isNotNull() & F.col("unit_price_eur").isNotNull()
    dated = F.col("event_timestamp_invoiced_at").isNotNull()
    counts = {
        "fact_without_time": F.count_if(~dated),
        "fact_outside_calendar": F.count_if(dated & F.col("date_id").isNull()),
        "fact_without_country": F.count_if(F.col("country_id").isNull()),
        "fact_total_too_large": F.count_if(known & F.col("total_price_eur").isNull()),
    }
    sold = fact.groupBy("item_uuid").agg(F.count("*").alias("n_fact"), *[count.alias(name) for name, count in counts.items()])
    listed = items.groupBy("item_uuid").agg(F.count("*").alias("n_items"))
    lost = F.when(F.col("n_items").isNull(), F.col("n_fact"))
    return _named(
        sold.join(listed, "item_uuid", "full")
        .withColumn("lost", lost)
        .agg(
            *[_total(name).alias(name) for name in counts],
            _total("lost").alias("fact_without_item"),
            F.count_if(F.col("item_uuid").isNotNull() & (F.col("n_items") > 1)).alias("repeated_item_uuid"),
        )
    )


def family_checks(items: DataFrame, families: DataFrame) -> DataFrame:
    """Items without a family, and repeated families; both tables are grouped by family first."""
    owned = items.groupBy("item_family_id").agg(F.count("*").alias("n_items"))
    listed = families.groupBy("item_family_id").agg(F.count("*").alias("n_families"))
    lost = F.when(F.col("n_families").isNull(), F.col("n_items"))
    return _named(
        owned.join(listed, "item_family_id", "full")
        .withColumn("lost", lost)
        .agg(
            _total("lost").alias("items_without_family"),
            F.count_if(F.col("item_family_id").isNotNull() & (F.col("n_families") > 1)).alias("repeated_item_family_id"),
        )
    )


def repeated_key_checks(dimension: DataFrame, *keys: str) -> DataFrame:
    """How many values of each key are repeated, in one pass over the dimension."""
    listed = F.array(*[F.struct(F.lit(f"repeated_{key}").alias("check_name"), F.col(key).cast("string").alias("key")) for key in keys])
    sizes = dimension.select(F.explode(listed).alias("k")).groupBy("k.check_name", "k.key").agg(F.count("*").alias("n"))
    found = F.count_if(F.col("key").isNotNull() & (F.col("n") > 1))
    return sizes.groupBy("check_name").agg(found.alias("n_rows"))


def repeated_keys(dimension: DataFrame, key: str) -> DataFrame:
    return (
        dimension.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
    )


def keys_unique(*dimensions: tuple[DataFrame, str]) -> bool:
    """Whether no key occurs twice, so that joins to the fact add no rows.

    Hashes of 64 bits are compared: no two keys share one either, or the answer is no.
    """
    hashes = [dimension.select(F.when(F.col(key).isNotNull(), F.xxhash64(key)).alias(key)) for dimension, key in dimensions]
    found = [repeated_keys(held, held.columns[0]).select(F.lit(1)) for held in hashes]
    return reduce(DataFrame.unionAll, found).isEmpty()


def quality_report(
    lines: DataFrame,
    fact: DataFrame,
    items: DataFrame,
    families: DataFrame,
    dim_date: DataFrame,
    dim_location: DataFrame,
) -> DataFrame:
    parts = [
        feed_checks(lines),
        fact_checks(fact, items),
        family_checks(items, families),
        repeated_key_checks(dim_date, "date_id", "date"),
        repeated_key_checks(dim_location, "country_id", "country_name"),
    ]
    return reduce(DataFrame.unionByName, parts)
