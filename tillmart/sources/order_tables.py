"""Order tables (lineitem, orders, part, customer, nation) as a raw sales feed.

Every line item becomes one line of the feed, all columns text. Some values
are made unreadable or odd on purpose, by rules over the keys, so that the
feed has what a real one has: fees, damaged goods, missing descriptions and
numbers, returns, anonymous buyers, dates in a wrong format, torn records. Lookups are left joins,
so a line is never lost.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillmart.functions.places import FEED_COUNTRIES

ODD_DESCRIPTIONS = [
    (53, None),
    (47, "?"),
    (43, "damaged"),
    (41, "Dotcom"),
    (37, "adjustment"),
    (31, "label mix up"),
    (29, "sold as 7 via ebay"),
]


def feed_country(nation_key: int, nation_name: str) -> str:
    """Four of five nations get a country of the feed; the fifth stays unknown."""
    return nation_name if nation_key % 5 == 4 else FEED_COUNTRIES[nation_key][2]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _description(key, part_key, line_number, name):
    upper = F.upper(name)
    text = (
        F.when(line_number == 7, F.concat(upper, F.lit(" LARGE EDITION")))
        .when(line_number == 6, F.concat(F.lit("new "), F.lower(name)))
        .when((line_number == 5) & (part_key % 3 == 0), F.lit("MINI"))
        .otherwise(upper)
    )
    for divisor, odd in reversed(ODD_DESCRIPTIONS):
        text = F.when(part_key % divisor == 0, F.lit(odd).cast("string")).otherwise(text)
    # a quoted line break, which tears the record in two
    return F.when((key % 229 == 0) & (line_number == 2), F.concat(upper, F.lit("\nSECOND LINE"))).otherwise(text)


def _invoice_time(moment, year):
    """``M/d/yy H:mm`` of a wall clock, from its parts, so that no zone takes a hand in it."""
    month, day, hour = (part(moment).cast("string") for part in (F.month, F.day, F.hour))
    minute = F.lpad(F.minute(moment).cast("string"), 2, "0")
    slash = F.lit("/")
    return F.concat(month, slash, day, slash, year, F.lit(" "), hour, F.lit(":"), minute)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key, buyer, day and nation of each order, as numbers: they are made texts after the lines have been moved."""
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").drop("c_custkey")


def _lines_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the numbers of their orders, those of a part together.

    So the few texts that a part's lines have are next to each other in all that is written from the feed, and a grouping by item
    finds most of an item's lines in one task. The rebalance hint cuts a part with very many lines.
    """
    key = F.col("l_orderkey")
    lines = _table(spark, sf_dir, "lineitem").select(
        key, "l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("quantity"), "l_returnflag"
    )
    known = lines.join(_orders(spark, sf_dir), key == F.col("o_orderkey"), "left").drop("o_orderkey")
    return known.hint("rebalance", "l_partkey").sortWithinPartitions("l_partkey")


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, line, item = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    nation_key, quantity = F.col("n_nationkey"), F.col("quantity")
    buyer = F.col("o_custkey").cast("string")
    signed = F.when(F.col("l_returnflag") == "R", -quantity).otherwise(quantity)
    countries = F.create_map(
        *[F.lit(v) for k in range(25) if k % 5 != 4 for v in (k, feed_country(k, ""))]
    )
    country = F.coalesce(F.try_element_at(countries, nation_key), F.col("n_name"))
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), ((key * 7) % 1440).cast("int"))
    # the last line of some orders comes a day later
    late = F.when((key % 5 == 0) & (line == 7), F.expr("interval 1 day")).otherwise(F.expr("interval 0 day"))
    year = F.year("moment").cast("string")
    time = _invoice_time("moment", F.when(key % 193 == 0, year).otherwise(F.substring(year, 3, 2)))
    return (
        _lines_by_part(spark, sf_dir)
        .join(_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice"), item == F.col("p_partkey"), "left")
        .join(_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == nation_key, "left")
        .withColumn("moment", F.col("o_orderdate") + F.expr("interval 14 years") + minutes + late)
        .select(
            key.cast("string").alias("InvoiceNo"),
            F.when(item % 97 == 0, "POST")
            .when(item % 89 == 0, "gift_0001_20")
            .otherwise(
                F.concat(
                    F.expr("10000 + l_partkey div 4").cast("string"),
                    F.when(item % 4 == 0, "").when(item % 4 == 1, "A").when(item % 4 == 2, "B").otherwise("bl"),
                )
            )
            .alias("StockCode"),
            _description(key, item, line, F.col("p_name")).alias("Description"),
            F.when(key % 211 == 0, "n/a")
            .when(key % 233 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(signed.cast("string"), F.when(key % 251 == 0, ".75").otherwise("")))
            .alias("Quantity"),
            F.when(key % 199 == 0, "unknown")
            .when(key % 241 == 0, F.lit(None).cast("string"))
            .otherwise(time)
            .alias("InvoiceDate"),
            F.when(key % 223 == 0, "free")
            .when(key % 239 == 0, F.lit(None).cast("string"))
            .otherwise(F.col("p_retailprice").cast("decimal(18,2)").cast("string"))
            .alias("UnitPrice"),
            F.when(key % 10 == 0, F.lit(None).cast("string"))
            .when(key % 101 == 0, "x")
            .when(key % 107 == 0, "1e3")
            .when(key % 3 == 0, F.concat(buyer, F.lit(".0")))
            .otherwise(buyer)
            .alias("CustomerID"),
            F.when(key % 17 == 0, "EIRE").otherwise(country).alias("Country"),
        )
    )


def raw_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One family per four parts, each line twice, as a feed sent again has it."""
    part = _table(spark, sf_dir, "part")
    family = F.expr("10000 + p_partkey div 4")
    return (
        part.groupBy(family.alias("family"))
        .agg(F.min(F.upper("p_name")).alias("item_family_description"), F.min("p_type").alias("category"))
        .filter(F.col("family") % 7 != 0)
        .select(
            F.col("family").cast("string").alias("item_family"),
            "item_family_description",
            "category",
            F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"),
        )
        .drop("copy")
    )
