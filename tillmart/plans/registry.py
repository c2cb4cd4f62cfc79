"""The checked queries, each over the whole order tables of a scale folder."""

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillmart.functions import columns as fn
from tillmart.operators import colocated, dimensions as dim, grouped, marts, mining, quality, quarantine, reports, staging
from tillmart.plans.batch import BUILDERS, LOADED, PUBLISHED, Lake, load_warehouse, run_batch
from tillmart.plans.builds import Builds
from tillmart.schemas import RAW_FAMILIES, RAW_SALES, TABLES, as_published
from tillmart.session import shared_dir, shuffles_removed, unsorted_writes
from tillmart.sources import files, order_tables, tables
from tillmart.sources.landing import Landing
from tillmart.streaming import incremental
from tillmart.streaming.following import FOLLOWED, Following

LOOKED_UP_INVOICE = "42"
PREVIEW_ROWS = 20
SAMPLE_ROWS = 20
SAMPLE_SEED = 7
ORDER_TABLES = ["customer", "lineitem", "nation", "orders", "part"]

#: The column of each table whose sum a check compares.
SUMMED = {
    "stg_transactions": "quantity_amount",
    "dim_customers": "customer_id",
    "dim_date": "date_id",
    "dim_item_family": "item_family_id",
    "dim_items": "item_family_id",
    "dim_location": "country_id",
    "fact_transactions": "total_price_eur",
    "int_items": "total_sales_amount",
    "int_transactions": "total_price_eur",
    "int_invoices": "total_invoice_amount",
    "int_customers": "total_sales_amount",
}


class Star:
    """Tables over the order tables of one folder.

    The feed is landed as CSV and the star schema written when a query first needs
    them, once per session, under one folder of the shared one; a query runs its own
    operator on what is written.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = shared_dir(spark, "star")

    @cached_property
    def landing(self) -> str:
        path = self.path("landing")
        with shuffles_removed(self.spark):
            files.write_csv(order_tables.raw_sales(self.spark, self.sf_dir), f"{path}/retail", files.RETAIL_ENCODING, compressed=True)
        files.write_csv(order_tables.raw_families(self.spark, self.sf_dir), f"{path}/families")
        return path

    @cached_property
    def lines(self) -> DataFrame:
        """All records of the sales feed, malformed ones too."""
        return files.read_csv(self.spark, f"{self.landing}/retail", RAW_SALES, files.RETAIL_ENCODING)

    @cached_property
    def raw_families(self) -> DataFrame:
        return files.well_formed(files.read_csv(self.spark, f"{self.landing}/families", RAW_FAMILIES))

    @cached_property
    def lake(self) -> Lake:
        return Lake(self.spark, self.raw, self.raw_families, self.path("star"))

    raw = property(lambda self: files.well_formed(self.lines))
    stg = property(lambda self: self.lake.table("stg_transactions"))
    families = property(lambda self: self.lake.table("dim_item_family"))
    dates = property(lambda self: self.lake.table("dim_date"))
    places = property(lambda self: self.lake.table("dim_location"))
    items = property(lambda self: self.lake.table("dim_items"))
    fact = property(lambda self: self.lake.table("fact_transactions"))
    transactions = property(lambda self: self.lake.table("int_transactions"))

    @cached_property
    def followed(self) -> Following:
        """Tables that have followed the feed in three drops, the latest days first."""
        where = self.path("followed")
        follow = Following(self.spark, f"{where}/tables", self.families, self.dates, self.places)
        year = F.regexp_extract("InvoiceDate", "([0-9]{2}) ", 1)
        drop = F.when(year >= "13", 0).when(year < "11", 1).otherwise(2)
        # the feed is read once; the files of a drop are moved where they are looked for when it is delivered
        with unsorted_writes(self.spark):
            files.write_partitions(self.raw.withColumn("drop", drop), f"{where}/feed", "drop", dynamic=False, dealt=True)
        for number in range(3):
            if not files.move(self.spark, f"{where}/feed/drop={number}", f"{where}/drops", f"{number}-"):
                self.raw.limit(0).write.mode("append").parquet(f"{where}/drops")
            incremental.load_new(self.spark, f"{where}/drops", RAW_SALES, f"{where}/staged", f"{where}/check", follow=follow)
        return follow

    @cached_property
    def ordered_texts(self) -> DataFrame:
        return mining.description_order(self.items)

    def odd_items(self) -> DataFrame:
        return mining.weird_items(self.ordered_texts)

    def classes(self) -> DataFrame:
        return mining.keyword_classes(self.odd_items())

    def timed(self) -> DataFrame:
        """The transactions with the time of each."""
        return marts.int_transactions(self.fact, self.items, self.families, self.dates, self.places, marts.TIME)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def fresh(self, name: str) -> str:
        """The path of a query's own files, without those of its last run."""
        files.remove(self.spark, self.path(name))
        return self.path(name)

    def database(self, name: str) -> str:
        return f"tillmart_{name}_{self.root[-8:]}"


_STARS: dict[tuple, Star] = {}


def star_of(spark: SparkSession, sf_dir: str, refresh: bool = False) -> Star:
    """The session's star over ``sf_dir``; a new one on ``refresh``, as when the folder's files have changed."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if refresh or key not in _STARS:
        _STARS[key] = Star(spark, sf_dir)
    return _STARS[key]


def planned(name: str) -> Callable[[Star], DataFrame]:
    """A table of the build as its plan over the written tables before it."""
    return lambda star: _without_id(star.lake.plan(name))


def _without_id(df: DataFrame) -> DataFrame:
    return as_published(df.drop("transaction_id"))


def csv_roundtrip(star: Star) -> DataFrame:
    path = star.path("csv_roundtrip")
    columns = {"item_family_id": "item_family", "item_category": "category"}
    files.write_csv(star.families.withColumnsRenamed(columns), path)
    return dim.dim_item_family(files.well_formed(files.read_csv(star.spark, path, RAW_FAMILIES)))


def parquet_scan(star: Star) -> DataFrame:
    path = f"{star.sf_dir}/lineitem.parquet"
    schema = (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
        "l_linestatus string, l_shipdate timestamp_ntz"
    )
    return star.spark.read.schema(schema).parquet(path)


def parquet_roundtrip(star: Star) -> DataFrame:
    path = star.path("parquet_roundtrip")
    files.write_parquet(star.items, path)
    return files.read_parquet(star.spark, path, TABLES["dim_items"])


def partition_overwrite(star: Star) -> DataFrame:
    """All months written, then one year's months again: the others must stay."""
    path = star.path("partition_overwrite")
    time = F.col("event_timestamp_invoiced_at")
    dated = star.fact.drop("transaction_id").withColumns({"year": F.year(time), "month": F.month(time)})
    files.write_partitions(dated, path, "year", "month")
    files.write_partitions(dated.filter("year = 2010"), path, "year", "month")
    return as_published(files.read_parquet(star.spark, path))


def _in_database(star: Star, name: str):
    return tables.in_database(star.spark, star.database(name), star.path(f"{name}_db"))


def typed_load(star: Star) -> DataFrame:
    star.fact  # noqa: B018  written before its folder is read
    with _in_database(star, "typed_load"):
        tables.load_typed(star.spark, f"{star.lake.out}/fact_transactions", "fact_transactions", TABLES["fact_transactions"])
    return _without_id(star.spark.table(f"{star.database('typed_load')}.fact_transactions"))


def warehouse(star: Star) -> DataFrame:
    """Rows and sums of the loaded tables and of the published views over the written star schema and marts."""
    for table in BUILDERS:
        star.lake.table(table)
    name = star.database("warehouse")
    load_warehouse(star.spark, star.lake.out, name, star.path("warehouse_db"))
    loaded = {table: star.spark.table(f"{name}.{table}") for table in [*LOADED, *PUBLISHED]}
    return reports.table_sums(loaded, {table: SUMMED[PUBLISHED.get(table, table)] for table in loaded})


def ctas_replace(star: Star) -> DataFrame:
    """A table created from one query and replaced by another."""
    with _in_database(star, "ctas_replace"):
        tables.create_or_replace(star.families, "int_table")
        tables.create_or_replace(star.lake.plan("int_items"), "int_table")
    return as_published(star.spark.table(f"{star.database('ctas_replace')}.int_table"))


def publish_marts(star: Star) -> DataFrame:
    with _in_database(star, "publish_marts"):
        tables.create_or_replace(star.lake.plan("int_invoices"), "int_invoices")
        tables.publish_table(star.spark, "int_invoices", "etl_invoices")
    return star.spark.table(f"{star.database('publish_marts')}.etl_invoices")


def _loaded_in_drops(star: Star, name: str, follow=None) -> str:
    """The feed landed in two drops, loaded after each, and once more with nothing new."""
    where = star.fresh(name)
    anonymous = F.col("CustomerID").isNull()
    for drop in (star.raw.filter(anonymous), star.raw.filter(~anonymous), None):
        if drop is not None:
            drop.write.mode("append").option("compression", files.CODEC).parquet(f"{where}/drops")
        incremental.load_new(star.spark, f"{where}/drops", RAW_SALES, f"{where}/staged", f"{where}/check", follow=follow and follow(where))
    return where


def incremental_load(star: Star) -> DataFrame:
    where = _loaded_in_drops(star, "incremental_load")
    return _without_id(files.read_parquet(star.spark, f"{where}/staged").drop("load_id"))


def incremental_fact(star: Star) -> DataFrame:
    """The fact, built from each load's staged rows."""

    def follow(where: str):
        build = lambda staged: staging.fact_transactions(staged, star.dates, star.places)
        return incremental.fact_follows(build, f"{where}/fact")

    where = _loaded_in_drops(star, "incremental_fact", follow)
    return _without_id(files.read_parquet(star.spark, f"{where}/fact").drop("load_id"))


def followed(name: str) -> Callable[[Star], DataFrame]:
    """A table that has followed the loads."""
    return lambda star: _without_id(star.followed.table(name))


def incremental_marts(star: Star) -> DataFrame:
    """Rows and sums of the tables that have followed the loads."""
    names = [name for name in SUMMED if name in FOLLOWED]
    return reports.table_sums({name: star.followed.table(name) for name in names}, {name: SUMMED[name] for name in names})


#: Months that estimates are made for, and the quarter of a report.
FIRST_MONTH, LAST_MONTH = "2010-03-01", "2012-10-01"
QUARTER = (2010, 2)


def distinct_estimates(star: Star) -> DataFrame:
    """Sales from stored monthly sketches, the true number of invoices, and whether the estimate is within its error."""
    path = star.path("sketches")
    files.write_parquet(reports.monthly_sketches(star.transactions), path)
    told = reports.sales_between(files.read_parquet(star.spark, path), FIRST_MONTH, LAST_MONTH)
    months = F.trunc("date", "month").between(F.lit(FIRST_MONTH).cast("date"), F.lit(LAST_MONTH).cast("date"))
    true = star.transactions.filter(months).groupBy(F.col("country_name").alias("country")).agg(F.countDistinct("invoice_id").alias("total_invoices"))
    near = F.abs(F.col("estimated_invoices") - F.col("total_invoices")) <= reports.SKETCH_ERROR * F.col("total_invoices")
    both = told.join(true, F.col("country_name").eqNullSafe(F.col("country")))
    return as_published(both.select("country_name", "total_sales_amount", "total_invoices", near.alias("within_error")))


def monthly_fact(star: Star) -> DataFrame:
    """The fact laid out by month; it is moved there with the items' keys in bytes."""
    path, time = star.path("monthly_fact"), F.col("event_timestamp_invoiced_at")
    dated = marts.with_packed_item(star.fact).withColumns({"year": F.year(time), "month": F.month(time)}).hint("rebalance", "year", "month")
    dated = dated.withColumn("item_uuid", fn.unpacked(F.col("item_uuid")))
    files.write_partitions(dated, path, "year", "month", dynamic=False, dealt=True)
    return files.read_parquet(star.spark, path)


def quarter_sales(star: Star) -> DataFrame:
    return as_published(reports.quarter_sales(monthly_fact(star), star.dates, *QUARTER))


def _colocated(star: Star) -> tuple[DataFrame, DataFrame]:
    """Fact and described items in buckets."""
    name = star.database("colocated")
    with _in_database(star, "colocated"):
        colocated.write_colocated(star.fact, star.items, star.families, ("fact_buckets", "item_buckets"), star.path("colocated"))
    return star.spark.table(f"{name}.fact_buckets"), star.spark.table(f"{name}.item_buckets")


def colocated_transactions(star: Star) -> DataFrame:
    return _without_id(colocated.transactions(*_colocated(star), star.dates, star.places, send=False))


def colocated_items(star: Star) -> DataFrame:
    return as_published(colocated.items_mart(_colocated(star)[0], star.items, star.families))


def quarantine_rows(star: Star) -> DataFrame:
    """Each rejected record and value; those of the same record and reason are as many rows."""
    return quarantine.rejected(star.lines)


def quarantine_balance(star: Star) -> DataFrame:
    return quarantine.balance(star.lines, star.stg, quarantine.rejected(star.lines))


def landing_manifest(star: Star) -> DataFrame:
    """What three checks of a landing folder find: two deliveries; one of them made again and the other replaced by a new one; nothing more.

    A delivery is a folder of as many files as tasks have written.
    """
    where = star.fresh("landing_manifest")
    anonymous = F.col("CustomerID").isNull()
    parts = {"a": star.raw.filter(anonymous), "b": star.raw.filter(~anonymous)}
    landing = Landing(star.spark, f"{where}/drops", f"{where}/manifest", RAW_SALES, by_folder=True)

    def deliver(name: str, rows: DataFrame) -> None:
        files.write_parquet(rows, f"{where}/drops/{name}")

    for name, rows in parts.items():
        deliver(name, rows)
    landing.check(0)
    files.remove(star.spark, f"{where}/drops/b")
    deliver("again", parts["a"])
    deliver("c", star.raw.filter(~anonymous & F.col("Quantity").isNotNull()))
    landing.check(1)
    landing.check(2)
    found = landing.history().groupBy("check_id", "status")
    return found.agg(F.count("*").alias("n_files"), F.sum("n_rows").alias("n_rows"), F.min(F.col("n_bytes") > 0).alias("has_size"))


def with_lines(star: Star, dimension: DataFrame, key: str) -> DataFrame:
    """Every row of the dimension, with the number of staged lines that have its key."""
    lines = star.stg.groupBy(key).agg(F.count("*").alias("n_lines"))
    return dimension.join(lines, key, "left").select(*dimension.columns, F.coalesce("n_lines", F.lit(0)).alias("n_lines"))


def transaction_id_unique(star: Star) -> DataFrame:
    return star.stg.agg(
        F.count("*").alias("n_rows"), F.countDistinct("transaction_id").alias("n_ids")
    )


def invoice_lookup(star: Star) -> DataFrame:
    """Lines of one invoice, and the lines without a readable time."""
    wanted = (F.col("invoice_id") == LOOKED_UP_INVOICE) | F.col("event_timestamp_invoiced_at").isNull()
    return _without_id(star.fact.filter(wanted))


def item_flags(star: Star) -> DataFrame:
    return star.items.select("item_uuid", "item_description", *[c for c in star.items.columns if c.startswith("is_")])


def item_uuid(star: Star) -> DataFrame:
    item_id, text = F.col("item_id"), F.col("item_description")
    return star.items.select(
        "item_id",
        "item_description",
        fn.joined_hash(item_id, text).alias("item_uuid"),
        fn.joined_hash(item_id, text, algorithm="md5").alias("item_uuid_md5"),
    )


def item_id_parts(star: Star) -> DataFrame:
    item_id = F.col("item_id")
    return star.stg.select("item_id").distinct().select(
        "item_id",
        F.length(item_id).alias("item_id_length"),
        fn.is_operational(item_id).alias("is_operational_item"),
        fn.family_id(item_id).alias("item_family_id"),
        fn.variant(item_id).alias("item_variant"),
    )


def customer_uuid(star: Star) -> DataFrame:
    keys = ["customer_id", "country_name"]
    known = star.stg.select(keys).dropna().distinct()
    return known.select(
        *keys, fn.joined_hash(F.col(keys[0]), F.col(keys[1]), algorithm="md5").alias("customer_uuid")
    )


def dedup_keep_first(star: Star) -> DataFrame:
    """First country of each customer by time of the first line there."""
    seen = star.stg.dropna(subset=["customer_id", "country_name", "event_timestamp_invoiced_at"])
    pairs = seen.groupBy("customer_id", "country_name").agg(
        F.min("event_timestamp_invoiced_at").alias("first_seen")
    )
    return grouped.keep_first(pairs, ["customer_id"], F.struct("first_seen", "country_name"))


def sample_one_per_key(star: Star) -> DataFrame:
    """Customers with one drawn line each."""
    lines = star.stg.dropna(subset=["customer_id"]).select(
        "customer_id", "invoice_id", "item_id", "quantity_amount"
    )
    return grouped.one_per_key(lines, ["customer_id"], seed=SAMPLE_SEED)


def sample_rows(star: Star) -> DataFrame:
    return grouped.sample_rows(star.items, SAMPLE_ROWS, SAMPLE_SEED, ["item_uuid", "item_id", "item_description"])


def preview_limit(star: Star) -> DataFrame:
    return star.items.orderBy("item_uuid", "item_id", "item_description").limit(PREVIEW_ROWS)


def table_counts(star: Star) -> DataFrame:
    return reports.table_counts({name: star.lake.table(name) for name in SUMMED})


def full_build(star: Star) -> DataFrame:
    """Rows and sums of all tables, read through the published names: a build of half the feed, then switched to a whole one."""
    name, out = star.database("full_build"), star.path("full_build")
    half = F.pmod(F.xxhash64("InvoiceNo"), F.lit(2)) == 0
    for feed in (star.raw.filter(half), star.raw):
        run_batch(star.spark, feed, star.raw_families, out)
        load_warehouse(star.spark, out, name, star.path("full_build_db"))
    unpublished = Builds(star.spark, out).table("stg_transactions")
    shown = {table: unpublished if table == "stg_transactions" else star.spark.table(f"{name}.{table}") for table in SUMMED}
    return reports.table_sums(shown, SUMMED)


def built_customers(star: Star) -> DataFrame:
    """The customer mart of a whole build."""
    return run_batch(star.spark, star.raw, star.raw_families, star.path("entry"))["etl_customers"]


def quality_report(star: Star) -> DataFrame:
    return quality.quality_report(star.lines, star.fact, star.items, star.families, star.dates, star.places)


QUERIES: dict[str, Callable[[Star], DataFrame]] = {
    "csv_scan": lambda star: star.raw,
    "csv_roundtrip": csv_roundtrip,
    "parquet_scan": parquet_scan,
    "parquet_roundtrip": parquet_roundtrip,
    "partition_overwrite": partition_overwrite,
    "typed_load": typed_load,
    "ctas_replace": ctas_replace,
    "publish_marts": publish_marts,
    "warehouse": warehouse,
    "full_build": full_build,
    "incremental_load": incremental_load,
    "incremental_fact": incremental_fact,
    "distinct_estimates": distinct_estimates,
    "quarter_sales": quarter_sales,
    "colocated_transactions": colocated_transactions,
    "colocated_items": colocated_items,
    "quarantine": quarantine_rows,
    "quarantine_balance": quarantine_balance,
    "landing_manifest": landing_manifest,
    "incremental_marts": incremental_marts,
    **{f"incremental_{name}": followed(name) for name in FOLLOWED if name != "fact_transactions"},
    "landing_inventory": lambda star: files.rows_per_file(star.spark, star.sf_dir, ORDER_TABLES),
    "stg_transactions": planned("stg_transactions"),
    "dim_item_family": planned("dim_item_family"),
    "dim_date": lambda star: with_lines(star, star.dates, "date"),
    "dim_location": lambda star: with_lines(star, star.places, "country_name"),
    "dim_items": planned("dim_items"),
    "dim_customers": planned("dim_customers"),
    "fact_transactions": planned("fact_transactions"),
    "int_items": planned("int_items"),
    "int_transactions": planned("int_transactions"),
    "int_invoices": planned("int_invoices"),
    "int_customers": planned("int_customers"),
    "invoice_first": lambda star: as_published(marts.invoice_first(star.timed(), star.dates, star.places)),
    "customer_mode_category": lambda star: as_published(
        marts.customer_mode_category(star.transactions, star.lake.keys_unique)
    ),
    "favorite_category": lambda star: marts.favorite_category(star.transactions),
    "transaction_id_unique": transaction_id_unique,
    "invoice_lookup": invoice_lookup,
    "item_flags": item_flags,
    "item_flags_masked": lambda star: dim.mask_operational(star.items),
    "item_uuid": item_uuid,
    "item_id_parts": item_id_parts,
    "customer_uuid": customer_uuid,
    "country_locale": lambda star: dim.country_locale(star.stg.select("country_name").distinct()),
    "dedup_keep_first": dedup_keep_first,
    "sample_one_per_key": sample_one_per_key,
    "sample_rows": sample_rows,
    "preview_limit": preview_limit,
    "table_counts": table_counts,
    "description_order": lambda star: star.ordered_texts,
    "weird_items": lambda star: star.odd_items(),
    "keyword_class": lambda star: star.classes(),
    "vocabulary_union": lambda star: mining.vocabulary(star.spark, star.classes()),
    "unclassified_items": lambda star: mining.unclassified(star.spark, star.classes()),
    "family_text": lambda star: mining.family_text(star.items),
    "family_top_words": lambda star: mining.family_top_words(star.items),
    "family_category": lambda star: mining.family_category(star.spark, mining.family_words(star.items)),
    "sales_monthly": lambda star: as_published(reports.sales_monthly(star.transactions)),
    "customer_overview": lambda star: as_published(reports.customer_overview(star.lake.plan("int_customers"))),
    "category_monthly": lambda star: as_published(reports.category_monthly(star.transactions)),
    "quality_report": quality_report,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build):
        return lambda spark, sf_dir: build(star_of(spark, sf_dir))

    return {name: bound(build) for name, build in QUERIES.items()}
