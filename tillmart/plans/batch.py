"""The whole build: raw feed to star schema, marts and published copies."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillmart.operators import dimensions as dim, marts, quality, staging
from tillmart.plans.builds import MONTHLY, PLAIN, POINTER, Builds
from tillmart.schemas import TABLES, as_published, conform
from tillmart.sources.files import read_parquet, write_parquet, write_partitions
from tillmart.sources.tables import in_database, load_typed, over_folder, publish_table

LOADED = ["dim_customers", "dim_date", "dim_item_family", "dim_items", "dim_location", "fact_transactions"]

PUBLISHED = {
    "etl_items": "int_items",
    "etl_transactions": "int_transactions",
    "etl_invoices": "int_invoices",
    "etl_customers": "int_customers",
}


#: Tables that a build can partition by year and month, by the column that says when.
DATED = {"fact_transactions": marts.TIME, "int_transactions": "date"}
MONTH = ["year", "month"]

#: Readings of the item flags that a build can have.
FLAG_READINGS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "exact": lambda items: items,
    "ignore-case": dim.flags_ignoring_case,
    "null-unknown": dim.null_text_is_unknown,
}


class Lake:
    """Tables of one build, each written under ``out`` when it is first needed.

    A table's plan reads the tables before it from storage. So transaction ids
    are fixed, no step repeats another's work, a lost executor costs one step,
    and the planner knows real sizes when it picks a side to broadcast.
    ``monthly`` lays the fact and the transactions mart out by month, which changes
    their folders, not their columns. With ``build``, the tables are those of that build (``Builds``).
    """

    def __init__(
        self,
        spark: SparkSession,
        raw_sales: DataFrame,
        raw_families: DataFrame,
        out: str,
        locations: DataFrame | None = None,
        monthly: bool = False,
        flags: str = "exact",
        build: int | None = None,
    ):
        self.spark = spark
        self.raw_sales = raw_sales
        self.raw_families = raw_families
        self.out = out
        self.locations = locations
        self.monthly = monthly
        self.flags = FLAG_READINGS[flags]
        self.build = build
        self._written: dict[str, DataFrame] = {}
        self._unique: bool | None = None

    def plan(self, name: str) -> DataFrame:
        """The table's rows, not yet written."""
        return BUILDERS[name](self)

    def layout(self, name: str) -> str:
        return MONTHLY if self.monthly and name in DATED else PLAIN

    def folder(self, name: str) -> str:
        if self.build is None:
            return f"{self.out}/{name}"
        return Builds(self.spark, self.out).folder(name, self.layout(name), self.build)

    def table(self, name: str) -> DataFrame:
        if name not in self._written:
            path, rows = self.folder(name), self.plan(name)
            if name in TABLES:
                rows = conform(rows, TABLES[name])
            if self.layout(name) == MONTHLY:
                when = F.col(DATED[name])
                write_partitions(rows.withColumns({"year": F.year(when), "month": F.month(when)}), path, *MONTH, dynamic=False)
            else:
                write_parquet(rows, path)
            schema = TABLES.get(name)
            back = read_parquet(self.spark, path, schema)
            self._written[name] = back.drop(*MONTH) if name in DATED else back
        return self._written[name]

    def month(self, name: str, year: int, month: int) -> DataFrame:
        """A month's rows of a table of ``DATED``; of a monthly build, only that month's folder is read."""
        rows = self.table(name)
        if self.monthly:
            rows = read_parquet(self.spark, self.folder(name))
            return rows.filter((F.col("year") == year) & (F.col("month") == month)).drop(*MONTH)
        when: Column = F.col(DATED[name])
        return rows.filter((F.year(when) == year) & (F.month(when) == month))

    @property
    def keys_unique(self) -> bool:
        """Whether no dimension key is repeated, so that a transaction is one row of its mart; nor do two items share a hash (``fn.short``)."""
        if self._unique is None:
            self._unique = quality.keys_unique(
                (marts.with_packed_item(self.table("dim_items")), "item_uuid"),
                (self.table("dim_item_family"), "item_family_id"),
                (self.table("dim_date"), "date_id"),
                (self.table("dim_date"), "date"),
                (self.table("dim_location"), "country_id"),
                (self.table("dim_location"), "country_name"),
            )
        return self._unique


def _with_star(build: Callable[..., DataFrame], *names: str) -> Callable[[Lake], DataFrame]:
    return lambda lake: build(*[lake.table(name) for name in names])


# In order of need.
BUILDERS: dict[str, Callable[[Lake], DataFrame]] = {
    "stg_transactions": lambda lake: staging.stg_transactions(lake.raw_sales),
    "dim_item_family": lambda lake: dim.dim_item_family(lake.raw_families),
    "dim_date": lambda lake: dim.dim_date(lake.spark),
    "dim_location": lambda lake: dim.dim_location(lake.spark) if lake.locations is None else lake.locations,
    "dim_items": lambda lake: lake.flags(dim.dim_items(lake.table("stg_transactions"))),
    "dim_customers": lambda lake: dim.dim_customers(lake.table("stg_transactions"), dim.name_pool(lake.spark)),
    "fact_transactions": _with_star(staging.fact_transactions, "stg_transactions", "dim_date", "dim_location"),
    "int_items": lambda lake: marts.int_items(
        lake.table("fact_transactions"), lake.table("dim_items"), lake.table("dim_item_family"), lake.keys_unique
    ),
    "int_transactions": _with_star(
        marts.int_transactions, "fact_transactions", "dim_items", "dim_item_family", "dim_date", "dim_location"
    ),
    "int_invoices": lambda lake: marts.int_invoices(
        lake.table("int_transactions"), lake.table("dim_date"), lake.table("dim_location"), lake.keys_unique
    ),
    "int_customers": lambda lake: marts.int_customers(lake.table("int_transactions"), lake.keys_unique),
}


def run_batch(
    spark: SparkSession,
    raw_sales: DataFrame,
    raw_families: DataFrame,
    out: str,
    locations: DataFrame | None = None,
    monthly: bool = False,
    flags: str = "exact",
) -> dict[str, DataFrame]:
    """Write every table as a new build under ``out``; the builds before it stay as they are until it is whole.

    Options: see ``Lake`` and ``FLAG_READINGS``.
    """
    builds = Builds(spark, out)
    lake = Lake(spark, raw_sales, raw_families, out, locations, monthly, flags, builds.begin())
    tables = {name: lake.table(name) for name in BUILDERS}
    builds.finish(lake.build, {name: lake.layout(name) for name in BUILDERS})
    builds.clean()
    for published, source in PUBLISHED.items():
        tables[published] = as_published(tables[source])
    return tables


def load_warehouse(spark: SparkSession, out: str, database: str, location: str | None = None) -> None:
    """Catalog tables of the last whole build: star schema, marts, and their published views.

    All of them turn to that build in one step. Where ``out`` has the tables of a ``Lake`` without builds, they are read in place.
    """
    builds = Builds(spark, out)
    build = builds.current()
    with in_database(spark, database, location):
        if build is None:
            for name in LOADED:
                load_typed(spark, f"{out}/{name}", name, TABLES[name])
            for source in PUBLISHED.values():
                over_folder(spark, f"{out}/{source}", source, read_parquet(spark, f"{out}/{source}").drop(*MONTH).columns)
        else:
            if not spark.catalog.tableExists(POINTER):
                builds.switch(build)
            for name in [*LOADED, *PUBLISHED.values()]:
                builds.define(name, builds.table(name, build).drop(*MONTH).columns)
        for published, source in PUBLISHED.items():
            publish_table(spark, source, published)
        if build is not None:
            builds.switch(build)
