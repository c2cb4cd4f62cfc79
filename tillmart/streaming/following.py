"""Dimensions and marts that follow the loads, without reading what a load does not touch.

Each load adds its own partial rows to the state of a table, spread over buckets of the table's key: sums and counts by
(key, value), where ``value`` is the column whose distinct values the table counts. Partial rows of any loads merge into others by
the same grouping, so the state of a bucket always gives the bucket's rows of the table. After a load, the buckets it has partial rows in are
merged and overwritten; all others are neither read nor written. Items, which never change, are written by load.

A load that is run again overwrites its own partial rows, and compares with those of other loads only, so it leaves the same tables.
Loads may come in any order of time: an earlier line that comes later changes its customer's first country.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillmart.functions import columns as fn
from tillmart.operators import dimensions as dim, grouped, marts, staging
from tillmart.schemas import MONEY_SUM, TABLES, conform
from tillmart.session import scratch, written
from tillmart.sources.files import create, exists, folders, read_parquet, remove, write_parquet, write_partitions

BUCKETS = 64
#: Days of a bucket of invoices, so that a load of new days leaves the buckets of old ones alone.
DAYS = 32
LOAD, BUCKET = "load_id", "bucket"
#: The most parts of a bucket, so that a bucket is not the work of one task, and the parts of all buckets that a shuffle partition has; each part is a file.
PARTS, SHARE = 16, 4
_PART = "_part"
FOLLOWED = ["dim_customers", "dim_items", "fact_transactions", "int_items", "int_transactions", "int_invoices", "int_customers"]


def by_hash(*columns: str | Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)).cast("int")


def by_days(column: str) -> Column:
    """Runs of days; rows without a day have a bucket of their own."""
    return F.coalesce(F.floor(F.col(column) / DAYS), F.lit(-1)).cast("int")


def part_of(column: str) -> Column:
    """Rows are dealt by it and then it is dropped, so loads may have different numbers of parts."""
    partitions = int(SparkSession.active().conf.get("spark.sql.shuffle.partitions"))
    parts = min(PARTS, -(-SHARE * partitions // BUCKETS))
    return F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table that the planner knows to be empty."""
    return spark.range(0).select([F.lit(None).cast(field.dataType).alias(field.name) for field in schema])


class State:
    """Partial rows of a table under ``path``, by generation, load and bucket."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark = spark
        self.path = path
        self.partial = T.StructType([*schema, T.StructField(BUCKET, T.IntegerType())])
        self.schema = T.StructType([*schema, T.StructField(LOAD, T.LongType()), T.StructField(BUCKET, T.IntegerType())])

    @property
    def generation(self) -> int:
        """The last one that is whole; a compaction makes a new one."""
        return max(map(int, folders(self.spark, f"{self.path}/whole")), default=0)

    def _folder(self, generation: int | None = None) -> str:
        return f"{self.path}/generation={self.generation if generation is None else generation}"

    def read(self, buckets: list[int] | None = None, but: int | None = None) -> DataFrame:
        """The rows in ``buckets``, of all loads but one; no other folder is read."""
        folder = self._folder()
        if not exists(self.spark, folder):
            return no_rows(self.spark, self.schema)
        rows = self.spark.read.schema(self.schema).parquet(folder)
        if buckets is not None:
            rows = rows.filter(F.col(BUCKET).isin(buckets) if buckets else F.lit(False))
        return rows.filter(F.col(LOAD) != but) if but is not None else rows

    def replace(self, rows: DataFrame, load_id: int, dealt: bool = False) -> list[int]:
        """``rows`` (with ``BUCKET``) as those of the load; the buckets that it has rows in. ``dealt`` rows are together by bucket already."""
        folder = f"{self._folder()}/{LOAD}={load_id}"
        write_partitions(conform(rows, self.partial), folder, BUCKET, dynamic=False, dealt=dealt)
        found = [name.removeprefix(f"{BUCKET}=") for name in folders(self.spark, folder) if name.startswith(f"{BUCKET}=")]
        return sorted(map(int, found))

    def by_loads(self, buckets: list[int]) -> list[tuple[list[int], bool]]:
        """The ``buckets`` that one load has rows in, with True, and those of several, with False; no empty list."""
        counts = dict.fromkeys(buckets, 0)
        for load in folders(self.spark, self._folder()):
            for name in folders(self.spark, f"{self._folder()}/{load}") if load.startswith(f"{LOAD}=") else []:
                bucket = name.removeprefix(f"{BUCKET}=")
                if bucket != name and int(bucket) in counts:
                    counts[int(bucket)] += 1
        groups = [([bucket for bucket in buckets if counts[bucket] == 1], True), ([bucket for bucket in buckets if counts[bucket] != 1], False)]
        return [(found, once) for found, once in groups if found]

    def compact(self, merge: Callable[[DataFrame], DataFrame]) -> None:
        """The rows of all loads but the last merged into one load's, as a new generation that is read from the moment it is whole.

        The last load keeps its own, as it may be run again. Not while a load runs.
        """
        rows, now = self.read(), self.generation
        last = rows.agg(F.max(LOAD)).first()[0]
        if last is not None:
            folder = self._folder(now + 1)
            remove(self.spark, folder)
            merged = conform(merge(rows.filter(F.col(LOAD) < last).drop(LOAD)), self.partial)
            own = conform(rows.filter(F.col(LOAD) == last), self.partial)
            for load, held in ((last - 1, merged), (last, own)):
                write_partitions(held, f"{folder}/{LOAD}={load}", BUCKET, dynamic=False)
            create(self.spark, f"{self.path}/whole/{now + 1}")
            remove(self.spark, self._folder(now))


def buckets_of(rows: DataFrame) -> list[int]:
    """The buckets that have rows; there is a bounded number of them, or one for some days."""
    return sorted(row[BUCKET] for row in rows.select(BUCKET).distinct().collect())


class Measures:
    """Sums, counts and flags (in bits) by ``keys``, and how many distinct values ``value`` has; mergeable.

    Partial rows are grouped by keys and value, so no two of a load, or of a merged state, have the same value.
    """

    def __init__(self, keys: list[str], value: str, sums: dict[str, str], flags: dict[str, str] | None = None):
        self.keys = keys
        self.value = value
        self.sums = sums
        self.flags = flags or {}

    def of_rows(self) -> "Measures":
        """The same for lines none of which is of the same transaction as another, so that rows are counted."""
        return Measures(self.keys, self.value, {name: _ROWS if own == _TRANSACTIONS else own for name, own in self.sums.items()}, self.flags)

    def partial(self, rows: DataFrame, bucket: Column) -> DataFrame:
        """The rows are moved once, by bucket and, as a key may have very many, by value."""
        own = [F.expr(measure).alias(name) for name, measure in {**self.sums, **self.flags}.items()]
        placed = rows.withColumns({BUCKET: bucket, _PART: part_of(self.value)})
        return placed.repartition(BUCKET, _PART).groupBy(BUCKET, _PART, *self.keys, self.value).agg(*own).drop(_PART)

    def merged(self, rows: DataFrame, *more: str) -> DataFrame:
        """Partial rows of several loads as those of one."""
        totals = [F.sum(name).alias(name) for name in self.sums] + [F.bit_or(name).alias(name) for name in self.flags]
        return rows.groupBy(*more, *self.keys, self.value).agg(*totals)

    def totals(self, rows: DataFrame, distinct: str, once: bool = False, by_bucket: bool = False) -> DataFrame:
        """A row per key, with the number of distinct values as ``distinct``; the partial rows are moved once (``grouped.totals``).

        They are dealt by key, or those of a bucket together, which the result then has. ``once``: the rows are those of one load.
        """
        placed, salted = grouped.with_salt(rows.drop(LOAD), self.keys[0], self.value)
        deal = [BUCKET, _PART] if by_bucket else self.keys[:1]
        placed = placed.withColumn(_PART, part_of(self.keys[0])) if by_bucket else placed.drop(BUCKET)
        measures = {name: (F.sum(name), F.sum) for name in self.sums} | {name: (F.bit_or(name), F.bit_or) for name in self.flags}
        keys = [*deal, *self.keys] if by_bucket else self.keys
        return grouped.totals(placed, keys, self.value, distinct, measures, deal, salted, once=once).drop(_PART)


_MONEY, _QUANTITY = "CAST(sum(total_price_eur) AS DECIMAL(28, 2))", "sum(quantity_amount)"
_TRANSACTIONS, _ROWS = "count(DISTINCT transaction_id)", "count(transaction_id)"

ITEM_SALES = Measures(
    ["item_uuid"], "customer_id", {"total_sales_amount": _MONEY, "total_quantity": _QUANTITY, "total_transactions": _TRANSACTIONS}
)
INVOICES = Measures(
    ["invoice_id", "date_id", "customer_id", "country_id"],
    "item_uuid",
    {"total_invoice_amount": _MONEY, "total_quantity": _QUANTITY},
    {"flags": "bit_or(flags)"},
)
CUSTOMERS = Measures(
    ["customer_id", "country_name"],
    "invoice_id",
    {"amount": _MONEY, "total_quantity": _QUANTITY, "total_transactions": _TRANSACTIONS, "total_returns": "count_if(is_return)"},
)

#: Items are held in bytes where they are keys only.
_KEY = T.BinaryType()
_TEXT, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()


def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


STATES = {
    "items_seen": _struct(item_uuid=_TEXT, item_id=_TEXT, item_description=_TEXT),
    "customers_seen": _struct(customer_id=_INT, country_name=_TEXT, first_seen=T.TimestampNTZType()),
    "item_sales": _struct(item_uuid=_KEY, customer_id=_INT, total_sales_amount=MONEY_SUM, total_quantity=_LONG, total_transactions=_LONG),
    "invoices": _struct(
        invoice_id=_TEXT,
        date_id=_INT,
        customer_id=_INT,
        country_id=_INT,
        item_uuid=_KEY,
        total_invoice_amount=MONEY_SUM,
        total_quantity=_LONG,
        flags=_INT,
    ),
    "customers": _struct(
        customer_id=_INT,
        country_name=_TEXT,
        invoice_id=_TEXT,
        amount=MONEY_SUM,
        total_quantity=_LONG,
        total_transactions=_LONG,
        total_returns=_LONG,
    ),
    "categories": _struct(customer_id=_INT, item_category=_TEXT, category_count=_LONG),
}


class Following:
    """Tables under ``root`` that follow the loads: fact and transactions by load, items by load and bucket, customers and marts by bucket.

    Families, calendar and locations do not change with loads; a new version of them needs a new build.
    """

    def __init__(self, spark: SparkSession, root: str, families: DataFrame, dates: DataFrame, places: DataFrame):
        self.spark = spark
        self.root = root
        self.families = families
        self.dates = dates
        self.places = places
        self.states = {name: State(spark, f"{root}/state/{name}", schema) for name, schema in STATES.items()}
        #: The buckets of each table that the last load has rewritten.
        self.touched: dict[str, list[int]] = {}

    def table(self, name: str) -> DataFrame:
        rows = self._known_items() if name == "dim_items" else read_parquet(self.spark, f"{self.root}/{name}")
        return rows.drop(*[column for column in (BUCKET, LOAD) if column in rows.columns])

    def __call__(self, staged: DataFrame, load_id: int) -> None:
        """``staged`` are the load's rows; may be called again for the same load."""
        with scratch(self.spark, "seen") as held:
            self._items(staged, load_id, held)
            self._customers(staged, load_id, held)
        n_lines = staged.count()
        fact = self._by_load("fact_transactions", staging.fact_transactions(staged, self.dates, self.places), load_id)
        sold = marts.int_transactions(fact, self._known_items(), self.families, self.dates, self.places)
        sold = self._by_load("int_transactions", sold, load_id)
        # joins keep every line, so as many rows as lines are one of each
        self._item_mart(fact, load_id, fact.count() == n_lines)
        self._invoice_mart(sold, load_id)
        self._customer_mart(sold, load_id, sold.count() == n_lines)

    def _by_load(self, name: str, rows: DataFrame, load_id: int) -> DataFrame:
        path = f"{self.root}/{name}/{LOAD}={load_id}"
        write_parquet(rows, path)
        return read_parquet(self.spark, path)

    def _rewrite(self, name: str, buckets: list[int], build: Callable[[list[int]], DataFrame]) -> None:
        """Overwrites the table's ``buckets``, which ``build`` gives with ``BUCKET``; each that was touched has rows."""
        self.touched[name] = buckets
        if buckets:
            write_partitions(build(buckets), f"{self.root}/{name}", BUCKET)

    def _rewrite_mart(self, name: str, buckets: list[int], state: State, build: Callable[[list[int], bool], DataFrame], dealt: bool = False) -> None:
        """As ``_rewrite``, for buckets of ``state`` that one load has rows in and for others; ``build`` is told which, and may have ``dealt`` the rows."""
        self.touched[name] = buckets
        for found, once in state.by_loads(buckets):
            write_partitions(build(found, once), f"{self.root}/{name}", BUCKET, dealt=dealt)

    def _known_items(self) -> DataFrame:
        schema = T.StructType([*TABLES["dim_items"], T.StructField(LOAD, T.LongType()), T.StructField(BUCKET, T.IntegerType())])
        return read_parquet(self.spark, f"{self.root}/dim_items", schema)

    def _items(self, staged: DataFrame, load_id: int, held: str) -> None:
        """Items that no other load has; an item's row depends on nothing but its key."""
        state, key = self.states["items_seen"], ["item_uuid", "item_id", "item_description"]
        seen = written(staged.select(key).distinct().withColumn(BUCKET, by_hash("item_uuid")), "items", held)
        known = state.read(buckets_of(seen), but=load_id).select(*[F.col(name).alias(f"known_{name}") for name in key])
        same = [F.col(name).eqNullSafe(F.col(f"known_{name}")) for name in key]
        touched = state.replace(seen.join(known, same[0] & same[1] & same[2], "left_anti"), load_id)
        self.touched["dim_items"] = touched
        # the load's own items, which lie by bucket already
        items = dim.described_items(state.read(touched).filter(F.col(LOAD) == load_id))
        items = conform(items, TABLES["dim_items"]).withColumn(BUCKET, by_hash("item_uuid"))
        write_partitions(items, f"{self.root}/dim_items/{LOAD}={load_id}", BUCKET, dynamic=False, dealt=True)

    def _customers(self, staged: DataFrame, load_id: int, held: str) -> None:
        """First times of customers in countries, where they are news: a country that is new to a customer, or an earlier time."""
        state = self.states["customers_seen"]
        known_customers = staged.filter(F.col("customer_id").isNotNull())
        seen = known_customers.groupBy("customer_id", "country_name").agg(F.min("event_timestamp_invoiced_at").alias("first_seen"))
        seen = written(seen.withColumn(BUCKET, by_hash("customer_id")), "customers", held)
        before = state.read(buckets_of(seen), but=load_id).groupBy("customer_id", "country_name").agg(F.min("first_seen").alias("known_seen"), F.lit(True).alias("known"))
        before = before.withColumnsRenamed({"customer_id": "known_id", "country_name": "known_country"})
        same = (F.col("customer_id") == F.col("known_id")) & F.col("country_name").eqNullSafe(F.col("known_country"))
        earlier = F.col("first_seen").isNotNull() & (F.col("known_seen").isNull() | (F.col("first_seen") < F.col("known_seen")))
        news = seen.join(before, same, "left").filter(F.col("known").isNull() | earlier).select(*seen.columns)
        touched = state.replace(news, load_id)

        def build(buckets: list[int]) -> DataFrame:
            lines = state.read(buckets).withColumnRenamed("first_seen", "event_timestamp_invoiced_at")
            named = conform(dim.dim_customers(lines, dim.name_pool(self.spark)), TABLES["dim_customers"])
            return named.withColumn(BUCKET, by_hash("customer_id"))

        self._rewrite("dim_customers", touched, build)

    def _item_mart(self, fact: DataFrame, load_id: int, unique: bool) -> None:
        state, measures = self.states["item_sales"], ITEM_SALES.of_rows() if unique else ITEM_SALES
        bucket = by_hash(fn.unpacked(F.col("item_uuid")))
        touched = state.replace(measures.partial(marts.with_packed_item(fact), bucket), load_id, dealt=True)

        def build(buckets: list[int], once: bool) -> DataFrame:
            sales = measures.totals(state.read(buckets), "total_customers", once)
            items = self._known_items().filter(F.col(BUCKET).isin(buckets))
            found = marts.described_sales(sales, marts.with_packed_item(items), self.families)
            return found.withColumn("item_uuid", fn.unpacked(F.col("item_uuid"))).withColumn(BUCKET, by_hash("item_uuid"))

        self._rewrite_mart("int_items", touched, state, build)

    def _invoice_mart(self, sold: DataFrame, load_id: int) -> None:
        state = self.states["invoices"]
        lines = marts.with_packed_item(sold).withColumn("flags", fn.flag_bits(marts.INVOICE_FLAGS))
        touched = state.replace(INVOICES.partial(lines, by_days("date_id")), load_id, dealt=True)

        def build(buckets: list[int], once: bool) -> DataFrame:
            rolled = INVOICES.totals(state.read(buckets), "total_items", once, by_bucket=True)
            rolled = rolled.withColumns({marts.has(flag): fn.flag_of(F.col("flags"), place) for place, flag in enumerate(marts.INVOICE_FLAGS)})
            return marts.named_invoices(rolled, self.dates, self.places).withColumn(BUCKET, by_days("date_id"))

        self._rewrite_mart("int_invoices", touched, state, build, dealt=True)

    def _customer_mart(self, sold: DataFrame, load_id: int, unique: bool) -> None:
        totals, categories, measures = self.states["customers"], self.states["categories"], CUSTOMERS.of_rows() if unique else CUSTOMERS
        touched = totals.replace(measures.partial(sold, by_hash("customer_id")), load_id, dealt=True)
        known = sold.filter(F.col("customer_id").isNotNull())
        counts = marts.category_counts(known, "customer_id").withColumn(BUCKET, by_hash("customer_id"))
        touched = sorted({*touched, *categories.replace(counts, load_id)})

        def build(buckets: list[int], once: bool) -> DataFrame:
            counted = categories.read(buckets).groupBy("customer_id", "item_category").agg(F.sum("category_count").alias("category_count"))
            rolled = measures.totals(totals.read(buckets), "total_invoices", once)
            return marts.with_favorites(rolled, counted).withColumn(BUCKET, by_hash("customer_id"))

        self._rewrite_mart("int_customers", touched, totals, build)

    def compact(self) -> None:
        """Two loads' worth of partial rows for all loads, so that merging does not grow with their number."""
        for name, measures in (("item_sales", ITEM_SALES), ("invoices", INVOICES), ("customers", CUSTOMERS)):
            self.states[name].compact(lambda rows, measures=measures: measures.merged(rows, BUCKET))
        self.states["categories"].compact(
            lambda rows: rows.groupBy(BUCKET, "customer_id", "item_category").agg(F.sum("category_count").alias("category_count"))
        )
        self.states["customers_seen"].compact(
            lambda rows: rows.groupBy(BUCKET, "customer_id", "country_name").agg(F.min("first_seen").alias("first_seen"))
        )
        self.states["items_seen"].compact(lambda rows: rows.distinct())
