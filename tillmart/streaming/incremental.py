"""Loading what is new in a landing folder into the staging table, and the fact after it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tillmart.operators.dimensions import literal_table
from tillmart.operators.staging import STAGING_COLUMNS, typed_sales
from tillmart.session import hashed_joins, scratch, shuffles_removed, unsorted_writes, written
from tillmart.sources.files import exists, read_parquet, write_parquet

# Spark's own row ids hold the task above this many bits.
SPARK_TASK_SHIFT = 33
LOADS = "load_id bigint, first_id bigint, n_rows bigint"


def first_id(spark: SparkSession, loads: str, load_id: int) -> int:
    """Id after all those of earlier loads."""
    before = f"{loads}/load_id={load_id - 1}"
    if exists(spark, before):
        row = spark.read.parquet(before).first()
        return row.first_id + row.n_rows
    if not exists(spark, loads):
        return 0
    earlier = spark.read.schema(LOADS).parquet(loads).filter(F.col("load_id") < load_id)
    return earlier.agg(F.max(F.col("first_id") + F.col("n_rows"))).first()[0] or 0


def numbered(
    rows: DataFrame, load_id: int, loads: str, name: str = "transaction_id", under: str | None = None, scan: DataFrame | None = None
) -> DataFrame:
    """``rows`` with running ids that go on where the loads before this one end.

    The rows are written and counted per task; an id is the load's first one, plus the
    rows of earlier tasks, plus the place in the task. ``loads`` has a row for each load, so
    a load that is run again takes its first id again. The written rows
    are kept ``under`` a folder that the caller may remove when it has written the result.

    Where ``rows`` are made one by one of the rows of a ``scan`` of files, whose tasks have the same rows in the same order whenever they are
    run, the scan is counted and nothing but the counts is written.
    """
    spark = rows.sparkSession
    held = rows.withColumn("_place", F.monotonically_increasing_id())
    held = written(held, "load", under) if scan is None else held
    task = F.shiftright("_place", SPARK_TASK_SHIFT).alias("_task")
    placed = held.select(*rows.columns, task, F.col("_place").bitwiseAND(F.lit((1 << SPARK_TASK_SHIFT) - 1)).alias("_row"))
    counted = placed.select("_task") if scan is None else scan.select(F.spark_partition_id().cast("bigint").alias("_task"))
    # one row per task that has rows; they are summed up in order and never leave the executors
    sizes = written(counted.groupBy("_task").agg(F.count("*").alias("_size")), "sizes", under)
    begin, n_rows = first_id(spark, loads, load_id), sizes.agg(F.sum("_size")).first()[0] or 0
    write_parquet(literal_table(spark, [(begin, n_rows)], ["first_id", "n_rows"]), f"{loads}/load_id={load_id}")
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_task", (F.lit(begin) + F.coalesce(F.sum("_size").over(earlier), F.lit(0))).alias("_first"))
    return placed.join(starts, "_task").select(*rows.columns, (F.col("_first") + F.col("_row")).alias(name))


def load_new(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    files_per_load: int | None = None,
    follow: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Append the Parquet files of ``source`` that no earlier call has loaded to the staging table ``target``.

    ``files_per_load`` cuts a large backlog into several loads. ``follow`` gets each
    load's staged rows and its number, to carry them on.

    Each load writes its own ``load_id`` partition and overwrites it when the
    same load is run again after a failure, so a file's rows are in the table
    exactly once, with the same ids.
    """

    def write(batch: DataFrame, load_id: int) -> None:
        path = f"{target}/load_id={load_id}"
        with scratch(spark, "load") as held:
            write_parquet(stage_load(batch, load_id, f"{target}-loads", held, scanned=True), path)
        if follow:
            follow(read_parquet(spark, path), load_id)

    reader = spark.readStream.schema(schema)
    if files_per_load:
        reader = reader.option("maxFilesPerTrigger", files_per_load)
    with shuffles_removed(spark), unsorted_writes(spark), hashed_joins(spark):
        (
            reader.parquet(source)
            .writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )


def stage_load(raw: DataFrame, load_id: int, loads: str, under: str | None = None, scanned: bool = False) -> DataFrame:
    """Staging rows of one load, with transaction ids no other load uses; ``scanned`` if ``raw`` is a scan of files (``numbered``)."""
    return numbered(typed_sales(raw), load_id, loads, under=under, scan=raw if scanned else None).select(STAGING_COLUMNS)


def fact_follows(build: Callable[[DataFrame], DataFrame], target: str) -> Callable[[DataFrame, int], None]:
    """A ``follow`` that writes the fact rows of a load as that load's partition of ``target``."""
    return lambda staged, load_id: write_parquet(build(staged), f"{target}/load_id={load_id}")
