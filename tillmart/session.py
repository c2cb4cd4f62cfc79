"""Spark session and the shared working folder."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tillmart", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on; sizes stay with the cluster."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def application_dir(spark: SparkSession) -> str:
    """Folder of this application under the folder the cluster names for checkpoints.

    Only a local session may fall back to a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tillmart-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/tillmart/{spark.sparkContext.applicationId}"


def shared_dir(spark: SparkSession, name: str) -> str:
    """New path under the application's folder."""
    return f"{application_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_working_tables(spark: SparkSession) -> None:
    """Removes the application's folder, when nothing reads it any more."""
    from tillmart.sources.files import remove

    remove(spark, application_dir(spark))


@contextmanager
def scratch(spark: SparkSession, name: str):
    """A folder of the shared one for the block, removed after it."""
    from tillmart.sources.files import remove

    path = shared_dir(spark, name)
    try:
        yield path
    finally:
        remove(spark, path)


@contextmanager
def settings(spark: SparkSession, **values: str):
    """What is run in the block has these settings, dots in names as ``__``; the old ones come back after it."""
    named = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in named}
    for name, value in named.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shuffles_removed(spark: SparkSession):
    """What is run in the block removes its shuffle files as soon as it is done, not when the driver collects its garbage."""
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


def unsorted_writes(spark: SparkSession):
    """Tasks in the block that write few folders hold their files open in place of sorting the rows by folder."""
    return settings(spark, spark__sql__maxConcurrentOutputFileWriters="32")


def hashed_joins(spark: SparkSession):
    """Joins of two shuffled tables in the block look up the smaller one in place of sorting both.

    The adaptive planner does so where it finds that none of its parts is larger than the size it aims at.
    """
    aimed = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    return settings(spark, spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold=aimed)


def written(df: DataFrame, name: str, under: str | None = None) -> DataFrame:
    """The rows of ``df`` as a table under the shared folder, or the folder ``under``, so that they are worked out once."""
    path = f"{under}/{name}" if under else shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
