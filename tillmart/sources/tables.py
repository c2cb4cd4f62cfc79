"""Catalog tables over written folders: typed loads, create-or-replace, published views."""

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, types as T

from tillmart.schemas import conform
from tillmart.sources.files import CODEC, folders, remove

#: Versions of a replaced table that stay: the current one, and one for those who still read it.
KEPT_VERSIONS = 2


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Make ``name`` the current database, creating it if there is none."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")
    spark.catalog.setCurrentDatabase(name)


@contextmanager
def in_database(spark: SparkSession, name: str, location: str | None = None):
    """``use_database`` for the block; the former database returns after it."""
    before = spark.catalog.currentDatabase()
    use_database(spark, name, location)
    try:
        yield
    finally:
        spark.catalog.setCurrentDatabase(before)


def _folder(spark: SparkSession, table: str) -> str:
    location = spark.catalog.getDatabase(spark.catalog.currentDatabase()).locationUri
    return f"{location.rstrip('/')}/{table}"


def create_or_replace(df: DataFrame, table: str) -> None:
    """``table`` with the rows of ``df``, which may read the table it replaces.

    The rows are written to a folder of their own before the name is switched to it
    in one step, so there is never no table, a write that fails changes nothing, and
    nothing is moved or copied.
    """
    spark, folder, version = df.sparkSession, _folder(df.sparkSession, table), uuid.uuid4().hex
    df.write.option("compression", CODEC).parquet(f"{folder}/{version}")
    spark.sql(f"CREATE OR REPLACE VIEW `{table}` AS SELECT * FROM parquet.`{folder}/{version}`")
    for name in [name for name in folders(spark, folder) if name != version][KEPT_VERSIONS - 1 :]:
        remove(spark, f"{folder}/{name}")


def over_folder(spark: SparkSession, path: str, table: str, columns: list[str]) -> None:
    """``table`` as the columns of a Parquet folder, read in place; a former table of the name is replaced in one step."""
    shown = ", ".join(f"`{column}`" for column in columns)
    spark.sql(f"CREATE OR REPLACE VIEW `{table}` AS SELECT {shown} FROM parquet.`{path}`")


def load_typed(spark: SparkSession, path: str, table: str, schema: T.StructType) -> None:
    """Table of ``schema`` over a Parquet folder; a rerun replaces, never appends.

    A folder that has the schema's columns is read in place. One of other types is cast
    into a new folder, and a value that does not fit raises.
    """
    rows = spark.read.parquet(path)
    kinds = {field.name: field.dataType for field in rows.schema}
    if all(kinds.get(field.name) == field.dataType for field in schema):
        over_folder(spark, path, table, schema.fieldNames())
    else:
        create_or_replace(conform(rows, schema), table)


def publish_table(spark: SparkSession, source: str, target: str) -> None:
    """View of a table for consumers, with money as double."""
    shown = [
        f"CAST(`{field.name}` AS DOUBLE) AS `{field.name}`" if isinstance(field.dataType, T.DecimalType) else f"`{field.name}`"
        for field in spark.table(source).schema
    ]
    spark.sql(f"CREATE OR REPLACE VIEW `{target}` AS SELECT {', '.join(shown)} FROM `{source}`")
