"""Files in and out: CSV, Parquet, and the rows of a folder's files."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

RETAIL_ENCODING = "ISO-8859-1"
#: Tables are written with it: keys that are hashes in hex take about half the bytes that the default codec needs.
CODEC = "zstd"
#: Rows of a compressed CSV file, which one task reads.
CSV_ROWS = 1_000_000


MALFORMED = "malformed_line"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, encoding: str = "UTF-8", multi_line: bool = False
) -> DataFrame:
    """CSV with a header row that must match ``schema``; doubled quotes are one quote.

    The column ``MALFORMED`` has the whole text of a record with too few or too many
    fields, and NULL for others. Records end at line breaks, so that large files are
    split between tasks; a record with a quoted line break then is two malformed lines.
    With ``multi_line`` it is one record, and each file is read by one task.
    """
    return (
        spark.read.schema(T.StructType([*schema, T.StructField(MALFORMED, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", MALFORMED)
        # a record's fields are counted only if all are read
        .option("columnPruning", False)
        .csv(path)
    )


def well_formed(lines: DataFrame) -> DataFrame:
    """The records of ``read_csv`` that are not malformed, without that column.

    Spark refuses to read the column of malformed records alone, as a count of rows would, so
    the condition asks for a field, too.
    """
    field = F.coalesce(F.col(lines.columns[0]), F.lit(""))
    return lines.filter(F.col(MALFORMED).isNull() & (F.length(field) >= 0)).drop(MALFORMED)


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8", compressed: bool = False) -> None:
    """CSV that ``read_csv`` reads; ``compressed`` are files of at most ``CSV_ROWS`` rows, as a gzipped file is not split."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("compression", "gzip" if compressed else "none")
        .option("maxRecordsPerFile", CSV_ROWS if compressed else 0)
        .csv(path)
    )


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", CODEC).parquet(path)


def write_partitions(df: DataFrame, path: str, *columns: str, dynamic: bool = True, dealt: bool = False) -> None:
    """Replace the partitions that ``df`` has rows for and leave the others, or all if not ``dynamic``.

    The rebalance hint lets the adaptive planner join small partitions and cut
    a hot one into files of the advised size. Rows that are ``dealt`` by ``columns`` are not moved again.
    """
    (
        (df if dealt else df.hint("rebalance", *columns))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .option("compression", CODEC)
        .partitionBy(*columns)
        .parquet(path)
    )


def rows_per_file(spark: SparkSession, folder: str, tables: list[str]) -> DataFrame:
    """Rows of each table's files under ``folder``, by the name below it."""
    rows = spark.read.schema("none int").parquet(*[f"{folder}/{table}.parquet" for table in tables])
    sizes = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n"))
    name = F.regexp_extract("path", r"([^/]+\.parquet)(/[^/]*)?$", 1)
    return sizes.groupBy(name.alias("file")).agg(F.sum("n").alias("n_rows"))


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _path(spark, path)
    return system.exists(where)


def create(spark: SparkSession, path: str) -> bool:
    """An empty file, if there is none of the name; whether this call has made it."""
    system, where = _path(spark, path)
    return system.createNewFile(where)


def remove(spark: SparkSession, path: str) -> None:
    system, where = _path(spark, path)
    system.delete(where, True)


def move(spark: SparkSession, path: str, folder: str, prefix: str) -> int:
    """Moves the data files directly under ``path`` into ``folder``, with ``prefix`` before their names; how many there are."""
    system, where = _path(spark, path)
    _, to = _path(spark, folder)
    system.mkdirs(to)
    names = [name for name in folders(spark, path) if not name.startswith(("_", "."))]
    for name in names:
        if not system.rename(_path(spark, f"{path}/{name}")[1], _path(spark, f"{folder}/{prefix}{name}")[1]):
            raise OSError(f"{path}/{name} was not moved to {folder}")
    return len(names)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what is directly under ``path``, the latest first."""
    system, where = _path(spark, path)
    found = sorted(system.listStatus(where), key=lambda status: -status.getModificationTime()) if system.exists(where) else []
    return [status.getPath().getName() for status in found]
