"""The files of a landing folder as a table: what is new, what has changed, and what has been delivered before.

Each check of the folder adds its findings to a manifest. Files are listed without being read; only those that the manifest does not
have with the same size and time are read once, for their rows and a digest of them that does not depend on the order. Where large
deliveries come as folders of files that many tasks have written, a folder is listed as one file is.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillmart.session import written
from tillmart.sources.files import exists

NEW, UNCHANGED, REWRITTEN, REDELIVERED, GONE = "new", "unchanged", "rewritten", "redelivered", "gone"
MANIFEST = "path string, n_bytes long, modified timestamp, n_rows long, digest string, status string"


def _unit(path: str, by_folder: bool) -> Column:
    """What a file is part of: itself, or the folder it is in."""
    return F.regexp_replace(path, "/[^/]*$", "") if by_folder else F.col(path)


def listing(spark: SparkSession, folder: str, pattern: str = "*.parquet", by_folder: bool = False) -> DataFrame:
    """Path, size and time of each file under ``folder``, or of each folder of files; no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    listed = files.select("path", F.col("length").alias("n_bytes"), F.col("modificationTime").alias("modified"))
    if not by_folder:
        return listed
    return listed.groupBy(_unit("path", True).alias("path")).agg(F.sum("n_bytes").alias("n_bytes"), F.max("modified").alias("modified"))


def digests(spark: SparkSession, paths: list[str], schema: T.StructType, by_folder: bool = False) -> DataFrame:
    """Rows of each file (or folder), and a digest of their values in any order: two sums of row hashes, and their number."""
    rows = spark.read.schema(schema).parquet(*paths)
    row = [F.col(f"`{name}`") for name in schema.fieldNames()]
    marked = [F.coalesce(column.cast("string"), F.lit("\x00")) for column in row]
    hashes = rows.select(F.col("_metadata.file_path").alias("file"), F.xxhash64(*marked).alias("h"), F.hash(*marked).alias("g"))
    hashes = hashes.withColumn("path", _unit("file", by_folder))
    sums = hashes.groupBy("path").agg(F.count("*").alias("n_rows"), F.bit_xor("h").alias("x"), F.sum(F.col("g").cast("decimal(20,0)")).alias("s"))
    return sums.select("path", "n_rows", F.concat_ws("-", "n_rows", F.hex("x"), F.col("s").cast("string")).alias("digest"))


class Landing:
    """A landing folder with its manifest, a folder of its own per check. ``by_folder``: each folder of files is taken as one file."""

    def __init__(self, spark: SparkSession, folder: str, manifest: str, schema: T.StructType, by_folder: bool = False):
        self.spark = spark
        self.folder = folder
        self.manifest = manifest
        self.schema = schema
        self.by_folder = by_folder

    def history(self, but: int | None = None) -> DataFrame:
        """All findings, with the number of the check."""
        whole = f"{MANIFEST}, check_id long"
        if not exists(self.spark, self.manifest):
            return self.spark.createDataFrame([], whole)
        rows = self.spark.read.schema(whole).parquet(self.manifest)
        return rows.filter(F.col("check_id") != but) if but is not None else rows

    def known(self, but: int | None = None) -> DataFrame:
        """The last finding of each path that is still there."""
        last = self.history(but).groupBy("path").agg(F.max_by(F.struct("n_bytes", "modified", "n_rows", "digest", "status"), "check_id").alias("last"))
        return last.select("path", "last.*").filter(F.col("status") != GONE)

    def check(self, check_id: int) -> DataFrame:
        """Finds what is new, and adds it to the manifest; a check that is run again replaces its findings.

        A file with the size and time it had is unchanged. Any other is read: with the same rows it is unchanged, too; with other rows than the path had it is
        rewritten; a new path whose rows are those of a file that has come before, now or in any check, is delivered again; else it is new. Of new files with
        the same rows, that with the first path is new. An empty file is new like others.
        """
        before = written(self.known(but=check_id), "known")
        listed = written(listing(self.spark, self.folder, by_folder=self.by_folder), "listed")
        old = before.select("path", *[F.col(name).alias(f"old_{name}") for name in ("n_bytes", "modified", "n_rows", "digest")])
        both = listed.join(old, "path", "full")
        same = F.col("n_bytes").eqNullSafe(F.col("old_n_bytes")) & F.col("modified").eqNullSafe(F.col("old_modified"))
        # paths of files that have come or changed since the last check
        paths = [row["path"] for row in both.filter(F.col("n_bytes").isNotNull() & ~same).select("path").toLocalIterator()]
        read = digests(self.spark, paths, self.schema, self.by_folder) if paths else self.spark.createDataFrame([], "path string, n_rows long, digest string")
        read = read.select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"), "n_rows", "digest")
        seen = self.history(check_id).filter(F.col("status").isin(NEW, REWRITTEN)).select(F.col("digest").alias("seen")).distinct()
        empty = F.lit("0")
        joined = both.join(read, "path", "left").join(seen, F.col("digest") == F.col("seen"), "left")
        # what is gone is told with what it had
        as_before = same | F.col("n_bytes").isNull()
        digest = F.when(as_before, F.col("old_digest")).otherwise(F.coalesce("digest", empty))
        n_rows = F.when(as_before, F.col("old_n_rows")).otherwise(F.coalesce("n_rows", F.lit(0)))
        found = joined.select(
            "path", "n_bytes", "modified", n_rows.alias("n_rows"), digest.alias("digest"), "old_digest", F.col("seen").isNotNull().alias("came")
        )
        fresh = F.col("n_bytes").isNotNull() & F.col("old_digest").isNull()
        first = found.filter(fresh & (F.col("digest") != empty)).groupBy("digest").agg(F.min("path").alias("first_path"))
        status = (
            F.when(F.col("n_bytes").isNull(), GONE)
            .when(F.col("old_digest") == F.col("digest"), UNCHANGED)
            .when(F.col("old_digest").isNotNull(), REWRITTEN)
            .when(F.col("came") | (F.col("path") != F.coalesce("first_path", "path")), REDELIVERED)
            .otherwise(NEW)
        )
        told = found.join(first, "digest", "left").withColumn("status", status).select("path", "n_bytes", "modified", "n_rows", "digest", "status")
        told = written(told, "findings")
        told.write.mode("overwrite").parquet(f"{self.manifest}/check_id={check_id}")
        return told

    def take(self, check_id: int) -> DataFrame:
        """The rows of the files that this check has found new."""
        paths = [row["path"] for row in self.check(check_id).filter(F.col("status") == NEW).select("path").toLocalIterator()]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)
