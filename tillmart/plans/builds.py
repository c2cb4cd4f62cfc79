"""Numbered builds of a lake, and the one switch that publishes a build's tables.

A table's rows are under ``root/table/layout/build=N``. A build takes its number before it writes anything and is whole
when its manifest is written, after its last table; a build that fails leaves folders that no manifest names, and
no folder of an earlier build is touched. Published views read the build that the view ``current_build`` names, as a
filter on a partition column, so replacing that one view switches all of them at once, and a query reads one
build's folders only. Readers that were there before the switch go on with the build they began with, for as
long as it is kept.
"""

from pyspark.sql import DataFrame, SparkSession, types as T

from tillmart.operators.dimensions import literal_table
from tillmart.sources.files import create, exists, folders, read_parquet, remove

PLAIN, MONTHLY = "plain", "monthly"
LAYOUTS = (PLAIN, MONTHLY)
#: Whole builds that stay: the current one, and one for those who still read it.
KEPT_BUILDS = 2
#: The view that names the build that is read.
POINTER = "current_build"


class Builds:
    """The builds under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _numbers(self, state: str) -> list[int]:
        names = folders(self.spark, f"{self.root}/builds/{state}")
        return sorted(int(name.removeprefix("build=")) for name in names if name.startswith("build="))

    def begin(self) -> int:
        """A number that no other build has or gets."""
        build = max([0, *self._numbers("begun"), *self.whole()]) + 1
        while not create(self.spark, f"{self.root}/builds/begun/build={build}"):
            build += 1
        return build

    def _manifest(self, build: int) -> str:
        return f"{self.root}/builds/whole/build={build}"

    def finish(self, build: int, layouts: dict[str, str]) -> None:
        """The build is whole: a row for each table with its layout. Written once, in one commit."""
        rows = literal_table(self.spark, sorted(layouts.items()), ["table", "layout"])
        rows.coalesce(1).write.parquet(self._manifest(build))

    def whole(self) -> list[int]:
        return [build for build in self._numbers("whole") if exists(self.spark, f"{self._manifest(build)}/_SUCCESS")]

    def current(self) -> int | None:
        """The last whole build."""
        return max(self.whole(), default=None)

    def layouts(self, build: int) -> dict[str, str]:
        """The tables of a whole build, with their layouts."""
        return {row["table"]: row["layout"] for row in self.spark.read.parquet(self._manifest(build)).collect()}

    def folder(self, table: str, layout: str, build: int) -> str:
        return f"{self.root}/{table}/{layout}/build={build}"

    def table(self, name: str, build: int | None = None, schema: T.StructType | None = None) -> DataFrame:
        """A table of a whole build, the last one by default."""
        build = build or self.current()
        if build is None:
            raise ValueError(f"no whole build in {self.root}")
        return read_parquet(self.spark, self.folder(name, self.layouts(build)[name], build), schema)

    def _read(self) -> dict[str, int]:
        """The build that each database's views read."""
        marks = (name.rsplit("=", 1) for name in folders(self.spark, f"{self.root}/builds/read"))
        return {database: int(build) for database, build in marks}

    def clean(self, keep: int = KEPT_BUILDS) -> list[int]:
        """Removes whole builds but the last ``keep`` and those that views read, and what builds before the current one
        left unfinished; returns their numbers."""
        whole = self.whole()
        kept = {*whole[-keep:], *self._read().values()}
        gone = sorted(build for build in {*self._numbers("begun"), *whole} if build not in kept and whole and build < whole[-1])
        for build in gone:
            # without its manifest it is no whole build any more, whatever becomes of the rest
            remove(self.spark, self._manifest(build))
            for table in folders(self.spark, self.root):
                for layout in LAYOUTS:
                    remove(self.spark, self.folder(table, layout, build))
            remove(self.spark, f"{self.root}/builds/begun/build={build}")
        return gone

    def define(self, table: str, columns: list[str]) -> None:
        """View of the current database on ``table`` in the build that ``POINTER`` names, whatever layout it has there."""
        shown = ", ".join(f"`{column}`" for column in columns)
        used = sorted({self.layouts(build)[table] for build in {*self.whole()[-KEPT_BUILDS:], *self._read().values()}})
        parts = [f"SELECT {shown} FROM parquet.`{self.root}/{table}/{layout}` WHERE build = (SELECT build FROM {POINTER})" for layout in used]
        self.spark.sql(f"CREATE OR REPLACE VIEW `{table}` AS {' UNION ALL '.join(parts)}")

    def switch(self, build: int) -> None:
        """All views of the current database read ``build`` from now on."""
        database, before = self.spark.catalog.currentDatabase(), self._read()
        create(self.spark, f"{self.root}/builds/read/{database}={build}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {POINTER} AS SELECT {build} AS build")
        if before.get(database, build) != build:
            remove(self.spark, f"{self.root}/builds/read/{database}={before[database]}")
