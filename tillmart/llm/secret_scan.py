"""Secret scans over a ledger of content-addressed blobs.

Every version of every path is filed under the SHA-256 of its text. A blob is
scanned for a rule version once, however many paths, versions and later ingests
hold it, and findings go back to all paths by the address.

Defined results: a null text is the empty text; a null path or version is a path
or version of its own; repeated rows are filed and reported as often as they come;
other columns of the input are not read. An empty input leaves the ledger as it is.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillmart.llm.common import small_batches, text_of

FINDING = "start int, rank int, kind string, version int, `end` int"
SCANNED = f"blob string, scanned array<string>, findings array<struct<start:int,rank:int,kind:string,version:int,`end`:int>>"
ADDRESS = "path string, version string, blob string"


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``part`` of a match must have ``least`` characters; matches are leftmost, non-overlapping."""

    kind: str
    pattern: str
    part: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: Fixed patterns. Letters of the first are taken in either case, ASCII only.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
#: Kinds beyond the base ones, in public formats of keys.
MORE_RULES = (
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]+", 0, 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
)
RULES = BASE_RULES + MORE_RULES


def spans_of(text: str, rules: dict[str, tuple[int, Rule, re.Pattern]], wanted: list[str]) -> list[dict]:
    found = []
    for name in wanted:
        rank, rule, pattern = rules[name]
        for match in pattern.finditer(text):
            if len(match[rule.part]) >= rule.least:
                found.append((match.start(), rank, rule.kind, rule.version, match.end()))
    keys = ("start", "rank", "kind", "version", "end")
    return [dict(zip(keys, span)) for span in sorted(found)]


def scan_blobs(rules: tuple[Rule, ...]):
    """mapInPandas function: (blob, text, wanted) to (blob, scanned, findings)."""

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled = {rule.name: (rank, rule, re.compile(rule.pattern, re.ASCII)) for rank, rule in enumerate(rules)}
        for frame in frames:
            findings = [spans_of(text, compiled, list(wanted)) for text, wanted in zip(frame["text"], frame["wanted"])]
            yield pd.DataFrame({"blob": frame["blob"], "scanned": frame["wanted"], "findings": findings})

    return scan


class Ledger:
    """Two growing tables under ``path``: ``addresses`` (path, version, blob) and ``scans`` (blob, scanned, findings)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def addresses(self) -> DataFrame:
        return self._table("addresses", ADDRESS)

    def scans(self) -> DataFrame:
        return self._table("scans", SCANNED)

    def _table(self, name: str, schema: str) -> DataFrame:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        exists = hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
        if not exists:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def ingest(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES, *, path: str = "path", version: str = "version", text: str = "text") -> None:
        """Files all rows of ``versions`` and scans the (blob, rule version) pairs no earlier ingest has scanned.

        The scans of an ingest are one append, so an ingest that fails and runs again
        scans once more at worst; the same findings of a blob count once.
        """
        small_batches(self.spark)
        filed = versions.select(
            F.col(path).cast("string").alias("path"), F.col(version).cast("string").alias("version"), text_of(text).alias("text")
        ).withColumn("blob", F.sha2("text", 256))
        known = self.scans()
        names = F.array(*[F.lit(rule.name) for rule in rules])
        blobs = filed.groupBy("blob").agg(F.first("text").alias("text"))
        if known.isEmpty():
            todo = blobs.withColumn("wanted", names)
        else:
            seen = known.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("scanned"))).alias("seen"))
            todo = (
                blobs.join(seen, "blob", "left")
                .withColumn("wanted", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>"))))
                .filter(F.size("wanted") > 0)
                .select("blob", "text", "wanted")
            )
        todo.mapInPandas(scan_blobs(rules), SCANNED).write.mode("append").parquet(f"{self.path}/scans")
        filed.select("path", "version", "blob").write.mode("append").parquet(f"{self.path}/addresses")

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """One row per filed (path, version): blob and the spans of ``rules``, by start, then rule order.

        Blobs with findings are written as a table of their own, so the planner sees
        its size and can split the paths of a blob that many paths hold.
        """
        current = F.array(*[F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version")) for rule in rules])
        hit = (
            self.scans()
            .filter(F.size("findings") > 0)
            .select("blob", F.explode("findings").alias("f"))
            .filter(F.array_contains(current, F.struct("f.kind", "f.version")))
            .groupBy("blob")
            .agg(F.sort_array(F.collect_set("f")).alias("findings"))
        )
        hit.write.mode("overwrite").parquet(f"{self.path}/hits")
        hits = self.spark.read.schema(hit.schema).parquet(f"{self.path}/hits")
        empty = F.array().cast(hit.schema["findings"].dataType)
        return self.addresses().join(hits, "blob", "left").withColumn("findings", F.coalesce("findings", empty))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans in order, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(spans: Column, kinds: list[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(kinds))
