"""Column and table helpers the corpus operators share."""

import sys
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: White space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until no column of ``df`` has it (any case)."""
    taken = {column.lower() for column in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def text_of(column: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


#: Rows that a Python worker gets at once, as texts may be long; Spark's own default is 10,000.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Lets Python workers have ``BATCH_ROWS`` rows at once, unless the session says otherwise."""
    setting, default = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
    if spark.conf.get(setting) == default:
        spark.conf.set(setting, str(BATCH_ROWS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def base32_of_hex(digest: Column) -> Column:
    """Base 32 (A-Z, 2-7) of a hex text whose length is a multiple of 5, such as a SHA-1.

    Five hex digits are 20 bits and so four base 32 digits.
    """
    parts = []
    for start in range(1, 41, 5):
        digits = F.lpad(F.conv(F.substring(digest, start, 5), 16, 32), 4, "0")
        parts.append(F.translate(F.upper(digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))
    return F.concat(*parts)


def kept(name: str, make: Callable):
    """What ``make`` has made under this name in this process: Python workers outlive tasks, and so does what they remember.

    A process keeps one thing. When another name is asked for, as in the next stage of a pipeline, the former one goes.
    """
    held = vars(sys.modules.setdefault("_tillmart_kept", ModuleType("_tillmart_kept")))
    if held.get("kept_name") != name:
        held.update(kept_name=None, kept_value=None)
        held.update(kept_value=make(), kept_name=name)
    return held["kept_value"]


class Remembered(dict):
    """Values by key, worked out once by ``find``; those used last, in at most ``most_bytes``, and no long keys."""

    most_bytes, longest = 72_000_000, 64
    #: Bytes of an entry besides key and value: its place in the table, and two object headers.
    entry_bytes = 190

    def __init__(self):
        super().__init__()
        self.older: dict = {}
        self.held_bytes = 0

    def find(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.find(key)
        if len(key) <= self.longest:
            weight = self.entry_bytes + len(key) + (len(value) if isinstance(value, bytes) else 0)
            if self.held_bytes + weight > self.most_bytes // 2:
                self.older = dict(self)
                self.clear()
                self.held_bytes = 0
            self.held_bytes += weight
            self[key] = value
        return value


def is_latin(text: str) -> bool:
    """Whether all characters are below 256; these are one character in every form, in either case."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def byte_signs() -> dict[str, str]:
    """The signs that byte-level tokenizers have for the bytes of blanks, and of letters below 256."""
    from tokenizers import pre_tokenizers

    signs = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    letters = [char for char in map(chr, range(256)) if char.isalpha() or char == " "]
    return {char: signs.pre_tokenize_str(char)[0][0] for char in letters}
