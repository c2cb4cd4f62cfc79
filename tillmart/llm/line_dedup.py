"""Line de-duplication by winnowing, with built-in functions only.

A window is the shortest run of lines, from a line on, that holds ``min_words`` words.
Of each window the line with the smallest hash is a fingerprint (the last of equal
ones), so two documents that share a run of at least ``min_words`` words share a fingerprint.
Windows whose fingerprint is in one place only are done with. The others are
joined by the hashes of all their lines, which grows a match from the fingerprint to
both ends of its window; windows that end at a line, taken besides those that begin at
one, grow it to the ends of the run. What was there before, by document id, text hash
and line, is a repeat, and all its lines go.

So a line goes if, and only if, it belongs to a run of lines with at least ``min_words``
words in all that also begins at an earlier place. Lines without words are not
compared; those inside a repeat go along.

Defined results: null and empty texts stay as they are; rows that repeat both id and text
are one document, and come out alike; documents with a null id come before others;
the text column is replaced and all other columns are kept; an empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillmart.llm.common import WORD, fresh, text_of
from tillmart.session import shared_dir, written
from tillmart.sources.files import remove

MIN_WORDS = 5


def _hashes(column: Column) -> list[Column]:
    """128 bits in two independent hashes."""
    return [F.xxhash64(column), F.xxhash64(F.lit(1), column)]


def windows_of(docs: DataFrame, min_words: int) -> DataFrame:
    """Windows from and to every line: document (id, text hash), first and last line, content hashes, fingerprint and its line."""
    first, second = _hashes(F.col("line"))
    lines = (
        docs.select("id", F.xxhash64("text").alias("k"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
        .select("id", "k", "pos", first.alias("h1"), second.alias("h2"), F.regexp_count("line", F.lit(WORD)).cast("long").alias("words"))
        .filter("words > 0")
        .repartition("id", "k")
        .dropDuplicates(["id", "k", "pos"])
    )
    doc = Window.partitionBy("id", "k")
    counted = (
        lines.withColumn("stop", F.sum("words").over(doc.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("start", F.col("stop") - F.col("words"))
        .withColumn("total", F.sum("words").over(doc))
    )

    def window(kind: int, over, full: Column) -> Column:
        contents = [F.xxhash64(F.lit(i), F.collect_list(f"h{i + 1}").over(over)) for i in (0, 1)]
        least = F.min(F.struct("h1", (-F.col("pos")).alias("back"))).over(over)
        fields = {
            "kind": F.lit(kind),
            "first": F.min("pos").over(over),
            "last": F.max("pos").over(over),
            "c1": contents[0],
            "c2": contents[1],
            "fingerprint": least["h1"],
            "place": -least["back"],
        }
        return F.when(full, F.struct(*[column.alias(name) for name, column in fields.items()]))

    onward = window(0, doc.orderBy("start").rangeBetween(0, min_words - 1), F.col("start") + min_words <= F.col("total"))
    backward = window(1, doc.orderBy("stop").rangeBetween(1 - min_words, 0), F.col("stop") >= min_words)
    both = counted.select("id", "k", onward.alias("onward"), backward.alias("backward"))
    return both.select("id", "k", F.explode(F.array("onward", "backward")).alias("w")).filter("w is not null").select("id", "k", "w.*")


def repeats_of(docs: DataFrame, min_words: int) -> DataFrame:
    """(id, k, lines): the line numbers that are repeats, per document."""
    spark, path = docs.sparkSession, shared_dir(docs.sparkSession, "windows")
    windows_of(docs, min_words).write.parquet(path)
    windows = spark.read.parquet(path)
    places = windows.groupBy("fingerprint").agg(
        F.min(F.struct("id", "k", "place")).alias("low"), F.max(F.struct("id", "k", "place")).alias("high")
    )
    shared = written(places.filter("low <> high").select("fingerprint"), "fingerprints")
    matched = windows.join(shared, "fingerprint", "left_semi")
    content, place = ["kind", "c1", "c2"], F.struct("id", "k", "first")
    firsts = matched.groupBy(*content).agg(F.min(place).alias("original"), F.count("*").alias("n")).filter("n > 1").drop("n")
    later = matched.join(written(firsts, "originals"), content).filter(~place.eqNullSafe(F.col("original")))
    lines = later.select("id", "k", F.explode(F.sequence("first", "last")).alias("pos"))
    repeats = written(lines.groupBy("id", "k").agg(F.collect_set("pos").alias("lines")), "repeats")
    remove(spark, path)
    return repeats


def without_lines(text: Column, lines: Column) -> Column:
    """The text without the lines of these numbers; each step is one pass over the lines."""
    whole = F.split(text, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(whole) - 1), lines)
    flags = F.sort_array(
        F.concat(
            F.transform(kept, lambda i: F.struct(i.alias("i"), F.lit(True).alias("stays"))),
            F.transform(lines, lambda i: F.struct(i.alias("i"), F.lit(False).alias("stays"))),
        )
    )
    marked = F.zip_with(whole, flags, lambda line, flag: F.when(flag["stays"], line))
    return F.array_join(F.filter(marked, lambda line: line.isNotNull()), "\n")


def dedup_lines(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    removed: str | None = None,
    drop_emptied: bool = False,
) -> DataFrame:
    """``docs`` with the repeated runs taken out of ``text``.

    ``removed`` names a column for the number of lines taken out. ``drop_emptied`` leaves
    out documents that lost lines and have no word left.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), text_of(f"`{text}`").alias("text"))
    lost_id, lost_key, lost = fresh(docs, "lost_id", "lost_key", "lost")
    repeats = repeats_of(rows, min_words).toDF(lost_id, lost_key, lost)
    same = docs[f"`{doc_id}`"].eqNullSafe(repeats[lost_id]) & (F.xxhash64(text_of(f"`{text}`")) == repeats[lost_key])
    joined = docs.join(repeats, same, "left")
    whole = F.col(f"`{text}`")
    rebuilt = F.when(F.col(lost).isNotNull(), without_lines(whole, F.col(lost))).otherwise(whole)
    columns = [rebuilt.alias(column) if column == text else F.col(f"`{column}`") for column in docs.columns]
    if removed:
        columns.append(F.coalesce(F.size(lost), F.lit(0)).cast("long").alias(removed))
    if drop_emptied:
        out = joined.select(*columns, F.col(lost).isNotNull().alias(lost_id))
        return out.filter(~F.col(lost_id) | whole.rlike(WORD)).drop(lost_id)
    return joined.select(*columns)
