"""Numbering, first-of-group, sampling and text joining that hold up with hot groups."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillmart.session import written

#: A value that more than this share of the rows has is hot, so there are at most 1 / HOT_SHARE; its rows are dealt over SALTS.
HOT_SHARE, SALTS = 0.005, 32
#: Hashes by which rows are counted to find hot values; the counts go to the driver.
HASHES = 1024


def number_in_groups(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """``row_number`` per group, with each large group cut into pieces.

    The rows are range-partitioned by group and order, so a piece is a run of
    consecutive rows of a group, of bounded size however large the group is. A
    row's number is its place in the piece plus the sizes of the pieces before.
    ``order`` must leave no ties. The pieces are written, as a second run of the
    range partitioning may cut elsewhere.
    """
    cut = df.repartitionByRange(*keys, *order).withColumn("_piece", F.spark_partition_id())
    pieces = written(cut, "pieces")
    earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        pieces.groupBy(*keys, "_piece")
        .agg(F.count("*").alias("_size"))
        .select(
            *[F.col(key).alias(f"_{key}") for key in keys],
            F.col("_piece").alias("_start_piece"),
            F.sum("_size").over(earlier).alias("_start"),
        )
        # only a group that goes on from an earlier piece, so one group a piece at most
        .filter("_start > 0")
    )
    same = F.col("_piece") == F.col("_start_piece")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    place = F.row_number().over(Window.partitionBy(*keys, "_piece").orderBy(*order))
    return (
        pieces.withColumn("_place", place)
        .join(starts, same, "left")
        .withColumn(name, (F.coalesce("_start", F.lit(0)) + F.col("_place")).cast("int"))
        .select(*df.columns, name)
    )


def keep_first(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """First row per key in ``order``; found by aggregation, so each task sends one row per key."""
    rest = [column for column in df.columns if column not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_first"))
    return first.select(*keys, "_first.*").select(df.columns)


def draw(seed: int, *columns: str) -> Column:
    """Random-looking text per row, the same wherever and whenever it is drawn: MD5 of seed and values, NULLs marked."""
    values = [F.coalesce(F.col(column).cast("string"), F.lit("<null>")) for column in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *values).cast("binary"))


def sample_rows(df: DataFrame, n: int, seed: int = 0, on: list[str] | None = None) -> DataFrame:
    """``n`` rows drawn by the columns ``on``, by default all."""
    return df.withColumn("_draw", draw(seed, *(on or df.columns))).orderBy("_draw").limit(n).drop("_draw")


def one_per_key(df: DataFrame, keys: list[str], seed: int = 0) -> DataFrame:
    """One randomly drawn row per key."""
    order = Window.partitionBy(*keys).orderBy("_draw")
    return (
        df.withColumn("_draw", draw(seed, *df.columns))
        .withColumn("_rank", F.row_number().over(order))
        .filter("_rank = 1")
        .drop("_draw", "_rank")
    )


def join_texts(df: DataFrame, key: str, text: str, name: str, per_part: int, ties: list[str] | None = None) -> DataFrame:
    """Texts of each group in order, joined by blanks, ``per_part`` to a part.

    A group's parts are numbered from 0, and joined in order they are its whole text.
    Texts are in order of ``text``, then ``ties``, which must leave no two rows alike.
    """
    numbered = number_in_groups(df, [key], [F.asc(column) for column in (text, *(ties or []))], "_number")
    part = F.expr(f"CAST((_number - 1) DIV {per_part} AS INT)")
    return (
        numbered.groupBy(key, part.alias("part"))
        .agg(F.sort_array(F.collect_list(F.struct("_number", text))).alias("_texts"))
        .select(key, "part", F.array_join(F.col("_texts")[text], " ").alias(name))
    )


def hot_values(df: DataFrame, column: str) -> list:
    """The values, NULL among them, that more than ``HOT_SHARE`` of the rows have.

    Rows are counted by a thousand hashes of the value. Only those of hashes with that many rows are counted by value, and none if there is no such hash.
    """
    hashed = F.pmod(F.xxhash64(column), F.lit(HASHES))
    sizes = dict(df.groupBy(hashed).agg(F.count("*")).collect())
    least = HOT_SHARE * sum(sizes.values())
    maybe = [value for value, n in sizes.items() if n > least]
    if not maybe:
        return []
    counted = df.filter(hashed.isin(maybe)).groupBy(column).agg(F.count("*").alias("n"))
    return [row[0] for row in counted.filter(F.col("n") > least).collect()]


def with_salt(df: DataFrame, key: str, value: str, name: str = "_salt") -> tuple[DataFrame, bool]:
    """``df`` with 0, or for hot keys a number from 1 on that depends on the value, and on the whole row if that is NULL; whether there are hot ones."""
    hot = hot_values(df, key)
    if not hot:
        return df.withColumn(name, F.lit(0)), False
    known = [found for found in hot if found is not None]
    is_hot = F.col(key).isNull() if len(known) < len(hot) else F.lit(False)
    is_hot = is_hot | F.coalesce(F.col(key).isin(known), F.lit(False)) if known else is_hot
    dealt = F.when(F.col(value).isNull(), F.xxhash64(*df.columns)).otherwise(F.xxhash64(value))
    return df.withColumn(name, F.when(is_hot, F.pmod(dealt, F.lit(SALTS)).cast("int") + 1).otherwise(0)), True


def totals(
    rows: DataFrame,
    keys: list[str],
    value: str,
    distinct: str,
    measures: dict[str, tuple[Column, Callable[[str], Column]]],
    deal: list[str],
    salted: bool,
    salt: str = "_salt",
    once: bool = False,
) -> DataFrame:
    """A row per ``keys`` with ``measures`` and the number of distinct values of ``value`` as ``distinct``; ``rows`` are moved once.

    They are dealt by ``deal``, some of the keys, so that a task has the whole of a group, and those of hot keys by their salt, too
    (``with_salt``, by the same value). Only the salts' sums of hot keys are moved again; a measure is how it is taken of rows, and of sums.
    With ``once`` no two rows have the same keys and value, so that the values are counted as rows.
    """
    different = F.count(value) if once else F.countDistinct(value)
    own = [first.alias(name) for name, (first, _) in measures.items()]
    if not salted:
        return rows.drop(salt).repartition(*deal).groupBy(*keys).agg(*own, different.alias(distinct))
    parts = rows.repartition(*deal, salt).groupBy(*keys, salt).agg(*own, different.alias(distinct))
    again = [then(name).alias(name) for name, (_, then) in measures.items()]
    cold = parts.filter(F.col(salt) == 0).drop(salt)
    hot = parts.filter(F.col(salt) > 0).groupBy(*keys).agg(*again, F.sum(distinct).alias(distinct))
    return cold.unionByName(hot)
