"""Connected components of links, by alternating stars."""

from pyspark.sql import DataFrame, functions as F

from tillmart.session import written


def _sum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node go to its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node that each linked node reaches; a label's own row is left out.

    Each round is written to the shared folder, which cuts the lineage; the number of
    rounds grows with the logarithm of the longest chain.
    """
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "links")
    before = _sum(edges)
    while before[0]:
        edges = written(_small_star(_large_star(edges)), "stars")
        now = _sum(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
