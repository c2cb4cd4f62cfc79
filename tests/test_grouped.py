import random

import pytest
from pyspark.sql import Window, functions as F

from tillmart.operators import grouped


def hot_groups(spark, n=3000):
    """A third of the rows in one group, some with no group."""
    random.seed(3)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{i % 200}"
        rows.append((key, random.choice("abcdef") * random.randint(1, 5) + str(i), i))
    return spark.createDataFrame(rows, "k string, t string, i int").repartition(7)


def test_numbering_like_a_window(spark):
    df = hot_groups(spark).withColumn("len", F.length("t"))
    order = [F.desc("len"), F.asc("t")]
    plain = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    cut = grouped.number_in_groups(df, ["k"], order, "rn")
    assert set(map(tuple, cut.collect())) == set(map(tuple, plain.collect()))
    assert cut.count() == 3000


def test_numbering_cuts_the_hot_group(spark, conf):
    """No piece holds much more than its share of the rows, though a third are one group."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "12")
    held = {}

    def spy(df, name):
        held["pieces"] = written(df, name)
        return held["pieces"]

    written = grouped.written
    grouped.written = spy
    try:
        grouped.number_in_groups(hot_groups(spark), ["k"], [F.asc("t")], "rn").count()
    finally:
        grouped.written = written
    sizes = [row["count"] for row in held["pieces"].groupBy("k", "_piece").count().collect()]
    assert max(sizes) < 3000 / 12 * 2
    assert held["pieces"].filter("k = 'hot'").select("_piece").distinct().count() >= 4


@pytest.mark.parametrize("per_part", [1, 10, 100, 5000])
def test_joined_parts_are_the_text(spark, per_part):
    """Of every group, large or small, and with equal texts."""
    df = hot_groups(spark).filter("k IS NOT NULL")
    df = df.unionByName(df.filter("i % 30 = 0").withColumn("i", F.col("i") + 10_000))
    want, found = {}, {}
    for row in df.collect():
        want.setdefault(row.k, []).append(row.t)
    for row in grouped.join_texts(df, "k", "t", "text", per_part, ["i"]).collect():
        found.setdefault(row.k, {})[row.part] = row.text
    assert set(found) == set(want)
    for key, texts in want.items():
        assert sorted(found[key]) == list(range(-(-len(texts) // per_part)))
        assert " ".join(found[key][part] for part in sorted(found[key])) == " ".join(sorted(texts))
        assert max(len(text.split()) for text in found[key].values()) <= per_part


def test_keep_first(spark):
    df = hot_groups(spark)
    first = {r.k: r.i for r in grouped.keep_first(df, ["k"], F.struct("t")).collect()}
    want = {}
    for row in sorted(df.collect(), key=lambda r: r.t):
        want.setdefault(row.k, row.i)
    assert first == want


def test_draws(spark):
    df = hot_groups(spark)
    one = grouped.one_per_key(df, ["k"], seed=1)
    rows = one.collect()
    assert len(rows) == len({r.k for r in rows}) == df.select("k").distinct().count()
    assert set(rows) <= set(df.collect())
    assert set(rows) == set(grouped.one_per_key(df.repartition(3), ["k"], seed=1).collect())
    assert set(rows) != set(grouped.one_per_key(df, ["k"], seed=2).collect())
    assert len(set(grouped.sample_rows(df, 20, seed=4).collect())) == 20
