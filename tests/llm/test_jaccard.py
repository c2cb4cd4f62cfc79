"""Jaccard join: components against brute force, guarantees of the sketches, edge rows."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from pyspark.sql import functions as F

from tests.compare import assert_same, connect
from tests.conftest import SF_DIR
from tillmart.llm import jaccard, queries
from tillmart.llm.components import components

DOC = "doc_id long, text string, node string, component_id string"


def grams(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def plain(rows, n, num, den):
    """Smallest id that each row reaches, by all pairs."""
    sets = [grams(text, n) for _, text in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        r = root(i)
        least[r] = min(least.get(r, key), key)
    return sorted((key, len(sets[i]), least[root(i)]) for i, (key, _) in enumerate(rows))


def found(spark, rows, **options):
    docs = spark.createDataFrame([(key, text, "x", "y") for key, text in rows], DOC).repartition(3)
    return sorted(tuple(r) for r in jaccard.jaccard_groups(docs, **options).collect())


def test_query_against_sql(spark):
    assert assert_same(queries.op10_jaccard_join(spark, SF_DIR), connect(SF_DIR).sql(queries.OP10_SQL)) > 0


def near_copies(rng, n_groups, size, copies, edits):
    rows = []
    for group in range(n_groups):
        base = ["".join(rng.choices("abcdef", k=3)) for _ in range(size)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(edits + 1)):
                own[rng.randrange(len(own))] = f"w{rng.randrange(10**6)}"
            rows.append(" ".join(own[: len(own) - rng.randrange(3)]))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("n, num, den, size, edits", [(3, 90, 100, 150, 4), (5, 80, 100, 120, 6), (3, 90, 100, 12, 1), (1, 50, 100, 9, 4), (5, 80, 100, 40, 3)])
def test_near_copies_against_brute_force(spark, n, num, den, size, edits):
    rows = near_copies(random.Random(size), 6, size, 25, edits)
    assert found(spark, rows, n=n, num=num, den=den) == plain(rows, n, num, den)


def test_common_passage_links_nothing(spark):
    """Documents that share a third of their text are not near copies, and most give no pair to compare."""
    rng = random.Random(1)
    common = " ".join(f"c{i}" for i in range(50))
    rows = [(k, " ".join([common, *(f"u{rng.randrange(10**6)}" for _ in range(100 + k % 3))])) for k in range(120)]
    assert found(spark, rows) == plain(rows, 5, 80, 100)
    docs = spark.createDataFrame([(k, t, "", "") for k, t in rows], DOC).select("doc_id", "text")
    bands = jaccard.Bands(80, 100)
    sets = jaccard.over_sets(docs, 5, jaccard.PROFILE, lambda _, own: [jaccard.profile(own, bands)])
    assert jaccard.rare_keys(sets).count() < len(rows)


def test_chain(spark):
    """Neighbours link, ends do not: one component all the same."""
    rows = [(k, " ".join(f"w{i}" for i in range(6 * k, 6 * k + 120))) for k in range(30)]
    assert found(spark, rows, n=3, num=80, den=100) == plain(rows, 3, 80, 100)
    assert {c for _, _, c in found(spark, rows, n=3, num=80, den=100)} == {0}


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.sampled_from([(90, 100), (80, 100), (50, 100)]), st.integers(0, 1000))
def test_linked_sets_share_a_rare_key(size, only_a, only_b, least, seed):
    """Pigeonhole: of each of two linked sets, any choice of its ``keep`` keys in one order holds a common one."""
    rng = np.random.default_rng(seed)
    codes = rng.integers(0, 1 << 63, size + only_a + only_b).astype(np.uint64)
    a, b = np.unique(codes[: size + only_a]), np.unique(np.concatenate([codes[:size], codes[size + only_a :]]))
    if least[1] * size < least[0] * (size + only_a + only_b):
        return
    bands = jaccard.Bands(*least)
    low = min(bands.of(len(a)), bands.of(len(b)))
    assert abs(bands.of(len(a)) - bands.of(len(b))) <= 1 and only_a + only_b <= bands.differing(low)
    for spare in (jaccard.SPARE, jaccard.FINE):
        of_a, _, keep_a = jaccard.block_keys(a, low, bands, spare)
        of_b, _, keep_b = jaccard.block_keys(b, low, bands, spare)
        common = set(of_a.tolist()) & set(of_b.tolist())
        # the order in which the common keys come last is the worst
        worst = lambda keys, keep: set(sorted(keys.tolist(), key=lambda k: (k in common, k))[:keep])  # noqa: E731, B023
        assert worst(of_a, keep_a) & worst(of_b, keep_b)
    assert set(jaccard.coarse_keys(a, bands).tolist()) & set(jaccard.coarse_keys(b, bands).tolist())
    narrow = [np.array(jaccard.profile(own, bands)[2]).view(np.uint64) for own in (a, b)]
    assert sum(int(x).bit_count() for x in narrow[0] ^ narrow[1]) <= only_a + only_b


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(5, "A b"), (3, "a  B\t"), (3, "a b"), (4, "a b c"), (7, None), (8, ""), (9, " \n\v"), (1, "É x y z"), (2, "é x y z"), (10, long), (11, long + " end")]
    assert found(spark, rows, n=3, num=90, den=100) == plain(rows, 3, 90, 100)
    docs = spark.createDataFrame([(None, "a b c d", "", ""), (6, "a b c d", "", ""), (None, "p q r s", "", "")], DOC)
    assert sorted((tuple(r) for r in jaccard.jaccard_groups(docs).collect()), key=str) == [(6, 1, 6), (None, 1, 6), (None, 1, None)]
    assert jaccard.jaccard_groups(docs.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    rows = [(2, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (3, "x"), (4, None), (None, "q r")]
    docs = spark.createDataFrame([(k, t, "n", "c") for k, t in rows], DOC)
    kept = jaccard.first_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 1, 3, 4, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(links):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    label = {i: i for i in range(31)}
    for _ in range(31):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: v for i, v in label.items() if i != v}


def test_copies_bring_their_keys_once_a_task(spark):
    """A class of copies has one row with keys in each task, and all copies have their groups."""
    text = "a hot text of ten words comes here again now"
    rows = [(i, text if i % 3 else f"{text} {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    held = jaccard.members_of(docs, 3, jaccard.Bands(90, 100)).withColumn("task", F.spark_partition_id())
    of_copies = held.filter("n = 8").groupBy("task").agg(F.count("*").alias("rows"), F.sum((F.size("keys") > 0).cast("int")).alias("full"))
    assert {r["full"] for r in of_copies.collect()} == {1} and of_copies.agg(F.sum("rows")).first()[0] == 200
    found = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_groups(docs, n=3, num=90, den=100).collect()}
    assert {found[i] for i in range(300) if i % 3} == {1}
