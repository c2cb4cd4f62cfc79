"""HyperMinHash groups: SQL and brute force, registers and their estimate, chances of the bands, edge rows."""

import random

import numpy as np
import pytest

from tests.compare import assert_same, connect
from tests.conftest import SF_DIR
from tests.llm.test_jaccard import near_copies, plain
from tillmart.llm import hyperminhash as hmh, queries
from tillmart.llm.jaccard import mix

DOC = "doc_id long, text string, node string, key string, component_id string, kept string"


def found(spark, rows, **options):
    docs = spark.createDataFrame([(key, text, "a", "b", "c", "d") for key, text in rows], DOC).repartition(3)
    got = [tuple(r) for r in hmh.near_duplicates(docs, **options).collect()]
    assert all(kept == (key == least) for key, _, least, kept in got)
    return sorted(row[:3] for row in got)


def test_query_against_sql(spark):
    assert assert_same(queries.op11_hyperminhash(spark, SF_DIR), connect(SF_DIR).sql(queries.OP11_SQL)) > 0


@pytest.mark.parametrize("n, num, den, size, edits", [(4, 80, 100, 150, 12), (4, 80, 100, 12, 1), (1, 75, 100, 9, 3)])
def test_near_copies_against_brute_force(spark, n, num, den, size, edits):
    rows = near_copies(random.Random(size), 6, size, 25, edits)
    assert found(spark, rows, n=n, num=num, den=den) == plain(rows, n, num, den)


def test_common_passage_links_nothing(spark):
    """Half of each text is the same; sets meet in coarse bands and stay apart."""
    rng = random.Random(1)
    common = " ".join(f"c{i}" for i in range(80))
    rows = [(k, " ".join([common, *(f"u{rng.randrange(10**6)}" for _ in range(80 + k % 3))])) for k in range(150)]
    rows += [(200 + k, rows[k][1] + " end") for k in range(10)]
    assert found(spark, rows) == plain(rows, 5, 80, 100)


def test_chains_within_a_group(spark):
    """Each text is near the one before only; all are one component, through links that no hub has."""
    rng = random.Random(2)
    words = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(40):
        rows.append((k, " ".join(words)))
        at = rng.randrange(190)
        words[at : at + 8] = [f"n{k}x{i}" for i in range(8)]
    want = plain(rows, 4, 80, 100)
    assert len({least for *_, least in want}) == 1 and found(spark, rows, n=4) == want


def test_edited_copies_make_few_pairs(spark, monkeypatch):
    """Copies of one text that are at 0.6 to 0.8 of each other: the pairs to compare grow with the copies, not with their square."""
    rng = random.Random(4)
    base = [f"w{k}" for k in range(150)]
    rows = [(0, " ".join(base))]
    for k in range(1, 240):
        own = list(base)
        for at in rng.sample(range(150), rng.choice([1, 2, 2, 5, 6, 6, 7])):
            own[at] = f"n{rng.randrange(10**6)}"
        rows.append((k, " ".join(own)))
    compared, estimated = [], hmh.estimated

    def counted(pairs, nodes, least):
        pairs = pairs.localCheckpoint()
        compared.append(pairs.count())
        return estimated(pairs, nodes, least)

    monkeypatch.setattr(hmh, "estimated", counted)
    want = plain(rows, 4, 80, 100)
    assert found(spark, rows, n=4) == want and len({least for *_, least in want}) > 50
    assert sum(compared) < 25 * len(rows), compared


def test_rare_shingles_lose_no_link(spark):
    """Sets of other sizes, some of one component: all pairs of different components that link share a rare n-gram."""
    rng = np.random.default_rng(5)
    base = mix(np.arange(160, dtype=np.uint64), 1)
    sets, labels = {}, {}
    for node in range(200):
        own = base[rng.random(160) > rng.choice([0.02, 0.06, 0.12])][: rng.integers(100, 161)]
        sets[node] = np.unique(np.concatenate([own, mix(rng.integers(0, 300, rng.integers(0, 20), dtype=np.uint64), 2)]))
        labels[node] = node - node % 3 if node < 60 else node
    linked = {(a, b) for a in sets for b in range(a) if labels[a] != labels[b] and 180 * len(np.intersect1d(sets[a], sets[b])) >= 80 * (len(sets[a]) + len(sets[b]))}
    opened = spark.createDataFrame([(node, labels[node], own.tobytes()) for node, own in sets.items()], "node long, label long, shingles binary")
    shared = hmh.shared_shingles(opened)
    held = {row["node"]: row["count"] for row in shared.groupBy("node").count().collect()}
    able = spark.createDataFrame([(node, len(own), held[node]) for node, own in sets.items()], "node long, n long, m long")
    told = spark.createDataFrame(list(labels.items()), "node long, label long").filter("node <> label")
    got = {(row["b"], row["a"]) for row in hmh.rare_pairs(shared, able, told, 80, 100).collect()}
    assert 500 < len(linked) and linked <= got and all(labels[a] != labels[b] for a, b in got)


def sets_at(rng, size, similarity, count):
    """Pairs of sorted hash sets of that Jaccard similarity."""
    for _ in range(count):
        own = mix(rng.integers(0, 2**62, size, dtype=np.uint64), 1)
        common = round(size * similarity)
        half = (size - common) // 2
        yield np.sort(own[: common + half]), np.sort(np.concatenate([own[:common], own[common + half :]]))


@pytest.mark.parametrize("size, spread", [(20, 0.12), (200, 0.07), (2000, 0.05), (50_000, 0.05)])
def test_estimate(size, spread):
    rng = np.random.default_rng(size)
    for similarity in (0.2, 0.5, 0.8, 1.0):
        pairs = list(sets_at(rng, size, similarity, 60))
        true = [len(np.intersect1d(a, b)) / len(np.union1d(a, b)) for a, b in pairs]
        x, y = (np.stack([hmh.registers_of(pair[side]) for pair in pairs]) for side in (0, 1))
        sizes = [np.array([len(pair[side]) for pair in pairs]) for side in (0, 1)]
        told = hmh.estimate(x, y, *sizes)
        assert abs(np.mean(told) - np.mean(true)) < 0.02
        assert np.std(told - true) < spread


def test_collisions_of_unrelated_sets():
    """The share of registers that are the same by chance is what the correction takes off."""
    rng = np.random.default_rng(3)
    for n, m in ((100_000, 100_000), (100_000, 20_000), (3000, 3000)):
        same = both = 0
        for _ in range(800 if n > 5000 else 3000):
            x, y = (hmh.registers_of(np.sort(mix(rng.integers(0, 2**62, size, dtype=np.uint64), 1))) for size in (min(n, 3000), min(m, 3000 * m // n)))
            same += ((x == y) & (x > 0)).sum()
            both += ((x > 0) & (y > 0)).sum()
        expected = hmh.chance(np.array([n]), np.array([m]))[0]
        assert 0.6 * expected < same / both < 1.5 * expected


@pytest.mark.parametrize("size", [12, 40, 300, 3000])
def test_bands_find_similar_pairs(size):
    rng = np.random.default_rng(size)
    pairs = [p for p in sets_at(rng, size, 0.8, 400) if len(np.intersect1d(*p)) >= 0.8 * len(np.union1d(*p))]
    for bands in (hmh.COARSE, hmh.fine_size(80, 100)):
        keys = [hmh.band_keys(np.stack([hmh.filled(hmh.registers_of(pair[side])) for pair in pairs]), bands) for side in (0, 1)]
        assert ((keys[0] == keys[1]).any(axis=1)).all()


def test_edge_rows(spark):
    empty = spark.createDataFrame([], DOC)
    assert hmh.near_duplicates(empty).collect() == []
    long = "a b c d e f g h " * 20_000
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE two"), (6, "one"), (7, "a b c d"), (7, "q r s t u v"), (8, "q r s t u v"), (9, long), (10, long)]
    assert found(spark, rows, n=4) == plain(rows, 4, 80, 100)
    docs = spark.createDataFrame([(None, "x y z u v w", *"abcd"), (3, "x y z u v w", *"abcd"), (None, "alone is this one text", *"abcd")], DOC)
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in hmh.near_duplicates(docs, n=4).collect()}
    assert got == {(None, 3, 3), (3, 3, 3), (None, 2, None)}
    with pytest.raises(ValueError):
        hmh.near_duplicates(empty, num=1, den=2)
