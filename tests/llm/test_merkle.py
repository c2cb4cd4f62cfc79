"""Merkle manifest: SQL and a plain tree, partial witnesses, tampering, edge rows."""

import hashlib
import random
import zlib

import pytest

from tests.compare import assert_same, connect
from tests.conftest import SF_DIR
from tillmart.llm import merkle, queries

DOC = "doc_id long, text string, source string, lang string, n_chars long, leaf string, tree string, pos string, row string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(nodes):
    """Root, and the (before, after) parts of each node's way."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for own in range(len(ways)):
            run, place = at[own] // 3 * 3, at[own] % 3
            ways[own].append(("".join(nodes[run : run + place]), "".join(nodes[run + place + 1 : run + 3])))
            at[own] //= 3
        nodes = [sha("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], ways


def plain_leaf(key, text, source, lang, n):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (key, source, lang, n, text)))


def plain(rows):
    groups = {}
    for key, text, source, lang, n in rows:
        bare = text is not None and key is not None and zlib.crc32(str(key).encode()) % 2 == 0
        seen = plain_leaf(key, text.replace("\n", "") if bare else text, source, lang, n)
        groups.setdefault(source, []).append((key, plain_leaf(key, text, source, lang, n), seen))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[name] = plain_tree([own for _, own, _ in groups[name]])
    root, upper = plain_tree([trees[name][0] for name in names])
    out = []
    for name, above in zip(names, upper):
        for (key, own, seen), way in zip(groups[name], trees[name][1]):
            folded = seen
            for before, after in way + above:
                folded = sha(before + folded + after)
            proof = sha("".join(before + after for before, after in way + above))
            out.append((key, own, trees[name][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def found(spark, rows):
    docs = spark.createDataFrame([(*row, "a", "b", "c", "d") for row in rows], DOC).repartition(5)
    return sorted((tuple(r) for r in merkle.verify(docs).collect()), key=repr)


def test_query_against_sql(spark):
    assert assert_same(queries.op12_merkle(spark, SF_DIR), connect(SF_DIR).sql(queries.OP12_SQL)) > 0


@pytest.mark.parametrize("sizes", [[1], [1, 1], [9, 10, 1, 27, 28, 2, 5, 3, 4]])
def test_sizes_against_plain_tree(spark, sizes):
    rng = random.Random(len(sizes))
    rows = [(rng.randrange(10**6), f"text {k}\n{s}", f"s{s}", "en", k) for s, size in enumerate(sizes) for k in range(size)]
    assert found(spark, rows) == plain(rows)


def test_many_blocks_and_a_hot_source(spark, monkeypatch):
    """With blocks of 9 leaves the trees take several rounds; most rows are of one source."""
    monkeypatch.setattr(merkle, "HEIGHT", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    rng = random.Random(1)
    rows = [(k, f"line\n{k}" if k % 3 else f"one {k}", "hot" if rng.random() < 0.8 else f"s{rng.randrange(40)}", "en", k) for k in range(700)]
    want = plain(rows)
    assert found(spark, rows) == want
    assert {own[-1] for own in want} == {True, False}


@pytest.mark.parametrize("size", [*range(1, 30), 80, 81, 82, 242, 243, 244])
def test_appender_extends_partial_witnesses(size):
    nodes = [sha(str(k)) for k in range(size)]
    grown = merkle.Appender()
    for k, node in enumerate(nodes):
        grown.append(node)
        assert all(len(w) <= 6 for w in grown.witnesses) and len(grown.witnesses) == k + 1
    root = grown.finish(None)
    assert (root, grown.witnesses) == plain_tree(nodes)


def test_other_leaves_do_not_verify(spark):
    rows = [(k, f"a\nb{k}", "s", "en", 3) for k in range(50)]
    for row in found(spark, rows):
        assert row[-1] == (zlib.crc32(str(row[0]).encode()) % 2 == 1)


def test_edge_rows(spark):
    empty = spark.createDataFrame([], DOC)
    assert merkle.verify(empty).collect() == []
    rows = [
        (None, None, None, None, None),
        (None, "x\ny", None, "en", 1),
        (1, "", "", "", 0),
        (1, "", "", "", 0),
        (2, "z" * 200_000 + "\n", "é", "-", 5),
        (2, "other", "é", None, None),
        (3, None, "ü", None, 2),
        (4, "\n", "Z", "en", 1),
    ]
    assert found(spark, rows) == plain(rows)
