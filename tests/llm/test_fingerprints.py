"""Fingerprints: edits against a plain version, votes, neighbours against brute force, edge rows."""

import hashlib
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tillmart.llm import fingerprints as fp, queries
from tillmart.llm.common import read_table

DOC = "doc_id long, text string, stretch int, place string"


def plain_edits(rows):
    """(id, characters, hash of the edited text), ids descending and null last."""
    ordered = sorted(((key, text or "") for key, text in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for i, (key, text) in enumerate(ordered):
        half = len(text) // 2
        edited = text[: len(text) - half] + ordered[(i + 1) % len(ordered)][1][:half]
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=str)


def edits(rows):
    return sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows), key=str)


def bits(a, b):
    return (int(a, 16) ^ int(b, 16)).bit_count()


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in read_table(spark, SF_DIR, "documents").collect()]
    rows = queries.op9_fingerprints(spark, SF_DIR).collect()
    assert edits(rows) == plain_edits(docs)
    by_id = {r["doc_id"]: r for r in rows}
    by_text = {}
    for key, text in docs:
        assert by_text.setdefault(text, by_id[key]["fingerprint"]) == by_id[key]["fingerprint"]
    ids = sorted(by_id, reverse=True)
    for place, key in enumerate(ids):
        row, after = by_id[key], by_id[ids[(place + 1) % len(ids)]]
        assert row["near_next"] == 1 - bits(row["fingerprint"], after["fingerprint"]) / 128
        assert row["near_edited"] == 1 - bits(row["fingerprint"], row["edited_fingerprint"]) / 128
    distinct = {r["fingerprint"] for r in rows}
    for row in rows:
        want = sum(bits(row["fingerprint"], other) <= queries.RADIUS for other in distinct) - 1
        assert row["n_near"] == (want if row["doc_id"] % 50 == 0 else None)
    assert statistics.mean(r["near_edited"] for r in rows) > statistics.mean(r["near_next"] for r in rows) + 0.1


def test_votes_against_plain_sums(spark):
    texts = ["The cat, the dog and the cat!", "one", "", "a b " * 500]
    terms = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "key int, text string")
    hashed = terms.select("key", F.explode(fp.terms_of(F.col("text"))).alias("t")).select("key", "t.*").collect()
    got = {r["key"]: (r["f0"], r["f1"]) for r in fp.fingerprint_rows(terms, ["key"], "text").collect()}
    for key, text in enumerate(texts):
        own = [r for r in hashed if r["key"] == key]
        assert len(own) == len(re.split(r"[\W_]+", text))
        for half in (0, 1):
            for bit in range(64):
                votes = sum(r["weight"] * (1 if r[f"h{half}"] >> bit & 1 else -1) for r in own)
                assert (got[key][half] >> bit & 1) == (votes > 0)


def test_edge_rows(spark):
    rows = [(5, "abc def"), (5, "abc def"), (5, "zz"), (None, "n u l l"), (None, None), (1, ""), (2, None), (3, "x" * 200_001), (4, "\U0001f600é\U0001f600é y"), (-7, "## $$")]
    docs = spark.createDataFrame([(*r, 1, "p") for r in rows], DOC).repartition(3)
    got = fp.fingerprint_edits(docs).collect()
    assert edits(got) == plain_edits(rows)
    assert len({r["fingerprint"] for r in got if r["n_chars"] in (0, 5) and r["doc_id"] in (1, 2, -7)}) <= 2
    for some in (docs.limit(1), docs.filter("doc_id is null")):
        assert edits(fp.fingerprint_edits(some).collect()) == plain_edits([(r["doc_id"], r["text"]) for r in some.collect()])
    assert fp.fingerprint_edits(docs.filter("doc_id = 99")).count() == 0


@pytest.mark.parametrize("radius", [0, 3, 10])
def test_neighbours_against_brute_force(spark, radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(128) for _ in range(30)]
    codes = base + [b ^ sum(1 << p for p in rng.sample(range(128), rng.randrange(radius + 3))) for b in base for _ in range(5)]
    texts = sorted({f"{c:032x}" for c in codes})
    table = spark.createDataFrame([(t, 1) for t in [*texts, texts[0]]] + [(None, 2)], "fingerprint string, key int")
    queried = table.filter("fingerprint < '8'")
    got = {(r["query"], r["fingerprint"], r["distance"]) for r in fp.within_radius(queried, table, radius).collect()}
    want = {(a, b, bits(a, b)) for a in texts if a < "8" for b in texts if bits(a, b) <= radius}
    assert got == want and len(got) > 0


def test_no_python_in_the_plan(spark):
    plan = fp.fingerprint_edits(read_table(spark, SF_DIR, "documents"))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_radius_blocks_and_ids(spark):
    """Copies with a word changed are neighbours, by id; wide radii find what all pairs find."""
    rows = queries.op9_fingerprints(spark, SF_DIR).collect()
    for row in rows:
        want = [r["doc_id"] for r in rows if 0 < bits(row["fingerprint"], r["fingerprint"]) <= queries.RADIUS]
        assert row["near_ids"] == (",".join(map(str, sorted(want))) if row["doc_id"] % 50 == 0 else None)
    rng = random.Random(20)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(200)) for _ in range(40)]
    changed = [" ".join("swapped" if i == 100 else word for i, word in enumerate(text.split())) for text in texts]
    terms = spark.createDataFrame(list(enumerate(texts + changed)), "key int, text string")
    found = fp.fingerprint_rows(terms, ["key"], "text").select("key", fp.as_text("f0", "f1").alias("fingerprint"))
    by_key = {r["key"]: r["fingerprint"] for r in found.collect()}
    got = {(r["query"], r["fingerprint"]) for r in fp.within_radius(found, found, queries.RADIUS).collect()}
    assert got == {(a, b) for a in by_key.values() for b in by_key.values() if bits(a, b) <= queries.RADIUS}
    assert sum((by_key[k], by_key[k + 40]) in got for k in range(40)) >= 38
