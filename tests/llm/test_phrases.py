"""Phrase mining: SQL and brute force, the guarantee of the summaries, edge rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.compare import assert_same, connect
from tests.conftest import SF_DIR
from tillmart.llm import phrases, queries

DOC = "doc_id long, text string, lang string, part string, score string, words string"


def plain(rows, least, longest, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts.update((lang, words[i : i + size]) for i in range(len(words) - size + 1))
    often = {key: n for key, n in counts.items() if n >= least}
    found = {}
    for (lang, words), a in often.items():
        if len(words) < 2:
            continue
        longer = [own for (other, own), n in often.items() if other == lang and len(own) > len(words) and n >= a]
        if any(own[i : i + len(words)] == words for own in longer for i in range(len(own))):
            continue
        cuts = [(1000 * a * totals[lang] // (often[lang, words[:k]] * often[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        row = (" ".join(words), a, often[lang, words[:k]], often[lang, words[k:]], totals[lang], score)
        found.setdefault(lang, []).append(row)
    out = []
    for lang, own in found.items():
        own.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, rank, *row) for rank, row in enumerate(own[:top], 1)]
    return sorted(out)


def found(spark, rows, **options):
    docs = spark.createDataFrame([(k, text, lang, "x", "y", "z") for k, (lang, text) in enumerate(rows)], DOC).repartition(3)
    return sorted(tuple(r) for r in phrases.collocations(docs, **options).collect())


def test_query_against_sql(spark):
    assert assert_same(queries.op13_phrases(spark, SF_DIR), connect(SF_DIR).sql(queries.OP13_SQL)) > 0


@pytest.mark.parametrize("least, longest, top, words", [(3, 5, 2000, 8), (5, 4, 7, 6)])
def test_against_brute_force(spark, least, longest, top, words):
    rng = random.Random(words)
    vocabulary = [f"w{k}" for k in range(words)] + ["É", "The", "the"]
    rows = []
    for _ in range(60):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", "; ", "\x0b"]) for _ in range(rng.randrange(40)))
        rows.append((rng.choice(["en", "en", "de", None, "und"]), text))
    want = plain(rows, least, longest, top)
    assert want and found(spark, rows, least=least, longest=longest, top=top) == want


def test_small_capacity_loses_nothing(spark, monkeypatch):
    """Many partitions, tiny buffers and sums that are sent on early: the same phrases."""
    rng = random.Random(4)
    rows = [("en", " ".join(rng.choice(["a b c d", "x y"]) if rng.random() < 0.2 else f"u{rng.randrange(3000)}" for _ in range(150))) for _ in range(80)]
    want = plain(rows, 40, 5, 2000)
    monkeypatch.setattr(phrases, "BUFFER", 400)
    monkeypatch.setattr(phrases, "HELD", 300)
    assert want and found(spark, rows, least=40) == want


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), max_size=200), min_size=1, max_size=6), st.integers(2, 20))
def test_merged_summaries_keep_what_is_frequent(parts, least):
    mass = sum(map(len, parts))
    room = np.array([mass // least + 1])
    merged = phrases.Summary(room)
    for part in parts:
        own = phrases.Summary(room)
        for at in range(0, len(part), 7):
            own.merge(*np.unique(np.array(part[at : at + 7], np.uint64), return_counts=True))
        merged.merge(own.keys, own.counts)
        assert len(merged.keys) <= room[0]
    true = Counter(x for part in parts for x in part)
    left = dict(zip(merged.keys.tolist(), merged.counts.tolist()))
    for key, n in true.items():
        assert n - least < left.get(key, 0) <= n
        assert n < least or key in left


def test_scores_pass_64_bits(spark):
    counts = spark.createDataFrame([("en", [1], 10**10), ("en", [2], 10**10), ("en", [1, 2], 10**9)], "lang string, words array<long>, n long")
    totals = spark.createDataFrame([("en", 10**13)], "lang string, words_n long")
    row = phrases.scored(counts.filter("size(words) = 2"), counts, totals).first()
    assert row["score"] == 1000 * 10**9 * 10**13 // 10**20 and (row["l"], row["r"]) == (10**10, 10**10)


def test_edge_rows(spark):
    empty = spark.createDataFrame([], DOC)
    assert phrases.collocations(empty).collect() == []
    rows = [(None, None), ("en", ""), ("en", " .;\n"), ("en", "one"), (None, "a b " * 3), ("und", "a b")]
    assert found(spark, rows, least=4) == plain(rows, 4, 5, 2000)
    long = [("en", "k l m " * 60_000)]
    assert found(spark, long, least=50_000) == plain(long, 50_000, 5, 2000)
    with pytest.raises(ValueError):
        phrases.collocations(empty, longest=6)
