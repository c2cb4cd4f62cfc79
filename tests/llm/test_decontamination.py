"""Decontamination: alignment and leaks against brute force, edited copies, edge rows."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.conftest import SF_DIR
from tillmart.llm import decontamination as dc, queries
from tillmart.llm.common import read_table

DOC = "doc_id long, text string, score string, item_id int"
ITEM = "item_id long, text string, doc_id int"


def plain_align(item, passage):
    table = np.zeros((len(item) + 1, len(passage) + 1))
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            same = 1.0 if a == b else -dc.MISMATCH
            table[i, j] = max(0, table[i - 1, j - 1] + same, table[i - 1, j] - dc.GAP, table[i, j - 1] - dc.GAP)
    return table.max()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=12), st.lists(st.integers(0, 4), max_size=20))
def test_alignment(item, passage):
    score, start, stop = dc.align(np.array(item), np.array(passage))
    assert score == pytest.approx(plain_align(item, passage))
    assert plain_align(item, passage[start:stop]) == pytest.approx(score)


def test_query_against_brute_force(spark):
    """All pairs aligned whole: the same leaks."""
    docs = read_table(spark, SF_DIR, "documents").collect()
    items = [(r["item_id"], dc.words_of(r["text"])) for r in read_table(spark, SF_DIR, "benchmark").collect()]
    numbers = {}
    code = lambda words: np.array([numbers.setdefault(w, len(numbers) + 1) for w in words], int)
    items = [(key, code(words)) for key, words in items]
    want = set()
    for doc in docs:
        words = code(dc.words_of(doc["text"]))
        for key, item in items:
            if dc.last_row(item, words)[0] / len(item) >= 0.5:
                want.add((doc["doc_id"], key))
    got = queries.op8_decontamination(spark, SF_DIR).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want) > 0


def words(rng, n):
    return ["".join(rng.choices("abcdefghij", k=4)) for _ in range(n)]


def test_edited_copies(spark):
    rng = random.Random(3)
    items = [words(rng, 30) for _ in range(12)]
    rows = []
    for key, item in enumerate(items):
        edited = list(item)
        for place in rng.sample(range(30), 5):
            edited[place] = "swapped"
        del edited[rng.randrange(25)]
        edited.insert(rng.randrange(25), "put")
        rows.append((key, " ".join(words(rng, 40) + edited + words(rng, 40)).upper(), "", 0))
        rows.append((100 + key, " ".join(words(rng, 80) + item[:10]), "", 0))
    docs = spark.createDataFrame(rows, DOC)
    bench = spark.createDataFrame([(k, " ".join(item), 0) for k, item in enumerate(items)], ITEM)
    got = dc.find_leaks(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(k, k) for k in range(12)}
    for r in got:
        assert 35 <= r["start"] < r["stop"] <= 76
    assert {r["doc_id"] for r in dc.without_leaks(docs, bench).collect()} == {100 + k for k in range(12)}


def test_blocks_of_items_give_the_same(spark):
    docs, bench = read_table(spark, SF_DIR, "documents"), read_table(spark, SF_DIR, "benchmark")
    whole = {tuple(r) for r in dc.find_leaks(docs, bench).collect()}
    assert {tuple(r) for r in dc.find_leaks(docs, bench, block_grams=500).collect()} == whole


def test_frequent_passages_are_found(spark):
    """An item in a third of the documents is found in all of them."""
    rng = random.Random(5)
    item = words(rng, 25)
    rows = [(k, " ".join(words(rng, 20) + (item if k % 3 == 0 else []) + words(rng, 20)), "", 0) for k in range(300)]
    got = dc.find_leaks(spark.createDataFrame(rows, DOC), spark.createDataFrame([(1, " ".join(item), 0)], ITEM)).collect()
    assert {r["doc_id"] for r in got} == {k for k in range(300) if k % 3 == 0}


def test_edge_rows(spark):
    item = "one two three four five six seven eight"
    bench = spark.createDataFrame([(1, item, 0), (1, item, 0), (2, "too short", 0), (3, None, 0), (4, "", 0), (None, f"nine {item}", 0)], ITEM)
    docs = spark.createDataFrame([(1, item, "", 0), (1, item, "", 0), (2, None, "", 0), (3, "", "", 0), (None, f"{'x ' * 9_000}{item}", "", 0)], DOC)
    got = dc.find_leaks(docs, bench).collect()
    assert sorted(((r["doc_id"], r["item_id"], round(r["score"], 2)) for r in got), key=str) == sorted(
        [(1, 1, 1.0), (None, 1, 1.0), (1, None, 0.89), (None, None, 0.89)], key=str
    )
    kept = dc.without_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    assert dc.find_leaks(docs, bench.limit(0)).count() == 0
    assert dc.find_leaks(docs.limit(0), bench).count() == 0


def plain_leaks(docs, items, threshold=0.5):
    """All pairs aligned whole."""
    numbers = {}
    code = lambda text: np.array([numbers.setdefault(w, len(numbers) + 1) for w in dc.words_of(text)], int)
    docs, items = ([(key, code(text)) for key, text in rows] for rows in (docs, items))
    return {(d, i) for d, doc in docs for i, item in items if len(item) and dc.last_row(item, doc)[0] / len(item) >= threshold}


@pytest.mark.parametrize("kind", ["every 3rd", "every 4th", "last", "random", "words put in"])
def test_short_edited_items(spark, kind):
    """Items of 1 to 20 words with words replaced or put in: the same leaks as of all pairs."""
    rng = random.Random(kind)
    items, docs = [], []
    for key, size in enumerate([*range(1, 21)] * 4):
        item = words(rng, size)
        edited = list(item)
        for place in range(size):
            if kind.startswith("every") and place % int(kind[6]) == int(kind[6]) - 1 or kind == "last" and place == size - 1:
                edited[place] = "swapped"
            if kind == "random" and rng.random() < 0.25:
                edited[place] = "swapped"
        if kind == "words put in":
            edited = [word for own in item for word in (own, "put")]
        items.append((key, " ".join(item)))
        docs.append((key, " ".join(words(rng, 15) + edited + words(rng, 15))))
    got = dc.find_leaks(spark.createDataFrame([(*r, "", 0) for r in docs], DOC), spark.createDataFrame([(*r, 0) for r in items], ITEM)).collect()
    want = plain_leaks(docs, items)
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    assert len(want) > 60 or kind == "random" and len(want) > 45


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), min_size=1, max_size=8), min_size=1, max_size=4), st.lists(st.integers(0, 6), max_size=40), st.sampled_from([0.4, 0.5, 0.8]))
def test_seeds_lose_nothing(items, doc, threshold):
    """Few different words, so seeds, stretches and scores of all kinds come up."""
    text = lambda numbers: " ".join(f"w{n}" for n in numbers)
    own = dc.Items([(key, text(item)) for key, item in enumerate(items)], threshold)
    found = own.numbers(dc.words_of(text(doc)))
    counts = np.bincount(found, minlength=own.size) + np.bincount(own.pairs_in(found), minlength=own.size)
    counts[0] = 0
    own.choose(counts)
    got = {(item, score) for _, item, score, _, _ in dc.leaks_in([found], own, threshold)}
    scores = {(key, dc.last_row(own.words[key], found)[0] / len(own.words[key])) for key in range(len(items))}
    assert got == {(key, score) for key, score in scores if score >= threshold}


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=400, codec="utf-8"), max_size=60))
def test_quick_words_are_the_words(text):
    quick = [word if isinstance(word, str) else word.decode("latin-1") for word in dc.quick_words(text)]
    assert quick == dc.words_of(text)
    items = dc.Items([(1, "a é straße ÿ 1 _ word"), (2, text[::2])], 0.5)
    assert items.numbers_in(text).tolist() == items.numbers(dc.words_of(text)).tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([0, 0, 0, 1, 2, 7]), max_size=40))
def test_shortened_numbers_are_whole(numbers):
    short = dc.shortened(np.array(numbers, np.int64))
    assert dc.lengthened(short).tolist() == numbers
    assert not ((short[1:] < 0) & (short[:-1] < 0)).any()


@pytest.mark.parametrize("at_once", [4, 64, 1 << 20])
def test_many_documents_in_one_step(monkeypatch, at_once):
    """Whatever a step holds, documents have the leaks that each has alone, with its own places."""
    monkeypatch.setattr(dc, "AT_ONCE", at_once)
    rng = random.Random(at_once)
    draw = lambda size: " ".join(f"w{rng.randrange(6)}" for _ in range(size))
    own = dc.Items([(key, draw(rng.randrange(1, 9))) for key in range(8)], 0.5)
    docs = [own.numbers(dc.words_of(draw(rng.choice([0, 1, 5, 40])))) for _ in range(60)]
    counts = np.bincount(np.concatenate(docs), minlength=own.size)
    counts[0] = 0
    own.choose(counts)
    got, before = [], 0
    for some in dc.in_steps(docs):
        got += [(before + doc, *leak) for doc, *leak in dc.leaks_in(some, own, 0.5)]
        before += len(some)
    assert before == len(docs)
    assert got == [(place, *leak) for place, doc in enumerate(docs) for _, *leak in dc.leaks_in([doc], own, 0.5)]
