"""Token counts: spans against the tokenizer, allocation against a plain count, edge rows."""

from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.conftest import SF_DIR
from tillmart.llm import queries, token_counts
from tillmart.llm.common import read_table

PATH = queries.tokenizer_path("byte_bpe_50k.json")
ODD = ["a\t b", "a  b\n\n c", "  x", "x  ", "é ñ 漢字 \U0001f600 z", "", "\n", "a\x1c b", "don't  we'll\n\n\nx", "<|endoftext|> y", "a b"]


@pytest.fixture(scope="module")
def spans():
    return token_counts.Spans(PATH)


def plain(tokenizer, text, rule):
    """Tokens per line, by looking at every character of every token."""
    lines = text.splitlines(keepends=True) if False else [line + "\n" for line in text.split("\n")[:-1]] + [text.split("\n")[-1]]
    lines = [line for line in lines if line] or [""]
    owner = [n for n, line in enumerate(lines) for _ in line]
    counts = defaultdict(float)
    for start, stop in tokenizer.encode(text, add_special_tokens=False).offsets:
        own = owner[start : max(stop, start + 1)]
        if rule == "first":
            counts[own[0]] += 1
        elif rule == "most":
            counts[max(dict.fromkeys(own), key=own.count)] += 1
        else:
            for n in own:
                counts[n] += 1 / len(own)
    return [counts[n] for n in range(len(lines))]


@pytest.mark.parametrize("text", ODD)
def test_spans_of_odd_texts(spans, text):
    starts, stops = spans.of(text)
    assert list(zip(starts.tolist(), stops.tolist())) == spans.tokenizer.encode(text, add_special_tokens=False).offsets


@settings(max_examples=200, deadline=None)
@given(st.text("aB é.\n\t'漢1", max_size=25), st.sampled_from(token_counts.RULES))
def test_any_text(text, rule):
    spans = test_any_text.__dict__.setdefault("spans", token_counts.Spans(PATH))
    starts, stops = spans.of(text)
    assert list(zip(starts.tolist(), stops.tolist())) == spans.tokenizer.encode(text, add_special_tokens=False).offsets
    counts, _ = token_counts.allocate(starts, stops, *token_counts.lines_of(text), rule)
    assert counts.tolist() == pytest.approx(plain(spans.tokenizer, text, rule))


def test_border_tokens():
    starts, stops = np.array([0, 2, 7]), np.array([2, 7, 9])
    begins, ends = np.array([0, 3, 5]), np.array([3, 5, 9])
    got = {rule: token_counts.allocate(starts, stops, begins, ends, rule) for rule in token_counts.RULES}
    assert got["first"][0].tolist() == [2, 0, 1]
    assert got["most"][0].tolist() == [1, 1, 1]
    assert got["share"][0].tolist() == pytest.approx([1.2, 0.4, 1.4])
    assert got["share"][1].tolist() == [1, 1, 1]


def test_query(spark, spans):
    texts = {r["doc_id"]: r["text"] for r in read_table(spark, SF_DIR, "documents").collect()}
    found = defaultdict(list)
    for r in queries.op7_token_counts(spark, SF_DIR).collect():
        found[r["doc_id"]].append((r["section"], r["n_tokens"]))
    assert set(found) == set(texts)
    for doc_id in sorted(texts)[::7]:
        assert [n for _, n in sorted(found[doc_id])] == plain(spans.tokenizer, texts[doc_id], "most")


def test_edge_rows(spark):
    rows = [(1, "a\nb", 9), (1, "a\nb", 9), (None, "c", 9), (2, None, 9), (3, "", 9), (4, "word " * 50_000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, section int")
    got = sorted(((r["doc_id"], r["section"], r["n_tokens"]) for r in token_counts.count_tokens(docs, PATH).collect()), key=str)
    assert got == sorted([(1, 0, 2.0), (1, 1, 1.0)] * 2 + [(None, 0, 1.0), (2, 0, 0.0), (3, 0, 0.0), (4, 0, 50_001.0)], key=str)
    assert token_counts.count_tokens(docs.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        token_counts.count_tokens(docs, PATH, rule="none")
