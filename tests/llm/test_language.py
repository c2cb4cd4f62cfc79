"""Language identification: held-out accuracy, a plain naive Bayes, edge rows."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.conftest import SF_DIR
from tillmart.llm import language, queries
from tillmart.llm.common import read_table

SCHEMA = "doc_id long, text string, lang string, score string"


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in read_table(spark, SF_DIR, "documents").collect()}
    rows = queries.op2_language_id(spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 20
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def plain_scores(train: list[tuple[str, str]], text: str, sizes, bits, smoothing) -> dict[str, float]:
    counts, texts = defaultdict(Counter), Counter()
    for lang, words in train:
        texts[lang] += 1
        for found in language.buckets_of(words, sizes, bits):
            counts[lang].update(found.tolist())
    scores = {}
    for lang in sorted(texts):
        total = sum(counts[lang].values()) + smoothing * (1 << bits)
        scores[lang] = math.log(texts[lang] / sum(texts.values()))
        for found in language.buckets_of(text, sizes, bits):
            scores[lang] += sum(math.log((counts[lang][b] + smoothing) / total) for b in found.tolist())
    top = max(scores.values())
    whole = sum(math.exp(s - top) for s in scores.values())
    return {lang: math.exp(s - top) / whole for lang, s in scores.items()}


def test_against_plain_naive_bayes(spark):
    train = [("en", "the thing and that"), ("en", "this other thing"), ("fr", "la chose et que"), ("de", "das Ding und der")]
    docs = spark.createDataFrame([(i, text, lang, "x") for i, (lang, text) in enumerate(train)], SCHEMA)
    model = language.train(docs, bits=8)
    for text in ("that thing", "und das", "que la", "zzz"):
        got = language.scores_of([text], model)[0]
        want = plain_scores(train, text, (1, 2, 3), 8, 0.5)
        assert model.languages == sorted(want)
        assert got == pytest.approx([want[lang] for lang in model.languages])


def test_long_texts_are_worked_off_in_pieces(monkeypatch):
    text = "Añb cdé " * 50
    whole = np.sort(np.concatenate(list(language.buckets_of(text, (1, 2, 3), 10))))
    monkeypatch.setattr(language, "PIECE", 7)
    assert (np.sort(np.concatenate(list(language.buckets_of(text, (1, 2, 3), 10)))) == whole).all()


def test_edge_rows(spark):
    rows = [
        (1, "the and that thing", "en", "s"),
        (1, "the and that thing", "en", "s"),
        (2, "der die das und", "de", None),
        (3, "abc", None, "s"),
        (4, None, "en", "s"),
        (5, "", "en", "s"),
        (6, "123 ### $$$", "de", "s"),
        (None, "das und", None, "s"),
        (7, "the " * 100_000, None, "s"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = language.predict(docs, language.train(docs))
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in out.collect()}
    assert len(out.collect()) == len(rows)
    for key in ((4, None), (5, ""), (6, "123 ### $$$")):
        assert got[key] == ("und", 0.0)
    assert got[(1, "the and that thing")][0] == "en"
    assert got[(None, "das und")][0] == "de"
    assert got[(7, "the " * 100_000)][0] == "en"


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "the", None, "s")], SCHEMA)
    (row,) = language.predict(docs, language.train(docs)).collect()
    assert (row["lang_pred"], row["score"]) == ("und", 0.0)
    assert language.predict(docs.limit(0), language.train(docs.limit(0))).count() == 0


def test_clashing_and_dotted_names(spark):
    rows = [(1, "the and of that", "en", 1, "x", 2.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, told int, `a.b` string, _best_language double")
    told = language.predict(docs, language.train(docs))
    assert told.columns == [*docs.columns, "lang_pred", "score"] and told.first()["a.b"] == "x"


def test_fit_tells_chance_and_other_languages(spark):
    rng = random.Random(5)
    letters = lambda size: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(size))
    # learned from a thousand documents; from fewer, letters that are drawn evenly are not yet told from text
    docs = read_table(spark, SF_DIR.replace("0.001", "0.01"), "documents")
    model = language.train(docs)
    odd = ["το σπίτι και το ποτάμι της παλιάς πόλης είναι κοντά μας " * 9, "дом и река старого города рядом с нами", *(letters(1000) for _ in range(20))]
    known = language.predict(docs, model, fit="Fit").filter("lang_pred <> 'und' and n_chars >= 100")
    told = language.predict(spark.createDataFrame([(i, text, None, "x") for i, text in enumerate(odd)], SCHEMA), model, fit="Fit").collect()
    assert all(row["Fit"] <= 0 for row in told) and min(row["score"] for row in told[:2]) > 0.5
    assert known.filter("Fit > 0").count() == known.count() > 500


def test_fit_is_the_mean_of_an_n_gram(spark):
    docs = spark.createDataFrame([(1, "the and of that", "en", "x"), (2, None, None, "x")], SCHEMA)
    model = language.train(docs, bits=8)
    one, none = sorted(language.predict(docs, model, fit="fit").collect(), key=lambda r: r["doc_id"])
    weights = [model.weights[b, 0] for found in language.buckets_of(one["text"], model.sizes, 8) for b in found]
    assert one["fit"] == pytest.approx(np.mean(weights) + math.log(256)) and none["fit"] == 0
