"""The pipeline's stages against plain versions of each, on its own input."""

import random

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from tests.conftest import SF_DIR
from tests.llm import test_decontamination, test_jaccard, test_line_dedup, test_packing
from tillmart.llm import decontamination as dc, line_dedup, packing
from tillmart.llm.common import read_table
from tillmart.session import written


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages(spark):
    docs = read_table(spark, SF_DIR, "documents")
    names = [name for name, _ in pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_duplicates", "decontamination", "packing"]
    outs = [docs]
    for name, stage in pipeline.STAGES:
        outs.append(written(stage(spark, outs[-1], SF_DIR), f"test_{name}"))
    for out in outs[1:-1]:
        assert out.schema.simpleString() == docs.schema.simpleString()
    start, told, cut, single, clean, packed = (rows_of(df) if "text" in df.columns else df.collect() for df in outs)
    assert set(told) <= set(start) and len(told) > 0.95 * len(start)

    want = test_line_dedup.plain(told, line_dedup.MIN_WORDS)
    lost = {key for key, text in want if text != dict(told)[key] and not test_line_dedup.n_words(text)}
    assert sorted(cut) == sorted((key, text) for key, text in want if key not in lost)

    groups = test_jaccard.plain(cut, 5, 80, 100)
    assert sorted(key for key, _ in single) == [key for key, _, least in groups if key == least]

    items = [dc.words_of(r["text"]) for r in read_table(spark, SF_DIR, "benchmark").collect()]
    numbers = {}
    code = lambda words: test_decontamination.np.array([numbers.setdefault(w, len(numbers) + 1) for w in words], int)
    items = [code(words) for words in items]
    leaking = {key for key, text in single if any(dc.last_row(item, code(dc.words_of(text)))[0] >= 0.5 * len(item) for item in items)}
    assert leaking and sorted(clean) == sorted(r for r in single if r[0] not in leaking)

    words = packing.WordIds(test_packing.PATH)
    used = test_packing.check_packed(packed, clean, words)
    assert used <= -(-sum(r["length"] for r in packed) // packing.CAPACITY) + 1


def test_language_stage_rejects(spark):
    docs = spark.createDataFrame(
        [(k, "the and of that this", "en", "s", 1) for k in range(3)] + [(4, "123 $$", "en", "s", 1), (5, None, None, "s", 0), (6, "", "en", None, None)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    assert sorted(r["doc_id"] for r in pipeline.identify_language(spark, docs, SF_DIR).collect()) == [0, 1, 2]


def test_language_stage_rejects_what_was_not_learned(spark):
    """Other scripts and drawn letters go, all labelled texts with a letter stay."""
    rng = random.Random(3)
    docs = read_table(spark, SF_DIR.replace("0.001", "0.01"), "documents")
    drawn = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(1000))
    odd = [(-1, "дом и река старого города рядом с нами", None, "s", 1), (-2, drawn, None, "s", 1)]
    own = docs.select("doc_id", "text", "lang", "source", "n_chars")
    left = pipeline.identify_language(spark, own.unionByName(spark.createDataFrame(odd, own.schema)), SF_DIR)
    kept = {r["doc_id"] for r in left.select("doc_id").collect()}
    assert not kept & {-1, -2}
    assert kept == {key for key, text in rows_of(docs) if text and any(char.isalpha() for char in text)}


def test_registered(spark):
    assert contract.queries()["pipeline"] is pipeline.run
    wanted = {f"op{n}_" for n in range(1, 14)}
    assert {name.split("_")[0] + "_" for name in contract.queries() if name.startswith("op")} == wanted


def test_edge_rows(spark, tmp_path):
    """Nulls in all columns, empty, long and repeated texts, repeated ids, odd column names; and an empty table."""
    words = "the house and the river of that old town are near to us "
    rows = [
        (1, words * 3, "en", "s", 1, "x"),
        (1, words * 3, "en", "s", 1, "x"),
        (2, words * 3, None, None, None, None),
        (None, None, None, None, None, None),
        (None, words + "or not", "en", "s", 1, "y"),
        (3, "", "en", "s", 0, "x"),
        (4, "123 456", "en", "s", 7, "x"),
        (5, words * 4_000, "en", "s", 7, "x"),
        (5, "der Fluss und das Haus sind alt und die Stadt ist nah", "de", "s", 7, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `told.row` string")
    for held in (docs, docs.limit(0)):
        out = held
        for name, stage in pipeline.STAGES[:-1]:
            out = written(stage(spark, out, SF_DIR), f"edge_{name}")
            assert out.schema.simpleString() == docs.schema.simpleString()
        packed = pipeline.STAGES[-1][1](spark, out, SF_DIR).collect()
        assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in out.collect()}
        assert bool(packed) == (held is docs)
