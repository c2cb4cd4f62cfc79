"""Line de-duplication against brute force and SQL, the winnowing guarantee, edge rows."""

import random
import re

import pytest

from tests.compare import assert_same, connect
from tests.conftest import SF_DIR
from tillmart.llm import line_dedup, queries

DOC = "doc_id long, text string, pos int, k string, lost_id string"


def n_words(line):
    return len(re.findall(r"[^\x20\x09-\x0D]+", line))


def plain(rows, least):
    """All runs of all documents, in order: lines of a run that was there before go."""
    seen, out = set(), {}
    ordered = sorted({(key, text) for key, text in rows}, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    first = {}
    for number, (key, text) in enumerate(ordered):
        lines = [(i, line) for i, line in enumerate((text or "").split("\n")) if n_words(line)]
        for i in range(len(lines)):
            words = 0
            for j in range(i, len(lines)):
                words += n_words(lines[j][1])
                if words >= least:
                    run = tuple(line for _, line in lines[i : j + 1])
                    first.setdefault(run, (number, i))
    for number, (key, text) in enumerate(ordered):
        lines = [(i, line) for i, line in enumerate((text or "").split("\n")) if n_words(line)]
        gone = set()
        for i in range(len(lines)):
            words = 0
            for j in range(i, len(lines)):
                words += n_words(lines[j][1])
                if words >= least and first[tuple(line for _, line in lines[i : j + 1])] < (number, i):
                    gone |= set(range(lines[i][0], lines[j][0] + 1))
        out[(key, text)] = text and "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)
    return sorted(((key, out[(key, text)]) for key, text in rows), key=str)


def found(spark, rows, least):
    docs = spark.createDataFrame([(key, text, 1, "k", "l") for key, text in rows], DOC).repartition(3)
    out = line_dedup.dedup_lines(docs, min_words=least)
    assert out.columns == docs.columns
    return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)


def test_query_against_sql(spark):
    assert assert_same(queries.op4_line_dedup(spark, SF_DIR), connect(SF_DIR).sql(queries.OP4_SQL)) > 0


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    """Few different lines, so runs of all kinds repeat, also within a document and over themselves."""
    rng = random.Random(seed)
    lines = ["", "a", "b c", "d e f", "g h i j", "k l m n o", " "]
    rows = [(k, "\n".join(rng.choices(lines, k=rng.randrange(1, 12)))) for k in range(30)]
    assert found(spark, rows, 6) == plain(rows, 6)


def test_first_occurrence_in_other_context(spark):
    """The fingerprint line stands alone in an earlier document; the run itself comes twice later."""
    run = "one two three\nfour five six\nseven eight nine"
    rows = [(1, "four five six\nx y"), (2, "seven eight nine\nz"), (3, f"p q\n{run}\nr"), (4, f"s t\n{run}\nu v"), (5, f"{run}")]
    assert found(spark, rows, 9) == plain(rows, 9) == [(1, rows[0][1]), (2, rows[1][1]), (3, rows[2][1]), (4, "s t\nu v"), (5, "")]


def test_edge_rows(spark):
    line = "one two three four five six seven eight nine ten"
    long = "\n".join(f"row {i} of a text that has very many lines in it" for i in range(120))
    rows = [(1, line), (1, line), (2, line), (2, f"{line}\nmore"), (None, f"{line}\nnone"), (3, None), (4, ""), (5, "\n\n"), (6, long), (7, long + "\nend")]
    assert found(spark, rows, 10) == plain(rows, 10)
    docs = spark.createDataFrame([(*r, 1, "k", "l") for r in rows], DOC)
    kept = line_dedup.dedup_lines(docs, drop_emptied=True, removed="n")
    assert kept.columns == [*docs.columns, "n"]
    assert sorted(((r["doc_id"], r["n"]) for r in kept.collect()), key=str) == sorted([(2, 1), (None, 0), (3, 0), (4, 0), (5, 0), (6, 0), (7, 120)], key=str)
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = queries.op4_line_dedup(spark, SF_DIR)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_dotted_names(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "x"), (2, "a b c d e f", "y")], "doc_id long, text string, `a.b` string")
    for emptied, left in ((False, 2), (True, 1)):
        out = line_dedup.dedup_lines(docs, drop_emptied=emptied)
        assert out.columns == docs.columns and out.count() == left
