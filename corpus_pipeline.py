"""A training corpus from raw documents: five stages, each on all rows that the one before kept.

All stages keep every column, whatever its name, and every row that they do not drop; the last gives pieces. Null and empty texts
have no language and go in the first. Very long texts go through whole. Rows that repeat an id are
each judged by their own text; of equal texts, one document stays: that with the smallest id, with all rows that
have this id; rows without an id have none to lose and stay. An empty table, or one of which nothing is left, gives no rows.
"""

import os
import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillmart.llm import decontamination, jaccard, language, line_dedup, packing  # noqa: E402
from tillmart.llm.common import fresh, read_table  # noqa: E402
from tillmart.llm.queries import tokenizer_path  # noqa: E402
from tillmart.session import written  # noqa: E402

#: A language is told if it is more probable than all others together, and explains the n-grams better than chance.
LEAST_SCORE, LEAST_FIT = 0.5, 0.0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those whose language is not clear or is none of the learned ones."""
    pred, score, fit = fresh(docs, "lang_pred", "lang_score", "lang_fit")
    told = language.predict(docs, language.train(docs), pred=pred, score=score, fit=fit)
    clear = (F.col(pred) != language.UNKNOWN) & (F.col(score) >= LEAST_SCORE) & (F.col(fit) > LEAST_FIT)
    return told.filter(clear).select([f"`{column}`" for column in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines are cut out; documents that lose all their words go."""
    return line_dedup.dedup_lines(docs, drop_emptied=True)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group of near copies (five words, similarity 0.8)."""
    return jaccard.first_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, edited or not, go."""
    return decontamination.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_duplicates", dedup_documents),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: SQL cannot express the language model; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each written and read again as the next one's documents."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
