"""Language identification: multinomial naive Bayes over hashed character n-grams.

Defined results: a text that is null or has no letter is ``und`` with score and fit 0.0,
and so is every text when no labelled row was learned from. Ties go to the
language first in order. Repeated rows count as often as they come. Other columns
are kept as they are; output columns of the given names are replaced.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tillmart.llm.common import fresh, small_batches, text_of

UNKNOWN = "und"
#: Code points hashed at once, so a very long text is worked off in pieces.
PIECE = 1 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


def buckets_of(text: str, sizes: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams of the text, lower case, with a space at each end."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    for start in range(0, len(points), PIECE):
        for n in sizes:
            piece = points[start : start + PIECE + n - 1].astype(np.uint64)
            if len(piece) < n:
                continue
            mixed = np.full(len(piece) - n + 1, n, np.uint64)
            for i in range(n):
                mixed = (mixed ^ piece[i : len(piece) - n + 1 + i]) * MIX
                mixed ^= mixed >> np.uint64(29)
            yield ((mixed * MIX) >> np.uint64(64 - bits)).astype(np.int64)


def has_letter(text: str) -> bool:
    return any(char.isalpha() for char in text)


@dataclass
class Model:
    """``weights``: log-probability of each bucket (rows) in each language (columns)."""

    languages: list[str]
    priors: np.ndarray
    weights: np.ndarray
    sizes: tuple[int, ...]
    bits: int


def train(labelled: DataFrame, *, text: str = "text", lang: str = "lang", sizes: tuple[int, ...] = (1, 2, 3), bits: int = 14, smoothing: float = 0.5) -> Model:
    """Counts over all labelled rows; null labels and texts without letters are left out.

    A task sends one row per language and bucket, and the driver gets at most
    ``2 ** bits`` numbers per language.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for frame in frames:
            for name, words in zip(frame["lang"], frame["text"]):
                if not has_letter(words):
                    continue
                held = grams.setdefault(name, np.zeros(1 << bits, np.int64))
                texts[name] = texts.get(name, 0) + 1
                for found in buckets_of(words, sizes, bits):
                    held += np.bincount(found, minlength=1 << bits)
        for name, held in grams.items():
            full = np.flatnonzero(held)
            # bucket -1 holds the number of texts
            yield pd.DataFrame({"lang": name, "bucket": np.append(full, -1), "n": np.append(held[full], texts[name])})

    small_batches(labelled.sparkSession)
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), text_of(text).alias("text")).filter("lang is not null")
    counted = rows.mapInPandas(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counted.toPandas()
    languages = sorted(table["lang"].unique())
    counts = np.zeros((1 << bits, len(languages)))
    texts = np.zeros(len(languages))
    for column, name in enumerate(languages):
        own = table[table["lang"] == name]
        texts[column] = own["n"][own["bucket"] == -1].sum()
        own = own[own["bucket"] >= 0]
        counts[own["bucket"].to_numpy(), column] = own["n"]
    smooth = counts + smoothing
    weights = np.log(smooth / smooth.sum(axis=0)) if languages else counts
    return Model(languages, np.log(texts / texts.sum()) if languages else texts, weights, sizes, bits)


def weighed(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The sum of its n-grams' weights in each language (columns) for each text, and its number of n-grams."""
    sums, sizes = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts), np.int64)
    for row, words in enumerate(texts):
        for found in buckets_of(words, model.sizes, model.bits):
            full = np.bincount(found, minlength=1 << model.bits)
            sparse = np.flatnonzero(full)
            sums[row] += full[sparse] @ model.weights[sparse]
            sizes[row] += len(found)
    return sums, sizes


def probabilities(sums: np.ndarray, model: Model) -> np.ndarray:
    told = sums + model.priors
    shifted = np.exp(told - told.max(axis=1, keepdims=True))
    return shifted / shifted.sum(axis=1, keepdims=True)


def scores_of(texts: list[str], model: Model) -> np.ndarray:
    """Probability of each language (columns) for each text."""
    return probabilities(weighed(texts, model)[0], model)


def predict(
    df: DataFrame, model: Model, *, text: str = "text", pred: str = "lang_pred", score: str = "score", fit: str | None = None
) -> DataFrame:
    """``df`` with the most probable language of each text and its probability.

    That probability is near 1 for nearly every text of some length, in whatever language. The column named by ``fit`` does not
    grow with the length: the mean log-probability of an n-gram in that language, less that of
    buckets drawn evenly. At 0 or below the language explains the text no better than chance.
    """
    small_batches(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf("pred string, score double, fit double")
    def best(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fitted = Model(**held.value)
        for texts in batches:
            known = np.array([bool(fitted.languages) and has_letter(words) for words in texts], bool)
            pred_of = np.full(len(texts), UNKNOWN, object)
            score_of, fit_of = np.zeros(len(texts)), np.zeros(len(texts))
            if known.any():
                sums, sizes = weighed(texts[known].tolist(), fitted)
                probability = probabilities(sums, fitted)
                top = probability.argmax(axis=1)
                pred_of[known] = np.array(fitted.languages, object)[top]
                score_of[known] = probability.max(axis=1)
                fit_of[known] = sums[np.arange(len(sums)), top] / sizes + fitted.bits * np.log(2)
            yield pd.DataFrame({"pred": pred_of, "score": score_of, "fit": fit_of})

    names = {"pred": pred, "score": score} | ({"fit": fit} if fit else {})
    taken = [name.lower() for name in names.values()]
    rest = [f"`{column}`" for column in df.columns if column.lower() not in taken]
    (told,) = fresh(df, "told")
    found = df.select(*rest, best(text_of(f"`{text}`")).alias(told))
    return found.select(*rest, *[F.col(f"{told}.{field}").alias(name) for field, name in names.items()])
