"""Benchmark decontamination: rare words and word pairs as seeds, then Smith-Waterman alignment.

Words are runs of letters, digits and underscores, lower case. A leak is a passage whose
alignment with an item scores at least ``threshold`` of the item's length. The seeds of an
item are chosen so that every such alignment holds one: say it matches m of L words in r
runs; between runs is an edit of cost c or more, so it scores at most m - c (r - 1), and
m - r word pairs of the item are matched. For any t, either at least t pairs are, and one
of the L - t rarest pairs is among them, or m is at least (threshold L - c t) / (1 - c), and
one of the L - m + 1 rarest words is. Words and pairs of the items are counted over the whole
corpus, and each item has the t whose seeds are fewest there. Where a seed is in a document,
the stretch that an alignment can reach is held against the same bound, then aligned.

Texts are cut into words once. A document that has words of the items is written as their numbers, with each run of
other words as its length; the counts come along. Seeds are looked for in these numbers.

The items' seeds and words go to the tasks in blocks of at most ``block_grams``
words; each block is a pass over the documents, so what a task holds is bounded
however many items there are. A very long text is one array of numbers; what is aligned at a time is a stretch of it.

Defined results: null texts and empty texts have no words and no leaks; items of one or
two words leak like others; items that repeat an id are aligned one by one, and the best
score of the pair counts; rows that repeat a document id likewise; null ids are kept; other
columns are not read.
"""

import re
from collections.abc import Iterator
from functools import cached_property
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillmart.llm.common import is_latin, small_batches, text_of
from tillmart.session import written

WORDS = re.compile(r"\w+")
LEAKS = "doc_id long, item_id long, score double, start long, stop long"
#: Costs, in units of a matching word.
MISMATCH, GAP = 0.5, 0.5
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Numbers that one step of the search for seeds holds; a longer text is in steps of its own.
AT_ONCE = 1 << 20


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


#: For each character below 256 itself in lower case if it can be in a word, else a blank.
WORD_SIGNS = "".join(char.lower() if WORDS.match(char) else " " for char in map(chr, range(256))).encode("latin-1")


def quick_words(text: str) -> list[bytes] | list[str]:
    """``words_of``, as bytes if all characters are below 256."""
    try:
        return text.encode("latin-1").translate(WORD_SIGNS).split()
    except UnicodeEncodeError:
        return words_of(text)


def shortened(numbers: np.ndarray) -> np.ndarray:
    """Word numbers with each run of words that no item has (number 0) as minus its length."""
    other = numbers == 0
    kept = np.flatnonzero(~other | np.concatenate([[True], ~other[:-1]])[: len(numbers)])
    runs = np.diff(np.append(kept, len(numbers)))
    return np.where(other[kept], -runs, numbers[kept]).astype(np.int32)


def lengthened(numbers: np.ndarray) -> np.ndarray:
    return np.repeat(np.maximum(numbers, 0), np.maximum(-numbers, 1))


def gram_codes(ids: np.ndarray, n: int) -> np.ndarray:
    """A number for each n-gram of word numbers; 0 where one has a word that no item has (number 0)."""
    if len(ids) < n:
        return np.zeros(0, np.uint64)
    size = len(ids) - n + 1
    codes, known = np.full(size, n, np.uint64), np.ones(size, bool)
    for i in range(n):
        own = ids[i : i + size]
        known &= own > 0
        codes = (codes ^ own.astype(np.uint64)) * MIX
        codes ^= codes >> np.uint64(31)
    return np.where(known, codes | np.uint64(1), np.uint64(0))


class Items:
    """Words of a block of test items as numbers, their word pairs, and the seeds among both.

    Words have their numbers as places in ``seeds`` and ``counts``, pairs the places after them.
    """

    def __init__(self, rows: list[tuple[int | None, str]], threshold: float):
        self.threshold = threshold
        self.vocabulary: dict[str, int] = {}
        self.ids = [key for key, _ in rows]
        self.words = [self.numbers(words_of(text), learn=True) for _, text in rows]
        grams = [gram_codes(words, 2) for words in self.words]
        self.codes = np.unique(np.concatenate([np.zeros(0, np.uint64), *grams]))
        self.pairs = [np.searchsorted(self.codes, own) + len(self.vocabulary) + 1 for own in grams]
        self.seeds = np.zeros(0, bool)
        self.sizes = np.array([len(words) for words in self.words], np.int64)
        self.word_keys, self.pair_keys = self.keys_of(self.words), self.keys_of(self.pairs)

    @classmethod
    def of(cls, fields: dict) -> "Items":
        """Items with the fields of others, as a broadcast has them."""
        items = cls.__new__(cls)
        vars(items).update(fields)
        return items

    @property
    def size(self) -> int:
        return len(self.vocabulary) + 1 + len(self.codes)

    def keys_of(self, numbers: list[np.ndarray]) -> np.ndarray:
        """Which item has which number, as sorted numbers of both."""
        own = [item * self.size + np.unique(held) for item, held in enumerate(numbers)]
        return np.concatenate([np.zeros(0, np.int64), *own])

    def numbers(self, words: list[str], learn: bool = False) -> np.ndarray:
        if learn:
            for word in words:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))

    def numbers_in(self, text: str) -> np.ndarray:
        """The numbers of the words of a text."""
        words = quick_words(text)
        if words and isinstance(words[0], bytes):
            return np.fromiter(map(self.quick.get, words, repeat(0)), np.int64, len(words))
        return self.numbers(words)

    @cached_property
    def quick(self) -> dict[bytes, int]:
        """The vocabulary by bytes, for words whose characters are all below 256."""
        return {word.encode("latin-1"): number for word, number in self.vocabulary.items() if is_latin(word)}

    def pairs_in(self, words: np.ndarray) -> np.ndarray:
        """Numbers of the pairs that begin at each word; 0 where no item has the pair."""
        found = np.zeros(len(words), np.int64)
        at, code = hits_of(gram_codes(words, 2), self.codes)
        found[at] = code + len(self.vocabulary) + 1
        return found

    def choose(self, counts: np.ndarray) -> None:
        """Seeds each item by those rare words and pairs that every leak has one of, and that are fewest in the corpus."""
        chosen: set[int] = set()
        for own, pairs in zip(self.words, self.pairs):
            size = len(own)
            words, pairs = (x[np.lexsort((x, counts[x]))] for x in (own, pairs))
            sums = [np.concatenate([[0], np.cumsum(counts[x])]) for x in (words, pairs)]
            best = None
            for least in range(1, size + 1):
                n_words = max(0, size - fewest_matches(size, self.threshold, least) + 1)
                total = sums[0][n_words] + sums[1][size - least]
                if best is None or total < best[0]:
                    best = (total, n_words, size - least)
            if best:
                chosen.update(words[: best[1]].tolist(), pairs[: best[2]].tolist())
        self.seeds = np.zeros(self.size, bool)
        self.seeds[sorted(chosen)] = True
        # where the items have the seeds: a stretch of these arrays for each number
        both = [own for item in zip(self.words, self.pairs) for own in item]
        numbers = np.concatenate([np.zeros(0, np.int64), *both])
        item = np.repeat(np.arange(len(both)) // 2, [len(own) for own in both])
        place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(own)) for own in both)])
        seeded = np.flatnonzero(self.seeds[numbers])
        seeded = seeded[np.argsort(numbers[seeded], kind="stable")]
        self.place_item, self.place_inside = item[seeded], place[seeded]
        self.place_first = np.searchsorted(numbers[seeded], np.arange(self.size + 1))


def fewest_matches(size: int, threshold: float, pairs: int) -> int:
    """How many words an alignment of that score matches at least, if it matches fewer than ``pairs`` word pairs."""
    cost = min(MISMATCH, GAP)
    return max(1, int(np.ceil(max(threshold * size, (threshold * size - cost * pairs) / (1 - cost)) - 1e-9)))


def hits_of(codes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``codes`` that are in the sorted ``table``, and where there."""
    full = np.flatnonzero(codes)
    if not len(full) or not len(table):
        return full[:0], full[:0]
    at = np.minimum(np.searchsorted(table, codes[full]), len(table) - 1)
    same = table[at] == codes[full]
    return full[same], at[same]


def last_row(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment score, and after how many words of item and passage it ends.

    The step along the passage is a running maximum, as a gap costs the same for each word.
    """
    slope = GAP * np.arange(len(passage) + 1)
    row, best = np.zeros(len(passage) + 1), (0.0, 0, 0)
    for i, word in enumerate(item, 1):
        fresh = np.maximum(0, row - GAP)
        fresh[1:] = np.maximum(fresh[1:], row[:-1] + np.where(passage == word, 1.0, -MISMATCH))
        row = np.maximum.accumulate(fresh + slope) - slope
        top = int(row.argmax())
        if row[top] > best[0] + 1e-9:
            best = (float(row[top]), i, top)
    return best


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Smith-Waterman score of the best local alignment, and its start and stop in the passage."""
    score, used, stop = last_row(item, passage)
    if not score:
        return 0.0, 0, 0
    _, _, back = last_row(item[:used][::-1], passage[:stop][::-1])
    return score, stop - back, stop


def windows_of(lows: np.ndarray, highs: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of a document, in order, joined where they overlap."""
    found: list[list[int]] = []
    for low, high in zip(lows.tolist(), highs.tolist()):
        if found and low <= found[-1][1]:
            found[-1][1] = max(found[-1][1], high)
        else:
            found.append([low, high])
    return [(low, high) for low, high in found]


def pieces(sizes: np.ndarray, most: int) -> list[slice]:
    """Slices of rows whose sizes sum to about ``most``; a larger row is in a slice of about its own size."""
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1
    return [slice(low, high) for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)]) if low < high]


def in_steps(texts: list[np.ndarray]) -> list[list[np.ndarray]]:
    """The texts, as many at a time as one step holds."""
    return [texts[some] for some in pieces(np.array([len(words) for words in texts], np.int64), AT_ONCE // 4)]


def joined(texts: list[np.ndarray]) -> np.ndarray:
    """The words of all texts with a 0 after each text, so that no pair has words of two."""
    return np.concatenate([np.zeros(0, np.int64), *(part for words in texts for part in (words, np.zeros(1, np.int64)))])


def spread(firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at ``firsts``, one range after the other."""
    return np.repeat(firsts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def counts_inside(numbers: np.ndarray, keys: np.ndarray, base: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """How many numbers of each range, offset by its item's ``base``, are among the sorted ``keys``."""
    full = np.flatnonzero(numbers)
    numbers, lows, highs = numbers[full], np.searchsorted(full, lows), np.searchsorted(full, highs)
    sizes, out = highs - lows, np.zeros(len(lows), np.int64)
    for some in pieces(sizes, AT_ONCE):
        own = np.repeat(base[some], sizes[some]) + numbers[spread(lows[some], sizes[some])]
        same = keys[np.minimum(np.searchsorted(keys, own), len(keys) - 1)] == own if len(keys) else np.zeros(len(own), bool)
        sums = np.concatenate([[0], np.cumsum(same)])
        ends = np.cumsum(sizes[some])
        out[some] = sums[ends] - sums[ends - sizes[some]]
    return out


def able_stretches(words: np.ndarray, firsts: np.ndarray, items: Items, threshold: float) -> Iterator[np.ndarray]:
    """Rows (document, item, low, high) of the stretches around seeds that the bounds leave.

    The documents' words stand one after the other, each document from its place in ``firsts`` on and with a 0 at its end.
    """
    pairs, cost = items.pairs_in(words), min(MISMATCH, GAP)
    known = np.concatenate([[0], np.cumsum(words > 0)])
    hits = [(np.flatnonzero(items.seeds[numbers]), numbers) for numbers in (words, pairs)]
    at = np.concatenate([own for own, _ in hits])
    number = np.concatenate([numbers[own] for own, numbers in hits])
    sizes = items.place_first[number + 1] - items.place_first[number]
    for some in pieces(sizes, AT_ONCE):
        places = spread(items.place_first[number[some]], sizes[some])
        begin, item = np.repeat(at[some], sizes[some]), items.place_item[places]
        doc = np.searchsorted(firsts, begin, side="right") - 1
        start, size = begin - items.place_inside[places], items.sizes[item]
        # words between those of the item cost a gap each, so no alignment strays further
        reach = (size * (1 - threshold) / GAP + 1e-9).astype(np.int64)
        low, high = np.maximum(start - reach, firsts[doc]), np.minimum(start + size + reach, firsts[doc + 1] - 1)
        enough = np.flatnonzero(known[high] - known[low] >= threshold * size - 1e-9)
        rows = np.unique(np.stack([doc, item, low, high], axis=1)[enough], axis=0)
        for numbers, keys, shorter in ((words, items.word_keys, 0), (pairs, items.pair_keys, 1)):
            _, item, low, high = rows.T
            inside = np.minimum(counts_inside(numbers, keys, item * items.size, low, high), items.sizes[item] - shorter)
            if not shorter:
                able = inside >= threshold * items.sizes[item] - 1e-9
                matched = inside[able]
            else:
                able = (1 - cost) * matched + cost * (inside + 1) >= threshold * items.sizes[item] - 1e-9
            rows = rows[able]
        yield rows


def leaks_in(docs: list[np.ndarray], items: Items, threshold: float) -> Iterator[tuple[int, int, float, int, int]]:
    """Place of the document, item, score and span (words) of the best passage for each item that leaks into one of the documents."""
    firsts = np.concatenate([[0], np.cumsum([len(words) + 1 for words in docs])])
    words = joined(docs)
    rows = np.concatenate([np.zeros((0, 4), np.int64), *able_stretches(words, firsts, items, threshold)])
    rows = rows[np.lexsort(rows.T[::-1])]
    changes = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
    for group in np.split(rows, changes) if len(rows) else []:
        doc, item = group[0, :2].tolist()
        size, best = int(items.sizes[item]), (0.0, 0, 0)
        for low, high in windows_of(group[:, 2], group[:, 3]):
            score, start, stop = align(items.words[item], words[low:high])
            best = max(best, (score / size, -(low + start), low + stop))
        if best[0] >= threshold:
            first = int(firsts[doc])
            yield doc, item, best[0], -best[1] - first, best[2] - first


def item_blocks(benchmark: DataFrame, item_id: str, text: str, threshold: float, block_grams: int) -> Iterator[Items]:
    """Items in blocks; rows come to the driver one partition at a time and stay there for a block only."""
    rows, grams = [], 0
    chosen = benchmark.select(F.col(item_id).cast("long").alias("item_id"), text_of(text).alias("text"))
    for row in chosen.toLocalIterator():
        size = len(words_of(row["text"]))
        if not size:
            continue
        if rows and grams + size > block_grams:
            yield Items(rows, threshold)
            rows, grams = [], 0
        rows.append((row["item_id"], row["text"]))
        grams += size
    if rows:
        yield Items(rows, threshold)


def numbered_docs(docs: DataFrame, items: Items) -> tuple[DataFrame, np.ndarray]:
    """The documents that have words of the items, as shortened numbers, written; and how often all documents have each word and pair.

    A task sends one row of counts, of what it has seen.
    """
    held = docs.sparkSession.sparkContext.broadcast(vars(items))
    names = ["doc_id", "kind", "numbers", "counts"]

    def number(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Items.of(held.value)
        seen = np.zeros(own.size, np.int64)
        for frame in frames:
            texts = [own.numbers_in(text) for text in frame["text"]]
            for some in in_steps(texts):
                words = joined(some)
                for numbers in (words, own.pairs_in(words)):
                    seen += np.bincount(numbers, minlength=own.size)
            rows = [(key, 0, shortened(words), None) for key, words in zip(frame["doc_id"], texts) if words.any()]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})
        seen[0] = 0
        full = np.flatnonzero(seen)
        yield pd.DataFrame([(None, 1, full.astype(np.int32), seen[full])], columns=names).astype({"doc_id": "Int64"})

    both = written(docs.mapInPandas(number, "doc_id long, kind int, numbers array<int>, counts array<long>"), "numbered")
    each = both.filter("kind = 1").select(F.explode(F.arrays_zip("numbers", "counts")).alias("c"))
    found = each.groupBy(F.col("c.numbers").alias("code")).agg(F.sum("c.counts").alias("n")).toPandas()
    counts = np.zeros(items.size, np.int64)
    counts[found["code"].to_numpy(dtype=int)] = found["n"].to_numpy(dtype=np.int64)
    return both.filter("kind = 0").select("doc_id", "numbers"), counts


def block_leaks(numbered: DataFrame, items: Items, threshold: float) -> DataFrame:
    held = numbered.sparkSession.sparkContext.broadcast(vars(items))

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Items.of(held.value)
        for frame in frames:
            rows, before = [], 0
            for texts in in_steps([lengthened(numbers) for numbers in frame["numbers"]]):
                for doc, item, score, start, stop in leaks_in(texts, own, threshold):
                    rows.append((frame["doc_id"].iat[before + doc], own.ids[item], score, start, stop))
                before += len(texts)
            names = [column.split()[0] for column in LEAKS.split(", ")]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64", "item_id": "Int64"})

    return numbered.mapInPandas(find, LEAKS)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = 0.5,
    block_grams: int = 1_000_000,
) -> DataFrame:
    """Documents with the items that leak into them: best score (1 is an exact copy) and its span in words."""
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    found = spark.createDataFrame([], LEAKS)
    for items in item_blocks(benchmark, item_id, item_text, threshold, block_grams):
        numbered, counts = numbered_docs(rows, items)
        items.choose(counts)
        found = found.union(block_leaks(numbered, items, threshold))
    best = F.max(F.struct("score", (-F.col("start")).alias("back"), "stop")).alias("best")
    return (
        found.groupBy("doc_id", "item_id")
        .agg(best)
        .select("doc_id", "item_id", "best.score", (-F.col("best.back")).alias("start"), "best.stop")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id has no leak; a null id with a leak takes all rows with a null id along."""
    leaks = find_leaks(docs, benchmark, doc_id=doc_id, **options).select(F.col("doc_id").alias("_leaking")).distinct()
    return docs.join(leaks, docs[doc_id].cast("long").eqNullSafe(leaks["_leaking"]), "left_anti")
