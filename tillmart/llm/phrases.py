"""Phrase collocations: frequent n-grams by mergeable Misra-Gries summaries, counted exactly, scored and cut to maximal ones.

Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line breaks, and pieces
into words at blanks and tabs. All counts are per language.

Words are counted as the texts are encoded. Longer n-grams are found in two passes over the encoded texts, first pairs,
then phrases of three words and more. In the first pass, n-grams are
dealt by hash to partitions. A summary of a partition has at most as many counters as its
mass (all its n-gram occurrences) divided by ``least``, and one more. Each task makes
summaries of its texts, they are shuffled by partition and merged; too many counters are cut by
taking the first one that is too many from all. What a count loses by that, in all tasks and merges together, is less than
``least``, so every n-gram that occurs ``least`` times survives; as summaries carry what they have lost, those that cannot
have occurred that often even with it go. The survivors are marked in a bitmap of
fixed size, and the second pass counts, exactly and by its words, each n-gram that is marked;
one that is marked by chance is counted like others and dropped with those below ``least``.

A pair is counted only where both its words are frequent, a phrase only where all its pairs are, as it is no more
frequent than they are. For that the frequent words, then pairs, are marked in a bitmap, too.

A phrase's score is its lowest over all cuts into two: 1000 * count * words / (count of the first part *
count of the rest), rounded down. All parts of a frequent phrase are frequent and so counted exactly.

Defined results: null texts are empty; texts without words have no phrases; a null language is
``und``; rows that repeat an id count each; a very long text is one encoded row and is never cut; ties go to the
more frequent phrase, then the first in byte order; other columns are not read; an empty table gives no rows.
Words are told apart by 64-bit hashes.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillmart.llm.common import Remembered, kept, small_batches, text_of
from tillmart.session import written

#: Bits of the bitmap that marks what survives: 8 MB, however large the corpus is.
MARK_BITS = 26
#: Counters that a task holds before it sends its summaries on and begins anew; words it takes before it sums them up.
HELD, BUFFER = 1_000_000, 500_000
#: Words that a task counts before it sends the counts on.
COUNTED = 100_000
#: Words of a task that makes summaries, where there are more tasks than two for each core: the more a task has read, the fewer rows it sends.
TASK_WORDS = 20_000_000
LONGEST = 5
LETTERS = bytes(range(65, 91))
BREAKS = b".,;:!?\n\x0b\x0c\r"
#: A-Z in lower case, and every sign that ends a piece as a line break.
FOLDED = bytes.maketrans(LETTERS + BREAKS, LETTERS.lower() + b"\n" * len(BREAKS))


class Codes(Remembered):
    """64-bit hashes of words; the end of a piece is 0."""

    most_bytes = 24_000_000

    def find(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        return 0 if word == b"\n" else xxh3_64_intdigest(word) or 1


def words_of(text: str) -> list[bytes]:
    """Words in order, with a line break after each piece that has any."""
    found: list[bytes] = []
    for piece in text.encode("utf-8", "surrogatepass").translate(FOLDED).split(b"\n"):
        if words := piece.split():
            found += words
            found.append(b"\n")
    return found


def mix(values: np.ndarray) -> np.ndarray:
    out = values * np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def encode(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, n, codes): the texts as word codes, pieces ended by 0; and (lang, code, word, n): how often some texts have each word."""

    def rows_of(counts: dict[str, Counter], codes: Codes) -> Iterator[pd.DataFrame]:
        for lang, own in counts.items():
            words = list(own)
            for at in range(0, len(words), COUNTED // 5):
                part = words[at : at + COUNTED // 5]
                told = np.fromiter(map(codes.__getitem__, part), np.uint64, len(part)).view(np.int64)
                spelled = [word.decode("utf-8", "surrogatepass") for word in part]
                yield pd.DataFrame([(1, lang, 0, told, spelled, [own[word] for word in part])], columns=names)
        counts.clear()

    names = ["kind", "lang", "n", "codes", "words", "counts"]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, counts = kept("word codes", Codes), {}
        for frame in frames:
            rows = []
            for lang, text in zip(frame["lang"], frame["text"]):
                words = words_of(text)
                own = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
                seen = counts.setdefault(lang, Counter())
                seen.update(words)
                breaks = seen.pop(b"\n", 0)
                rows.append((0, lang, len(words) - breaks, own.view(np.int64), None, None))
            yield pd.DataFrame(rows, columns=names)
            if sum(map(len, counts.values())) > COUNTED:
                yield from rows_of(counts, codes)
        yield from rows_of(counts, codes)

    small_batches(docs.sparkSession)
    schema = "kind int, lang string, n long, codes array<long>, words array<string>, counts array<long>"
    both = written(docs.mapInPandas(work, schema), "encoded")
    texts = both.filter("kind = 0 and n > 0").select("lang", "n", "codes")
    spelled = both.filter("kind = 1").select("lang", F.explode(F.arrays_zip("codes", "words", "counts")).alias("w"))
    return texts, spelled.select("lang", F.col("w.codes").alias("code"), F.col("w.words").alias("word"), F.col("w.counts").alias("n"))


class Tokens:
    """The words of a batch of texts in one row, each with its language, and keys of the n-grams that begin at them."""

    def __init__(self, langs: np.ndarray, lengths: np.ndarray, codes: np.ndarray):
        self.codes = codes.view(np.uint64)
        self.langs = np.repeat(langs, lengths)

    def grams(self, size: int, marks: np.ndarray, marked: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and keys of the n-grams within pieces all of whose ``marked``-grams have a mark."""
        n = len(self.codes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        inside = self.codes[:n] > 0
        for i in range(1, size):
            inside &= self.codes[i : i + n] > 0
        places = np.flatnonzero(inside)
        for i in range(size - marked + 1):
            places = places[is_marked(marks, self.keys(places + i, marked))]
        return places, self.keys(places, size)

    def keys(self, places: np.ndarray, size: int) -> np.ndarray:
        out = self.langs[places] + np.uint64(size)
        for i in range(size):
            out = mix(out ^ self.codes[places + i])
        return out


def is_marked(marks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = (keys >> np.uint64(64 - MARK_BITS)).astype(np.int64)
    return (marks[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 > 0


def token_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Tokens, dict[int, str]]]:
    """Batches joined to about ``BUFFER`` words, with the names of their languages by hash."""
    from xxhash import xxh3_64_intdigest

    names: dict[int, str] = {}
    held, size = [], 0

    def joined() -> Tokens:
        return Tokens(*[np.concatenate([part[i] for part in held]) for i in range(3)])

    for batch in batches:
        column = batch.column("codes")
        lang = batch.column("lang").dictionary_encode()
        hashes = np.array([xxh3_64_intdigest(name) for name in lang.dictionary.to_pylist()], np.uint64)
        names.update(zip(hashes.tolist(), lang.dictionary.to_pylist()))
        lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        held.append((hashes[lang.indices.to_numpy(zero_copy_only=False)], lengths, column.flatten().to_numpy(zero_copy_only=False)))
        size += int(lengths.sum())
        if size >= BUFFER:
            yield joined(), names
            held, size = [], 0
    if size:
        yield joined(), names


class Summary:
    """A Misra-Gries summary for each hash partition: sorted keys with counts, so a partition is a stretch of them.

    ``capacity`` has the most counters of each partition, ``begins`` its least key, and ``lost`` how much less than
    the truth a count of it is at most.
    """

    def __init__(self, capacity: np.ndarray):
        self.capacity = capacity
        shift = np.uint64(64 - (len(capacity) - 1).bit_length())
        self.begins = np.arange(len(capacity), dtype=np.uint64) << shift if len(capacity) > 1 else np.zeros(1, np.uint64)
        self.clear()

    def clear(self) -> None:
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.lost = np.zeros(len(self.capacity), np.int64)

    @property
    def ends(self) -> np.ndarray:
        """Where the keys of each partition begin, and the end of the last one's."""
        return np.append(np.searchsorted(self.keys, self.begins), len(self.keys))

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Counts of the same key are added; a partition with too many counters loses the first one that is too many from all."""
        self.keys, inverse = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        totals = np.zeros(len(self.keys), np.int64)
        np.add.at(totals, inverse, np.concatenate([self.counts, counts]))
        self.counts = totals
        ends = self.ends
        over = np.flatnonzero(np.diff(ends) > self.capacity)
        for part in over.tolist():
            own = self.counts[ends[part] : ends[part + 1]]
            place = len(own) - 1 - int(self.capacity[part])
            cut = np.partition(own, place)[place]
            own -= cut
            self.lost[part] += cut
        if len(over):
            left = self.counts > 0
            self.keys, self.counts = self.keys[left], self.counts[left]

    def able(self, least: int) -> np.ndarray:
        """The keys that may have occurred ``least`` times."""
        return self.keys[self.counts + np.repeat(self.lost, np.diff(self.ends)) >= least]


def partitions_of(mass: int, least: int) -> int:
    """Hash partitions, a power of two, so that a summary has about 30,000 counters; 256 at least, as tasks share them out."""
    return 1 << min(20, max(8, (mass // least // 30_000).bit_length()))


def to_rows(schema: str):
    """Arrow columns of a ``mapInArrow`` by the names of its schema."""
    names = [column.split()[0] for column in schema.split(", ")]
    return lambda *columns: pa.RecordBatch.from_arrays([column if isinstance(column, pa.Array) else pa.array(column) for column in columns], names)


def grams_of(batches: Iterator[pa.RecordBatch], sizes: list[int], given, marked: int) -> Iterator[tuple]:
    """(tokens, names of the languages, size, places, keys) of the n-grams in batches of texts."""
    for tokens, names in token_batches(batches):
        for size in sizes:
            yield tokens, names, size, *tokens.grams(size, given.value, marked)


def marks_of(keys: DataFrame, n_parts: int) -> np.ndarray:
    """A bitmap of the ``keys`` (part, key); each of its slices is made in one task."""
    slice_bits = (1 << MARK_BITS) // n_parts
    as_marks = to_rows("part int, bits binary")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[int, np.ndarray] = {}
        for batch in batches:
            places = (batch.column("key").to_numpy().view(np.uint64) >> np.uint64(64 - MARK_BITS)).astype(np.int64)
            parts = places // slice_bits
            for part in np.unique(parts).tolist():
                slices.setdefault(part, np.zeros(slice_bits, np.uint8))[places[parts == part] - part * slice_bits] = 1
        for part, bits in slices.items():
            yield as_marks(np.array([part], np.int32), pa.array([np.packbits(bits).tobytes()], pa.binary()))

    bitmap = np.zeros((1 << MARK_BITS) // 8, np.uint8)
    # a slice a partition, so as many bytes as the bitmap has
    for row in keys.repartition("part").mapInArrow(mark, "part int, bits binary").collect():
        begin = row["part"] * slice_bits // 8
        bitmap[begin : begin + slice_bits // 8] = np.frombuffer(row["bits"], np.uint8)
    return bitmap


def marks_of_frequent(found: DataFrame, size: int, n_parts: int = 256) -> np.ndarray:
    """The bitmap of n-grams (lang, words) of ``size``."""
    from xxhash import xxh3_64_intdigest

    as_keys, shift = to_rows("part int, key long"), np.uint64(64 - (n_parts - 1).bit_length())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [xxh3_64_intdigest(name) for name in batch.column("lang").to_pylist()]
            words = batch.column("words").flatten().to_numpy(zero_copy_only=False)
            tokens = Tokens(np.array(hashes, np.uint64), np.full(len(hashes), size), words)
            keys = tokens.keys(np.arange(len(hashes)) * size, size)
            yield as_keys((keys >> shift).astype(np.int32), keys.view(np.int64))

    return marks_of(found.select("lang", "words").mapInArrow(work, "part int, key long"), n_parts)


def frequent(texts: DataFrame, sizes: list[int], least: int, mass: int, marks: np.ndarray, marked: int) -> DataFrame:
    """(lang, words, n) of the n-grams of ``sizes`` that occur ``least`` times, written.

    ``mass`` is not less than all words. ``marks`` has the ``marked``-grams that are frequent.
    """
    spark: SparkSession = texts.sparkSession
    n_parts = partitions_of(mass * len(sizes), least)
    shift = np.uint64(64 - (n_parts - 1).bit_length())
    given = spark.sparkContext.broadcast(marks)
    as_mass, as_counts, as_keys = to_rows("part int, n long"), to_rows("part int, key long, n long"), to_rows("part int, key long")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(n_parts, np.int64)
        for *_, keys in grams_of(batches, sizes, given, marked):
            seen += np.bincount((keys >> shift).astype(np.int64), minlength=n_parts)
        full = np.flatnonzero(seen)
        yield as_mass(full.astype(np.int32), seen[full])

    weighed = texts.mapInArrow(weigh, "part int, n long").groupBy("part").agg(F.sum("n").alias("n")).toPandas()
    capacity = np.ones(n_parts, np.int64)
    capacity[weighed["part"].to_numpy(int)] = weighed["n"].to_numpy(np.int64) // least + 1
    room = spark.sparkContext.broadcast(capacity)

    def rows_of(summary: Summary) -> Iterator[pa.RecordBatch]:
        """The counters, and for each partition that has lost something a row with that below zero."""
        losing = np.flatnonzero(summary.lost)
        yield as_counts(losing.astype(np.int32), np.zeros(len(losing), np.int64), -summary.lost[losing])
        for at in range(0, len(summary.keys), 100_000):
            keys, counts = summary.keys[at : at + 100_000], summary.counts[at : at + 100_000]
            yield as_counts((keys >> shift).astype(np.int32), keys.view(np.int64), counts)

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(room.value)
        for *_, keys in grams_of(batches, sizes, given, marked):
            summary.merge(*np.unique(keys, return_counts=True))
            if len(summary.keys) > HELD:
                yield from rows_of(summary)
                summary.clear()
        yield from rows_of(summary)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Merges the summaries of the task's partitions as they come; the keys that may be frequent are left."""
        summary, held, size = Summary(room.value), [], 0

        def settle() -> None:
            if held:
                summary.merge(*(np.concatenate([part[i] for part in held]) for i in range(2)))
                held.clear()

        for batch in batches:
            parts, keys, counts = (batch.column(name).to_numpy() for name in ("part", "key", "n"))
            lost = counts < 0
            np.add.at(summary.lost, parts[lost], -counts[lost])
            held.append((keys[~lost].view(np.uint64), counts[~lost]))
            size += batch.num_rows
            if size > BUFFER:
                settle()
                size = 0
        settle()
        keys = summary.able(least)
        yield as_keys((keys >> shift).astype(np.int32), keys.view(np.int64))

    counted = texts.mapInArrow(summarize, "part int, key long, n long")
    survived = counted.repartition("part").mapInArrow(merge, "part int, key long")
    found = spark.sparkContext.broadcast(marks_of(survived, n_parts))
    as_exact = to_rows("lang string, words array<long>, n long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Exact counts of the marked n-grams, by their words; sent on whenever there are many."""
        keys, counts, words, names = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((0, LONGEST + 1), np.uint64), {}

        def exact() -> pa.RecordBatch:
            own = words[:, 1:]
            held = own > 0
            ends = np.concatenate([[0], np.cumsum(held.sum(axis=1))])
            listed = pa.ListArray.from_arrays(ends.astype(np.int32), own[held].view(np.int64))
            return as_exact(pa.array([names[code] for code in words[:, 0].tolist()], pa.string()), listed, counts)

        for tokens, names, size, places, own in grams_of(batches, sizes, given, marked):
            often = is_marked(found.value, own)
            own, first, n = np.unique(own[often], return_index=True, return_counts=True)
            places = places[often][first]
            spelled = np.zeros((len(own), LONGEST + 1), np.uint64)
            spelled[:, 0] = tokens.langs[places]
            for i in range(size):
                spelled[:, i + 1] = tokens.codes[places + i]
            keys, first, inverse = np.unique(np.concatenate([keys, own]), return_index=True, return_inverse=True)
            totals = np.zeros(len(keys), np.int64)
            np.add.at(totals, inverse, np.concatenate([counts, n]))
            counts, words = totals, np.concatenate([words, spelled])[first]
            if len(keys) > HELD // 4:
                yield exact()
                keys, counts, words = keys[:0], counts[:0], words[:0]
        if len(keys):
            yield exact()

    exact_counts = texts.mapInArrow(count, "lang string, words array<long>, n long").groupBy("lang", "words")
    return written(exact_counts.agg(F.sum("n").alias("n")).filter(F.col("n") >= least), "frequent")


def frequent_words(spelled: DataFrame, least: int) -> DataFrame:
    """(lang, words, n, word) of the words that occur ``least`` times, written; they are counted by a number, and only those that stay are spelled."""
    keyed = spelled.withColumn("key", F.xxhash64("lang", "code"))
    counts = written(keyed.groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= least), "word_counts")
    told = keyed.drop("n").join(counts, "key").groupBy("lang", "code").agg(F.first("n").alias("n"), F.min("word").alias("word"))
    return written(told.select("lang", F.array("code").alias("words"), "n", "word"), "words")


def scored(phrases: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Each phrase with ``l``, ``r``, ``score`` of its lowest-scoring cut, and ``words_n``, the words of its language."""
    part = counts.select(F.col("lang").alias("part_lang"), F.col("words").alias("part"), F.col("n").alias("part_n"))

    def counted(cuts: DataFrame, words: str, name: str) -> DataFrame:
        same = (F.col("lang") == F.col("part_lang")) & (F.col(words) == F.col("part"))
        return cuts.join(part, same).withColumn(name, F.col("part_n")).drop("part_lang", "part", "part_n")

    cuts = phrases.select("lang", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"head": F.expr("slice(words, 1, k)"), "rest": F.expr("slice(words, k + 1, size(words) - k)")})
    cuts = counted(counted(cuts, "head", "l"), "rest", "r").join(totals, "lang")
    # 1000 * a * words and l * r pass 64 bits; decimals of 38 digits hold them, and the quotient is at most 10 * words
    score = F.expr("(CAST(1000 * a AS DECIMAL(19, 0)) * CAST(words_n AS DECIMAL(19, 0))) DIV (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r", "words_n")).alias("cut")
    return cuts.groupBy("lang", "words", "a").agg(lowest).select("lang", "words", "a", "cut.l", "cut.r", "cut.words_n", "cut.score")


def maximal(phrases: DataFrame) -> DataFrame:
    """Phrases without those that never occur outside a longer one.

    If a phrase is as frequent as a longer one that holds it, it is as frequent as one by a single word longer, too.
    """
    inner = F.explode(F.array(F.expr("slice(words, 1, size(words) - 1)"), F.expr("slice(words, 2, size(words) - 1)")))
    longer = phrases.filter(F.size("words") > 2).select("lang", inner.alias("words"), F.col("n").alias("outer"))
    most = longer.groupBy("lang", "words").agg(F.max("outer").alias("outer"))
    return phrases.join(most, ["lang", "words"], "left").filter(F.col("outer").isNull() | (F.col("outer") < F.col("n"))).drop("outer")


def spell(phrases: DataFrame, spelled: DataFrame) -> DataFrame:
    """``phrase`` in place of the word codes; ``spelled`` (lang, words, word) has the frequent words."""
    numbered = written(phrases.withColumn("row", F.monotonically_increasing_id()), "phrases")
    each = numbered.select("row", "lang", F.posexplode("words").alias("place", "code"))
    known = spelled.select("lang", F.col("words")[0].alias("code"), "word")
    told = each.join(known, ["lang", "code"]).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("told"))
    return numbered.join(told, "row").withColumn("phrase", F.array_join(F.col("told.word"), " ")).drop("row", "told", "words")


def first_of_each_language(rows: DataFrame, order: list[Column], top: int, name: str) -> DataFrame:
    """The first ``top`` rows of each language, numbered; pieces of a language are cut to as many first."""
    piece = Window.partitionBy("lang", "piece").orderBy(*order)
    cut = rows.withColumn("piece", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    cut = cut.withColumn("place", F.row_number().over(piece)).filter(F.col("place") <= top).drop("place", "piece")
    numbered = cut.withColumn(name, F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return numbered.filter(F.col(name) <= top)


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = 100, longest: int = LONGEST, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to ``longest`` words of each language."""
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"longest must be from 2 to {LONGEST}")
    rows = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), text_of(f"`{text}`").alias("text"))
    texts, spelled = encode(rows)
    totals = written(texts.groupBy("lang").agg(F.sum("n").alias("words_n")), "totals")
    mass = totals.agg(F.sum("words_n")).first()[0] or 0
    texts = texts.coalesce(max(2 * docs.sparkSession.sparkContext.defaultParallelism, mass // TASK_WORDS))
    words = frequent_words(spelled, least)
    pairs = frequent(texts, [2], least, mass, marks_of_frequent(words, 1), 1)
    phrases = pairs
    if longest > 2:
        phrases = pairs.unionByName(frequent(texts, list(range(3, longest + 1)), least, mass, marks_of_frequent(pairs, 2), 2))
    counts = words.drop("word").unionByName(phrases)
    best = spell(scored(maximal(phrases), counts, totals), words)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = first_of_each_language(best, order, top, "rank")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", F.col("words_n").alias("n"), "score")
