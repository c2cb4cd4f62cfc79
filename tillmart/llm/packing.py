"""Packing of token pieces into as few fixed-size sequences as possible.

The lengths of all pieces make a histogram of at most ``capacity`` entries. A
configuration is a multiset of lengths that fits one sequence. The linear program is
"cover the histogram with the fewest configurations". It is solved by multiplicative weights: a length's
weight is its share of a sequence times ``exp(PULL * share of its pieces that are left)``, and a knapsack by dynamic
programming prices configurations within the counts that are left. Each of the best, for several
first pieces, is dealt a ``STEP`` of what its scarcest length has, rounded down to whole copies, so weights of lengths that
lag behind rise and all lengths run out together. For that, lengths are joined to ``GROUPS`` groups of about as many pieces,
counted at their longest. What is left in the end goes where best fit puts it, into the room that configurations
leave or new sequences. The weights on the way are also solutions of the dual, and the best of them is a
bound: no packing has fewer sequences. If plain best fit needs fewer sequences, its plan is taken. The shortest pieces, with few of the
tokens, are no part of the program; they go last, into the room that is left.

Only the histogram is on the driver: pieces find their place by their number within their length.

Defined results: a null text is empty and gives the end mark alone; rows that repeat
an id are packed one by one; a null id is kept; other columns are not read; an empty
table gives no rows.
"""

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillmart.llm.common import Remembered, byte_signs, is_latin, kept, small_batches, text_of
from tillmart.session import written

CAPACITY = 4096
END_ID = 1
#: Of the linear program: groups of lengths, how strongly lengths that lag behind pull, the share of a length that is dealt at a
#: time, first pieces that are tried for each pricing, how near to the best their worth must be, and the share that best fit gets.
GROUPS, PULL, STEP, MANY, NEAR, REST = 240, 8.0, 0.15, 16, 0.03, 0.01
TURNS = 1500
#: Short pieces go last, into the room that is left: those up to this share of a sequence, with this share of all tokens at most.
SHORT, SHORT_TOKENS = 1 / 8, 0.08
#: Rows of ``slots`` that are sent to all tasks; more are joined by their length.
SENT = 200_000
PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, place long"


class WordIds(Remembered):
    """Token ids, as little-endian unsigned 32-bit numbers, of words without blanks and line breaks.

    The tokenizer drops white space and works on each word by itself, so a text's
    ids are those of its words in order. It ignores case and keeps letters apart from
    other signs, so a word with a full stop or comma at its end is looked up as word and
    sign, and a word in letters goes straight to the merges.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.signs = byte_signs()

    def find(self, word: str) -> bytes:
        if word[-1:] in (".", ",") and word[:-1].isalpha():
            return self[word[:-1]] + self[word[-1]]
        if word.isalpha() and is_latin(word):
            signs = "".join(map(self.signs.__getitem__, word.lower()))
            ids = [token.id for token in self.tokenizer.model.tokenize(signs)]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def of(self, text: str) -> bytes:
        # these are tokens as they are, but not in capitals
        if any(token in text.lower() for token in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        words = text.lower() if is_latin(text) else text
        return b"".join(map(self.__getitem__, words.replace("\n", " ").split(" ")))


def pieces_of(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all texts, written: each has its task and its place among that task's pieces of its length."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, part = kept(f"ids of {tokenizer}", lambda: WordIds(tokenizer)), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([END_ID], "<u4").tobytes()
        for frame in frames:
            rows = []
            for key, whole in zip(frame["doc_id"], frame["text"]):
                ids = words.of(whole) + end
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    length = len(own) // 4
                    rows.append((key, number, at // 4, length, zlib.crc32(own), part, seen[length]))
                    seen[length] += 1
            names = [column.split()[0] for column in PIECES.split(", ")]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return written(rows.mapInPandas(cut, PIECES), "pieces")


def best_pattern(worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Knapsack by dynamic programming: the multiset of lengths of most worth that fits ``capacity``, and its worth.

    ``worth[l]`` is that of a piece of length ``l``; lengths without pieces have none.
    """
    best, chosen = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        # worth of a piece of length 1, 2, ..., and the best of what it leaves
        total = worth[1 : room + 1] + best[:room][::-1]
        top = total.argmax()
        best[room] = total[top]
        chosen[room] = top + 1 if worth[top + 1] > 0 else 0
    pattern, room = [], capacity
    while room > 0:
        if chosen[room]:
            pattern.append(chosen[room])
            room -= chosen[room]
        else:
            room -= 1
    return best[capacity], np.array(pattern, np.int64)


def least_sequences(counts: np.ndarray, capacity: int) -> float:
    """A lower bound of the linear program, by a solution of its dual that the knapsack makes feasible.

    Worth of a length is its share of a sequence; lengths under a threshold may be worth nothing, and
    those that leave no more than it are then worth a whole sequence. The best threshold counts.
    """
    sizes = np.arange(capacity + 1)
    pieces, tokens = (np.concatenate([[0], np.cumsum(x)]) for x in (counts, counts * sizes / capacity))
    low = np.arange(capacity // 2 + 1)
    bounds = tokens[capacity - low + 1] - tokens[low] + pieces[-1] - pieces[capacity - low + 1]
    least = int(bounds.argmax())
    worth = np.where(sizes > capacity - least, 1.0, np.where(sizes < least, 0.0, sizes / capacity)) * (counts > 0)
    return float((counts * worth).sum() / max(1.0, best_pattern(worth, capacity)[0]))


def best_fit(counts: np.ndarray, capacity: int, begun: dict[tuple[int, ...], int] | None = None) -> dict[tuple[int, ...], int]:
    """Best-fit decreasing, on counts: each piece goes where it leaves the least room, into ``begun`` sequences or new ones."""
    rooms: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]
    waiting = np.zeros(capacity + 1, np.int64)

    def add(room: int, pattern: tuple[int, ...], copies: int) -> None:
        if copies:
            rooms[room].append((pattern, copies))
            waiting[room] += copies

    for pattern, copies in (begun or {}).items():
        add(capacity - sum(pattern), pattern, copies)
    for length in np.flatnonzero(counts)[::-1].tolist():
        n = int(counts[length])
        while n:
            able = np.flatnonzero(waiting[length:])
            if not len(able):
                # new sequences take as many as they hold
                times = capacity // length
                add(capacity - times * length, (length,) * times, n // times)
                if n % times:
                    add(capacity - n % times * length, (length,) * (n % times), 1)
                break
            room = length + int(able[0])
            pattern, copies = rooms[room].pop()
            waiting[room] -= copies
            # a sequence with the least room that will do has the least room after it has taken one, too
            times = min(room // length, n)
            used = min(copies, n // times)
            add(room, pattern, copies - used)
            add(room - times * length, pattern + (length,) * times, used)
            n -= used * times
    packed: dict[tuple[int, ...], int] = {}
    for held in rooms:
        for pattern, copies in held:
            own = tuple(sorted(pattern, reverse=True))
            packed[own] = packed.get(own, 0) + copies
    return packed


def grouped(counts: np.ndarray, groups: int) -> list[np.ndarray]:
    """The lengths with pieces, in runs with about as many pieces each."""
    lengths = np.flatnonzero(counts)
    if len(lengths) <= groups:
        return [lengths[i : i + 1] for i in range(len(lengths))]
    before = np.cumsum(counts[lengths]) - counts[lengths]
    of = before * groups // counts.sum()
    return np.split(lengths, np.flatnonzero(np.diff(of)) + 1)


class Knapsack:
    """The most worth that fits each room, of at most ``most`` pieces of each size, by dynamic programming over sizes."""

    def __init__(self, sizes: np.ndarray, worth: np.ndarray, most: np.ndarray, capacity: int):
        self.best, self.steps, self.n = np.zeros(capacity + 1), [], len(sizes)
        for item in np.flatnonzero(most > 0)[::-1].tolist():
            size, left, times = int(sizes[item]), min(int(most[item]), capacity // int(sizes[item])), 1
            while left:
                times = min(times, left)
                width = times * size
                other = self.best[: capacity + 1 - width] + times * worth[item]
                better = other > self.best[width:] + 1e-12
                self.best[width:] = np.where(better, other, self.best[width:])
                self.steps.append((item, times, width, better))
                left -= times
                times *= 2

    def choice(self, room: int) -> np.ndarray:
        """How many of each size the best choice for ``room`` has."""
        out = np.zeros(self.n, np.int64)
        for item, times, width, better in reversed(self.steps):
            if room >= width and better[room - width]:
                out[item] += times
                room -= width
        return out


def priced(counts: np.ndarray, capacity: int) -> tuple[dict[tuple[int, ...], int], float]:
    """Configurations with their copies, within ``counts`` but for a rest, and a lower bound of the linear program."""
    tokens = np.cumsum(counts * np.arange(capacity + 1))
    short = min(int(np.searchsorted(tokens, SHORT_TOKENS * tokens[-1], side="right")) - 1, int(SHORT * capacity))
    long = counts * (np.arange(capacity + 1) > short)
    members = grouped(long, GROUPS)
    sizes = np.array([own[-1] for own in members])
    total = np.array([counts[own].sum() for own in members])
    left, bound, dealt, turn = total.copy(), 0.0, [], 0
    while left.sum() > REST * total.sum() and turn < TURNS:
        share = left / total
        weight = sizes / capacity * np.exp(PULL * (share - share.max())) * (left > 0)
        if turn % 50 == 0:
            bound = max(bound, dual_bound(counts, members, sizes / capacity * np.exp(PULL * (share - share.max())), capacity))
        sack = Knapsack(sizes, weight, left, capacity)
        top = weight + sack.best[capacity - sizes]
        firsts = [g for g in np.argsort(-np.where(left > 0, top, -1.0), kind="stable")[:MANY].tolist() if left[g] and top[g] >= (1 - NEAR) * sack.best[capacity]]
        seen = set()
        for first in firsts:
            pattern = sack.choice(capacity - int(sizes[first]))
            pattern[first] += 1
            held = pattern > 0
            able = int((left[held] // pattern[held]).min())
            if able and pattern.tobytes() not in seen:
                seen.add(pattern.tobytes())
                copies = min(able, max(1, int(STEP * (left[held] / pattern[held]).min())))
                left -= copies * pattern
                dealt.append((pattern, copies))
        if not seen:
            break
        turn += 1
    return spelled_out(dealt, members, counts), bound


def spelled_out(dealt: list[tuple[np.ndarray, int]], members: list[np.ndarray], counts: np.ndarray) -> dict[tuple[int, ...], int]:
    """Configurations of groups as such of lengths: each takes the longest pieces that its groups still have."""
    stocks = [[[int(length), int(counts[length])] for length in own] for own in members]
    packed: dict[tuple[int, ...], int] = {}
    for pattern, copies in dealt:
        needs = [(stocks[group], int(pattern[group])) for group in np.flatnonzero(pattern).tolist()]
        while copies:
            used = min(copies, *(stock[-1][1] // need for stock, need in needs), copies)
            own: list[int] = []
            for stock, need in needs:
                # whole copies of the longest length, or one copy over several lengths
                missing = need
                while missing:
                    taken = min(missing, stock[-1][1]) if not used else need
                    own += [stock[-1][0]] * taken
                    stock[-1][1] -= taken * max(used, 1)
                    missing -= taken
                    while stock and not stock[-1][1]:
                        stock.pop()
            copies -= max(used, 1)
            key = tuple(sorted(own, reverse=True))
            packed[key] = packed.get(key, 0) + max(used, 1)
    return packed


def dual_bound(counts: np.ndarray, members: list[np.ndarray], weight: np.ndarray, capacity: int) -> float:
    """The weights as worth of lengths, scaled by what the best configuration of any counts has: a bound for any packing."""
    worth = np.zeros(capacity + 1)
    for own, value in zip(members, weight):
        worth[own] = value
    return float((counts * worth).sum() / best_pattern(worth, capacity)[0])


def plan_with_bound(counts: np.ndarray, capacity: int = CAPACITY) -> tuple[dict[tuple[int, ...], int], float]:
    """Configurations (lengths, longest first) and how many sequences take each; together they hold ``counts`` exactly.

    And a number of sequences that no packing is below. With equal numbers the linear program's plan is taken.
    """
    counts = counts.astype(np.int64)
    if not counts.any():
        return {}, 0.0
    dealt, bound = priced(counts, capacity)
    left = counts.copy()
    for pattern, copies in dealt.items():
        np.subtract.at(left, list(pattern), copies)
    plans = best_fit(left, capacity, dealt), best_fit(counts, capacity)
    return min(plans, key=lambda packed: sum(packed.values())), max(bound, least_sequences(counts, capacity))


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> dict[tuple[int, ...], int]:
    return plan_with_bound(counts, capacity)[0]


def slots(spark: SparkSession, packed: dict[tuple[int, ...], int]) -> DataFrame:
    """Which numbers of a length go to which configuration: at most one row per configuration and length.

    Its size does not grow with the corpus, as the histogram has at most ``capacity`` entries and a
    turn deals at most ``MANY`` configurations.
    """
    rows, taken, first = [], {}, 0
    for pattern, copies in packed.items():
        offset = 0
        for length in dict.fromkeys(pattern):
            times, begin = pattern.count(length), taken.get(length, 0)
            rows.append((length, begin, begin + copies * times, times, first, offset))
            taken[length] = begin + copies * times
            offset += times * length
        first += copies
    names = ["length", "begin", "stop", "times", "first", "offset"]
    frame = pd.DataFrame(rows, columns=names, dtype="int64")
    return spark.createDataFrame(frame, "length long, begin long, stop long, times long, first long, offset long")


def pack(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Each piece with its sequence and its offset there."""
    spark = docs.sparkSession
    pieces = pieces_of(docs, tokenizer, doc_id=doc_id, text=text, capacity=capacity)
    held = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first_number"))
    histogram = pieces.groupBy("length").agg(F.count("*").alias("n")).toPandas()
    counts = np.zeros(capacity + 1, np.int64)
    counts[histogram["length"].to_numpy(dtype=int)] = histogram["n"].to_numpy(dtype=np.int64)
    packed = plan(counts, capacity)
    taken = slots(spark, packed)
    if sum(len(set(pattern)) for pattern in packed) <= SENT:
        taken = F.broadcast(taken)
    numbered = pieces.join(starts, ["length", "part"]).withColumn("number", F.col("first_number") + F.col("place"))
    own = numbered.alias("p").join(
        taken.alias("s"),
        (F.col("p.length") == F.col("s.length")) & (F.col("p.number") >= F.col("s.begin")) & (F.col("p.number") < F.col("s.stop")),
    )
    at = F.col("p.number") - F.col("s.begin")
    return own.select(
        "doc_id",
        "piece",
        "start",
        F.col("p.length").cast("long").alias("length"),
        "ids_crc32",
        (F.col("s.first") + F.floor(at / F.col("s.times"))).cast("long").alias("sequence_id"),
        (F.col("s.offset") + (at % F.col("s.times")) * F.col("p.length")).cast("long").alias("offset"),
    )
