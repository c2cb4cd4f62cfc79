"""Near-duplicate groups by HyperMinHash.

A document's set is its distinct word n-grams, as 64-bit hashes. The top bits of a hash choose one of
``BUCKETS`` buckets; a bucket keeps the least of the other bits in 16 bits: the number of its
leading zeros, and the ``MANTISSA`` bits after its first one. Two sets agree in a bucket about as often as their Jaccard
similarity says, plus by chance, as a register does not have the whole hash.

* **Banding.** Registers are hashed ``COARSE`` to a band, and sets with a common band are candidates. For
  that an empty bucket borrows the register of the filled bucket that a fixed table ranks first for it, so that small sets agree
  as often as large ones.
* **Groups, not pairs.** In a group with a common band each set is held against the group's first one only. Sets that are still apart after
  that are banded again, more registers to a band, drawn from all of them; in these far smaller groups each is held against the one that
  has the largest share of n-grams that sets of other components have, too, such as the text that the others were copied from.
* **Rare n-grams.** Of the sets that share a fine band and are apart after that, only those are held against each other that share an n-gram
  which is among the rarest of both: linked sets have ``num / (num + den)`` of their sizes' sum in common, so the first common one of them, rarest first, has that many after it in
  both. N-grams of one component only come first and are no keys. Edits are rare and what all copies have is frequent, so copies that differ too much do not meet.
  This loses no link among these sets.
* **Estimate.** The similarity of a candidate pair is estimated from the buckets that either fills, less the agreements that are expected by
  chance for sets of these sizes. A pair that is estimated more than ``MARGIN`` below the threshold goes.
* **Verification.** The sets themselves decide.

Equal sets are one node throughout. Chances for a pair at a similarity of 0.8: that no band of 51 agrees, 2e-9; that it
is then missed among the 256 fine bands, about 1e-5; that the estimate is 0.2 too low, below 1e-9. A missed pair matters only if nothing else connects its
documents. For more similar pairs all are far smaller.

Defined results: null texts and texts without words have the empty set, which links with nothing; a text with fewer words than
``n`` has all of them as its only n-gram; rows that repeat an id have one row each, of their own text; a null id is never a component's name
unless all ids in it are null; a very long text has one large set; ties go to the smallest id; other columns are not read; an empty table gives no rows.
"""

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillmart.llm.common import kept, small_batches, text_of
from tillmart.llm.components import components
from tillmart.llm.jaccard import WordHashes, mix, node_of, shingles_of
from tillmart.session import scratch, written

BUCKETS, BUCKET_BITS, MANTISSA = 256, 8, 10
COARSE, FINE_BANDS, EXPECTED = 5, 256, 27
MARGIN = 0.2
#: Sizes of a class differ by less than this factor.
CLASS = 1.03
MEMBER = "doc_id long, n long, node long, registers binary"


def registers_of(shingles: np.ndarray) -> np.ndarray:
    """A register per bucket, 0 for an empty one; ``shingles`` are sorted, so a bucket's least hash is its first."""
    out = np.zeros(BUCKETS, np.uint16)
    if not len(shingles):
        return out
    bucket = (shingles >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    # 53 of the other bits, as a fraction that a double holds exactly
    least = (shingles[first] << np.uint64(BUCKET_BITS)) >> np.uint64(11)
    fraction, power = np.frexp(least.astype(np.float64))
    zeros = 53 - power
    mantissa = ((2 * fraction - 1) * (1 << MANTISSA)).astype(np.int64)
    out[bucket[first]] = 1 + (np.minimum(zeros, 53) << MANTISSA) + np.maximum(mantissa, 0)
    return out


#: For each bucket all buckets in the order in which it borrows from them.
LENDERS = np.argsort(mix(np.arange(BUCKETS * BUCKETS, dtype=np.uint64), 21).reshape(BUCKETS, BUCKETS), axis=1)
LENDER_RANK = np.argsort(LENDERS, axis=1)


def filled(registers: np.ndarray) -> np.ndarray:
    """The registers with those of empty buckets borrowed."""
    full, empty = np.flatnonzero(registers), np.flatnonzero(registers == 0)
    if not len(empty) or not len(full):
        return registers
    out = registers.copy()
    out[empty] = registers[full[LENDER_RANK[np.ix_(empty, full)].argmin(axis=1)]]
    return out


def fine_size(num: int, den: int) -> int:
    """Registers to a fine band: as many as leave two sets at the threshold ``EXPECTED`` common bands on the mean."""
    return max(COARSE, int(np.log(FINE_BANDS / EXPECTED) / np.log(den / num))) if num < den else BUCKETS


@cache
def bands_of(size: int) -> np.ndarray:
    """Which registers make a band: all in turn, each time in another order."""
    count = BUCKETS // size if size == COARSE else FINE_BANDS
    orders = [np.argsort(mix(np.arange(BUCKETS, dtype=np.uint64), 40 + turn)) for turn in range(-(-size * count // BUCKETS))]
    return np.concatenate(orders)[: size * count].reshape(count, size)


def band_keys(registers: np.ndarray, size: int) -> np.ndarray:
    """The keys of the bands of ``size`` registers; registers are a row per set, without empty ones."""
    chosen = bands_of(size)
    out = np.broadcast_to(np.arange(len(chosen), dtype=np.uint64) + np.uint64(size << 32), (len(registers), len(chosen))).copy()
    for place in range(size):
        out = mix(out ^ registers[:, chosen[:, place]].astype(np.uint64), 22)
    return out.view(np.int64)


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How probably two registers of unrelated sets of ``n`` and ``m`` n-grams are the same.

    The least hash of a bucket is about exponential, with as many hashes as the bucket has on the mean as its rate. A
    register is as wide as its value's power of two over ``2 ** MANTISSA``; over all widths that gives the rates' product over the square of
    their sum, times 1 / (2 ln 2), over ``2 ** MANTISSA``. A bucket that is filled has a rate of one at least.
    """
    a, b = np.maximum(n / BUCKETS, 1.0), np.maximum(m / BUCKETS, 1.0)
    return a * b / (a + b) ** 2 / (2 * np.log(2)) / 2**MANTISSA


def estimate(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity of each pair of rows of registers, corrected for registers that are the same by chance."""
    either = ((x > 0) | (y > 0)).sum(axis=1)
    both = ((x > 0) & (y > 0)).sum(axis=1)
    same = ((x == y) & (x > 0)).sum(axis=1)
    by_chance = chance(n, m) * (both - same)
    return np.maximum(same - by_chance, 0) / np.maximum(either, 1)


def members_of(docs: DataFrame, n: int) -> DataFrame:
    """Each document with the size, number and registers of its set."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = kept("word hashes", WordHashes)
        for frame in frames:
            rows = []
            for key, text in zip(frame["doc_id"], frame["text"]):
                own = shingles_of(text, n, hashes)
                rows.append((key, len(own), node_of(own), registers_of(own).tobytes()))
            out = pd.DataFrame(rows, columns=[column.split()[0] for column in MEMBER.split(", ")])
            yield out.astype({"doc_id": "Int64"})

    small_batches(docs.sparkSession)
    return docs.mapInPandas(work, MEMBER)


def keyed(nodes: DataFrame, size: int) -> DataFrame:
    """(key, node) of the bands of all ``nodes`` (node, registers), written."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                own = np.stack([filled(np.frombuffer(held, np.uint16)) for held in frame["registers"]])
                keys = band_keys(own, size)
                yield pd.DataFrame({"key": keys.ravel(), "node": np.repeat(frame["node"].to_numpy(), keys.shape[1])})

    return written(nodes.select("node", "registers").mapInPandas(work, "key long, node long"), "bands")


def in_groups(keys: DataFrame) -> DataFrame:
    """(key, node, hub) of the keys that several nodes have; the hub is the node with the least number, which is a hash."""
    groups = keys.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub < last")
    return keys.join(groups.select("key", "hub"), "key")


def estimated(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) that are estimated at ``least``."""
    own = nodes.select("node", "n", "registers")
    both = pairs
    for name in ("a", "b"):
        both = both.join(own.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("registers").alias(f"of_{name}")), name)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                x, y = (np.frombuffer(b"".join(frame[of]), np.uint16).reshape(-1, BUCKETS) for of in ("of_a", "of_b"))
                near = estimate(x, y, frame["n_a"].to_numpy(), frame["n_b"].to_numpy()) >= least
                yield frame.loc[near, ["a", "b"]]

    return both.mapInPandas(work, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose sets are similar enough."""
    both = pairs
    for name in ("a", "b"):
        both = both.join(sets.select(F.col("node").alias(name), F.col("shingles").alias(f"of_{name}")), name)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            linked = np.zeros(len(frame), bool)
            for place, (x, y) in enumerate(zip(frame["of_a"], frame["of_b"])):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked[place] = den * common >= num * (len(x) + len(y) - common)
            yield frame.loc[linked, ["a", "b"]]

    return both.mapInPandas(work, "a long, b long")


def sets_of(docs: DataFrame, chosen: DataFrame, n: int) -> DataFrame:
    """(node, shingles) of the ``chosen`` (doc_id, node), written; each node once."""
    spark = docs.sparkSession

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = kept("word hashes", WordHashes)
        for frame in frames:
            own = [shingles_of(text, n, hashes) for text in frame["text"]]
            yield pd.DataFrame({"node": np.array([node_of(x) for x in own], np.int64), "shingles": [x.tobytes() for x in own]})

    small_batches(spark)
    known = docs.join(chosen.filter("doc_id is not null").select("doc_id").distinct(), "doc_id", "left_semi")
    texts = known.unionByName(docs.filter("doc_id is null")).select("text")
    found = texts.mapInPandas(work, "node long, shingles binary").join(chosen.select("node"), "node", "left_semi")
    return written(found.groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")


def with_label(rows: DataFrame, labels: DataFrame, node: str, label: str) -> DataFrame:
    """``rows`` with the component of a node, which is its own if it has no links."""
    own = labels.select(F.col("node").alias(node), F.col("label").alias(label))
    return rows.join(own, node, "left").withColumn(label, F.coalesce(label, node))


def apart(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """``groups`` with the ``label`` of each node, without groups that are of one component."""
    told = with_label(groups, labels, "node", "label")
    mixed = told.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    return told.join(mixed.select("key"), "key", "left_semi")


def ends_of(pairs: DataFrame) -> DataFrame:
    """The nodes that are in a pair."""
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()


def in_order(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def shared_shingles(opened: DataFrame) -> DataFrame:
    """(node, shingle, f): n-grams that sets of several components have, with the number of sets, of ``opened`` (node, label, shingles); written."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                own = [np.frombuffer(held, np.int64) for held in frame["shingles"]]
                sizes = [len(held) for held in own]
                yield pd.DataFrame({name: np.repeat(frame[name].to_numpy(), sizes) for name in ("node", "label")} | {"shingle": np.concatenate(own)})

    spark = opened.sparkSession
    with scratch(spark, "shingles") as path:
        opened.select("node", "label", "shingles").mapInPandas(work, "node long, label long, shingle long").write.parquet(path)
        rows = spark.read.parquet(path)
        counts = rows.groupBy("shingle").agg(F.count("*").alias("f"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
        return written(rows.join(counts.select("shingle", "f"), "shingle").select("node", "shingle", "f"), "shared")


def size_class(n: Column) -> Column:
    return F.floor(F.log(n) / F.log(F.lit(CLASS)))


def rare_pairs(shared: DataFrame, able: DataFrame, labels: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of different components among ``able`` (node, n, m) that share an n-gram which is among the rarest of both.

    ``m`` of a set's ``n`` n-grams are in ``shared``. How many are the rarest depends on both sizes, so a key is an n-gram with both classes of sizes.
    """
    n, place = F.col("n"), F.row_number().over(Window.partitionBy("node").orderBy("f", "shingle"))
    least, most = F.ceil(n * num / den), F.floor(n * den / num)
    ranked = shared.join(able, "node").withColumn("place", F.col("n") - F.col("m") + place - 1).filter(F.col("place") <= n - least)
    classed = ranked.withColumns({"own": size_class(n), "other": F.explode(F.sequence(size_class(least), size_class(most)))})
    common = F.ceil((n + F.greatest(F.floor(F.pow(F.lit(CLASS), "other")), least)) * num / (num + den))
    keyed = classed.filter((F.col("place") <= n - common) & (F.col("m") >= common))
    key = ["shingle", "low", "high"]
    told = with_label(keyed.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}), labels, "node", "label")
    told = written(told.select(*key, "own", "other", "node", "n", "m", "place", "label"), "rare")
    counts = told.groupBy(*key, "label").agg(F.count("*").alias("rows"))
    mixed = counts.groupBy(*key).agg(F.count("*").alias("labels"), F.max(F.struct("rows", "label"))["label"].alias("main")).filter("labels > 1")
    # a key's largest component is not held against itself
    open_rows = written(told.join(mixed.select(*key, "main"), key), "open")
    x, y = open_rows.filter("label <> main").alias("x"), open_rows.alias("y")
    both = F.ceil((F.col("x.n") + F.col("y.n")) * num / (num + den))
    met = (
        (F.col("x.shingle") == F.col("y.shingle"))
        & (F.col("x.own") == F.col("y.other"))
        & (F.col("x.other") == F.col("y.own"))
        & ((F.col("y.label") == F.col("y.main")) | (F.col("x.label") < F.col("y.label")))
        & (F.least("x.m", "y.m") >= both)
        & (F.col("x.place") <= F.col("x.n") - both)
        & (F.col("y.place") <= F.col("y.n") - both)
    )
    return x.join(y, met).select(*in_order("x.node", "y.node")).distinct()


def links_of(docs: DataFrame, nodes: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Links (a, b) that connect all nodes that are connected; not each pair within a component."""
    least = num / den - MARGIN
    starred = written(in_groups(keyed(nodes, COARSE)), "coarse")
    first = written(estimated(starred.filter("node <> hub").select(*in_order("hub", "node")).distinct(), nodes, least), "pairs")
    docs_of = nodes.select("node", "doc_id")
    sets = sets_of(docs, docs_of.join(ends_of(first), "node", "left_semi"), n)
    links = written(verified(first, sets, num, den), "links")

    # sets that share a coarse band with one of another component are banded again
    labels = components(links)
    left = apart(starred.select("key", "node"), labels).select("node").distinct()
    fine = in_groups(keyed(nodes.join(left, "node", "left_semi"), fine_size(num, den))).select("key", "node")
    open_rows = written(apart(fine, labels), "open")
    opened = open_rows.select("node", "label").distinct()
    sets = sets.unionByName(sets_of(docs, docs_of.join(opened, "node", "left_semi").join(sets.select("node"), "node", "left_anti"), n))
    shared = shared_shingles(sets.join(opened, "node"))
    sizes = opened.join(nodes.select("node", "n"), "node").join(shared.groupBy("node").agg(F.count("*").alias("m")), "node", "left")
    sizes = written(sizes.select("node", "label", "n", F.coalesce("m", F.lit(0)).alias("m")), "sizes")

    weighed = open_rows.select("key", "node").join(sizes.select("node", "label", (F.col("m") / F.col("n")).alias("share")), "node")
    hubs = weighed.groupBy("key").agg(F.max(F.struct("share", "node", "label")).alias("hub")).select("key", "hub.node", "hub.label")
    others = weighed.join(hubs.select("key", F.col("node").alias("hub"), F.col("label").alias("of_hub")), "key").filter("label <> of_hub")
    tried = others.select(*in_order("hub", "node")).distinct().join(first, ["a", "b"], "left_anti")
    second = written(estimated(tried, nodes, least), "pairs")
    links = written(links.unionByName(verified(second, sets, num, den)), "links")

    able = sizes.filter(F.col("m") * den >= F.col("n") * num).select("node", "n", "m")
    rare = rare_pairs(shared, able, components(links), num, den).join(first.unionByName(second), ["a", "b"], "left_anti")
    third = written(estimated(rare, nodes, least), "pairs")
    return links.unionByName(verified(third, sets, num, den))


def near_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): documents link when ``den * intersection >= num * union``; the smallest id of a component is kept."""
    if num / den < 0.75:
        raise ValueError("the bands find links at a similarity of 0.75 or more")
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(f"`{text}`").alias("text"))
    members = written(members_of(rows, n), "members")
    classes = members.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("registers").alias("registers"))
    nodes = written(classes, "nodes")
    labels = components(links_of(rows, nodes, n, num, den))
    labelled = with_label(nodes.select("node", "doc_id"), labels, "node", "label")
    named = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    names = written(labelled.join(named, "label").select("node", "component_id"), "names")
    # empty sets are spread over the join, and keep their own id
    node = F.when(F.col("n") > 0, F.col("node")).otherwise(F.col("doc_id"))
    told = members.select("doc_id", F.col("n").alias("n_shingles"), node.alias("node")).join(names, "node", "left")
    own = F.coalesce(F.when(F.col("n_shingles") > 0, F.col("component_id")), F.col("doc_id"))
    return told.select("doc_id", "n_shingles", own.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
