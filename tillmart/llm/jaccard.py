"""N-gram Jaccard join by parity sketches.

A document's set is its distinct word n-grams. Each n-gram toggles one bit of a wide
sketch, so the Hamming distance of two sketches is at most the size of the sets'
symmetric difference. For sets of a size band that difference is at most ``d`` if they
link; the wide sketch has more than ``d`` blocks, so linked sets agree in a block
(pigeonhole), and a join on (band, block, bits of the block) finds them. A narrow
sketch of ``BITS`` bits drops pairs that are too far apart, and the sets themselves
decide.

Four things keep the join in bounds without losing a link:

* Equal sets are one class.
* At most ``d`` blocks of a set differ in a linked one, so of any ``d + 1`` of its blocks,
  first in one order for all sets, one is common. A first join, over the fullest blocks
  only, tells which sets share one with any other set.
* These sets are joined again by more and so finer blocks, rare ones first. Blocks that many
  sets share, such as those of a common passage, are no keys as long as a set has enough
  rarer ones. Edits are in blocks of their own, and a set with more than ``d`` such blocks
  links with nothing, so of many copies that differ too much few are left.
* In a group with the same key all sets are compared with the one that has the fewest
  blocks of its own, such as the text that the others were copied from. Jaccard
  distance is a metric, so this tells which of the others can link; only those of
  these that are in different components are compared.

Words are runs of characters other than ASCII white space, with A-Z in lower case; a
text with fewer words than ``n`` has all of them as its only n-gram. Sets hold 64-bit
hashes of the n-grams.

Defined results: null texts and texts without words have the empty set, which links
with nothing; rows that repeat an id have one row each, of their own text; a null id
is never a component's name unless all ids in it are null; other columns are not read;
an empty table gives no rows.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillmart.llm.common import Remembered, kept, small_batches, text_of
from tillmart.llm.components import components
from tillmart.session import shared_dir, written
from tillmart.sources.files import remove

BITS = 1024
#: Blocks of the wide sketch per symmetric difference allowed, in the first join and in the second.
SPARE, FINE = 1.3, 4.0
#: Larger sizes than any text has.
TOP_SIZE = 1 << 40
MEMBER = "doc_id long, n long, node long, keys array<long>"
PROFILE = "node long, n long, sketch array<long>, shingles array<long>, keys array<long>, n_even int, n_odd int, keep_even int, keep_odd int"


class WordHashes(Remembered):
    def find(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        return xxh3_64_intdigest(word)


def mix(values: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    out = (values ^ np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(31))


def shingles_of(text: str, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(n, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        out = mix(out ^ codes[i : i + len(out)], i + 1)
    return np.unique(out)


class Bands:
    """Size bands for a least similarity of ``num / den``: sets that link are in one band or in two next to each other."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        tops = [1]
        while tops[-1] < TOP_SIZE:
            tops.append(max(tops[-1] + 1, tops[-1] * den // num))
        self.tops = np.array(tops)

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.tops, size))

    def differing(self, band: int) -> int:
        """Most n-grams in one only of two linked sets, the smaller of which is in the band."""
        top = int(self.tops[band])
        return (top + top * self.den // self.num) * (self.den - self.num) // (self.den + self.num)


def node_of(shingles: np.ndarray) -> int:
    """A number for the set; 0 for the empty one."""
    if not len(shingles):
        return 0
    whole = np.bitwise_xor.reduce(mix(shingles, 16), keepdims=True) ^ np.uint64(len(shingles))
    return int(mix(whole, 17).astype(np.int64)[0])


def block_keys(shingles: np.ndarray, band: int, bands: Bands, spare: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys of the blocks, their n-grams, and how many keys, first in any order that all sets have, find all links.

    A key is a hash of band, block and the block's bits; its lowest bit is that of the
    band. Blocks without bits are left out, unless so many have none that a linked set
    may agree in these only.
    """
    differ = bands.differing(band)
    blocks = int(spare * differ) + 1
    place = (mix(shingles, 11) >> np.uint64(16)) % np.uint64(blocks)
    order = np.argsort(place, kind="stable")
    place = place[order]
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    bits = np.bitwise_xor.reduceat(mix(shingles, 12)[order], first)
    full = place[first]
    held = np.diff(np.append(first, len(place)))
    enough = differ + 1
    if len(full) <= differ:
        at, all_bits, all_held = full.astype(np.int64), np.zeros(blocks, np.uint64), np.zeros(blocks, np.int64)
        all_bits[at], all_held[at] = bits, held
        full, bits, held, enough = np.arange(blocks, dtype=np.uint64), all_bits, all_held, blocks
    keys = mix(bits ^ mix((full << np.uint64(12)) + np.uint64(band), 13), 14)
    return (keys & ~np.uint64(1)) | np.uint64(band & 1), held, enough


def own_bands(shingles: np.ndarray, bands: Bands) -> list[int]:
    """The band of the set and the one below, whose sets it may link with."""
    band = bands.of(len(shingles))
    return [own for own in (band, band - 1) if own >= 0]


def coarse_keys(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """The keys of the first join: as many as find all links, those of the fullest blocks, as these are rarely equal by chance."""
    found = [np.zeros(0, np.uint64)]
    for band in own_bands(shingles, bands) if len(shingles) else []:
        keys, held, enough = block_keys(shingles, band, bands, SPARE)
        found.append(keys[np.lexsort((keys, -held))[:enough]])
    return np.concatenate(found).astype(np.int64)


def profile(shingles: np.ndarray, bands: Bands) -> tuple:
    """A row of ``PROFILE``: narrow sketch, and all keys of the second join with the number that is enough."""
    found, count, keep = [], [0, 0], [0, 0]
    for band in own_bands(shingles, bands):
        keys, _, enough = block_keys(shingles, band, bands, FINE)
        found.append(keys)
        count[band & 1], keep[band & 1] = len(keys), enough
    narrow = np.bincount((mix(shingles, 15) % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    sketch = np.packbits(narrow.astype(np.uint8)).view(np.int64)
    return node_of(shingles), len(shingles), sketch, shingles.astype(np.int64), np.concatenate(found).astype(np.int64), *count, *keep


def over_sets(docs: DataFrame, n: int, schema: str, rows_of) -> DataFrame:
    """The rows that ``rows_of`` gives for (id, set) of each document."""
    small_batches(docs.sparkSession)
    names = [column.split()[0] for column in schema.split(", ")]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = kept("word hashes", WordHashes)
        for frame in frames:
            for at in range(0, len(frame), 1000):
                part = frame.iloc[at : at + 1000]
                rows = [row for key, text in zip(part["doc_id"], part["text"]) for row in rows_of(key, shingles_of(text, n, hashes))]
                out = pd.DataFrame(rows, columns=names)
                yield out.astype({"doc_id": "Int64"}) if "doc_id" in names else out

    return docs.mapInPandas(work, schema)


def members_of(docs: DataFrame, n: int, bands: Bands) -> DataFrame:
    """Each document with its set's size, number and keys of the first join.

    Of the rows of a task that have the same set only the first has the keys, so a class of copies, however large, brings no more rows to a key than there are tasks.
    """
    seen: set[int] = set()  # of one task: each task gets the function anew

    def row_of(key: int | None, own: np.ndarray) -> list[tuple]:
        node = node_of(own)
        keys = np.zeros(0, np.int64) if node in seen else coarse_keys(own, bands)
        seen.add(node)
        return [(key, len(own), node, keys)]

    return over_sets(docs, n, MEMBER, row_of)


def partnered(members: DataFrame) -> DataFrame:
    """The sets (node) that share a key of the first join with a set of another class."""
    group = Window.partitionBy("key")
    rows = members.select("node", F.explode("keys").alias("key"))
    beside = rows.withColumns({"low": F.min("node").over(group), "high": F.max("node").over(group)}).filter("low < high")
    return beside.select("node").distinct()


def rare_keys(sets: DataFrame) -> DataFrame:
    """(key, node, alone): keys that several sets share, cut to the rarest that are enough for each set and band.

    ``alone`` is the share of the set's blocks in the band that no other set has.
    """
    rows = sets.select("node", F.explode("keys").alias("key")).repartition("key").dropDuplicates(["key", "node"])
    sizes = rows.groupBy("key").agg(F.count("*").alias("f")).filter("f > 1")
    odd = F.col("key").bitwiseAND(F.lit(1)) == 1
    own = Window.partitionBy("node", "odd")
    ranked = (
        rows.join(sizes, "key")
        .join(sets.select("node", "n_even", "n_odd", "keep_even", "keep_odd").distinct(), "node")
        .select(
            "key",
            "node",
            "f",
            odd.alias("odd"),
            F.when(odd, F.col("n_odd")).otherwise(F.col("n_even")).alias("keys"),
            F.when(odd, F.col("keep_odd")).otherwise(F.col("keep_even")).alias("keep"),
        )
        .withColumn("unshared", F.col("keys") - F.count("*").over(own))
        .withColumn("rank", F.row_number().over(own.orderBy("f", "key")))
    )
    kept = ranked.filter(F.col("unshared") + F.col("rank") <= F.col("keep"))
    return kept.select("key", "node", (F.col("unshared") / F.col("keys")).alias("alone"))


def in_groups(keyed: DataFrame) -> DataFrame:
    """Rows of keys that several sets have kept, with the ``hub`` all others are compared with."""
    keyed = written(keyed, "keys")
    hub = F.min_by("node", F.struct("alone", "node")).alias("hub")
    groups = keyed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), hub).filter("low < high")
    return written(keyed.join(groups.select("key", "hub"), "key"), "groups")


def _hamming(a: str, b: str) -> Column:
    differing = F.transform(F.arrays_zip(F.col(a).alias("x"), F.col(b).alias("y")), lambda z: F.bit_count(z["x"].bitwiseXOR(z["y"])))
    return F.aggregate(differing, F.lit(0), lambda total, bits: total + bits)


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``common`` and ``total``: sizes of intersection and union of the sets of ``a`` and ``b``."""
    first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    sized = pairs.join(first, "a").join(second, "b").select("a", "b", common.alias("common"), (F.size("of_a") + F.size("of_b")).alias("sizes"))
    # a set is there as often as rows repeat its text and id
    return sized.select("a", "b", "common", (F.col("sizes") - F.col("common")).alias("total")).distinct()


def partnered_docs(docs: DataFrame, n: int, bands: Bands) -> tuple[DataFrame, DataFrame]:
    """All documents with their sets' sizes and numbers, and one document id for each set that has found a partner."""
    spark, path = docs.sparkSession, shared_dir(docs.sparkSession, "keyed")
    members_of(docs, n, bands).write.parquet(path)
    keyed = spark.read.parquet(path)
    classes = keyed.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    chosen = written(partnered(keyed).join(classes, "node").select("doc_id").distinct(), "chosen")
    members = written(keyed.drop("keys"), "members")
    remove(spark, path)
    return members, chosen


def find_links(docs: DataFrame, chosen: DataFrame, n: int, bands: Bands) -> DataFrame:
    """Links between classes (node ids) that connect all sets that are connected; not each pair within a component."""
    num, den = bands.num, bands.den
    linked = F.col("common") * den >= F.col("total") * num
    texts = docs.join(chosen, "doc_id", "left_semi").unionByName(docs.filter("doc_id is null"))
    profiles = over_sets(texts, n, PROFILE, lambda _, own: [profile(own, bands)] if len(own) else [])
    sets = written(profiles, "sets")

    starred = in_groups(rare_keys(sets))
    pairs = starred.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    tried = written(compare(pairs, sets), "tried")
    links = tried.filter(linked).select("a", "b")
    labels = components(links)

    far = F.when(F.col("node") == F.col("hub"), F.lit(0.0)).otherwise(1 - F.col("common") / F.col("total"))
    reach = (den - num) / den + 1e-9
    compared = tried.select(F.col("a").alias("hub"), F.col("b").alias("node"), "common", "total")
    placed = (
        starred.join(compared, ["hub", "node"], "left")
        .select("key", "node", far.alias("far"))
        .join(labels, "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
        .withColumn("cell", F.floor(F.col("far") / reach))
    )
    open_keys = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("key")
    left = placed.join(open_keys, "key", "left_semi").join(sets.select("node", "n", "sketch").distinct(), "node")
    left = written(left, "open")
    x = left.withColumn("cell", F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1))).alias("x")
    y = left.alias("y")
    bound = F.floor((F.col("x.n") + F.col("y.n")) * (den - num) / (den + num))
    near = (
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.cell") == F.col("y.cell"))
        & (F.col("x.label") < F.col("y.label"))
        & (F.abs(F.col("x.far") - F.col("y.far")) <= reach)
        # the hub has been compared with all
        & (F.col("x.far") > 0)
        & (F.col("y.far") > 0)
        & (F.col("x.n") * den >= F.col("y.n") * num)
        & (F.col("y.n") * den >= F.col("x.n") * num)
        & (_hamming("x.sketch", "y.sketch") <= bound)
    )
    close = x.join(y, near).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    late = compare(close, sets).filter(linked).select("a", "b")
    return links.unionByName(late)


def jaccard_groups(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """(doc_id, n_shingles, component_id): sets link when ``den * intersection >= num * union``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    bands = Bands(num, den)
    members, chosen = partnered_docs(rows, n, bands)
    labels = components(find_links(rows, chosen, n, bands))
    classes = members.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("first"))
    labelled = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    names = written(labelled.join(named, "label").select("node", "component_id"), "names")
    # empty sets are spread over the join, and keep their own id
    node = F.when(F.col("n") > 0, F.col("node")).otherwise(F.col("doc_id"))
    named_members = members.select("doc_id", F.col("n").alias("n_shingles"), node.alias("node")).join(names, "node", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id"))
    return named_members.select("doc_id", "n_shingles", F.coalesce(own, "doc_id").alias("component_id"))


def first_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` whose id names its component: one document of each group, that with the smallest id.

    Rows that repeat such an id, and rows without an id, all stay.
    """
    groups = jaccard_groups(docs, doc_id=doc_id, text=text, n=n, num=num, den=den)
    gone = groups.filter("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    kept = groups.filter("component_id = doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    gone = gone.join(kept, "_gone", "left_anti")
    return docs.join(gone, docs[doc_id].cast("long") == gone["_gone"], "left_anti")
