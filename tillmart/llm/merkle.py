"""Merkle manifest of a dataset with a witness for each row, made by appending.

A row is a leaf: the SHA-256 of its fields, each as its length in bytes and value. The leaves of a group, in
order of id, are joined three by three (a last run may be shorter, even one) into the SHA-256 of their digests
until one is left, the group's root; the groups' roots, in order of group, are joined in the same way.
A leaf's witness has, for each level, the digests left and right of it in its run. Leaf and
witness give the root again, and no other leaf does.

Leaves are appended in blocks of ``3 ** HEIGHT``, aligned to their places in the group, so that
a block is a whole subtree. The blocks are spread over the tasks, and each task appends its leaves one by
one, as they stream in: a leaf is attached to the open subtree at the right edge with a partial witness; each later sibling that
completes a run extends the witnesses of all leaves below it, and the run moves up as one node. Block
roots are appends to the tree above, again in blocks, until a group has one root; a leaf's
witness is that within its block, followed by its block's.

A task holds one block, of 729 leaves, at a time, however large a group is. Places in a group come from a range
partitioning by group and id, so no group is in one task.

Defined results: a null field is ``-`` in its leaf; a null group is the first group; a null id comes before all others;
rows that repeat an id are leaves of their own, in order of their digests; equal rows have equal
leaves, next to each other; a very long text is hashed whole by its row; other columns, whatever
their names, are kept apart from the leaf; an empty table gives no rows.
"""

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillmart.session import written

WAYS, HEIGHT = 3, 6
BLOCK = WAYS**HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WITNESS = "array<struct<before: string, after: string>>"
APPENDED = f"tree string, pos long, witness {WITNESS}, block long, root string"


def field(value: Column) -> Column:
    """Length in bytes and value of a field; integers are written in decimal."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(value) for value in values]).cast("binary"), 256)


def digest(nodes: Iterable[str]) -> str:
    return hashlib.sha256("".join(nodes).encode("ascii")).hexdigest()


class Appender:
    """A tree that grows at its right edge, and the witnesses of its leaves.

    ``open[level]`` has the finished nodes of a run that still waits for siblings, each with the leaves below it.
    """

    def __init__(self):
        self.open: list[list[tuple[str, list[int]]]] = []
        self.witnesses: list[list[tuple[str, str]]] = []

    def append(self, node: str) -> None:
        self.witnesses.append([])
        self._add(0, node, [len(self.witnesses) - 1])

    def _add(self, level: int, node: str, leaves: list[int]) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append((node, leaves))
        if len(self.open[level]) == WAYS:
            self._close(level)

    def _close(self, level: int) -> None:
        """The run becomes a node of the next level, and its nodes the last part of each other's witnesses."""
        run, self.open[level] = self.open[level], []
        nodes = [node for node, _ in run]
        for place, (_, leaves) in enumerate(run):
            sides = "".join(nodes[:place]), "".join(nodes[place + 1 :])
            for own in leaves:
                self.witnesses[own].append(sides)
        self._add(level + 1, digest(nodes), [own for _, leaves in run for own in leaves])

    def finish(self, height: int | None) -> str:
        """The root, after short runs are closed: at ``height`` if the block is part of a tree, else as soon as one node is left."""
        level = 0
        while level != height:
            alone = not any(self.open[level + 1 :])
            if height is None and alone and len(self.open[level]) == 1:
                break
            if self.open[level]:
                self._close(level)
            level += 1
        return self.open[level][0][0]


def _appended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Witnesses and roots of blocks that come one after the other, each in order of its nodes."""
    now, grown = None, Appender()
    out: list[tuple] = []
    size = 0

    def settle() -> None:
        nonlocal size
        if now:
            tree, block, whole, first = now
            root = grown.finish(None if whole else HEIGHT)
            out.append((tree, block, first, root, grown.witnesses))
            size += len(grown.witnesses)

    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("tree", "pos", "total", "node"))
        for tree, pos, total, node in zip(*columns):
            block = pos // BLOCK
            if now is None or now[:2] != (tree, block):
                settle()
                now, grown = (tree, block, total <= BLOCK, pos), Appender()
                if size >= 4 * BLOCK:
                    yield _rows(out)
                    out, size = [], 0
            grown.append(node)
    settle()
    if out:
        yield _rows(out)


def _rows(blocks: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), None, pa.int64(), pa.string()]
    trees, places, numbers, roots, befores, afters, ends = [], [], [], [], [], [], [0]
    for tree, block, first, root, witnesses in blocks:
        n = len(witnesses)
        trees += [tree] * n
        places += range(first, first + n)
        numbers += [block] * n
        roots += [root] * n
        for witness in witnesses:
            befores += [before for before, _ in witness]
            afters += [after for _, after in witness]
            ends.append(len(befores))
    sides = pa.StructArray.from_arrays([pa.array(befores, pa.string()), pa.array(afters, pa.string())], ["before", "after"])
    listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), sides)
    columns = [pa.array(trees, kinds[0]), pa.array(places, kinds[1]), listed, pa.array(numbers, kinds[3]), pa.array(roots, kinds[4])]
    return pa.RecordBatch.from_arrays(columns, ["tree", "pos", "witness", "block", "root"])


def placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``pos`` of each node in its tree, from 0, and ``total``, the nodes of its tree; written."""
    pieces = written(nodes.repartitionByRange("tree", *order).withColumn("piece", F.spark_partition_id()), "pieces")
    sizes = pieces.groupBy("tree", "piece").agg(F.count("*").alias("n"))
    tree, before = Window.partitionBy("tree"), Window.partitionBy("tree").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("tree", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(tree).alias("total"))
    place = F.row_number().over(Window.partitionBy("tree", "piece").orderBy(*order)) - 1
    held = pieces.withColumn("place", place).join(starts, ["tree", "piece"])
    return written(held.withColumn("pos", F.col("start") + F.col("place")).drop("piece", "place", "start"), "placed")


def _append(nodes: DataFrame) -> DataFrame:
    """``nodes`` (tree, pos, total, node) in blocks: the witness of each within its block, the block and its root; written."""
    block = F.expr(f"pos DIV {BLOCK}")
    dealt = nodes.select("tree", "pos", "total", "node").repartition("tree", block).sortWithinPartitions("tree", "pos")
    return written(dealt.mapInArrow(_appended, APPENDED), "blocks")


def grow(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tree, pos, witness) of all ``nodes`` (tree, pos, total, node), and (tree, root).

    A round appends the block roots of the round before; there are log(largest tree) / log(729) of them.
    """
    rounds, roots = [], []
    while True:
        grown = _append(nodes)
        rounds.append(grown)
        several = F.expr(f"total > {BLOCK}")
        first = f"pos % {BLOCK} = 0"
        tops = nodes.filter(first).select("tree", "pos", "total").join(grown.filter(first).select("tree", "pos", "root"), ["tree", "pos"])
        roots.append(tops.filter(~several).select("tree", "root"))
        above = tops.filter(several).select(
            "tree",
            F.expr(f"pos DIV {BLOCK}").alias("pos"),
            F.expr(f"(total + {BLOCK - 1}) DIV {BLOCK}").alias("total"),
            F.col("root").alias("node"),
        )
        nodes = written(above, "roots")
        if nodes.isEmpty():
            break
    witnesses = rounds.pop().select("tree", "pos", "witness")
    while rounds:
        upper = witnesses.select("tree", F.col("pos").alias("block"), F.col("witness").alias("upper"))
        joined = rounds.pop().join(upper, ["tree", "block"], "left")
        longer = F.concat("witness", F.coalesce("upper", F.expr(f"CAST(array() AS {WITNESS})")))
        witnesses = joined.select("tree", "pos", longer.alias("witness"))
    all_roots = roots[0]
    for more in roots[1:]:
        all_roots = all_roots.unionByName(more)
    return witnesses, written(all_roots, "tree_roots")


def folded(node: Column, witness: Column) -> Column:
    """The root that a leaf and a witness give."""
    return F.aggregate(witness, node, lambda below, sides: F.sha2(F.concat(sides["before"], below, sides["after"]).cast("binary"), 256))


def proof_digest(witness: Column) -> Column:
    """SHA-256 of all digests of a witness, level by level, left to right."""
    told = F.array_join(F.transform(witness, lambda sides: F.concat(sides["before"], sides["after"])), "")
    return F.sha2(told.cast("binary"), 256)


def manifest(leaves: DataFrame, *, group: str = "source", doc_id: str = "doc_id", node: str = "leaf") -> DataFrame:
    """``leaves`` with ``subroot``, ``root`` and ``witness``, the way from leaf to root.

    The columns of ``leaves`` are kept; none may have one of these names.
    """
    held = [F.col(f"`{name}`").alias(f"kept {place}") for place, name in enumerate(leaves.columns)]
    # an empty tree name for the null group, which is before all others
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    rows = leaves.select(*held, tree.alias("tree"), F.col(f"`{doc_id}`").alias("key"), F.col(f"`{node}`").alias("node"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "leaves")
    places = placed(rows, ["key", "node", "row"])
    witnesses, subroots = grow(places)
    groups = placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("root").alias("node")), ["key"])
    upper, root = grow(groups)
    tops = upper.join(groups.select("tree", "pos", "key", "node"), ["tree", "pos"]).join(root, "tree")
    tops = written(tops.select(F.col("key").alias("tree"), F.col("node").alias("subroot"), "root", F.col("witness").alias("upper")), "groups")
    found = places.join(witnesses, ["tree", "pos"]).join(tops, "tree")
    back = [F.col(f"`kept {place}`").alias(name) for place, name in enumerate(leaves.columns)]
    return found.select(*back, "subroot", "root", F.concat("witness", "upper").alias("witness"))


def tampered_text(text: Column, doc_id: Column) -> Column:
    """The text without its line breaks in rows whose id has an even CRC-32, else as it is."""
    chosen = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    return F.when(chosen, F.regexp_replace(text, "\n", "")).otherwise(text)


def verify(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` held against rows that have been tampered with: only leaves that are still the same give the root."""
    doc_id, text = F.col("doc_id"), F.col("text")
    others = [F.col(name) for name in FIELDS[:-1]]
    leaves = docs.select("doc_id", "source", leaf(*others, text).alias("leaf"), leaf(*others, tampered_text(text, doc_id)).alias("seen"))
    known = manifest(leaves)
    told = known.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("witness")).alias("proof_sha256"), folded(F.col("seen"), F.col("witness")).alias("folded_root")
    )
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))
