"""SimHash fingerprints and their neighbours, with built-in functions only.

Terms are pairs of neighbouring words (runs of letters and digits, lower case), and the
last word by itself; a term weighs as much as it has characters. Each of 128 hash bits
of a term votes for or against, and the fingerprint has the bits that win. Two counters
are held in one 64-bit sum, 32 bits each, so a text may have 2^30 characters.

``within_radius`` finds all fingerprints within a Hamming radius. A fingerprint is cut into
blocks, each with a radius of its own; these add up to so much that a neighbour is within
the radius of one block at least. A query asks for all values of a block within its radius,
and a pair is taken at the first block that has it, so it comes once.

Defined results: a null text is the empty text; all texts without letters and digits have
the same terms; equal texts have equal fingerprints; a bit without majority is 0; rows that
repeat an id are documents of their own, in order of their text; a null id comes last
in descending order; other columns are not read; an empty table gives no rows.
"""

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillmart.llm.common import text_of

BITS = 128
DIGITS = BITS // 4
SEPARATOR = r"[^\p{L}\p{N}]+"
LANES = (1 << 32) + 1


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def terms_of(text: Column) -> Column:
    words = F.split(F.lower(text), SEPARATOR)
    return F.zip_with(
        words,
        F.slice(words, 2, F.size(words)),
        lambda a, b: F.struct(
            F.xxhash64(a, b).alias("h0"),
            F.xxhash64(F.lit(1), a, b).alias("h1"),
            (F.length(a) + F.coalesce(F.length(b), F.lit(0)) + 1).cast("long").alias("weight"),
        ),
    )


def _votes() -> dict[str, Column]:
    """Sums over ``h0``, ``h1``, ``weight``: the sum ``v<half>_<bit>`` counts the bit, and 32 places up the bit 32 above."""
    sums = {"whole": F.sum("weight")}
    for half in (0, 1):
        for bit in range(32):
            lanes = F.shiftrightunsigned(f"h{half}", bit).bitwiseAND(F.lit(LANES))
            sums[f"v{half}_{bit}"] = F.sum(lanes * F.col("weight"))
    return sums


def _half(half: int) -> Column:
    """The 64 bits of a half that more than half of the weight votes for."""

    def won(bit: int) -> Column:
        both = F.col(f"v{half}_{bit % 32}")
        votes = F.shiftrightunsigned(both, 32) if bit >= 32 else both.bitwiseAND(F.lit((1 << 32) - 1))
        return F.when(votes * 2 > F.col("whole"), F.lit(_signed(1 << bit))).otherwise(F.lit(0).cast("long"))

    return reduce(lambda x, y: x.bitwiseOR(y), (won(bit) for bit in range(64)))


def fingerprint_rows(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and the fingerprint's halves ``f0`` and ``f1``; rows with equal keys are one text."""
    terms = rows.select(*keys, F.explode(terms_of(F.col(text))).alias("t")).select(*keys, "t.*")
    voted = terms.groupBy(*keys).agg(*[column.alias(name) for name, column in _votes().items()])
    return voted.select(*keys, _half(0).alias("f0"), _half(1).alias("f1"))


def as_text(f0: str, f1: str) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(half), 16, "0") for half in (f0, f1)]))


def likeness(f0: str, f1: str, g0: str, g1: str) -> Column:
    """Share of equal bits."""
    differing = F.bit_count(F.col(f0).bitwiseXOR(F.col(g0))) + F.bit_count(F.col(f1).bitwiseXOR(F.col(g1)))
    return 1 - differing / F.lit(float(BITS))


def in_stretches(docs: DataFrame, per_partition: int = 4) -> DataFrame:
    """Rows (id, text) dealt into stretches of neighbouring ids, about ``per_partition`` for each shuffle partition.

    Bounds are ids of documents, so the document after a stretch is that of its lower
    bound; a copy of it (``extra``) stands at the stretch's end, and one of the first
    document of all at the end of the last.
    """
    n = per_partition * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [(i + 1) / n for i in range(n)]
    found = docs.agg(F.percentile_approx("id", shares, 100 * n).alias("bounds"), F.max("id").alias("top")).first()
    bounds = sorted({*(found["bounds"] or []), *([found["top"]] if found["top"] is not None else [])})
    if not bounds:
        return docs.select("*", F.lit(0).alias("stretch"), F.explode(F.array(F.lit(False), F.lit(True))).alias("extra"))
    listed = F.array(*[F.lit(bound) for bound in bounds])
    own = F.coalesce(F.size(F.filter(listed, lambda b: b < F.col("id"))), F.lit(0))
    # a null id compares with nothing, so it is in the lowest stretch
    placed = docs.withColumn("own", F.when(F.col("id").isNull(), 0).otherwise(own))
    after = F.when(F.col("id") == bounds[-1], F.lit(0)).when(F.array_contains(listed, F.col("id")), F.col("own") + 1)
    one = lambda stretch, extra: F.struct(stretch.alias("stretch"), F.lit(extra).alias("extra"))
    both = F.filter(F.array(one(F.col("own"), False), one(after, True)), lambda s: s["stretch"].isNotNull())
    return placed.select("id", "text", F.explode(both).alias("s")).select("id", "text", "s.*")


def fingerprint_edits(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of all texts and of their edited texts.

    The edited text has the first half of the text's characters (the larger one), then as
    many of the next document's as the other half has. The next document is that of the next
    smaller id; after the smallest comes the largest.
    """
    rows = in_stretches(docs.select(F.col(doc_id).alias("id"), text_of(text).alias("text")))
    order = Window.partitionBy("stretch").orderBy("extra", F.col("id").desc_nulls_last(), "text")
    size = F.length("text")
    edited = F.concat(
        F.substr("text", F.lit(1), size - F.floor(size / 2).cast("int")),
        F.substr(F.coalesce("following", F.lit("")), F.lit(1), F.floor(size / 2).cast("int")),
    )
    ordered = rows.select(
        "stretch", "extra", "id", "text", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("following")
    )
    both = F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("words"), F.lit("").alias("sha")),
        F.struct(F.lit(1).alias("which"), edited.alias("words"), F.sha2(edited.cast("binary"), 256).alias("sha")),
    )
    texts = ordered.select("stretch", "extra", "id", "place", size.alias("n_chars"), F.explode(both).alias("e")).select(
        "stretch", "extra", "id", "place", "n_chars", "e.*"
    )
    keys = ["stretch", "place", "extra", "id", "n_chars", "which", "sha"]
    found = fingerprint_rows(texts, keys, "words")
    first, second = F.col("which") == 0, F.col("which") == 1
    whole = found.groupBy("stretch", "place").agg(
        F.max("extra").alias("extra"),
        F.max("id").alias("id"),
        F.max("n_chars").alias("n_chars"),
        F.max("sha").alias("edited_sha256"),
        *[F.max(F.when(which, F.col(f))).alias(f"{name}{f[1]}") for name, which in (("f", first), ("e", second)) for f in ("f0", "f1")],
    )
    along = Window.partitionBy("stretch").orderBy("place")
    # in the last stretch of few documents the copy follows, so the next row is always there
    after = whole.withColumns({f"n{i}": F.lead(f"f{i}").over(along) for i in (0, 1)})
    return after.filter(~F.col("extra")).select(
        F.col("id").alias(doc_id),
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        as_text("f0", "f1").alias("fingerprint"),
        as_text("e0", "e1").alias("edited_fingerprint"),
        likeness("f0", "f1", "e0", "e1").alias("near_edited"),
        likeness("f0", "f1", "n0", "n1").alias("near_next"),
    )


def halves(fingerprint: Column) -> list[Column]:
    """The two 64-bit halves of a hex text, as signed numbers."""
    part = lambda at: F.conv(F.substring(fingerprint, at, 8), 16, 10).cast("long")
    return [F.shiftleft(part(at), 32).bitwiseOR(part(at + 8)) for at in (1, 17)]


def split_bits(value: int) -> tuple[int, int]:
    return _signed(value >> 64), _signed(value & ((1 << 64) - 1))


def blocks_of(radius: int) -> list[tuple[list[int], int]]:
    """Blocks (their bits) with radii of at most 2: if all were exceeded, more than ``radius`` bits would differ."""
    if not 0 <= radius <= DIGITS - 2:
        raise ValueError(f"radius must be 0 to {DIGITS - 2}")
    n = max(4, radius // 3 + 1)
    cuts = [BITS * i // n for i in range(n + 1)]
    radii = [radius // n - (i > radius % n) for i in range(n)]
    return [(list(range(cuts[i], cuts[i + 1])), own) for i, own in enumerate(radii) if own >= 0]


def changes(bits: list[int], radius: int) -> list[int]:
    """All sets of at most ``radius`` of these bits, as numbers."""
    return [sum(1 << bit for bit in some) for size in range(radius + 1) for some in combinations(bits, size)]


def within_radius(queries: DataFrame, fingerprints: DataFrame, radius: int) -> DataFrame:
    """(query, fingerprint, distance) of all distinct fingerprints that differ in at most ``radius`` bits.

    Both tables have a column ``fingerprint``; null ones have no neighbours.
    """
    blocks = blocks_of(radius)
    masks = [split_bits(sum(1 << bit for bit in bits)) for bits, _ in blocks]

    def rows(df: DataFrame, name: str) -> DataFrame:
        f0, f1 = halves(F.col("fingerprint"))
        return df.select("fingerprint").dropna().distinct().select(F.col("fingerprint").alias(name), f0.alias(f"{name}0"), f1.alias(f"{name}1"))

    def key(block: int, name: str) -> Column:
        parts = [F.col(f"{name}{i}").bitwiseAND(F.lit(masks[block][i])) for i in (0, 1)]
        return F.struct(F.lit(block).alias("block"), parts[0].alias("k0"), parts[1].alias("k1"))

    spark = queries.sparkSession
    # which values of a block are asked for is the same for all queries
    listed = [(block, *split_bits(change)) for block, (bits, own) in enumerate(blocks) for change in changes(bits, own)]
    asked_for = F.broadcast(spark.createDataFrame(listed, "block int, c0 long, c1 long"))
    own_mask = [F.array(*[F.lit(mask[i]) for mask in masks])[F.col("block")] for i in (0, 1)]
    asked = rows(queries, "query").crossJoin(asked_for).select(
        "query", "query0", "query1", "block",
        *[F.col(f"query{i}").bitwiseAND(own_mask[i]).bitwiseXOR(F.col(f"c{i}")).alias(f"k{i}") for i in (0, 1)],
    )
    held = rows(fingerprints, "other").select("*", F.explode(F.array(*[key(block, "other") for block in range(len(blocks))])).alias("k"))
    held = held.select("other", "other0", "other1", F.col("k.block").alias("held_block"), F.col("k.k0").alias("h0"), F.col("k.k1").alias("h1"))
    apart = [F.col(f"query{i}").bitwiseXOR(F.col(f"other{i}")) for i in (0, 1)]
    total = F.bit_count(apart[0]) + F.bit_count(apart[1])
    same = (F.col("block") == F.col("held_block")) & (F.col("k0") == F.col("h0")) & (F.col("k1") == F.col("h1")) & (total <= radius)
    for block, (_, own) in enumerate(blocks[:-1]):
        within = reduce(lambda x, y: x + y, (F.bit_count(apart[i].bitwiseAND(F.lit(masks[block][i]))) for i in (0, 1)))
        same &= (F.col("block") <= block) | (within > own)
    return asked.join(held, same).select("query", F.col("other").alias("fingerprint"), total.alias("distance"))
