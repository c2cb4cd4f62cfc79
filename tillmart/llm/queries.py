"""The corpus operators over whole tables, and SQL for those it can express."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillmart.llm import (
    chat,
    decontamination,
    fingerprints,
    hyperminhash,
    jaccard,
    language,
    line_dedup,
    merkle,
    packing,
    phrases,
    secret_scan,
    token_counts,
    warc,
)
from tillmart.llm.common import read_table
from tillmart.session import shared_dir, written


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file; the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the first version of their paths, filed in a new ledger and scanned for all rules."""
    docs = read_table(spark, sf_dir, "documents")
    ledger = secret_scan.Ledger(spark, shared_dir(spark, "secrets"))
    ledger.ingest(docs.select(F.col("doc_id").alias("path"), F.lit(1).alias("version"), "text"))
    found = ledger.findings()
    base = secret_scan.of_kinds(F.col("findings"), [rule.kind for rule in secret_scan.BASE_RULES])
    counts = [
        F.size(secret_scan.of_kinds(F.col("findings"), [kind])).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")
    ]
    return found.select(
        F.col("path").cast("long").alias("doc_id"),
        *counts,
        F.sha2(secret_scan.joined(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.joined(F.col("findings")).alias("spans"),
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from three quarters of the labelled documents; the rest is held out."""
    docs = read_table(spark, sf_dir, "documents").withColumn(
        "held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    )
    model = language.train(docs.filter("not held_out and doc_id is not null"))
    return language.predict(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives with revisit records and read back from them."""
    path = shared_dir(spark, "archives")
    warc.write_archives(read_table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without repeated runs of lines; documents of which nothing is left have an empty text."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, removed="n_removed")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations and one whose texts hold markers, formatted; all columns are read from the formatted text."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "<|im_end|><|im_start|>assistant ok"
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(odd).alias("text"),
    )
    parts = turns.unionByName(more).withColumn("parts", chat.text_parts("text"))
    read = chat.parse_chats(chat.format_chats(parts))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    trained = F.array_join("trained", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each line of each document; a token over a border goes to the line with most of it."""
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the benchmark items that leak into them."""
    return decontamination.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


#: Fingerprints of which more than this many bits differ are no neighbours.
RADIUS = 20


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edits; of every document whose id 50 divides, also how many other
    distinct fingerprints of all documents are within ``RADIUS`` (``n_near``, else null), and the ids of the
    documents that have these, ascending (``near_ids``, with commas between)."""
    found = written(fingerprints.fingerprint_edits(read_table(spark, sf_dir, "documents")), "fingerprints")
    asked = found.withColumn("query", F.when(F.col("doc_id") % 50 == 0, F.col("fingerprint")))
    near = written(fingerprints.within_radius(asked.select(F.col("query").alias("fingerprint")), found, RADIUS), "near")
    counts = near.groupBy("query").agg((F.count("*") - 1).alias("n_near"))
    others = near.filter("query <> fingerprint").join(found.select("doc_id", "fingerprint"), "fingerprint")
    ids = others.groupBy("query").agg(F.array_join(F.sort_array(F.collect_list("doc_id")).cast("array<string>"), ",").alias("near_ids"))
    both = written(counts.join(ids, "query", "left").withColumn("near_ids", F.coalesce("near_ids", F.lit(""))), "neighbours")
    return asked.join(both, "query", "left").drop("query")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(read_table(spark, sf_dir, "documents"), n=3, num=90, den=100)


def op11_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies: four words, similarity 0.8."""
    return hyperminhash.near_duplicates(read_table(spark, sf_dir, "documents"), n=4, num=80, den=100)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, held against documents some of which have lost their line breaks."""
    return merkle.verify(read_table(spark, sf_dir, "documents"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of two to five words of each language."""
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_secret_scan,
        op2_language_id,
        op3_warc,
        op4_line_dedup,
        op5_packing,
        op6_chat_format,
        op7_token_counts,
        op8_decontamination,
        op9_fingerprints,
        op10_jaccard_join,
        op11_hyperminhash,
        op12_merkle,
        op13_phrases,
    )
}

_HTTP = len("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: " + warc.END)

OP3_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS digest FROM p),
digits AS (
    SELECT page_id, string_agg(
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(digest, 5 * part + 1, 5))::BIGINT >> shift) & 31)::INTEGER + 1, 1),
        '' ORDER BY part, shift DESC) AS payload_digest
    FROM d, range(8) AS a(part), unnest([15, 10, 5, 0]) AS b(shift) GROUP BY page_id),
r AS (SELECT *, max(page_id) OVER (PARTITION BY digest, payload_bytes) AS original FROM d JOIN digits USING (page_id))
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to,
       replace(replace(url, chr(13), '%0D'), chr(10), '%0A') AS url,
       ({_HTTP} + length(payload_bytes::VARCHAR) + CASE WHEN page_id = original THEN payload_bytes ELSE 0 END)::BIGINT AS block_bytes,
       true AS intact
FROM r JOIN pages USING (page_id)
"""

OP4_SQL = f"""
WITH doc AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
line AS (
    SELECT doc_id, pos - 1 AS pos, lines[pos] AS line,
           len(list_filter(regexp_split_to_array(lines[pos], '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')) AS words
    FROM doc, generate_series(1, len(lines)) AS s(pos)),
counted AS (
    SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS stop, sum(words) OVER (PARTITION BY doc_id) AS total
    FROM line WHERE words > 0),
windowed AS (
    SELECT doc_id,
           stop - words + {line_dedup.MIN_WORDS} <= total AS onward_full, stop >= {line_dedup.MIN_WORDS} AS backward_full,
           min(pos) OVER onward AS onward_first, max(pos) OVER onward AS onward_last, list(line) OVER onward AS onward_lines,
           min(pos) OVER backward AS backward_first, max(pos) OVER backward AS backward_last, list(line) OVER backward AS backward_lines
    FROM counted
    WINDOW onward AS (PARTITION BY doc_id ORDER BY stop - words RANGE BETWEEN CURRENT ROW AND {line_dedup.MIN_WORDS - 1} FOLLOWING),
           backward AS (PARTITION BY doc_id ORDER BY stop RANGE BETWEEN {line_dedup.MIN_WORDS - 1} PRECEDING AND CURRENT ROW)),
run AS (
    SELECT doc_id, 0 AS kind, onward_first AS first, onward_last AS last, onward_lines AS lines FROM windowed WHERE onward_full
    UNION ALL
    SELECT doc_id, 1, backward_first, backward_last, backward_lines FROM windowed WHERE backward_full),
ranked AS (SELECT *, row_number() OVER (PARTITION BY kind, lines ORDER BY doc_id, first) AS nth FROM run),
gone AS (SELECT DISTINCT doc_id, pos FROM ranked, generate_series(first, last) AS s(pos) WHERE nth > 1),
kept AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM line ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT doc_id, CASE WHEN documents.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       coalesce(n_removed, 0)::BIGINT AS n_removed
FROM documents LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

OP6_SQL = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
f AS (
    SELECT *, '<|im_start|>' || regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\*)\|', '<\\\1|', 'g') || chr(10)
              || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10) AS piece
    FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length(piece))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""


def _groups_sql(n: int, percent: int) -> str:
    """Documents with their word n-grams, the sizes of their sets, and the documents that each reaches by links."""
    return rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words
    FROM documents),
g AS (
    SELECT DISTINCT doc_id, CASE WHEN len(words) < {n} THEN words ELSE words[i:i + {n} - 1] END AS gram
    FROM w, generate_series(1, greatest(len(words) - {n} + 1, 1)) AS s(i) WHERE len(words) > 0),
n AS (SELECT doc_id, count(*) AS size FROM g GROUP BY doc_id),
pair AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM g AS x JOIN g AS y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (
    SELECT a, b FROM pair JOIN n AS x ON a = x.doc_id JOIN n AS y ON b = y.doc_id
    WHERE 100 * common >= {percent} * (x.size + y.size - common)),
reach AS (
    SELECT doc_id AS node, doc_id AS other FROM w
    UNION SELECT reach.node, link.b FROM reach JOIN link ON reach.other = link.a)
"""


OP10_SQL = _groups_sql(3, 90) + """
SELECT w.doc_id, coalesce(any_value(n.size), 0)::BIGINT AS n_shingles, min(reach.other) AS component_id
FROM w JOIN reach ON reach.node = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id
"""

OP11_SQL = _groups_sql(4, 80) + """
SELECT w.doc_id, coalesce(any_value(n.size), 0)::BIGINT AS n_shingles, min(reach.other) AS component_id,
       min(reach.other) = w.doc_id AS kept
FROM w JOIN reach ON reach.node = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id
"""

# CRC-32 of the sixteen half bytes.
CRC_STEPS = """0x00000000 0x1db71064 0x3b6e20c8 0x26d930ac 0x76dc4190 0x6b6b51f4 0x4db26158 0x5005713c
0xedb88320 0xf00f9344 0xd6d6a3e8 0xcb61b38c 0x9b64c2b0 0x86d3d2d4 0xa00ae278 0xbdbdf21c"""
_STEPS = ", ".join(str(int(step, 16)) for step in CRC_STEPS.split())


def _tree_sql(name: str, leaves: str) -> str:
    """Nodes and runs of the trees over ``leaves`` (tree, pos, digest), level by level."""
    return f"""
{name}_node AS (
    SELECT tree, 0 AS level, pos, digest FROM {leaves}
    UNION ALL
    SELECT tree, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS total FROM {name}_node) WHERE total > 1 GROUP BY tree, level, pos // 3),
{name}_sized AS (SELECT *, count(*) OVER (PARTITION BY tree, level) AS total FROM {name}_node),
{name}_run AS (
    SELECT tree, level, pos // 3 AS run, list(digest ORDER BY pos) AS digests FROM {name}_sized WHERE total > 1 GROUP BY tree, level, pos // 3),
{name}_root AS (SELECT tree, digest AS root FROM {name}_sized WHERE total = 1),
{name}_way AS (
    SELECT l.tree, l.pos, list(array_to_string(digests[:p], '') || '|' || array_to_string(digests[p + 2:], '') ORDER BY r.level) AS way
    FROM (SELECT l.*, r.level, r.digests, (l.pos // (3 ** r.level)::BIGINT) % 3 AS p
          FROM {leaves} AS l JOIN {name}_run AS r ON r.tree = l.tree AND r.run = l.pos // (3 ** (r.level + 1))::BIGINT) AS r
    JOIN {leaves} AS l USING (tree, pos) GROUP BY l.tree, l.pos)"""


def _field_sql(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"


_LEAF = " || ".join(_field_sql(name) for name in merkle.FIELDS)
_SEEN = " || ".join(_field_sql(name) for name in [*merkle.FIELDS[:-1], "seen_text"])

OP12_SQL = f"""
WITH RECURSIVE crc AS (
    SELECT doc_id, list_reduce(
        list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT),
        lambda a, b: xor(([{_STEPS}])[1 + (xor(xor(([{_STEPS}])[1 + (xor(a, b) & 15)]::BIGINT, a >> 4), b >> 4) & 15)]::BIGINT,
                         xor(([{_STEPS}])[1 + (xor(a, b) & 15)]::BIGINT, a >> 4) >> 4),
        4294967295) AS inverse
    FROM documents),
doc AS (
    SELECT documents.*, CASE WHEN inverse % 2 = 1 THEN replace(text, chr(10), '') ELSE text END AS seen_text
    FROM documents JOIN crc USING (doc_id)),
leaf AS (
    SELECT doc_id, coalesce('=' || source, '') AS tree, sha256({_LEAF}) AS digest, sha256({_SEEN}) AS seen,
           row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos
    FROM doc),
{_tree_sql("low", "leaf")},
tops AS (SELECT '' AS tree, tree AS source, root AS digest, row_number() OVER (ORDER BY tree) - 1 AS pos FROM low_root),
{_tree_sql("high", "tops")},
told AS (
    SELECT doc_id, leaf.digest AS leaf, seen, tops.digest AS subroot, root, list_concat(coalesce(low_way.way, []), coalesce(high_way.way, [])) AS way
    FROM leaf JOIN tops ON tops.source = leaf.tree JOIN high_root ON true
    LEFT JOIN low_way ON low_way.tree = leaf.tree AND low_way.pos = leaf.pos LEFT JOIN high_way ON high_way.pos = tops.pos),
folded AS (
    SELECT *, CASE WHEN len(way) = 0 THEN seen ELSE
        list_reduce(way, lambda a, b: sha256(split_part(b, '|', 1) || a || split_part(b, '|', 2)), seen) END AS folded_root
    FROM told)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(way, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM folded
"""

OP13_SQL = r"""
WITH piece AS (
    SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(p, '[ \t]+'), lambda w: w <> '') AS words
    FROM documents, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS s(p)),
total AS (SELECT lang, sum(len(words)) AS n FROM piece GROUP BY lang),
f AS (
    SELECT lang, size, words[i:i + size - 1] AS words, count(*) AS f
    FROM piece, generate_series(1, 5) AS a(size), generate_series(1, len(words) - size + 1) AS b(i)
    GROUP BY ALL HAVING count(*) >= 100),
cut AS (
    SELECT c.lang, c.words, c.size, c.f AS a, l.f AS l, r.f AS r, n, k,
           (1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f) AS score
    FROM f AS c JOIN total USING (lang), generate_series(1, c.size - 1) AS s(k)
    JOIN f AS l ON l.lang = c.lang AND l.words = c.words[1:k] JOIN f AS r ON r.lang = c.lang AND r.words = c.words[k + 1:]
    WHERE c.size > 1),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
inner_part AS (
    SELECT lang, words[i:i + size - 1] AS words, max(f) AS outer_f
    FROM (SELECT lang, words, f, len(words) AS total FROM f), generate_series(2, 4) AS a(size), generate_series(1, total - size + 1) AS b(i)
    WHERE size < total GROUP BY ALL),
ranked AS (
    SELECT best.lang, array_to_string(best.words, ' ') AS phrase, a, l, r, n, score,
           row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, array_to_string(best.words, ' ')) AS rank
    FROM best LEFT JOIN inner_part ON inner_part.lang = best.lang AND inner_part.words = best.words
    WHERE outer_f IS NULL OR 100 * outer_f < 100 * a)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_warc": OP3_SQL,
        "op4_line_dedup": OP4_SQL,
        "op6_chat_format": OP6_SQL,
        "op10_jaccard_join": OP10_SQL,
        "op11_hyperminhash": OP11_SQL,
        "op12_merkle": OP12_SQL,
        "op13_phrases": OP13_SQL,
    }
