"""Registered queries: every operator over its whole driver table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, crosspolytope, jaccard, langid, linededup, merkle, packing, quality, sharding, substrings,
               tokenbin, vectorcodes, winnow)
from .common import table
from .tokens import tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenbin.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2)


def op2_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents"))


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), with_bytes=False).drop("kept")


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def _remainder(n: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op5_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(_remainder(3) != 1)
    net = quality.fit(docs, labels.select("doc_id", F.col("quality").alias("label")))
    return quality.score(docs, net).select(
        "doc_id", F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op7_bigru_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = langid.fit(docs.filter(_remainder(4) != 2))
    return langid.identify(docs, net).select(
        "doc_id", F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op8_concat_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1, length=2048)


def op9_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0, k=5)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(planted).alias("text"))
    turns = turns.unionByName(extra).withColumn("parts", chat.text_parts(F.col("text")))
    return chat.digest(chat.read_back(chat.format_conversations(turns)))


def op11_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.manifest(table(spark, sf_dir, "documents"), sharding.even(8), sharding.even(9))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    cut = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    altered = F.when(_remainder(2) == 0, merkle.record_digest(*fields[:-1], cut))
    built = merkle.build(docs, merkle.record_digest(*fields), tree="source", order="doc_id", altered=altered)
    return merkle.prove(built).select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256",
                                      "folded_root", "verified")


def op13_cover_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vectorcodes.compress(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6)
    return vectorcodes.with_label_error(coded, F.struct("id", "code")).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error",
        F.lit(vectorcodes.books_digest(books)).alias("codebooks_sha256"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_token_shards, op2_fuzzy_lines, op3_suffix_array, op4_winnowing, op5_byte_cnn, op6_ngram_jaccard,
        op7_bigru_langid, op8_concat_packing, op9_cross_polytope, op10_chat_format, op11_rendezvous_shards,
        op12_merkle_manifest, op13_cover_tree_codes)}


_OP10_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, replace(replace(replace(text, chr(27), chr(27) || 'e'), '<|', chr(27) || 'l|'), '|>', chr(27) || 'r>') AS etext,
         replace(replace(replace(role, chr(27), chr(27) || 'e'), '<|', chr(27) || 'l|'), '|>', chr(27) || 'r>') AS erole
  FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(erole) + length(etext) + 16) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP4_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS span, array_to_string(ws[p:p + least(len(ws), 10) - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS p FROM i WHERE len(ws) > 0)),
dw AS (
  SELECT r, span, p, array_to_string(ws[p:p + span - 1], ' ') AS w
  FROM (SELECT r, ws, span, unnest(range(1, len(ws) - span + 2)) AS p
        FROM d, (SELECT DISTINCT span FROM iw) WHERE len(ws) >= span)),
h AS (SELECT r, p, dw.span, item_id FROM dw JOIN iw USING (span, w)),
c AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(p, p + span)) AS x FROM h) GROUP BY r),
n AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
      FROM (SELECT DISTINCT r, item_id FROM h) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN n USING (r)
"""

_OP6_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p:p + 4], ' ') AS t
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - 3, 2))) AS p FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT t FROM s GROUP BY t HAVING count(*) > 1),
r AS (SELECT s.* FROM s SEMI JOIN shared USING (t)),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM r a JOIN r b ON a.t = b.t AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
c(node, seen) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT l.b, c.seen FROM c JOIN l ON l.a = c.node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(seen) FROM c WHERE c.node = d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id)
"""

_OP3_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
s AS (
  SELECT r, doc_id, p, md5(substr(x, 2 * p + 1, 100)) AS w
  FROM (SELECT *, unnest(range(0, len(x) // 2 - 49)) AS p FROM d WHERE len(x) >= 100)),
hit AS (
  SELECT r, p FROM (SELECT r, p, doc_id, min(doc_id) OVER (PARTITION BY w) AS m FROM s) WHERE m < doc_id),
run AS (
  SELECT r, p, p > 50 + lag(p) OVER (PARTITION BY r ORDER BY p) AS fresh FROM hit),
num AS (SELECT r, p, sum(coalesce(fresh, true)::INT) OVER (PARTITION BY r ORDER BY p) AS k FROM run),
span AS (SELECT r, k, min(p) AS a, max(p) + 50 AS b FROM num GROUP BY r, k),
cut AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS z FROM span),
agg AS (
  SELECT cut.r, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS e,
         string_agg(substr(x, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS kept
  FROM cut JOIN d USING (r) GROUP BY cut.r)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN x ELSE kept || substr(x, 2 * e + 1) END)) AS kept_sha256
FROM d LEFT JOIN agg USING (r)
"""


def _crc_table() -> list[int]:
    """Remainders of the bytes for the reflected polynomial of CRC-32."""
    out = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        out.append(byte)
    return out


def _crc_sql(text: str) -> str:
    """DuckDB expression: unsigned CRC-32 of the UTF-8 bytes of ``text``; needs ``crc(tab)`` in FROM."""
    data = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), "
            "lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])), 4294967295)")


_OP11_SQL = f"""
WITH crc AS (SELECT {_crc_table()}::BIGINT[] AS tab),
d AS (
  SELECT row_number() OVER () AS r, doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size,
         {_crc_sql("coalesce(text, '')")} AS text_crc32
  FROM documents, crc),
draw AS (
  SELECT r, s, substr(md5(coalesce('=' || doc_id, 'null') || '@' || s), 1, 13) AS u
  FROM d, (SELECT unnest(range(9)) AS s)),
pick AS (
  SELECT r, CAST(arg_max(s, u) FILTER (s < 8) AS INTEGER) AS shard, CAST(arg_max(s, u) AS INTEGER) AS grown_shard
  FROM draw GROUP BY r)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), 'null'), size, text_crc32, pos)),
                          doc_id NULLS FIRST, size, text_crc32) - 1 AS slot
FROM (SELECT *, (row_number() OVER (PARTITION BY doc_id, size, text_crc32) - 1) // 10000 * 10000 AS pos FROM d)
JOIN pick USING (r)
"""


def _field_sql(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE octet_length(encode(CAST({x} AS VARCHAR))) || ':' || CAST({x} AS VARCHAR) END"


_HEAD = " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars"))
_OP12_SQL = f"""
WITH RECURSIVE crc AS (SELECT {_crc_table()}::BIGINT[] AS tab),
d AS (
  SELECT doc_id, coalesce('=' || source, '') AS s, sha256({_HEAD} || {_field_sql("text")}) AS leaf,
         CASE WHEN {_crc_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0
              THEN sha256({_HEAD} || {_field_sql("replace(text, chr(10), '')")}) END AS altered
  FROM documents, crc),
leaves AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k FROM d),
tree AS (
  SELECT s, 0 AS lvl, k, leaf AS h FROM leaves
  UNION ALL
  SELECT s, lvl + 1, k // 3, sha256(string_agg(h, '' ORDER BY k))
  FROM (SELECT *, count(*) OVER (PARTITION BY s) AS c FROM tree) WHERE c > 1 GROUP BY s, lvl, k // 3),
height AS (SELECT s, max(lvl) AS top FROM tree GROUP BY s),
subroots AS (
  SELECT s, h, top, row_number() OVER (ORDER BY encode(s)) - 1 AS k FROM tree JOIN height USING (s) WHERE lvl = top),
crown AS (
  SELECT 0 AS lvl, k, h FROM subroots
  UNION ALL
  SELECT lvl + 1, k // 3, sha256(string_agg(h, '' ORDER BY k))
  FROM (SELECT *, count(*) OVER () AS c FROM crown) WHERE c > 1 GROUP BY lvl, k // 3),
root AS (SELECT h AS root, lvl AS top FROM crown ORDER BY lvl DESC LIMIT 1),
walk AS (
  SELECT s, k, doc_id, leaf, coalesce(altered, leaf) AS h, 0 AS lvl, k AS at, '' AS proof FROM leaves
  UNION ALL
  SELECT w.s, w.k, any_value(doc_id), any_value(leaf),
         sha256(string_agg(CASE WHEN t.k = w.at THEN w.h ELSE t.h END, '' ORDER BY t.k)), w.lvl + 1, any_value(w.at // 3),
         any_value(proof) || coalesce(string_agg(t.h, '' ORDER BY t.k) FILTER (t.k <> w.at), '')
  FROM walk w JOIN height USING (s) JOIN tree t ON t.s = w.s AND t.lvl = w.lvl AND t.k // 3 = w.at // 3
  WHERE w.lvl < height.top GROUP BY w.s, w.k, w.lvl),
climb AS (
  SELECT w.s, w.k, doc_id, leaf, b.h AS subroot, w.h, 0 AS lvl, b.k AS at, proof
  FROM walk w JOIN subroots b ON b.s = w.s AND b.top = w.lvl
  UNION ALL
  SELECT w.s, w.k, any_value(doc_id), any_value(leaf), any_value(subroot),
         sha256(string_agg(CASE WHEN t.k = w.at THEN w.h ELSE t.h END, '' ORDER BY t.k)), w.lvl + 1, any_value(w.at // 3),
         any_value(proof) || coalesce(string_agg(t.h, '' ORDER BY t.k) FILTER (t.k <> w.at), '')
  FROM climb w CROSS JOIN root JOIN crown t ON t.lvl = w.lvl AND t.k // 3 = w.at // 3
  WHERE w.lvl < root.top GROUP BY w.s, w.k, w.lvl)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, climb.h AS folded_root, climb.h = root AS verified
FROM climb JOIN root ON climb.lvl = root.top
"""


def _op13_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, part, any_value(x) AS x, min({{'d': d, 'e': entry}}) AS best
  FROM (SELECT r, p.part, p.x, entry, list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM p JOIN b{i} b ON p.part = b.part) GROUP BY r, part)""")
        if i < rounds:
            steps.append(f"""
b{i + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(n.x, b.x) AS x FROM b{i} b LEFT JOIN (
    SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS x
    FROM (SELECT part, best.e AS entry, pos, sum(c)::BIGINT AS s, count(*) AS n
          FROM (SELECT part, best, unnest(x) AS c, generate_subscripts(x, 1) AS pos FROM a{i}) GROUP BY ALL)
    GROUP BY part, entry) n USING (part, entry))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r, vec_id, label,
         list_transform(embedding, lambda c: CAST(floor(4096 * CAST(c AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
p AS MATERIALIZED (
  SELECT r, part, w[part * (len(w) // {parts}) + 1:(part + 1) * (len(w) // {parts})] AS x
  FROM kept, (SELECT unnest(range({parts})) AS part)),
b0 AS MATERIALIZED (SELECT part, r AS entry, x FROM p WHERE r < {entries}),{",".join(steps)},
code AS (
  SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
  FROM a{rounds} GROUP BY r),
digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN code USING (r), digest
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_suffix_array": _OP3_SQL, "op4_winnowing": _OP4_SQL, "op6_ngram_jaccard": _OP6_SQL,
            "op10_chat_format": _OP10_SQL, "op11_rendezvous_shards": _OP11_SQL,
            "op12_merkle_manifest": _OP12_SQL, "op13_cover_tree_codes": _op13_sql()}
