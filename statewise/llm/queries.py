"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_format import chat_digests, format_chats
from .common import table
from .decontaminate import leaks
from .fingerprints import fingerprint_edits
from .licenses import scan_licenses
from .lm_score import score_corpus
from .merkle import manifest, tamper
from .mixing import mix_sources
from .near_dedup import near_groups
from .repeats import remove_repeats
from .sharding import shard_by_bytes
from .suffix_dedup import remove_repeated_bytes
from .token_alignment import align_tokenizers
from .toxicity import score_toxicity

#: A text full of control strings, formatted beside the conversations of the table.
TRAP = r"\### Assistant: </turn> ok"


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))[0]


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_corpus(table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.range(2).selectExpr(
        "-7L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role", f"r'{TRAP}' AS text"
    )
    return chat_digests(format_chats(turns.unionByName(trap)))


def op5_shard_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"))


def op6_scan_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op7_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("hamming")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return manifest(docs, tampered=tamper(F.col("doc_id"), F.col("text"))).proofs().drop("proof")


#: Where the public tokenizers lie on the driver's machine.
TOKENIZERS = "/opt/tokenizers"


def op12_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return align_tokenizers(docs, f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")[0]


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_near_dedup,
        op2_toxicity,
        op3_lm_score,
        op4_chat_format,
        op5_shard_by_bytes,
        op6_scan_licenses,
        op7_remove_repeats,
        op8_fingerprints,
        op9_mix_sources,
        op10_decontaminate,
        op11_merkle_manifest,
        op12_align_tokenizers,
        op13_suffix_dedup,
    )
}

OP1_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM docs WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached(a, b) AS (
  SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reached r JOIN both_ways l ON r.b = l.a
), least AS (
  SELECT a, min(b) AS b FROM reached GROUP BY a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, b) AS component_id, d.doc_id = least(d.doc_id, b) AS kept
FROM docs d LEFT JOIN sizes s ON d.doc_id = s.doc_id LEFT JOIN least ON d.doc_id = a
"""

OP7_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs WHERE len(w) >= 13)
), firsts AS (
  SELECT s, min(doc_id) AS first_id FROM windows GROUP BY s
), removed AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM windows JOIN firsts USING (s) WHERE first_id < doc_id
), placed AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM docs
), kept AS (
  SELECT x.doc_id, count(*) AS n, string_agg(w[x.p], ' ' ORDER BY x.p) AS text FROM placed x ANTI JOIN removed r ON x.doc_id = r.doc_id AND x.p = r.p
  GROUP BY x.doc_id
)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

OP4_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), sized AS (
  SELECT *, replace(replace(role, '\', '\\'), '<', '\l') AS role_out, replace(replace(text, '\', '\\'), '<', '\l') AS text_out,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(length(text_out) + CASE WHEN before = role THEN 8 ELSE 18 + length(role_out) END) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP9_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM docs GROUP BY source
), capped AS (
  SELECT *, source_size * 3 AS cap, CAST(source_size * 3 AS DOUBLE) / weight AS ratio FROM sources
), levels AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM capped
), targets AS (
  SELECT source, source_size, least(max(CASE WHEN level <= ratio THEN level END) OVER () * weight, CAST(cap AS DOUBLE)) AS target
  FROM levels
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets
), drawn AS (
  SELECT d.*, r.source_size, r.target, r.whole, r.target - r.whole * r.source_size AS part,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key) AS upto
  FROM docs d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
), cut AS (
  SELECT source, max(key) AS last_key FROM drawn WHERE part > 0 AND upto - size / 2.0 <= part GROUP BY source
)
SELECT d.doc_id, d.size, d.source_size, d.target,
  d.size * (d.whole + CASE WHEN d.key <= c.last_key THEN 1 ELSE 0 END) AS taken,
  CAST(d.whole + CASE WHEN d.key <= c.last_key THEN 1 ELSE 0 END AS INTEGER) AS epochs
FROM drawn d LEFT JOIN cut c ON d.source IS NOT DISTINCT FROM c.source
"""

OP10_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark
), doc_words AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w
  FROM documents
), item_sh AS (
  SELECT item_id, len(w) AS n_words, array_to_string(w[i:i + 4], ' ') AS sh
  FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM item_words WHERE len(w) >= 5)
), item_count AS (
  SELECT item_id, n_words, sh, count(*) AS n FROM item_sh GROUP BY ALL
), doc_sh AS (
  SELECT row, doc_id, len(w) AS n, i - 1 AS p, array_to_string(w[i:i + 4], ' ') AS sh
  FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM doc_words WHERE len(w) >= 5)
), met AS (
  SELECT DISTINCT d.row, d.doc_id, d.n, d.p, i.item_id, i.n_words FROM doc_sh d JOIN item_count i USING (sh)
), windows AS (
  SELECT DISTINCT row, doc_id, item_id, n_words,
    unnest(range(greatest(0, p - n_words + 5), least(p, greatest(0, n - n_words)) + 1)) AS start
  FROM met
), window_count AS (
  SELECT v.row, v.doc_id, v.item_id, v.n_words, v.start, d.sh, count(*) AS n
  FROM windows v JOIN doc_sh d ON d.row = v.row AND d.p >= v.start AND d.p <= v.start + v.n_words - 5
  GROUP BY ALL
), weighed AS (
  SELECT v.doc_id, v.item_id, v.n_words, v.start, v.row, sum(v.n) AS window_weight, sum(least(v.n, coalesce(i.n, 0))) AS common
  FROM window_count v LEFT JOIN item_count i ON i.item_id = v.item_id AND i.sh = v.sh
  GROUP BY ALL
), alike AS (
  SELECT *, CAST(common AS DOUBLE) / (window_weight + n_words - 4 - common) AS similarity FROM weighed
  WHERE 100 * common >= 80 * (window_weight + n_words - 4 - common)
)
SELECT doc_id, item_id, similarity, CAST(start AS INTEGER) AS start, CAST(n_words AS INTEGER) AS n_words FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) AS place FROM alike
) WHERE place = 1
"""

OP11_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, lang, coalesce('=' || lang, '') AS g, text, crc32_hit, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
    sha256(head || CASE WHEN text IS NULL THEN '-' WHEN crc32_hit THEN strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
      ELSE strlen(text) || ':' || text END) AS found
  FROM (
    SELECT *, coalesce(xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT), lambda a, c:
        list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, b: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 3 = 0, false) AS crc32_hit,
      coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head
    FROM documents)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM docs
), tree(g, level, i, h, n) AS (
  SELECT g, 0, i, leaf, n FROM placed
  UNION ALL
  SELECT g, level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 7) // 8 FROM tree WHERE n > 1 GROUP BY g, level, i // 8
), subroots AS (
  SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1
), top(level, i, h, n) AS (
  SELECT 0, i, h, n FROM subroots
  UNION ALL
  SELECT level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 7) // 8 FROM top WHERE n > 1 GROUP BY level, i // 8
), heights AS (
  SELECT g, max(level) AS height FROM tree GROUP BY g
), runs AS (
  SELECT g, level, i // 8 AS run, list(h ORDER BY i) AS hs FROM tree WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT x.g, height + level, t.i // 8, list(t.h ORDER BY t.i) FROM top t, heights x WHERE t.n > 1 GROUP BY x.g, height, level, t.i // 8
), folded(g, i, level, spot, h, proof) AS (
  SELECT g, i, 0, i, found, '' FROM placed
  UNION ALL
  SELECT f.g, f.i, f.level + 1, CASE WHEN f.level + 1 = height THEN s.i ELSE f.spot // 8 END,
    sha256(array_to_string(hs[:f.spot % 8] || [f.h] || hs[f.spot % 8 + 2:], '')),
    proof || array_to_string(hs[:f.spot % 8] || hs[f.spot % 8 + 2:], '')
  FROM (
    SELECT f.g, f.i, f.level, CASE WHEN f.level = 0 AND height = 0 THEN s.i ELSE f.spot END AS spot, f.h, f.proof
    FROM folded f JOIN heights USING (g) JOIN subroots s USING (g)
  ) f JOIN heights USING (g) JOIN subroots s USING (g) JOIN runs r ON r.g = f.g AND r.level = f.level AND r.run = f.spot // 8
), ends AS (
  SELECT g, i, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM folded GROUP BY g, i
)
SELECT p.doc_id, p.leaf, s.h AS subroot, t.h AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root, e.h = t.h AS verified
FROM placed p JOIN subroots s USING (g) JOIN ends e ON e.g = p.g AND e.i = p.i, (SELECT h FROM top WHERE n = 1) t
"""


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS h FROM documents
), windows AS (
  SELECT r, p, md5_number(h[p + 1:p + 200]) AS w
  FROM (SELECT r, h, unnest(range(octet_length(h) - 199)) AS p FROM docs WHERE octet_length(h) >= 200)
), repeated AS (
  SELECT w FROM windows GROUP BY w HAVING count(*) > 1
), hits AS (
  SELECT r, p, coalesce(p > lag(p) OVER (PARTITION BY r ORDER BY p) + 200, true) AS first FROM windows SEMI JOIN repeated USING (w)
), spans AS (
  SELECT r, min(p) AS a, max(p) + 200 AS b
  FROM (SELECT r, p, sum(first::INTEGER) OVER (PARTITION BY r ORDER BY p) AS span FROM hits) GROUP BY r, span
), gaps AS (
  SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS upto FROM spans
), cut AS (
  SELECT g.r, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last, string_agg(hex(h[upto + 1:a]), '' ORDER BY a) AS kept
  FROM gaps g JOIN docs USING (r) GROUP BY g.r
)
SELECT doc_id, octet_length(h) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || hex(h[coalesce(last, 0) + 1:octet_length(h)]))) AS kept_sha256
FROM docs LEFT JOIN cut ON docs.r = cut.r
"""

SQL: dict[str, str] = {
    "op11_merkle_manifest": OP11_SQL,
    "op13_suffix_dedup": OP13_SQL,
    "op1_near_dedup": OP1_SQL,
    "op7_remove_repeats": OP7_SQL,
    "op4_chat_format": OP4_SQL,
    "op9_mix_sources": OP9_SQL,
    "op10_decontaminate": OP10_SQL,
}
