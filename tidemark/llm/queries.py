"""The registered queries of the subpackage and, where SQL can state them, their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, chat, fingerprint, neardup, packing, pii, secret_scan, topk, toxicity, warc
from tidemark.llm.shared import table

#: The conversation added to ``conversations``: both of its texts look like control strings.
TRICKY = r"\### Assistant: </turn> ok"


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op2_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk.quantise(table(spark, sf_dir, "embeddings"))
    return topk.top_k(rows, rows.filter(F.col("vec_id") % 100 == 0))


def op3_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.explode(F.arrays_zip(F.array(F.lit(0), F.lit(1)).alias("turn"), F.array(F.lit("user"), F.lit("assistant")).alias("role"))).alias("x"),
    )
    own = own.select("conv_id", F.col("x.turn").cast("long").alias("turn"), "x.role", F.lit(TRICKY).alias("text"))
    return chat.chat_digests(rows.unionByName(own))


def op10_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_bit_sliced_topk": op2_bit_sliced_topk,
    "op3_bag_minhash": op3_bag_minhash,
    "op4_toxicity": op4_toxicity,
    "op5_fingerprint": op5_fingerprint,
    "op6_pii": op6_pii,
    "op7_packing": op7_packing,
    "op8_secret_scan": op8_secret_scan,
    "op9_chat_format": op9_chat_format,
    "op10_warc_archive": op10_warc_archive,
}


def _spans_sql(regex: str, group: int, kind: int, least: int) -> str:
    """DuckDB: the spans of a rule in ``text``, from the pieces between its matches."""
    r = regex.replace("'", "''")
    return f"""(SELECT coalesce(list({{'start': s, 'kind': {kind}, 'end': s + length(m)}} ORDER BY s) FILTER (length(g) >= {least}), [])
      FROM (SELECT m, g, sum(length(p)) OVER (ORDER BY i) + coalesce(sum(length(m)) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
        FROM (SELECT unnest(ms) AS m, unnest(gs) AS g, unnest(ps[1:len(ms)]) AS p, unnest(range(len(ms))) AS i
          FROM (SELECT regexp_extract_all(d.t, '{r}') AS ms, regexp_extract_all(d.t, '{r}', {group}) AS gs, string_split_regex(d.t, '{r}') AS ps))))"""


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_ASSIGN = "(" + "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _any_case("api") + "_?" + _any_case("key") + r")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
_SQL_RULES = [
    ("assign", _ASSIGN, 2, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]+", 0, 16),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("pem", "-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----", 0, 1),
]
_KINDS = ", ".join(f"'{k[0]}'" for k in _SQL_RULES)


def _joined(spans: str) -> str:
    return f"array_to_string(list_transform(list_sort({spans}), lambda x: [{_KINDS}][x.kind + 1] || ':' || x.start || ':' || x.end), ',')"


ORACLE_SQL: dict[str, str] = {
    "op2_bit_sliced_topk": """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM e q, e c WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op8_secret_scan": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS (SELECT doc_id, {", ".join(f"{_spans_sql(r, g, i, n)} AS s{i}" for i, (_, r, g, n) in enumerate(_SQL_RULES))} FROM d)
SELECT doc_id, len(s0)::BIGINT AS n_assign, len(s1)::BIGINT AS n_access, len(s2)::BIGINT AS n_hex,
  sha256({_joined("s0 || s1 || s2")}) AS base_sha256, {_joined("s0 || s1 || s2 || s3 || s4 || s5")} AS spans
FROM f""",
    "op9_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
n AS (
  SELECT *, row_number() OVER w - 1 AS i,
    CASE coalesce(lag(role) OVER w, 'start') WHEN 'start' THEN role IN ('system', 'user') WHEN 'system' THEN role = 'user'
      WHEN 'user' THEN role = 'assistant' WHEN 'assistant' THEN role = 'user' ELSE false END AS ok,
    length(text) + length(role) + length(regexp_replace(text || role, '[^\\|]', '', 'g')) + 13 AS chars
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars, bool_and(ok) AS valid, coalesce(min(i) FILTER (NOT ok), -1)::INTEGER AS first_error
FROM n GROUP BY conv_id""",
    "op10_warc_archive": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
q AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM q)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM r""",
}
