"""Registered queries of the training-data operators and their DuckDB SQL.

Every query applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hourglass.llm import (align, bpe, language_id, license_scan, mixing, ngram_join, secret_scan, sharding, suffix_dedup, topk,
                           toxicity, weak_quality, whitening)
from hourglass.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build
    return register


@query("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digest(table(spark, sf_dir, "documents"))


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_sharding", f"""
WITH r AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents
), b AS (
  SELECT d, h >> (60 - d) AS p, sum(n_bytes) AS bytes, min(h) = max(h) AS one
  FROM r, range(0, 61) x(d) GROUP BY ALL
), f AS (
  SELECT r.doc_id, r.n_bytes, r.h, min(b.d) AS d
  FROM r JOIN b ON b.p = r.h >> (60 - b.d)
  WHERE b.bytes <= {sharding.SHARD_BYTES} OR b.one GROUP BY ALL
)
SELECT f.doc_id, CAST(f.n_bytes AS BIGINT) AS n_bytes,
       CASE WHEN f.d = 0 THEN '' ELSE lpad(bin(f.h >> (60 - f.d)), CAST(f.d AS INTEGER), '0') END AS shard,
       CAST(f.d AS INTEGER) AS depth, CAST(0 AS INTEGER) AS chain, CAST(b.bytes AS BIGINT) AS bucket_bytes
FROM f JOIN b ON b.d = f.d AND b.p = f.h >> (60 - f.d)
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


@query("op4_topk", """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(topk.quantize(table(spark, sf_dir, "embeddings")))
    return found.select("query_id", "rank", "vec_id", "score")


_WORD5 = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TEMPLATES = ", ".join(f"('{k}', list_distinct(string_split('{v}', ' ')), "
                       f"{license_scan.needed(len(set(v.split())), license_scan.THRESHOLD)})"
                       for k, v in sorted(license_scan.TEMPLATES.items()))
_PLACES = ", ".join(
    "(SELECT list({'i': i, 'label': '%s'}) FROM range(0, len(w) - %d) g(i) WHERE %s)"
    % (label, len(p.split()) - 1, " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(p.split())))
    for p, label in license_scan.PHRASES.items())


@query("op5_license_scan", f"""
WITH t AS (
  SELECT row_number() OVER () AS k, doc_id, lower(coalesce(text, '')) AS t FROM documents
), w AS (
  SELECT k, doc_id, t, regexp_extract_all(t, '{_WORD5}') AS w FROM t
), p AS (
  SELECT k, doc_id, len(w) AS n_words, list_filter(flatten([{_PLACES}]), lambda x: x IS NOT NULL) AS places FROM w
), blocks AS (
  SELECT k, list_distinct(regexp_extract_all(line, '{_WORD5}')) AS b
  FROM (SELECT k, unnest(string_split(t, chr(10))) AS line FROM t)
), templates(label, words, need) AS (VALUES {_TEMPLATES}
), m AS (
  SELECT k, label, max(len(list_intersect(b, words)) / len(words)) AS c FROM blocks, templates
  WHERE len(list_intersect(b, words)) >= need GROUP BY ALL
), g AS (
  SELECT k, list(label) AS more, max(c) AS c FROM m GROUP BY k
)
SELECT p.doc_id, n_words, len(places) AS n_base,
       list_min(list_transform(places, lambda x: x.i)) AS first_word,
       list_max(list_transform(places, lambda x: x.i)) AS last_word,
       array_to_string(list_sort(list_distinct(list_transform(places, lambda x: x.label))), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(list_transform(places, lambda x: x.label),
                                                           coalesce(more, [])))), ',') AS labels,
       CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(g.c, 0.0)::DOUBLE END AS score
FROM p LEFT JOIN g USING (k)
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


@query("op7_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digest(table(spark, sf_dir, "documents"))


@query("op8_weak_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = weak_quality.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", "probability")


@query("op9_mixing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op10_ngram_join", """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), g AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i + 1:i + 5], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 4, 1))) AS i FROM w WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM w
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.component_ids(table(spark, sf_dir, "documents"))


@query("op11_align")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents"))


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def _secret_spans(kind: int) -> str:
    """Matches of one kind with their places: lengths of the pieces between matches and of the matches, summed up."""
    pattern = (secret_scan.PATTERNS[kind] if kind in (0, 3, 5) else
               secret_scan.PATTERNS[kind].replace("AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{14,}").replace(
                   "]+", "]{%d,}" % secret_scan.LEAST[kind])).replace("'", "''")
    group = 2 if kind in (0, 3) else 0
    mixed = " AND regexp_matches(x, '[0-9]') AND regexp_matches(x, '[A-Z]') AND regexp_matches(x, '[a-z]')" if kind == 4 else ""
    return f"""
SELECT r, {kind} AS kind, s, s + length(x) AS e FROM (
  SELECT r, xs[i] AS x, gs[i] AS g,
         CAST(list_sum(list_transform(ps[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(xs[1:i - 1], lambda p: length(p))), 0)
              AS BIGINT) AS s
  FROM (SELECT r, xs, gs, ps, unnest(range(1, len(xs) + 1)) AS i FROM (
    SELECT r, regexp_extract_all(t, '{pattern}') AS xs, regexp_extract_all(t, '{pattern}', {group}) AS gs,
           regexp_split_to_array(t, '{pattern}') AS ps FROM d) a) b) c
WHERE length(g) >= {secret_scan.LEAST[kind]}{mixed}"""


_ROLE13 = "CASE kind " + " ".join(f"WHEN {k} THEN {r}" for k, r in enumerate(secret_scan.ROLES)) + " END"
_NAME13 = "CASE kind " + " ".join(f"WHEN {k} THEN '{n}'" for k, n in enumerate(secret_scan.KINDS)) + " END"


@query("op13_secret_scan", f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), found AS MATERIALIZED ({" UNION ALL ".join(_secret_spans(k) for k in range(len(secret_scan.KINDS)))}
), base AS (
  SELECT * FROM found WHERE kind < {secret_scan.BASE}
), parts AS MATERIALIZED (
  SELECT f.r, f.kind, f.s, f.e, {_ROLE13} AS role,
         (length(left(t, f.s)) - length(replace(left(t, f.s), chr(10) || chr(10), ''))) // 2 AS para
  FROM found f JOIN d USING (r)
  WHERE f.kind < {secret_scan.BASE} OR NOT EXISTS (SELECT 1 FROM base b WHERE b.r = f.r AND b.s < f.e AND b.e > f.s)
), linked AS (
  SELECT w.r, w.kind, w.s, w.e FROM parts w JOIN parts o ON o.r = w.r AND o.para = w.para AND o.role <> w.role
    AND o.s < w.e + {secret_scan.REACH} AND o.e > w.s - {secret_scan.REACH}
  WHERE w.kind >= {secret_scan.BASE} GROUP BY ALL
  HAVING bool_or(o.kind <= 1) OR count(DISTINCT o.role) = 2
), every AS (
  SELECT * FROM base UNION ALL SELECT * FROM linked
), g AS (
  SELECT r, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
         count(*) FILTER (WHERE kind = 2) AS n_hex, count(*) FILTER (WHERE kind >= {secret_scan.BASE}) AS n_linked,
         string_agg({_NAME13} || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (WHERE kind < {secret_scan.BASE}) AS base,
         string_agg({_NAME13} || ':' || s || ':' || e, ',' ORDER BY s, kind) AS spans
  FROM every GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_linked, 0) AS n_linked
FROM d LEFT JOIN g USING (r)
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))
