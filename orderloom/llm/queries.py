"""The registered queries of this folder and their SQL forms."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (
    bloomlm, crf, decontaminate, linededup, mixing, pii, prefixtrie, quality, runs, simhash, tokens, vptree, warc,
)
from orderloom.llm.common import table
from orderloom.session import run_dir

Query = Callable[[SparkSession, str], DataFrame]

END_ID = 2


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_crf_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = crf.extract(pages).select("page_id", "url", "text")
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op2_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "token_shards")
    docs = table(spark, sf_dir, "documents")
    manifest = tokens.write_shards(docs, path, tokenizer_path(), END_ID, special_as_text=False)
    return tokens.decoded(spark, path, manifest)


def op3_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloomlm.score(table(spark, sf_dir, "documents"), bloomlm.held_out())


def op4_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "warc")
    warc.write_pages(table(spark, sf_dir, "pages"), path, min_bytes=0)
    records = warc.read_records(spark, path)

    def page(urn: str) -> Column:
        return F.split(urn, ":")[2].try_cast("long")

    return records.select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        page("refers_to").alias("refers_to"),
        "problem",
    )


def op5_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.poisson_mix(table(spark, sf_dir, "documents"))


def op6_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", simhash.hex_of("fp").alias("fingerprint"), "component_id")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "leak.n_words",
        "leak.n_hit",
        F.size("leak.items").cast("long").alias("n_items"),
        decontaminate.items_digest("leak.items").alias("items_sha256"),
        (F.col("leak.n_hit") > 0).alias("contaminated"),
    )


def op8_vantage_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vptree.nearest(vectors, F.col("vec_id") % 20 == 0, k=20, factor=1.0)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.with_score(docs, model).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[pii.counted(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.digest(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.digest(F.concat("base", "added")).alias("spans"),
    )


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = linededup.LineIndex(spark, run_dir(spark, "line_index"))
    lines = index.add(docs)
    return index.clean(docs, lines=lines).select(
        "doc_id", "cleaned.n_lines", "cleaned.n_dropped", F.sha2(F.col("cleaned.kept").cast("binary"), 256).alias("kept_sha256")
    )


def folded(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's words: those of every tenth document repeat from some word on."""
    h = 1 if doc_id is None else crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # The greatest length, then the least start, then the least period.
    best = F.array_max(F.transform("found.runs", lambda r: F.struct(r.length, (-r.start).alias("s"), (-r.period).alias("p"))))
    rows = F.transform("found.runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    digest = F.concat(F.array_join(rows, "\n"), F.when(F.size(rows) > 0, "\n").otherwise(""))
    return runs.find_runs(docs, prepare=folded).withColumn("best", best).select(
        "doc_id",
        F.size("found.runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2(digest.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("found.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return prefixtrie.statistics(prefixtrie.rebuilt(turns))


QUERIES: dict[str, Query] = {
    "op1_crf_main_text": op1_crf_main_text,
    "op2_token_shards": op2_token_shards,
    "op3_bloom_lm": op3_bloom_lm,
    "op4_warc_segments": op4_warc_segments,
    "op5_poisson_mix": op5_poisson_mix,
    "op6_simhash_near_duplicates": op6_simhash_near_duplicates,
    "op7_decontaminate": op7_decontaminate,
    "op8_vantage_point_search": op8_vantage_point_search,
    "op9_quality": op9_quality,
    "op10_pii": op10_pii,
    "op11_line_dedup": op11_line_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_prefix_trie": op13_prefix_trie,
}

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE: dict[str, str] = {
    "op4_warc_segments": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
  (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
     ((('0x' || substr(h, (5 * i) // 4 + 1, 2))::INT >> (3 - (5 * i) % 4)) & 31) + 1, 1), '' ORDER BY i)
   FROM unnest(range(32)) AS t(i)) AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to,
  NULL::VARCHAR AS problem
FROM m
""",
    "op5_poisson_mix": r"""
WITH src AS (
  SELECT source, count(*) AS n, sum(length(coalesce(text, '')) + 1) AS size FROM documents GROUP BY source),
rate AS (
  SELECT source, sqrt(size) / (SELECT sum(sqrt(size)) FROM src) * (SELECT sum(size) FROM src) / size AS r
  FROM src),
part AS (SELECT source, ceil(r / 32)::INT AS m, r / ceil(r / 32) AS mean FROM rate WHERE r > 0),
cdf AS (
  SELECT source, sum(exp(k * ln(mean) - mean - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS c
  FROM part, (SELECT unnest(range(0, 130)) AS k)),
num AS (
  SELECT d.doc_id, text, lang, d.source, n_chars, p.source AS src, j,
    ('0x' || substr(md5('poisson|42|' || coalesce(doc_id::VARCHAR, '') || '|' || j), 1, 13))::BIGINT
    / 4503599627370496.0::DOUBLE AS u
  FROM documents d JOIN part p ON d.source IS NOT DISTINCT FROM p.source, unnest(range(1, p.m + 1)) AS t(j)),
cnt AS (
  SELECT num.doc_id, text, lang, num.source, n_chars, sum((c <= u)::INT)::INT AS copies
  FROM num JOIN cdf ON num.src IS NOT DISTINCT FROM cdf.source GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy,
  md5('order|42|' || coalesce(doc_id::VARCHAR, '') || '|' || copy) AS shuffle_key
FROM cnt, unnest(range(1, copies + 1)) AS t(copy)
""",
    "op7_decontaminate": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
    regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
iw AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
dw AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM d, (SELECT DISTINCT n FROM iw), unnest(range(1, len(w) - n + 2)) AS t(i)),
m AS (SELECT r, i, n, item FROM dw JOIN iw USING (n, win)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM m, unnest(range(i, i + n)) AS t(p) GROUP BY r),
it AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM m GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
""",
    "op11_line_dedup": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
l AS (
  SELECT r, doc_id, i, line, trim(translate(line, {_LETTERS}), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k
  FROM (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
        FROM d)),
k AS (
  SELECT k, count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) AS n, max(doc_id) AS last
  FROM l WHERE length(k) >= 20 GROUP BY k HAVING n >= 3),
m AS (SELECT l.*, k.k IS NOT NULL AND l.doc_id IS DISTINCT FROM k.last AS gone FROM l LEFT JOIN k ON l.k = k.k)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
""",
    "op13_prefix_trie": """
WITH t AS (
  SELECT conv_id AS c, coalesce(text, '') AS text,
    md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT c, c - c % 5 AS b, list(struct_pack(x := x, n := strlen(text)) ORDER BY i) AS w,
    xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
      lambda a, y: list_reduce(list_prepend(xor(a, y), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda z, u: xor(z >> 1, 3988292384::BIGINT * (z & 1))))) % 9 AS h
  FROM t GROUP BY c),
made AS (
  SELECT a.c, list_concat(coalesce(p.w[1:a.h], []), a.w[a.h + 1:]) AS w FROM own a LEFT JOIN own p ON p.c = a.b),
pre AS (
  SELECT c, d, len(w) AS len, coalesce(w[d].n, 0) AS n,
    array_to_string(list_transform(w[1:d], lambda s: s.x), '') AS k
  FROM made, unnest(range(0, len(w) + 1)) AS q(d)),
node AS (
  SELECT k, any_value(d) AS d, any_value(n) AS n, count(*) AS m, min(c) AS c,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = len), '')) AS ends
  FROM pre GROUP BY k),
kids AS (SELECT left(k, (32 * (d - 1))::INT) AS k, count(*) AS kids FROM node WHERE d > 0 GROUP BY 1),
full_ AS (SELECT node.*, coalesce(kids, 0) AS kids, (m - 1) * n AS own FROM node LEFT JOIN kids USING (k)),
below AS (
  SELECT left(k, (32 * j)::INT) AS k, sum((kids = 0)::INT) AS leaves, sum(own) AS saved
  FROM full_, unnest(range(0, d + 1)) AS q(j) GROUP BY 1)
SELECT f.c AS conv_id, f.d AS depth, up.c AS parent_conv_id, f.m AS n_convs, f.kids AS n_children,
  leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, f.ends AS ends_sha256
FROM full_ f JOIN below USING (k) LEFT JOIN node up ON f.d > 0 AND up.k = left(f.k, (32 * (f.d - 1))::INT)
""",
    "op8_vantage_point_search": """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND list_min(list_transform(embedding, lambda x: coalesce(isfinite(x), false)::INT)) = 1
    AND list_max(list_transform(embedding, lambda x: (x <> 0)::INT)) = 1),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20
""",
}
