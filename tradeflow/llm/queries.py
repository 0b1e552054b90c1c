"""The registered queries of this subpackage, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.llm import arc_warc, attention_lm, bpe, chosen_path, kneser_ney, multiset_hash, periodic_runs, pii_crf, product_codes, quality_fm, secret_entropy, strassen_negatives, templates, vectors
from tradeflow.llm.text import remainder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Rank file and pattern of the byte-level BPE.
RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(plan: Query) -> Query:
        QUERIES[plan.__name__] = plan
        if sql is not None:
            ORACLES[plan.__name__] = sql
        return plan

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text: base patterns and spans of the conditional random field."""
    found = pii_crf.find(table(spark, sf_dir, "documents"), pii_crf.train())
    order = F.array_sort(
        F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), F.array_position(F.lit(list(pii_crf.KINDS)), s["kind"]).alias("place"), s["kind"].alias("kind"), s["end"].alias("end")))
    )
    return found.select(
        "doc_id",
        *[pii_crf.with_kind("base", kind).alias(f"n_{kind}") for kind in pii_crf.KINDS],
        F.size("added").cast("long").alias("n_added"),
        F.sha2(pii_crf.listed("base"), 256).alias("base_sha256"),
        pii_crf.listed(order).alias("spans"),
    )


@query()
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every whole text and the bytes they decode to, as digests."""
    return bpe.token_digests(table(spark, sf_dir, "documents"), RANKS, PATTERN)


@query()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factorisation-machine score of every document, learnt from rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).filter(remainder("doc_id", 5) != 0)
    scored = quality_fm.score(docs, quality_fm.train(docs, labels))
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query()
def op4_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text, its edited text and their likeness."""
    return multiset_hash.edited_pairs(table(spark, sf_dir, "documents"))


@query(
    """WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
shingled AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
         ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END) AS shingles
  FROM worded),
classes AS (
  SELECT min(doc_id) AS rep, sorted FROM (SELECT doc_id, list_sort(shingles) AS sorted FROM shingled WHERE len(shingles) > 0) GROUP BY sorted),
tokens AS (SELECT rep, len(sorted) AS n, unnest(sorted) AS s FROM classes),
common AS (
  SELECT a.rep AS a, b.rep AS b, a.n AS na, b.n AS nb, count(*) AS c
  FROM tokens a JOIN tokens b ON a.s = b.s AND a.rep < b.rep GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * c >= 85 * (na + nb - c)),
linked AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rep AS a, rep AS b FROM classes UNION SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a),
roots AS (SELECT a AS rep, min(b) AS root FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, coalesce(r.root, s.doc_id) AS component_id,
       s.doc_id = coalesce(r.root, s.doc_id) AS kept
FROM shingled s LEFT JOIN classes c ON c.sorted = list_sort(s.shingles) LEFT JOIN roots r USING (rep)"""
)
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of similarity 0.85 over three-word shingles."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return chosen_path.near_duplicates(docs, width=3, percent=85)


def _sql_spans(name: str, pattern: str, kind: str) -> str:
    """Lists of matches and of the spans ``(start, place, end, kind)`` of a pattern without look-behind."""
    place = secret_entropy.KINDS.index(kind)
    quoted = pattern.replace("'", "''")
    return f"""{name}_m AS (
  SELECT doc_id, text, regexp_extract_all(text, '{quoted}') AS m, string_split_regex(text, '{quoted}') AS g FROM texts),
{name} AS (
  SELECT doc_id, list_transform(range(1, len(m) + 1), lambda i: {{'start': CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
         + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT), 'place': {place}, 'found': m[i], 'kind': '{kind}'}}) AS s
  FROM {name}_m)"""


def _secrets_sql() -> str:
    """Patterns, then windows of candidate runs one after the other, as DuckDB SQL."""
    window = secret_entropy.WINDOW
    allowed = " OR ".join(f"regexp_matches(x.found, '{p}')" for p in secret_entropy.ALLOWED)
    bits = " ".join(f"WHEN regexp_matches(x.found, '{p}') THEN {b}" for _, p, b in secret_entropy.CLASSES)
    peak = f"list_max(list_transform(range(1, length(x.found) - {window - 2}), lambda k: list_aggregate(string_split(substr(x.found, k, {window}), ''), 'entropy')))"
    parts = [_sql_spans("assign", secret_entropy.ASSIGN, "assign"), _sql_spans("access", secret_entropy.ACCESS, "access")]
    parts += [_sql_spans("hexes", "[0-9a-f]{24,}", "hex"), _sql_spans("runs", "[A-Za-z0-9+/_=-]{20,}", "entropy")]
    value = secret_entropy.ASSIGN.replace("'", "''")
    joined = "array_to_string(list_transform({0}, lambda x: x.kind || ':' || x.start || ':' || (x.start + length(x.found))), ',')"
    return f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
{", ".join(parts)},
base AS (
  SELECT doc_id, list_sort(list_concat(list_concat(list_filter(assign.s, lambda x: length(regexp_extract(x.found, '^{value}$', 1)) >= {secret_entropy.ASSIGN_MIN}), access.s), hexes.s)) AS b
  FROM assign JOIN access USING (doc_id) JOIN hexes USING (doc_id)),
both AS (
  SELECT doc_id, b, list_filter(runs.s, lambda x: regexp_matches(x.found, '[0-9]') AND NOT ({allowed}) AND {peak} >= CASE {bits} END
         AND len(list_filter(b, lambda y: y.start < x.start + length(x.found) AND x.start < y.start + length(y.found))) = 0) AS e
  FROM base JOIN runs USING (doc_id))
SELECT doc_id, {", ".join(f"CAST(len(list_filter(b, lambda x: x.kind = '{k}')) AS BIGINT) AS n_{k}" for k in ("assign", "access", "hex"))},
       CAST(len(e) AS BIGINT) AS n_entropy, sha256({joined.format("b")}) AS base_sha256,
       {joined.format("list_sort(list_concat(b, e))")} AS spans
FROM both""".replace("both AS", "all_spans AS").replace("FROM both", "FROM all_spans")


@query(_secrets_sql())
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text: pattern matches and windows of high entropy."""
    found = secret_entropy.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[secret_entropy.count_kind("base", kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.size("added").cast("long").alias("n_entropy"),
        F.sha2(secret_entropy.joined("base"), 256).alias("base_sha256"),
        secret_entropy.joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


@query()
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text by Kneser-Ney models of the rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learn = docs.filter(remainder("doc_id", 4) != 2)
    model = kneser_ney.calibrate(kneser_ney.train(learn), learn)
    found = kneser_ney.identify(docs, model)
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "accepted")


@query(
    """WITH hexed AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
bits AS (
  SELECT *, array_to_string(list_transform(string_split(h, ''), lambda c:
         substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (instr('0123456789abcdef', c) - 1) + 1, 4)), '') AS b
  FROM hexed),
coded AS (
  SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
         + 16 * CAST(substr(b, 5 * i + 1, 1) AS INTEGER) + 8 * CAST(substr(b, 5 * i + 2, 1) AS INTEGER) + 4 * CAST(substr(b, 5 * i + 3, 1) AS INTEGER)
         + 2 * CAST(substr(b, 5 * i + 4, 1) AS INTEGER) + CAST(substr(b, 5 * i + 5, 1) AS INTEGER) AS INTEGER), 1)), '') AS digest,
         min(page_id) OVER (PARTITION BY body) AS first
  FROM bits)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM coded"""
)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through ARC and WARC files and back."""
    found = arc_warc.convert(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attention-model and unigram scores of every whole text, learnt from rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (remainder("doc_id", 7) != 2).alias("train"))
    found = attention_lm.score_documents(docs, RANKS, PATTERN)
    return found.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query()
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, word for word or with other names and numbers."""
    return templates.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least four periods in the words of every whole text, and the texts without repetitions."""
    docs = table(spark, sf_dir, "documents")
    seed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return periodic_runs.digests(periodic_runs.find(docs, seed, periodic_runs.repeated_tail))


@query(
    """WITH RECURSIVE usable AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM usable UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
roots AS (SELECT a AS vec_id, min(b) AS root FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, coalesce(r.root, e.vec_id) AS component_id, e.vec_id = coalesce(r.root, e.vec_id) AS kept
FROM embeddings e LEFT JOIN roots r USING (vec_id) LEFT JOIN counts c USING (vec_id)"""
)
def op12_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors under a cosine of 0.98 within their label."""
    return product_codes.near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


@query(
    """WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
hard AS (
  SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS rank,
         other_id AS negative_id, positive_score, score AS negative_score
  FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM hard WHERE rank <= 3"""
)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five best positives of every fiftieth row."""
    rows = table(spark, sf_dir, "embeddings").filter(vectors.finite(F.col("embedding")))
    label = F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = rows.select("vec_id", label.alias("label"), F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("vec"))
    return strassen_negatives.mine(whole, F.pmod("vec_id", F.lit(50)) == 0)
