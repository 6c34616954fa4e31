"""The operators' queries over the given tables, and SQL where it can express one.

Each query applies its operator to its whole table and derives the result
columns from what the operator returns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontam, html_main, licenses, pieces, sharding, simhash, sketches, suffixes, toxicity, url_rules, vector_codes, warc
from .common import durable, shared_folder, table

URL_RULES = [
    url_rules.rule("allow", "com/"),
    url_rules.rule("block", "example.com/en/"),
    url_rules.rule("allow", "www.example.com/en/"),
    url_rules.rule("block", "net/es/"),
    url_rules.rule("block", "net/fr/"),
]


def tokenizer_path() -> str:
    """The model file; other callers pass a path of their own."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def op1_url_rules(spark: SparkSession, d: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, d, "pages"), URL_RULES)


def op2_main_text(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    out = html_main.main_text(pages, html_main.learn(pages))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("tie", F.xxhash64("text")).withColumn("sketch", sketches.sketch(F.col("text")))
    rows = sketches.with_next(docs, ["text", "sketch"], "doc_id", "tie")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"), F.substring("next_text", F.lit(1), half)))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "sketch", "next_sketch", sketches.sketch(F.col("edited")).alias("edited_sketch"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        sketches.hex_of(F.col("sketch")).alias("fingerprint"), sketches.hex_of(F.col("edited_sketch")).alias("edited_fingerprint"),
        sketches.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), sketches.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def toxicity_grammar(spark: SparkSession, d: str) -> toxicity.Grammar:
    return toxicity.learn(table(spark, d, "documents"), table(spark, d, "labels"), lambda doc_id: ~held_out(doc_id))


def op4_toxicity(spark: SparkSession, d: str) -> DataFrame:
    scored = toxicity.score_documents(table(spark, d, "documents"), toxicity_grammar(spark, d))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_shards(spark: SparkSession, d: str) -> DataFrame:
    return sharding.shard(table(spark, d, "documents"), 16)


def op6_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontam.benchmark_leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op7_simhash(spark: SparkSession, d: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, d, "documents"), words=3, radius=2)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_licenses(spark: SparkSession, d: str) -> DataFrame:
    return licenses.licence_notices(table(spark, d, "documents"))


def op9_pieces(spark: SparkSession, d: str, model_path: str | None = None) -> DataFrame:
    proto = pieces.model_bytes(model_path or tokenizer_path())
    out = pieces.encode(table(spark, d, "documents"), proto, decoded=True)
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    out = suffixes.cut_documents(table(spark, d, "documents"), length=400)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocations.collocations(table(spark, d, "documents"), least=100, most=5, top=2000)


def op12_warc(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(pages, f"{folder}/whole")
    found = durable(warc.read_records(warc.normalise(spark, f"{folder}/whole", f"{folder}/records")))
    found = warc.resolved(found)
    kind = pages.schema["page_id"].dataType
    return found.select(F.col("source_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_source_id").cast(kind).alias("refers_to"))


def op13_vector_codes(spark: SparkSession, d: str) -> DataFrame:
    kept, length = vector_codes.kept_vectors(table(spark, d, "embeddings"), parts=16)
    if not length:
        empty = kept.select("vec_id").schema.add("code", "string").add("error", "long").add("label_error", "long").add("codebooks_sha256", "string")
        return spark.createDataFrame([], empty)
    books = vector_codes.learn(kept, length, parts=16, entries=64, rounds=2)
    coded = durable(vector_codes.encode(kept, books))
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    out = coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(vector_codes.books_sha256(books)).alias("codebooks_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_url_rules, op2_main_text, op3_fingerprints, op4_toxicity, op5_shards, op6_decontamination, op7_simhash, op8_licenses, op9_pieces, op10_suffix_dedup, op11_collocations, op12_warc, op13_vector_codes)
    return {f.__name__: f for f in ops}


_OP1 = """
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path
  FROM cut),
rules(verdict, rhost, rpath) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fit AS (
  SELECT page_id, host, path, rhost || rpath AS rule, verdict
  FROM parts LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, COALESCE(verdict, 'allow') AS verdict FROM fit
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1
"""


# 160 bits of the digest as 32 characters of five bits each
_OP12 = """
WITH p AS (
  SELECT page_id, COALESCE(html, '') AS body, sha1(COALESCE(html, '')) AS hex FROM pages),
b AS (
  SELECT page_id, octet_length(encode(body)) AS payload_bytes,
         array_to_string(list_transform(range(160), lambda i: ((strpos('0123456789abcdef', hex[i // 4 + 1]) - 1) >> (3 - i % 4)) & 1), '') AS bits
  FROM p),
d AS (
  SELECT page_id, payload_bytes,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + list_sum(list_transform(range(5), lambda j: substr(bits, i * 5 + j + 1, 1)::BIGINT << (4 - j)))::BIGINT, 1)), '') AS payload_digest
  FROM b),
f AS (SELECT *, MIN(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

_OP11 = """
WITH pieces AS (
  SELECT COALESCE(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(SUM(len(w)) AS HUGEINT) AS n FROM split GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM split, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, COUNT(*) AS f FROM grams GROUP BY ALL HAVING COUNT(*) >= 100),
spread AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM f),
grown AS (
  SELECT lang, part, MAX(f) AS f
  FROM (SELECT lang, f, unnest([array_to_string(w[1:k - 1], ' '), array_to_string(w[2:k], ' ')]) AS part FROM spread WHERE k > 1)
  GROUP BY lang, part),
cand AS (
  SELECT s.* FROM spread s LEFT JOIN grown g ON s.lang = g.lang AND s.phrase = g.part WHERE s.k > 1 AND COALESCE(g.f, 0) < s.f),
cuts AS (
  SELECT lang, phrase, f AS a, i, array_to_string(w[1:i], ' ') AS p1, array_to_string(w[i + 1:k], ' ') AS p2
  FROM cand, (SELECT unnest(range(1, 5)) AS i) WHERE i < k),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.i, x.f AS l, y.f AS r, t.n,
         (1000 * CAST(c.a AS HUGEINT) * t.n) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM cuts c JOIN f x ON c.lang = x.lang AND c.p1 = x.phrase JOIN f y ON c.lang = y.lang AND c.p2 = y.phrase JOIN totals t ON c.lang = t.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""


def _op13() -> str:
    """Each round measures every part against its codebook, then moves the entries."""
    parts = """
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS v FROM kept, (SELECT unnest(range(16)) AS p)),
book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM part
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= 64)"""
    near = """,
near{r} AS MATERIALIZED (
  SELECT vec_id, label, a.p, any_value(a.v) AS v,
         MIN(64 * CAST(list_sum(list_transform(range(len(a.v)), lambda i: (a.v[i + 1] - b.v[i + 1]) * (a.v[i + 1] - b.v[i + 1]))) AS BIGINT) + b.e) AS x
  FROM part a JOIN book{r} b ON a.p = b.p GROUP BY vec_id, label, a.p)"""
    move = """,
sum{r} AS (
  SELECT p, x % 64 AS e, i, SUM(v[i + 1]) AS s, COUNT(*) AS n FROM near{q}, (SELECT unnest(range((SELECT len(v) FROM part LIMIT 1))) AS i) GROUP BY ALL),
mean{r} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM sum{r} GROUP BY p, e),
book{r} AS MATERIALIZED (SELECT b.p, b.e, COALESCE(m.v, b.v) AS v FROM book{q} b LEFT JOIN mean{r} m ON b.p = m.p AND b.e = m.e)"""
    end = """,
coded AS (
  SELECT vec_id, label, string_agg(lpad(to_hex(x % 64), 2, '0'), '' ORDER BY p) AS code, CAST(SUM(x // 64) AS BIGINT) AS error
  FROM near2 GROUP BY vec_id, label)
SELECT vec_id, lower(code) AS code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM coded
"""
    return parts + near.format(r=0) + "".join(move.format(r=r, q=r - 1) + near.format(r=r) for r in (1, 2)) + end


def oracle_sql() -> dict[str, str]:
    """What can be said in SQL that runs on whole tables."""
    return {"op1_url_rules": _OP1, "op11_collocations": _OP11, "op12_warc": _OP12, "op13_vector_codes": _op13()}
