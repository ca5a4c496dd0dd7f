"""One registered query for each operator, with the columns its contract asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from episodica.llm import bpe, exact_dedup, lattice, main_text, mixing, near_dedup, phrases, repeats, spelling, token_files, topk, toxicity, url_rules
from episodica.llm.tables import table
from episodica.shared import scratch_path

QUERIES = {}
ORACLES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = bpe.encoded(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, keep_ids=False)
    return rows.select(F.col("id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


def fold(modulus: int):
    """Whether crc32 of the identifier as text leaves 0: the held-out fold."""
    return lambda identifier: F.coalesce(F.crc32(identifier.cast("string")) % modulus == 0, F.lit(False))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold(5))
    rows = toxicity.scored(docs, model, passages=False)
    return rows.select(F.col("id").alias("doc_id"), fold(5)(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    docs = token_files.in_file_order(table(spark, sf_dir, "documents"))
    token_files.write_token_files(token_files.token_ids(docs, public_tokenizers.path("word_bpe_49k.json")), path)
    rows = token_files.read_token_files(spark, path).join(token_files.token_starts(spark, path), ["file", "row"])
    return rows.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = exact_dedup.exact_classes(table(spark, sf_dir, "documents"))
    return classes.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLES["op8_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op10_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lattice.likelihood(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), fold(10))
    return rows.withColumnRenamed("id", "doc_id")


@query
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents"), words=2, similarity=0.8).withColumnRenamed("id", "doc_id")


@query
def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLES["op3_top_k"] = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score
    FROM whole q JOIN whole d ON q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id
)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score
FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 20
"""


@query
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repeats.without_repeats(table(spark, sf_dir, "documents"), keep_bytes=False)
    return rows.drop("kept").withColumnRenamed("id", "doc_id")


@query
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return main_text.extracted(pages, main_text.fit(pages))


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query
def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = url_rules.judged(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


ORACLES["op11_url_rules"] = """
WITH parsed AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages
), fitted AS (
    SELECT page_id, host, path, list_filter(
        [{'host': 'net', 'path': '/', 'verdict': 'block'}, {'host': 'example.net', 'path': '/en/', 'verdict': 'allow'},
         {'host': 'example.com', 'path': '/de/', 'verdict': 'block'}, {'host': 'org', 'path': '/fr/', 'verdict': 'allow'}],
        lambda x: (parsed.host = x.host OR ends_with(parsed.host, '.' || x.host)) AND starts_with(parsed.path, x.path)) AS fit
    FROM parsed
), chosen AS (
    SELECT page_id, host, path, list_reduce(fit, lambda x, y: CASE WHEN length(y.host || y.path) > length(x.host || x.path) THEN y ELSE x END) AS best
    FROM fitted WHERE len(fit) > 0
    UNION ALL
    SELECT page_id, host, path, NULL FROM fitted WHERE len(fit) = 0
)
SELECT page_id, host, path, best.host || best.path AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM chosen
"""


@query
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.planted(spelling.words_of(table(spark, sf_dir, "documents")), one_in=199)
    return spelling.variants(spelling.counted(words, length=6, least=5))


@query
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.best_phrases(phrases.collocations(table(spark, sf_dir, "documents")), 2000)


ORACLES["op13_phrases"] = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), starts AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS b FROM split
), grams AS (
    SELECT lang, unnest(range(1, least(3, len(w) - b + 1) + 1)) AS m, w, b FROM starts
), counts AS (
    SELECT lang, array_to_string(list_slice(w, b, b + m - 1), ' ') AS phrase, m, count(*) AS c FROM grams GROUP BY ALL
), totals AS (
    SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM counts WHERE m = 1 GROUP BY lang
), candidates AS (
    SELECT lang, phrase, m, c AS a, string_split(phrase, ' ') AS w FROM counts WHERE m > 1 AND c >= 10
), cuts AS (
    SELECT lang, phrase, a, k, array_to_string(list_slice(w, 1, k), ' ') AS head, array_to_string(list_slice(w, k + 1, m), ' ') AS rest
    FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates)
), scored AS (
    SELECT cuts.lang, cuts.phrase, a, k, x.c AS l, y.c AS r,
           CAST(1000000::HUGEINT * a * a // (x.c::HUGEINT * y.c) AS BIGINT) AS score
    FROM cuts JOIN counts x ON x.lang = cuts.lang AND x.phrase = cuts.head JOIN counts y ON y.lang = cuts.lang AND y.phrase = cuts.rest
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
    SELECT lang, phrase, max(a) AS f FROM (
        SELECT lang, a, unnest([array_to_string(list_slice(w, 1, 2), ' '), array_to_string(list_slice(w, 2, 3), ' ')]) AS phrase
        FROM candidates WHERE m = 3
    ) GROUP BY ALL
), kept AS (
    SELECT lowest.* FROM lowest LEFT JOIN longer USING (lang, phrase) WHERE f IS NULL OR 100 * f < 50 * a
)
SELECT lang, row_number() OVER best AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY rank <= 2000
"""
