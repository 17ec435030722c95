"""The operators with production parameters on their whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.llm import (
    bpe,
    decontaminate,
    hardneg,
    knn,
    neardup,
    packing,
    quality,
    repeats,
    sharding,
    spelling,
    tokenfile,
    toxicity,
    urls,
)
from eddyline.llm.batches import small_batches
from eddyline.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

#: The rules of the url query (fixed values).
URL_RULES = (
    urls.Rule.parse("allow", "com/"),
    urls.Rule.parse("block", "example.com/en/"),
    urls.Rule.parse("allow", "www.example.com/en/"),
    urls.Rule.parse("block", "net/es/"),
    urls.Rule.parse("block", "net/fr/"),
)


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_voronoi_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return knn.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLES["op1_voronoi_top_k"] = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, d.vec_id AS vec_id, list_dot_product(q.v, d.v)::BIGINT AS score
    FROM vectors q JOIN vectors d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    target = scratch_path(spark, "tokens")
    manifest = tokenfile.write_tokens(table(spark, folder, "documents"), WORD_BPE, target, end=1)
    return tokenfile.read_digests(manifest, target, WORD_BPE)


@query
def op3_levenshtein_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op4_bpe_automaton(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encoding_digests(table(spark, folder, "documents"), BYTE_BPE)


@query
def op5_fm_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op6_url_cascade(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge_urls(table(spark, folder, "pages"), URL_RULES)


@query
def op7_label_propagation(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"))


@query
def op8_dart_minhash(spark: SparkSession, folder: str) -> DataFrame:
    classes = neardup.duplicate_classes(table(spark, folder, "documents"))
    return classes.select("doc_id", "class_id", "class_size")


@query
def op9_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op10_merged_transforms(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeat_digests(table(spark, folder, "documents"))


@query
def op11_minimum_bin_slack(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, folder, "documents"), WORD_BPE, end=0)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op12_trie_pair_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(spelling.word_counts(table(spark, folder, "documents")))


@query
def op13_slot_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


ORACLES["op6_url_cascade"] = """
WITH parts AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), urls AS (
    SELECT page_id,
        coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
    FROM parts
), rules(verdict, rule_host, rule_path) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
        ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fitting AS (
    SELECT page_id, max_by({'rule': rule_host || rule_path, 'verdict': verdict}, length(rule_host || rule_path)) AS best
    FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM urls LEFT JOIN fitting USING (page_id)
"""

#: The table of the checksum is made from its polynomial; only letters are compared afterwards.
ORACLES["op12_trie_pair_spelling"] = """
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce(range(9), lambda c, k: CASE WHEN k = 0 THEN c WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS crcs
    FROM range(256) AS r(b)
), runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{C0}-\\x{FF}]+')) AS run FROM documents)
    WHERE length(run) >= 5 GROUP BY ALL
), sums AS (
    SELECT run, times, xor(list_reduce(
            list_transform(range(0, strlen(line)), lambda i: (('0x' || hex(encode(line))[2 * i + 1:2 * i + 2])::BIGINT)),
            lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]), 4294967295
        ), 4294967295) AS h
    FROM (SELECT run, times, coalesce(doc_id::VARCHAR, '') || ':' || run AS line FROM runs), crc_table
), words AS (
    SELECT word, sum(times)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times
        FROM sums
    ) WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), skips AS (
    SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS b
    FROM words, LATERAL (SELECT unnest(range(length(word))) AS i)
), near AS (
    SELECT x.word, y.word AS other, y.n AS other_n FROM skips x JOIN skips y ON x.a = y.a AND x.b = y.b AND x.i = y.i AND x.word <> y.word
    UNION
    SELECT x.word, w.word, w.n FROM skips x JOIN words w ON w.word = x.a || x.b
    UNION
    SELECT w.word, x.word, x.n FROM skips x JOIN words w ON w.word = x.a || x.b
), best AS (
    SELECT word, count(*) AS n_near, max(other_n) AS m, min(other) FILTER (other_n = top) AS other
    FROM (SELECT *, max(other_n) OVER (PARTITION BY word) AS top FROM near) GROUP BY word
), forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near,
        CASE WHEN m >= 2 * n THEN other END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n
    FROM words LEFT JOIN best USING (word)
), walk AS (
    SELECT word, word AS root, form AS next FROM forms
    UNION ALL
    SELECT walk.word, walk.next, forms.form FROM walk JOIN forms ON forms.word = walk.next
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, root FROM walk WHERE next IS NULL) USING (word)
"""

ORACLES["op13_slot_hard_negatives"] = """
WITH moved AS (
    SELECT vec_id, embedding, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM embeddings
), vectors AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM moved
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same, list_dot_product(a.v, d.v)::BIGINT AS score
    FROM vectors a JOIN vectors d ON a.vec_id % 100 = 0 AND a.vec_id <> d.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
