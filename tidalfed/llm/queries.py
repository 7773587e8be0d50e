"""The registered queries of this subpackage, and their statements where SQL has them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidalfed.llm import (
    fingerprints,
    jaccard,
    language,
    mixing,
    negatives,
    packing,
    pieces,
    quality,
    sharding,
    substrings,
    toxicity,
    tries,
    vectors,
)
from tidalfed.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(prepare(spark), folder)

        QUERIES[function.__name__] = run
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer(name: str = packing.TOKENIZER) -> str:
    """Place of a tokenizer's file; the files themselves are not part of the repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, folder, "documents"))


@query()
def op2_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, folder, "documents"))


@query()
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op4_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.removed_bytes(table(spark, folder, "documents"))


@query()
def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer())


@query()
def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(table(spark, folder, "documents"),
                                  table(spark, folder, "labels"))


@query(r"""
    WITH sized AS (
        SELECT doc_id, source, md5('mix:' || doc_id) AS key,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
        FROM documents),
    lined AS (
        SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, size
                                  ROWS UNBOUNDED PRECEDING) AS ending
        FROM sized),
    sources AS (
        SELECT source, sum(size) AS source_size,
               row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
        FROM sized GROUP BY source),
    weighed AS (
        SELECT *, [3, 1, 2][place % 3 + 1] AS weight,
               (SELECT sum(size) * 3 // 2 FROM sized) AS goal
        FROM sources),
    levels AS (
        SELECT *, coalesce(sum(2 * source_size) OVER w, 0) AS below,
               sum(weight) OVER (ORDER BY 2 * source_size / weight DESC, place DESC
                                 ROWS UNBOUNDED PRECEDING) AS open_weight,
               2 * source_size / weight AS fill
        FROM weighed
        WINDOW w AS (ORDER BY 2 * source_size / weight, place
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    level AS (
        SELECT (goal - below)::DOUBLE / open_weight AS level FROM levels
        WHERE (goal - below) / open_weight < fill ORDER BY fill, place LIMIT 1),
    targets AS (
        SELECT weighed.*, CASE WHEN 2 * source_size <= weight * level
                          THEN (2 * source_size)::DOUBLE ELSE weight * level END AS target
        FROM weighed, level),
    turns AS (
        SELECT l.doc_id, l.key, l.size, t.source_size::BIGINT AS source_size, t.target, t.place,
               t.goal, ending + p.turn * t.source_size AS upto
        FROM lined l JOIN targets t ON l.source IS NOT DISTINCT FROM t.source,
             (VALUES (0), (1)) p(turn)),
    merged AS (
        SELECT *, sum(size) OVER (ORDER BY upto::DOUBLE / target, place, upto
                                  ROWS UNBOUNDED PRECEDING) <= goal AS used
        FROM turns)
    SELECT doc_id, size::BIGINT AS size, source_size, target,
           coalesce(sum(CASE WHEN used THEN size END), 0)::BIGINT AS taken
    FROM merged GROUP BY ALL""")
def op7_mixing_to_target_weights(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).drop("source", "times")


@query(r"""
    WITH known AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL),
    links AS (
        SELECT a.vec_id AS a, b.vec_id AS b
        FROM known a JOIN known b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
    reach AS (
        WITH RECURSIVE r(a, b) AS (
            SELECT a, b FROM links UNION SELECT r.a, l.b FROM r JOIN links l ON r.b = l.a)
        SELECT a, min(b) AS low FROM r GROUP BY a)
    SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links,
           least(e.vec_id, r.low) AS component_id, e.vec_id = least(e.vec_id, r.low) AS kept
    FROM embeddings e LEFT JOIN reach r ON e.vec_id = r.a
         LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON e.vec_id = n.a""")
def op8_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(table(spark, folder, "embeddings"))


@query()
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.languages(table(spark, folder, "documents"))


@query()
def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, folder, "documents"))


@query()
def op11_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digests(table(spark, folder, "documents"), tokenizer(pieces.MODEL))


@query(r"""
    WITH known AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(
            embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
               list_inner_product(a.v, b.v)::BIGINT AS score
        FROM known a JOIN known b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
    positives AS (
        SELECT * FROM scored WHERE same QUALIFY row_number() OVER (
            PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    negatives AS (
        SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
               p.score AS positive_score, n.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor_id, p.vec_id
                                  ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
        FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
             AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
    SELECT * FROM negatives WHERE rank <= 3""")
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, folder, "embeddings"))


# crc32 by its definition, bit by bit: -1 stands for a step of the shift register.
@query(r"""
    WITH turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(
                   len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1
                   AS place
        FROM conversations WHERE conv_id IS NOT NULL),
    ids AS (
        SELECT DISTINCT conv_id, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(
            list_transform(string_split(conv_id::VARCHAR, ''),
                           lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda r, b: CASE WHEN b >= 0 THEN xor(r::BIGINT, b::BIGINT)
                         ELSE xor(r::BIGINT >> 1, 3988292384 * (r::BIGINT & 1)) END)) % 4 AS h
        FROM turns),
    rebuilt AS (
        SELECT i.conv_id, t.place, t.role, t.text
        FROM ids i JOIN turns t ON t.conv_id = i.conv_id - i.conv_id % 20 AND t.place < i.h
        UNION ALL
        SELECT i.conv_id, t.place, t.role, t.text
        FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.place >= i.h),
    paths AS (
        SELECT i.conv_id, coalesce(list([r.role, r.text] ORDER BY r.place)
                                   FILTER (r.place IS NOT NULL), []) AS path
        FROM ids i LEFT JOIN rebuilt r USING (conv_id) GROUP BY i.conv_id),
    prefixes AS (
        SELECT conv_id, path, unnest(range(len(path) + 1)) AS depth FROM paths),
    nodes AS (
        SELECT depth, path[1:depth] AS node, min(conv_id) AS conv_id, count(*) AS n_convs,
               sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                               FILTER (len(path) = depth), '')) AS ends_sha256
        FROM prefixes GROUP BY ALL),
    families AS (
        SELECT node[1:depth - 1] AS node, depth - 1 AS depth, count(*) AS n_children
        FROM nodes WHERE depth > 0 GROUP BY ALL),
    known AS (
        SELECT n.*, coalesce(f.n_children, 0) AS n_children,
               CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * len(regexp_extract_all(
                   n.node[n.depth][2], '[^\x20\x09-\x0D]+')) END AS saved
        FROM nodes n LEFT JOIN families f USING (node, depth)),
    above AS (
        SELECT node[1:d] AS node, d AS depth, sum(saved) AS saved_tokens,
               count(*) FILTER (n_children = 0) AS n_leaves
        FROM (SELECT *, unnest(range(depth + 1)) AS d FROM known) GROUP BY ALL)
    SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, a.n_leaves,
           a.saved_tokens::BIGINT AS saved_tokens, k.ends_sha256
    FROM known k JOIN above a USING (node, depth)
         LEFT JOIN nodes p ON k.depth > 0 AND p.depth = k.depth - 1
                              AND p.node = k.node[1:k.depth - 1]""")
def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return tries.prefix_trie(table(spark, folder, "conversations"))
