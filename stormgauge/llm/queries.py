"""Registered queries of this subpackage, over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from stormgauge.llm import (
    balltree,
    bpe,
    brown,
    idfiles,
    jaccard,
    langid,
    lattice,
    linededup,
    mixing,
    sharding,
    spelling,
    tokenalign,
    toxicity,
)
from stormgauge.llm.common import fold, scratch, small_batches, table

# bytes of text in a shard: small enough to be shuffled and resumed as a unit by a reader
SHARD_BYTES = 1 << 20
# id that ends each document
END_ID = 2
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_extendible_hash_shards(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").alias("bytes"))
    shards = sharding.extendible_shards(docs, "doc_id", F.col("bytes"), SHARD_BYTES)
    return shards.select("doc_id", "shard_id", "shard_depth", "shard_bytes", "shard_rows", "oversized")


def op2_hashed_subword_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit_language_model(docs, fold("doc_id") != 0)
    made = langid.identify(model, docs).alias("made")
    held_out = (fold("doc_id") == 0).alias("held_out")
    return docs.select("doc_id", held_out, made).select("doc_id", "held_out", "made.*")


def op3_ball_tree_top_k(spark, sf_dir):
    return balltree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_convolutional_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    usable = fold("doc_id") != 0
    languages = langid.fit_language_model(docs, usable)
    model = toxicity.fit_toxicity_model(
        docs, table(spark, sf_dir, "labels"), usable, languages
    )
    scored = docs.select(
        "doc_id",
        (fold("doc_id") == 0).alias("held_out"),
        toxicity.rate(model, languages, docs).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_e8_lattice_near_duplicates(spark, sf_dir):
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_brown_class_scores(spark, sf_dir):
    return brown.class_scores(table(spark, sf_dir, "documents"), fold("doc_id") == 1)


def op7_bpe_rank_array(spark, sf_dir):
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", bpe.round_trip(WORD_VOCABULARY).alias("made")).select(
        "doc_id", "made.*"
    )


def op8_bit_plane_files(spark, sf_dir):
    folder = scratch(spark, "id-planes")
    files = idfiles.write_texts(
        table(spark, sf_dir, "documents"), folder, WORD_VOCABULARY, END_ID
    )
    return idfiles.read_documents(files, folder, digest=True)


def op9_ngram_jaccard_join(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return jaccard.jaccard_components(docs).select("doc_id", "n_shingles", "component_id")


def op10_raked_source_mix(spark, sf_dir):
    made = mixing.mixed(table(spark, sf_dir, "documents"))
    return made.select(
        F.col("row.doc_id").alias("doc_id"),
        "source",
        "lang",
        "topic",
        "tokens",
        F.round("probability", 6).alias("probability"),
        "kept",
    )


def op11_shared_lines_perfect_hash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = linededup.drop_shared_lines(docs)
    digest = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return made.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", digest)


def op12_aligned_tokenizers(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = tokenalign.alignments(docs, BYTE_VOCABULARY, PIECE_MODEL)
    return made.select(F.col("row.doc_id").alias("doc_id"), *tokenalign.MEASURES, "groups_sha256")


def op13_spelling_variants_trie(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_extendible_hash_shards,
        op2_hashed_subword_language,
        op3_ball_tree_top_k,
        op4_convolutional_toxicity,
        op5_e8_lattice_near_duplicates,
        op6_brown_class_scores,
        op7_bpe_rank_array,
        op8_bit_plane_files,
        op9_ngram_jaccard_join,
        op10_raked_source_mix,
        op11_shared_lines_perfect_hash,
        op12_aligned_tokenizers,
        op13_spelling_variants_trie,
    )
}

OP3_ORACLE = """
WITH v AS (
    SELECT vec_id, max(list_transform(embedding, lambda x: floor(256 * x::DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    GROUP BY vec_id
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT query_id, vec_id, score,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# the shallowest prefix of the id's hash whose documents fit a shard
OP1_ORACLE = f"""
WITH d AS (
    SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS bytes,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 10) AS BIGINT) AS h
    FROM documents
), b AS (
    SELECT depth, h >> (40 - depth) AS prefix, CAST(sum(bytes) AS BIGINT) AS bytes, count(*) AS n
    FROM d, generate_series(0, 40) AS g(depth) GROUP BY ALL
), fits AS (
    SELECT d.doc_id, CAST(b.depth AS INTEGER) AS shard_depth, b.prefix, b.bytes, b.n,
           row_number() OVER (PARTITION BY d.doc_id ORDER BY b.depth) AS k
    FROM d JOIN b ON d.h >> (40 - b.depth) = b.prefix
    WHERE b.bytes <= {SHARD_BYTES} OR b.n = 1
)
SELECT doc_id,
       CASE WHEN shard_depth = 0 THEN '' ELSE lpad(bin(prefix), shard_depth, '0') END AS shard_id,
       shard_depth, bytes AS shard_bytes, n AS shard_rows, bytes > {SHARD_BYTES} AS oversized
FROM fits WHERE k = 1
"""

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP11_ORACLE = f"""
WITH lines AS (
    SELECT doc_id, i, line,
           translate(trim(line, {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (
        SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
    )
), often AS (
    SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= {linededup.LEAST_CHARS}
    GROUP BY key HAVING count(DISTINCT doc_id) >= {linededup.LEAST_DOCS}
), marked AS (
    SELECT l.*, coalesce(o.keeper <> l.doc_id, false) AS lost FROM lines AS l LEFT JOIN often AS o USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def _op10_oracle(iterations: int = mixing.ITERATIONS) -> str:
    """Raking unrolled: a step divides each margin's sum into its target, one margin a time."""
    target = ", ".join(
        f"pow(sum(t) OVER (PARTITION BY {m}) / sum(t) OVER (), {p}) AS raw_{m}"
        for m, p in mixing.POWERS.items()
    )
    norms = ", ".join(
        f"raw_{m} / (SELECT sum(x) FROM (SELECT any_value(raw_{m}) AS x FROM raw GROUP BY {m})) AS goal_{m}"
        for m in mixing.MARGINS
    )
    steps, last = [], "w0"
    for k in range(iterations * 3):
        m = mixing.MARGINS[k % 3]
        steps.append(
            f"w{k + 1} AS MATERIALIZED (SELECT * REPLACE (w * goal_{m} * total "
            f"/ sum(w) OVER (PARTITION BY {m}) AS w) FROM {last})"
        )
        last = f"w{k + 1}"
    return f"""
WITH d AS (
    SELECT doc_id, source, lang,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens,
           CASE WHEN regexp_matches(text, '\\|[^|\\n]*\\|') THEN 'table'
                WHEN regexp_matches(text, '[;{{}}][ \\t]*\\n') THEN 'code'
                WHEN regexp_matches(text, '(^|\\n)[ \\t]*([-*]|[0-9]+[.)]) ') THEN 'list'
                WHEN regexp_matches(text, '(\\n[^\\n]{{1,40}}){{4}}') THEN 'lines'
                ELSE 'prose' END AS topic,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 12) AS BIGINT)
               / 281474976710656.0 AS draw
    FROM documents
), cells AS (
    SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS t FROM d GROUP BY ALL
), raw AS (SELECT *, {target} FROM cells),
w0 AS (SELECT *, t AS w, (SELECT sum(t) FROM cells) AS total, {norms} FROM raw WHERE t > 0),
{", ".join(steps)},
ratio AS (SELECT *, w / t AS r FROM {last}),
ordered AS (
    SELECT *, {mixing.KEEP} * total - coalesce(sum(t) OVER (ORDER BY r DESC, source, lang, topic
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
           sum(w) OVER (ORDER BY r DESC, source, lang, topic
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
    FROM ratio
),
factor AS (SELECT arg_max(left_over / rest, r) AS f FROM ordered WHERE left_over / rest * r <= 1)
SELECT d.doc_id, d.source, d.lang, d.topic, d.tokens,
       round(least(1, r * f), 6) AS probability,
       d.tokens > 0 AND d.draw < least(1, r * f) AS kept
FROM d JOIN ratio USING (source, lang, topic), factor
"""


ORACLES = {
    "op1_extendible_hash_shards": OP1_ORACLE,
    "op3_ball_tree_top_k": OP3_ORACLE,
    "op10_raked_source_mix": _op10_oracle(),
    "op11_shared_lines_perfect_hash": OP11_ORACLE,
}
