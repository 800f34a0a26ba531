"""The registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import (bytebpe, fingerprints, hardnegatives, langid, linededup, mixing, ngramjoin, secretscan, substrings, tokencount,
               tokenfiles, topk, whitening)
from .common import documents


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every document, and back."""
    return bytebpe.digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                           public_tokenizers.PATTERN)


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest others, by integer inner product, of every vector whose id is divisible by 20."""
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 20 == 0)


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 35 words and more that occur anywhere else too."""
    rows = substrings.drop_repeats(documents(spark, sf_dir), window=35)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowed fingerprints of every document and of its edited text, and how like they are."""
    return fingerprints.digests(documents(spark, sf_dir))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of documents at a Jaccard similarity of 0.8 and more, and its number of links."""
    return ngramjoin.join(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document by the compiled transducer."""
    return tokencount.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written as ORC, and each document's place and checksum read from the files."""
    return tokenfiles.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is taken when the sources are mixed 5 : 2 : 1."""
    rows = mixing.taken(documents(spark, sf_dir))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those that are not held out."""
    docs = documents(spark, sf_dir)
    model = langid.train(docs.where(~langid.held_out()))
    rows = langid.predict(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, told from widely copied examples by who holds them."""
    return secretscan.digests(documents(spark, sf_dir))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that a document of a lesser id holds too."""
    rows = linededup.drop_lines(documents(spark, sf_dir))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each anchor's best five of its label, the best five of other labels that come close below."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardnegatives.mine(vectors, F.col("id") % 100 == 0, label)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the eight leading components of all, at unit variance."""
    rows = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_mix": op2_mix,
    "op3_top_k": op3_top_k,
    "op4_substrings": op4_substrings,
    "op5_fingerprints": op5_fingerprints,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_token_counts": op7_token_counts,
    "op8_language": op8_language,
    "op9_secrets": op9_secrets,
    "op10_token_files": op10_token_files,
    "op11_line_dedup": op11_line_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL = {
    "op3_top_k": """
        WITH rows AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.r, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
            FROM rows q JOIN rows c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op2_mix": r"""
        WITH sized AS (
            SELECT doc_id, text, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
            FROM documents),
        sources AS (SELECT source, sum(size)::BIGINT AS s FROM sized GROUP BY source),
        weighed AS (
            SELECT source, s, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM sources),
        -- in order of stop per weight, the first k sources stop; the level is what the others then get
        steps AS (
            SELECT *, sum(s) OVER () AS total,
                   coalesce(sum(3 * s) OVER (ORDER BY 3 * s / w, source NULLS LAST
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped,
                   sum(w) OVER (ORDER BY 3 * s / w, source NULLS LAST
                            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
            FROM weighed),
        level AS (SELECT max(((total - stopped)::DOUBLE) / free::DOUBLE) AS l FROM steps),
        rates AS (
            SELECT source, s, least(w * l, (3 * s)::DOUBLE) AS target,
                   CASE WHEN s > 0 THEN least(least(w * l, (3 * s)::DOUBLE) / s, 3.0::DOUBLE) ELSE 0 END AS rate
            FROM weighed, level),
        drawn AS (
            SELECT *, ('0x' || substr(md5('0|' || coalesce(doc_id::VARCHAR, 'text:' || coalesce(text, ''))), 1, 8))::BIGINT
                      / 4294967296.0::DOUBLE AS draw FROM sized)
        SELECT doc_id, size, s AS source_size, target,
               (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM drawn JOIN rates ON drawn.source IS NOT DISTINCT FROM rates.source""",
    "op4_substrings": r"""
        WITH split AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        places AS (SELECT r, words, unnest(generate_series(1, len(words))) AS p FROM split),
        starts AS (
            SELECT r, p, words[p] AS word,
                   CASE WHEN p + 34 <= len(words) THEN array_to_string(words[p:p + 34], ' ') END AS passage FROM places),
        judged AS (
            SELECT r, p, word, passage IS NOT NULL AND count(*) OVER (PARTITION BY passage) > 1 AS repeated FROM starts),
        covered AS (
            SELECT r, p, word, coalesce(max(repeated::INT) OVER (PARTITION BY r ORDER BY p
                                        ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) = 1 AS gone FROM judged),
        kept AS (
            SELECT r, sum(gone::INT)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS kept
            FROM covered GROUP BY r)
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM split LEFT JOIN kept USING (r)""",
    "op11_line_dedup": r"""
        WITH split AS (
            SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        places AS (SELECT r, doc_id, unnest(lines) AS line, unnest(generate_series(1, len(lines))) AS p FROM split),
        keyed AS (
            SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM places),
        held AS (
            SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
            GROUP BY key HAVING count(DISTINCT doc_id) > 1),
        judged AS (SELECT k.*, h.owner IS NOT NULL AND h.owner <> k.doc_id AS gone FROM keyed k LEFT JOIN held h USING (key))
        SELECT doc_id, count(*)::BIGINT AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY r, doc_id""",
    "op12_hard_negatives": """
        WITH rows AS (
            SELECT row_number() OVER () AS r, vec_id,
                   CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.r AS ar, c.r AS cr, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                   list_dot_product(a.v, c.v)::BIGINT AS score
            FROM rows a JOIN rows c ON a.r <> c.r AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0),
        positives AS (
            SELECT ar, anchor_id, cr, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) <= 5),
        near AS (
            SELECT p.ar, p.cr, p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
                   row_number() OVER (PARTITION BY p.ar, p.cr ORDER BY s.score DESC, s.vec_id) AS rank
            FROM positives p JOIN scored s ON p.ar = s.ar AND NOT s.same
             AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
        SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
        FROM near WHERE rank <= 5""",
}


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter and those whose score is about chance; only the former where there is nothing to learn from."""
    model = langid.train(docs.where(~langid.held_out()))
    if not model.languages:
        return langid.with_letters(docs)
    told = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= langid.least_score(model))
    return langid.predict(docs, model).where(told).select(docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near copies."""
    return ngramjoin.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask the secrets that look live."""
    return secretscan.mask(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and thin out documents so that the sources meet their weights."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every document, and decode it to prove that nothing is lost."""
    return bytebpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


#: The stages of the pipeline: (name, function of the session, the documents and the folder of the tables).
PIPELINE = [
    ("language_id", keep_known_languages),
    ("ngram_jaccard_join", keep_one_of_each),
    ("secret_scans", mask_secrets),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]
