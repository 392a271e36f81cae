"""The registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.hard_negatives import hard_negatives
from tally.llm.licenses import license_scan
from tally.llm.line_crf import LineField, fit, held_out, quality_scores, training_texts
from tally.llm.mixing import mix_sources
from tally.llm.packing import best_fit_packing
from tally.llm.periodic_runs import periodic_runs, run_digests
from tally.llm.quality_rules import quality_rules
from tally.llm.scratch import new_path
from tally.llm.secrets import secret_scan
from tally.llm.shingle_join import shingle_components
from tally.llm.token_counts import token_counts
from tally.llm.token_files import read_token_files, token_digests, write_token_files
from tally.llm.url_filter import url_filter, url_filter_sql
from tally.llm.vector_join import nearest


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def quality_field(spark: SparkSession, docs: DataFrame, sf_dir: str) -> LineField:
    """The field fitted to the labels of documents that are not held out."""
    return fit(*training_texts(docs, table(spark, sf_dir, "labels").where(~held_out())))


def op3_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, quality_field(spark, docs, sf_dir)).withColumn("held_out", held_out())


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_digests(read_token_files(spark, path))


def op6_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op9_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_components(table(spark, sf_dir, "documents"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    id_, label = F.col("vec_id"), F.col("label")
    changed = F.when(id_ % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(table(spark, sf_dir, "embeddings"), id_ % 100 == 0, label=changed)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """One text in ten (by a hash of doc_id) repeats some of its words from a place on; all else stays as it is."""
    hashed = F.crc32(F.col("doc_id").cast("string"))
    split = docs.withColumns({"words__": F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), ""), "g__": (hashed / 10).cast("long")})
    n = F.size("words__")
    placed = split.withColumn("a__", (F.col("g__") % F.greatest(n, F.lit(1))).cast("int"))
    period = (1 + F.floor((n - F.col("a__")) / (3 + F.col("g__") % 8))).cast("int")
    sized = placed.withColumn("p__", period)
    root = F.slice("words__", F.col("a__") + 1, F.greatest(F.col("p__"), F.lit(1)))
    rest = n - F.col("a__")
    tail = F.slice(F.flatten(F.array_repeat(root, F.ceil(rest / F.col("p__")).cast("int"))), F.lit(1), rest)
    planted = F.array_join(F.concat(F.slice("words__", F.lit(1), F.col("a__")), tail), " ")
    return sized.withColumn("text", F.when((hashed % 10 == 0) & (n > 0), planted).otherwise(F.col("text"))).drop("words__", "g__", "a__", "p__")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_quality_rules": op2_quality_rules,
    "op3_line_crf": op3_line_crf,
    "op4_token_counts": op4_token_counts,
    "op5_token_files": op5_token_files,
    "op6_nearest_vectors": op6_nearest_vectors,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_secret_scan": op8_secret_scan,
    "op9_shingle_join": op9_shingle_join,
    "op10_mix_sources": op10_mix_sources,
    "op11_url_filter": op11_url_filter,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {
    "op6_nearest_vectors": """
        WITH v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), p AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
        ), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
    """,
    "op11_url_filter": url_filter_sql(),
    "op12_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        QUALIFY rank <= 5
    """,
}
