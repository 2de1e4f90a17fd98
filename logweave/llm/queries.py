"""The registered queries of the operators on documents, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import (
    centroids,
    exact_dedup,
    fingerprint,
    html_text,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    quality,
    secrets,
    suffix_dedup,
    toxicity,
    whitening,
)
from logweave.session import pin

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(pin(spark), sf_dir.rstrip("/"))

    _QUERIES[fn.__name__] = pinned
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_fingerprint(spark, sf):
    return fingerprint.edited(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


@query
def op2_secrets(spark, sf):
    return secrets.find(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


@query
def op3_html_text(spark, sf):
    return html_text.extract(table(spark, sf, "pages")).withColumnRenamed("id", "page_id")


@query
def op4_toxicity(spark, sf):
    found = toxicity.score(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return found.withColumnRenamed("id", "doc_id")


@query
def op5_quality(spark, sf):
    found = quality.score(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return found.withColumnRenamed("id", "doc_id")


@query
def op6_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), tokenizer_file()).withColumnRenamed("id", "doc_id")


@query
def op7_near_dedup(spark, sf):
    found = near_dedup.dedup(table(spark, sf, "documents"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", kept.alias("kept"))


@query
def op8_suffix_dedup(spark, sf):
    found = suffix_dedup.dedup(table(spark, sf, "documents"))
    kept = F.sha2(F.col("kept"), 256).alias("kept_sha256")
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", kept)


@query
def op9_exact_dedup(spark, sf):
    found = exact_dedup.dedup(table(spark, sf, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


@query
def op10_mixing(spark, sf):
    return mixing.mixed(table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


@query
def op11_whitening(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings")).withColumnRenamed("id", "vec_id")


@query
def op12_line_dedup(spark, sf):
    found = line_dedup.dedup(table(spark, sf, "documents"))
    kept = F.sha2(F.col("kept"), 256).alias("kept_sha256")
    return found.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", kept)


@query
def op13_centroids(spark, sf):
    return centroids.cluster(table(spark, sf, "embeddings")).withColumnRenamed("id", "vec_id")
