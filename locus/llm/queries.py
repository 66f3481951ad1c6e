"""The registered queries: thin digests of each operator's own output.

Each reads its whole table and passes its production parameters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from locus.llm import (byte_bpe, embedding_dedup, filter_audit, importance, licenses, line_dedup, order_minhash, packing, pii, simhash,
                       substring_dedup, token_counts, toxicity)
from locus.llm.columns import hex_digest

TOKEN_LIMIT = 2048
#: Words of a shingle, and bits by which linked fingerprints differ at most.
SIMHASH_SHINGLE, SIMHASH_RADIUS = 3, 3
#: Words of a window that is removed where it repeats.
WINDOW_WORDS = 50
#: Least cosine of linked vectors.
COSINE = 0.95
#: Documents from which a line is dropped.
LINE_DOCS = 10


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as vocab

    return packing.pack(read(spark, sf_dir, "documents"), vocab.path("byte_bpe_50k.json"), vocab.PATTERN, TOKEN_LIMIT)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as vocab

    return token_counts.token_counts(read(spark, sf_dir, "documents"), vocab.path("word_bpe_49k.json"), TOKEN_LIMIT) \
        .select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(read(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.sanitise(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return out.select("doc_id", *map(count, pii.KINDS), hex_digest(pii.listed(F.col("base"))).alias("base_sha256"),
                      pii.listed(pii.ordered(F.concat("base", "terms"))).alias("spans"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as vocab

    path = vocab.path("byte_bpe_50k.tiktoken")
    tokens = byte_bpe.encode(read(spark, sf_dir, "documents"), path, vocab.PATTERN)
    return byte_bpe.decode(tokens, path, vocab.PATTERN).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        hex_digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"), threshold=COSINE)
    return out.select("vec_id", "n_links", F.col("component").alias("component_id"),
                      (F.col("vec_id") == F.col("component")).alias("kept"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=SIMHASH_SHINGLE, radius=SIMHASH_RADIUS)
    return out.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"),
                      F.col("component").alias("component_id"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup(read(spark, sf_dir, "documents"), length=WINDOW_WORDS)
    return out.select("doc_id", "n_words", "n_removed", hex_digest(F.col("kept")).alias("kept_sha256"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    index = line_dedup.LineIndex(spark, min_chars=1).insert(docs)
    return index.drop(docs, min_docs=LINE_DOCS).select(
        "doc_id", "n_lines", "n_dropped", hex_digest(F.col("kept")).alias("kept_sha256"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["exact"])
    labels = lambda x: F.array_join(F.array_sort(F.array_distinct(x["label"])), ",")
    return out.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(base["start"]).alias("first_word"), F.array_max(base["start"]).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.col("spans")["similarity"]), F.lit(0.0)).alias("score"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")) \
        .select("doc_id", "n_features", "weight", "score", "rank")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}
