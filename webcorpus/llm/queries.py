"""One query per operator, with production parameters over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.llm import byte_bpe, classifier, decontaminate, fertility, fill_middle, line_dedup
from webcorpus.llm import mixing, perspectives, prefix_trie, simhash, token_counts, toxicity, wrappers
from webcorpus.llm.common import docs


def tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(docs(spark, sf_dir), tokenizer("word_bpe_49k.json"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(docs(spark, sf_dir))


def op4_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.quality(docs(spark, sf_dir), tokenizer("piece_bpe_32k.model"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(docs(spark, sf_dir),
                                      spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op6_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(docs(spark, sf_dir)).select("doc_id", "text", "n_removed")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(docs(spark, sf_dir))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = tokenizer("byte_bpe_50k.tiktoken")
    encoded = byte_bpe.encode(docs(spark, sf_dir), path, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fill_in_middle(docs(spark, sf_dir)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.digests(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: value for name, value in globals().items() if name.startswith("op")}


def all_sql() -> dict[str, str]:
    return {"op1_perspectives": perspectives.SQL, "op3_mix_sources": mixing.SQL,
            "op7_line_dedup": line_dedup.SQL, "op12_fill_in_middle": fill_middle.SQL,
            "op13_prefix_trie": prefix_trie.SQL}
