"""Documents to a training mixture: each stage works on all that the one before it kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.llm import decontaminate, fertility, line_dedup, mixing, simhash
from webcorpus.llm.common import docs
from webcorpus.llm.queries import tokenizer
from webcorpus.session import written


def good_quality(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the tokenizer's figures reject go."""
    return fertility.good(documents, tokenizer("piece_bpe_32k.model"))


def without_repeated_lines(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """Passages found before go; a document of which nothing but white space is left goes too."""
    others = [c for c in documents.columns if c not in ("doc_id", "text")]
    row = F.struct(*[F.col(f"`{c}`") for c in others]).alias("row")
    changed = line_dedup.line_dedup(documents.select("doc_id", "text", row), short=True)
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    new = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.when(
        F.col("n_removed") > 0, F.length("text")).otherwise(F.col("row.n_chars"))
        .cast(documents.schema["n_chars"].dataType)}
    return changed.filter(~emptied).select(*[
        (new[c] if c in new else F.col("row")[c]).alias(c) for c in documents.columns])


def without_near_copies(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-copies stays, the one with the smallest doc_id.

    Near-copies are those of the operator: fingerprints of 3-word shingles, at most 2 bits apart.
    """
    return simhash.keep_one(documents)


def without_benchmark(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a region that repeats a benchmark item go."""
    return decontaminate.clean(documents, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mixture takes of each document."""
    return mixing.mix(documents)


STAGES = [
    ("quality_rules", good_quality),
    ("line_dedup", without_repeated_lines),
    ("simhash", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixture),
]

# Tokenizer statistics, SimHash and banded alignment are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; what a stage returns is written and read again for the next."""
    return reduce(lambda kept, stage: written(stage[1](spark, kept, sf_dir), stage[0]),
                  STAGES, docs(spark, sf_dir))
