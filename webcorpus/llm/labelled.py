"""Labelled rows to learn from: a bounded, reproducible sample outside the held-out fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.session import written

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether a row belongs to the fold that nothing is learnt from; a null id does."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def sample(documents: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(text, y): at most `limit` labelled documents by the hash of their id, stored.

    Ids with several labels count as 1 if any is; null ids, labels and texts are left out, and so
    are held-out ids. Texts that occur several times come once. The ids, `limit` at most, are broadcast.
    """
    ids = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()
                        & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max(label).cast("double").alias("y")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = documents.select("doc_id", "text").filter("text IS NOT NULL").join(
        F.broadcast(written(ids, "ids")), "doc_id")
    return written(rows.select("text", "y", F.xxhash64("text").alias("_th"))
                   .dropDuplicates(["_th"]).select("text", "y"), "sample")


def prior(n: int, ones: float) -> float:
    """Log odds of label 1 where nothing else is known."""
    from math import log

    share = (ones + 0.05) / (n + 1)
    return log(share / (1 - share))
