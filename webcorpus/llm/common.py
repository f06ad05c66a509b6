"""What several operators share: words, row prefix sums over hot groups, text batches in tasks."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from webcorpus.session import written

# A word: no ASCII white space in it. bytes.split() cuts at exactly these characters.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def prefix_sums(df: DataFrame, keys: list[str], order: list[Column], name: str,
                **values: Column) -> DataFrame:
    """Add per value `<out>`: its sum over the rows of the same keys that come before in `order`.

    Rows are dealt by range of (keys, order), so a key with a third of all rows is spread over
    many partitions; a window sums inside a partition, and one row per key and partition carries
    the total on. Rows that agree in `order` are told apart by their place in the input. The dealt
    rows are written, so that both reads see the same partitions, also after lost executors.
    """
    tie = F.monotonically_increasing_id()
    named = df.select("*", *[v.alias(f"_v_{out}") for out, v in values.items()],
                      *[c.alias(f"_o{i}") for i, c in enumerate(order)], tie.alias("_tie"))
    by = [*[f"_o{i}" for i in range(len(order))], "_tie"]
    dealt = written(named.repartitionByRange(partitions(df), *keys, *by)
                    .withColumn("_part", F.spark_partition_id()), name)
    null_safe = [F.struct(*keys).alias("_key")] if keys else [F.lit(0).alias("_key")]
    dealt = dealt.select("*", *null_safe)
    sums = dealt.groupBy("_key", "_part").agg(
        *[F.sum(f"_v_{out}").alias(f"_s_{out}") for out in values])
    earlier = W.partitionBy("_key").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("_key", "_part", *[
        F.coalesce(F.sum(f"_s_{out}").over(earlier), F.lit(0)).alias(f"_b_{out}") for out in values])
    inside = W.partitionBy("_key", "_part").orderBy(*by).rowsBetween(W.unboundedPreceding, -1)
    rows = dealt.select("*", *[
        F.coalesce(F.sum(f"_v_{out}").over(inside), F.lit(0)).alias(f"_i_{out}") for out in values])
    joined = rows.alias("r").join(
        starts.alias("s"), (F.col("r._key").eqNullSafe(F.col("s._key")))
        & (F.col("r._part") == F.col("s._part")))
    return joined.select(*[F.col(f"r.`{c}`") for c in df.columns], *[
        (F.col(f"s._b_{out}") + F.col(f"r._i_{out}")).alias(out) for out in values])


def without_rows(documents: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents but for the rows that `gone` lists as (doc_id, th), th being the text's hash.

    Rows are held as one value in between, so that no column's name can clash.
    """
    held = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    listed = gone.select(F.col("doc_id").alias("gone_id"), F.col("th").alias("gone_th"))
    kept = held.join(listed, F.col("row.doc_id").eqNullSafe(F.col("gone_id"))
                     & (F.xxhash64("row.text") == F.col("gone_th")), "left_anti")
    return kept.select(*[F.col("row")[c].alias(c) for c in documents.columns])


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into smaller ones, so that working memory follows few texts only."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers of every executor, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="run-"), "webcorpus.zip")  # the driver serves it
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as packed:
        for folder, _, names in os.walk(os.path.join(top, "webcorpus")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    packed.write(full, os.path.relpath(full, top))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def map_batches(df: DataFrame, task: Callable, schema: str | StructType) -> DataFrame:
    """mapInArrow with a task that may import this package."""
    ship(df.sparkSession)
    return df.mapInArrow(task, schema)


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
