"""Running totals and serial numbers without ever ordering a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from webcorpus.session import written

# Most rows of one key that any task sorts.
BLOCK = 1 << 16


def running_total(df: DataFrame, keys: list[str], order: str, value: Column, out: str,
                  block: int = BLOCK) -> DataFrame:
    """Add `out`: the sum of `value` up to and including the row, per key, by `order`.

    `order` is a whole number, unique per key. Rows are cut into blocks of `block` consecutive
    order values, so a block holds at most `block` rows however large its key is; the block sums,
    a small table, carry the total from one block to the next. `df` is read twice (block sums,
    then rows): hand in a stored or cached frame when it is costly to compute.
    """
    place = F.col(order).cast("long")
    cut = df.withColumns({"_block": place - F.pmod(place, F.lit(block)), "_value": value})
    sums = cut.groupBy(*keys, "_block").agg(F.sum("_value").alias("_sum"))
    before = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(
        *keys, "_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy(*keys, "_block").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return (
        cut.withColumn("_inside", F.sum("_value").over(inside))
        .join(starts, [*keys, "_block"])
        .withColumn(out, F.col("_start") + F.col("_inside"))
        .drop("_block", "_value", "_start", "_inside")
    )


def assign_ids(df: DataFrame, arrival: str | list[str], after: Column | int = 0,
               out: str = "id") -> DataFrame:
    """Serial ids after + 1, after + 2, … in order of `arrival`, which orders the rows totally.

    The rows are dealt to tasks by ranges of `arrival`, however dense or sparse its values are, and
    stored with the number of their range; the counts of the ranges, a few rows, carry the ids on.
    """
    order = [arrival] if isinstance(arrival, str) else arrival
    dealt = written(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = W.partitionBy().orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = dealt.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    start = after if isinstance(after, Column) else F.lit(after)
    rank = F.row_number().over(W.partitionBy("_range").orderBy(*order))
    return (dealt.withColumn("_rank", rank).join(starts, "_range")
            .withColumn(out, (start + F.col("_start") + F.col("_rank")).cast("long"))
            .select(*[c for c in df.columns if c != out], out))
