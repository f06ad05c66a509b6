"""Stored pages and the article store."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus import schemas
from webcorpus.operators.dedupe import arrivals, numbered
from webcorpus.operators.numbering import assign_ids
from webcorpus.sources.files import exists, spread, streamed
from webcorpus.sources.store import BUCKETS, KeyedTable


def pages_source(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAGE).parquet(path)


def pages_to_extract(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages, on at least as many tasks as there are cores."""
    return spread(pages_source(spark, path))


def pages_stream(spark: SparkSession, path: str, glob: str | None = None,
                 files_per_batch: int | None = None) -> DataFrame:
    """Stored pages as they come; `glob` names the files below `path`, or the folders that hold them."""
    reader = spark.readStream.schema(schemas.PAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(streamed(path, glob) if glob else path)


def articles_ddl(spark: SparkSession, name: str, location: str) -> None:
    """Create the article table unless it exists."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.ARTICLE)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"LOCATION '{location}'")


def article_table(spark: SparkSession, path: str, buckets: int = BUCKETS) -> KeyedTable:
    """The store below `path`, keyed by content."""
    return KeyedTable(spark, path, schemas.ARTICLE, "content_fp", buckets)


def articles_source(spark: SparkSession, name_or_path: str) -> DataFrame:
    """The store, by table name or by folder; an empty frame while the folder holds nothing.

    A folder may hold a keyed store or plain files.
    """
    if "/" not in name_or_path:
        return spark.table(name_or_path)
    table = article_table(spark, name_or_path)
    if table.exists():
        return table.rows()
    if not exists(spark, name_or_path):
        return spark.createDataFrame([], schemas.ARTICLE)
    return spark.read.schema(schemas.ARTICLE).parquet(name_or_path)


def articles_jdbc(spark: SparkSession, url: str, table: str = "articles", partitions: int = 64,
                  lower: int = 1, upper: int = 1 << 31, **options: str) -> DataFrame:
    """The store in a relational database, read in id ranges (needs the driver's jar)."""
    return spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn="id", lowerBound=str(lower),
        upperBound=str(upper), numPartitions=str(partitions), **options).load()


def articles_stream(spark: SparkSession, path: str) -> DataFrame:
    """What is added to the store, as a stream. Files that a compaction writes come once more."""
    return spark.readStream.schema(schemas.ARTICLE).parquet(path).select(schemas.ARTICLE_FIELDS)


def articles_sink(incoming: DataFrame, path: str, arrival: str, buckets: int = BUCKETS) -> int:
    """Append what is new to the store below `path`; returns the number of rows inserted.

    One writer at a time. A replay inserts nothing, because the store itself is the set of
    known contents. The store is read in the buckets that `incoming` falls in, and there only its
    fingerprints; ids go on from the number kept beside it. `incoming` is read twice, for its
    fingerprints and for the rows that win: hand in a stored or cached frame.
    """
    table = article_table(incoming.sparkSession, path, buckets)
    if "crawled_at" not in incoming.columns:
        incoming = incoming.withColumn("crawled_at", F.current_timestamp())
    state = table.state()
    fresh = table.unseen(arrivals(incoming, arrival), "_at", state)
    ids = assign_ids(fresh, ["_at", "content_fp"], state.last)
    inserted = ids.count()
    if inserted:
        table.append(numbered(incoming, arrival, ids), replace(state, last=state.last + inserted))
    return inserted
