"""Incremental collection: pages to the article store, and first-wins across runs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from webcorpus.operators.extract import build_articles
from webcorpus.operators.quality import QualityRules, quality_filter
from webcorpus.sources.articles import articles_sink
from webcorpus.sources.files import spread
from webcorpus.sources.store import BUCKETS, KeyedTable

_ONCE = {"availableNow": True}


def _per_batch(stream: DataFrame, write: Callable[[DataFrame], None], checkpoint: str,
               trigger: dict | None) -> StreamingQuery:
    return (stream.writeStream.foreachBatch(lambda batch, _: write(batch))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or _ONCE)).start())


@contextmanager
def _cached(df: DataFrame) -> Iterator[DataFrame]:
    """Rows of one batch that are read more than once; lost blocks are computed again."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def stream_ingest(pages: DataFrame, path: str, checkpoint: str, rules: QualityRules | None = None,
                  trigger: dict | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Stream of pages -> articles -> quality rules -> insert-if-absent into the store at `path`.

    One query per store: batches are serial, so check and append cannot race. A replayed batch
    finds its contents stored and appends nothing. A batch reads the store in its own buckets only.
    """
    def write(batch: DataFrame) -> None:
        articles = quality_filter(build_articles(spread(batch)), rules)
        with _cached(articles.withColumn("crawled_at", F.current_timestamp())) as fresh:
            articles_sink(fresh, path, "page_id", buckets)

    return _per_batch(pages, write, checkpoint, trigger)


def stream_dedupe(rows: DataFrame, key: str, arrival: str, path: str, checkpoint: str,
                  trigger: dict | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Append the first row of every key to the keyed table at `path`, across batches and restarts."""
    schema = rows.schema

    def write(batch: DataFrame) -> None:
        table = KeyedTable(batch.sparkSession, path, schema, key, buckets)
        state = table.state()
        table.append(table.unseen(batch, arrival, state), state)

    return _per_batch(rows, write, checkpoint, trigger)


def stateful_dedupe(rows: DataFrame, key: str) -> DataFrame:
    """The same with the keys in Spark's state store: no read of the target per batch.

    The state holds every key for good (session.py selects RocksDB for it); within one batch any
    of several copies may win.
    """
    return rows.dropDuplicates([key])
