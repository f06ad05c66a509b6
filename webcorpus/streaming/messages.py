"""Message consumers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from webcorpus.operators.dedupe import fulltext_lookup
from webcorpus.operators.messages import message_rows
from webcorpus.session import written
from webcorpus.sources.articles import article_table
from webcorpus.sources.files import exists


def stream_consume(messages: DataFrame, path: str, checkpoint: str,
                   trigger: dict | None = None) -> StreamingQuery:
    """Append message rows to `path`; one checkpoint per consumer group keeps its offsets."""
    return (message_rows(messages).writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def stream_fulltext(messages: DataFrame, store: str, path: str, checkpoint: str,
                    trigger: dict | None = None) -> StreamingQuery:
    """Append messages with the bodies of their articles to `path`, as they come.

    A message may be ahead of its article: it waits, beside `path`, and is looked up again with every
    later batch. A batch reads the store in the buckets of its own messages. What a batch writes goes
    to a folder of its number, so a batch that is repeated replaces what it wrote before. One
    checkpoint per `path`.
    """
    def write(batch: DataFrame, number: int) -> None:
        spark, waiting = batch.sparkSession, f"{path}.waiting/batch={{}}"
        known = batch.filter(F.col("content_fp").isNotNull())
        if exists(spark, waiting.format(number - 1)):
            known = known.unionByName(spark.read.schema(batch.schema).parquet(waiting.format(number - 1)))
        asked = written(known, "messages")
        stored = article_table(spark, store).beside(asked.select("content_fp").distinct())
        late = asked
        if stored is not None:
            late = asked.join(stored.select("content_fp"), "content_fp", "left_anti").select(asked.columns)
            fulltext_lookup(asked, stored).write.mode("overwrite").parquet(f"{path}/batch={number}")
        late.write.mode("overwrite").parquet(waiting.format(number))

    return (messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
