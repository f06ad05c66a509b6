"""Message topics: Kafka where its connector is present, folders of JSON text otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from webcorpus import settings
from webcorpus.operators.messages import article_messages, decode_messages


def message_sink(articles: DataFrame, checkpoint: str, path: str | None = None,
                 bootstrap: str | None = None, topic: str = settings.MESSAGE_TOPIC,
                 trigger: dict | None = None) -> StreamingQuery:
    """Publish a stream of stored articles as its own query with its own checkpoint.

    It reads the store, not the ingest query, so that a failing broker never holds up storage.
    """
    values = article_messages(articles)
    if bootstrap:
        writer = values.writeStream.format("kafka").options(
            **{"kafka.bootstrap.servers": bootstrap, "topic": topic})
    else:
        writer = values.select("value").writeStream.format("text").option("path", path)
    return writer.option("checkpointLocation", checkpoint) \
        .trigger(**(trigger or {"availableNow": True})).start()


def message_values(spark: SparkSession, path: str | None = None, bootstrap: str | None = None,
                   topic: str = settings.MESSAGE_TOPIC,
                   files_per_batch: int | None = None) -> DataFrame:
    """The raw `value` stream from its earliest message on."""
    if bootstrap:
        return (spark.readStream.format("kafka")
                .options(**{"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
                            "startingOffsets": "earliest"}).load().select("value"))
    reader = spark.readStream.schema("value string").format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def message_source(spark: SparkSession, **where) -> DataFrame:
    """Decoded messages from the earliest on."""
    return decode_messages(message_values(spark, **where))
