"""Message envelopes: metadata and fingerprints, never the body."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus import schemas, settings
from webcorpus.functions.text import or_default

_FIELDS = schemas.MESSAGE.fieldNames()


def article_messages(articles: DataFrame) -> DataFrame:
    """One JSON `value` per article, keyed by content fingerprint."""
    return articles.select(F.col("content_fp").alias("key"),
                           F.to_json(F.struct(*_FIELDS)).alias("value"))


def decode_messages(values: DataFrame) -> DataFrame:
    """The message columns of a frame with a `value` of JSON text or bytes."""
    body = F.from_json(F.col("value").cast("string"), schemas.MESSAGE)
    return values.select(body.alias("m")).select("m.*")


def message_rows(messages: DataFrame) -> DataFrame:
    """What a consumer shows: title or its placeholder, and url."""
    return messages.select(
        or_default(F.col("title"), settings.NO_TITLE).alias("title"), "url")
