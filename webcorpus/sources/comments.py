"""Comment pages, the comment CSV, and the progress store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus import schemas, settings
from webcorpus.sources.files import exists

_CSV = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def comment_pages_source(spark: SparkSession, path: str) -> DataFrame:
    """(post, page, data, max_id) from files of one JSON document per line."""
    fields = {f.name: f for f in schemas.COMMENT_PAGE}
    schema = "post string, page bigint, data {}, max_id bigint".format(
        fields["data"].dataType.simpleString())
    return spark.read.schema(schema).json(path)


def comments_csv_sink(comments: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Append as CSV; every part file has a byte-order mark and one header line.

    Texts may hold line breaks, so a file is read by one task: `rows_per_file` bounds its size.
    """
    header = ["﻿" + settings.COMMENT_CSV_FIELDS[0], *settings.COMMENT_CSV_FIELDS[1:]]
    (comments.select("id", "screen_name", "region", "text").toDF(*header)
     .write.mode("append").options(**_CSV, maxRecordsPerFile=rows_per_file, emptyValue="").csv(path))


def comments_csv_source(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(schemas.COMMENT_CSV).options(**_CSV, multiLine="true").csv(path)
    return rows.na.fill("")


def comments_sink(comments: DataFrame, path: str, fmt: str = "csv") -> None:
    """Append comments as CSV, or as Parquet, which gives up its ids without reading the texts."""
    if fmt == "csv":
        comments_csv_sink(comments, path)
    else:
        comments.select("id", "screen_name", "region", "text").write.mode("append").parquet(path)


def comments_source(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    if fmt == "csv":
        return comments_csv_source(spark, path)
    return spark.read.schema(schemas.COMMENT_CSV).parquet(path)


def seen_comment_ids(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """(id): the distinct comment ids stored so far; none when there is no file yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], "id string")
    return comments_source(spark, path, fmt).select("id").distinct()


def load_progress(spark: SparkSession, path: str) -> DataFrame:
    """(post, max_id, page, done): the latest state of every post; empty before the first run."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.PROGRESS)
    log = spark.read.schema("post string, max_id bigint, page bigint, done boolean, run bigint") \
        .parquet(path)
    latest = log.groupBy("post").agg(F.max_by(F.struct("max_id", "page", "done"), "run").alias("s"))
    return latest.select("post", "s.*")


def save_progress(progress: DataFrame, path: str) -> None:
    """Append the states of one run; the state read before is never overwritten."""
    spark = progress.sparkSession
    run = 0
    if exists(spark, path):
        run = spark.read.schema("run bigint").parquet(path).agg(F.max("run")).first()[0] or 0
    rows = progress.select("post", "max_id", "page", "done", F.lit(run + 1).cast("long").alias("run"))
    rows.write.mode("append").parquet(path)
