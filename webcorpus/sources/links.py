"""The link graph, stored as the links of each page and keyed by the page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from webcorpus import schemas
from webcorpus.operators.links import page_links
from webcorpus.sources.store import BUCKETS, KeyedTable


def link_table(spark: SparkSession, path: str, buckets: int = BUCKETS) -> KeyedTable:
    return KeyedTable(spark, path, schemas.PAGE_LINKS, "src_fp", buckets)


def store_links(pages: DataFrame, path: str, buckets: int = BUCKETS) -> KeyedTable:
    """Add the links of pages that are not in the table yet; the first page of an address counts.

    Pages without links are kept too, so that they are known. Pages give up their links where they
    are read, and only these are moved.
    """
    table = link_table(pages.sparkSession, path, buckets)
    state = table.state()
    table.append(table.unseen(page_links(pages), "page_id", state), state)
    return table
