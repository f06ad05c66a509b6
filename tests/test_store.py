"""The table that is keyed by content: what it reads, what it keeps, what a failure leaves."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from webcorpus import schemas
from webcorpus.plans import fixtures as fx
from webcorpus.sources import articles as article_io
from webcorpus.sources import store
from webcorpus.sources.store import KeyedTable

SF = "/root/testdata/sf0.001"


def rows_of(spark, *keys, first=0):
    return spark.createDataFrame([(k, first + n) for n, k in enumerate(keys)], "k string, at long")


def table(spark, folder, buckets=8):
    return KeyedTable(spark, folder + "/t", rows_of(spark, "x").schema, "k", buckets)


def add(made, batch):
    made.append(made.unseen(batch, "at"))
    return sorted((tuple(r) for r in made.rows().collect()), key=str)


def test_first_rows_stay_across_batches_and_compactions(spark, folder):
    made = table(spark, folder)
    assert made.rows().count() == 0 and made.among(rows_of(spark, "a")) is None
    assert add(made, rows_of(spark, "b", "a", "b")) == [("a", 1), ("b", 0)]
    made.compact()
    assert add(made, rows_of(spark, "c", "b", first=10)) == [("a", 1), ("b", 0), ("c", 10)]
    assert add(made, rows_of(spark, "c", "b", first=20)) == [("a", 1), ("b", 0), ("c", 10)]
    for _ in range(3):
        made.compact()
        assert add(made, rows_of(spark)) == [("a", 1), ("b", 0), ("c", 10)]
    assert len(glob.glob(folder + "/t/version=*")) == 2  # the one that counts, and the one before it
    assert made.state().buckets == 8 and table(spark, folder, 99).state().buckets == 8


def test_keys_without_text(spark, folder):
    """A null key is a key of its own, found by no comparison: its rows are kept, one per batch."""
    made = table(spark, folder)
    batch = spark.createDataFrame([(None, 1), (None, 2), ("", 3)], "k string, at long")
    assert [r for r in add(made, batch) if r[0] == ""] == [("", 3)]
    assert [r for r in add(made, batch) if r[0] == ""] == [("", 3)]


def test_many_keys_are_joined_without_a_broadcast(spark, folder, monkeypatch):
    made = table(spark, folder)
    add(made, rows_of(spark, *[f"k{n}" for n in range(200)]))
    monkeypatch.setattr(store, "SENT", 10)
    got = add(made, rows_of(spark, *[f"k{n}" for n in range(100, 300)], first=1000))
    assert len(got) == 300 and sum(at >= 1000 for _, at in got) == 100


def test_a_small_batch_reads_its_own_buckets_and_moves_no_rows(spark, folder):
    made = table(spark, folder, buckets=32)
    add(made, rows_of(spark, *[f"k{n}" for n in range(2000)]))
    found = made.among(rows_of(spark, "k1", "k2", "nothing"))
    assert sorted(r.k for r in found.collect()) == ["k1", "k2"]
    plan = found.select("k")._jdf.queryExecution().executedPlan().toString()
    asked = {pmod for pmod in (r[0] for r in rows_of(spark, "k1", "k2", "nothing").select(
        made.bucket(F.col("k"), made.state())).collect())}
    listed = re.search(r"PartitionFilters: \[[^]]*bucket#\d+ (?:IN \(|= )([\d,]+)", plan)[1]
    assert {int(b) for b in listed.split(",")} == asked
    assert "ReadSchema: struct<k:string>" in plan and "hashpartitioning(k" not in plan
    assert "BroadcastHashJoin" in plan


def test_what_a_failed_compaction_left_does_not_count(spark, folder):
    made = table(spark, folder)
    add(made, rows_of(spark, "a", "b"))
    half = rows_of(spark, "a").withColumns({"version": F.lit(1), "bucket": F.lit(0)})
    half.write.partitionBy("version", "bucket").mode("append").parquet(folder + "/t")
    assert made.rows().count() == 2
    made.compact()
    assert made.rows().count() == 2


def test_serial_numbers_go_on_after_a_failure(spark, folder):
    path = folder + "/s"
    articles = fx.articles(spark, SF)
    first = article_io.articles_sink(articles.filter("id <= 50"), path, "id")
    made = article_io.article_table(spark, path)
    state = made.state()
    made._note(store.State(state.buckets, state.version, state.last + 5))  # noted, but never written
    article_io.articles_sink(articles.filter("id > 50"), path, "id")
    ids = sorted(r.id for r in made.rows().select("id").collect())
    assert ids[:first] == list(range(1, first + 1)) and ids[first] == first + 6 and len(set(ids)) == len(ids)


def test_plain_files_are_read_but_not_taken_for_a_keyed_table(spark, folder):
    path = folder + "/plain"
    fx.articles(spark, SF).write.parquet(path)
    assert article_io.articles_source(spark, path).columns == schemas.ARTICLE_FIELDS
    with pytest.raises(ValueError):
        article_io.articles_sink(fx.articles(spark, SF), path, "id")
