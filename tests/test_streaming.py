import glob
import os
import shutil

import compare
from pyspark.sql import functions as F

from webcorpus import settings
from webcorpus.operators import analytics, dedupe
from webcorpus.operators.messages import article_messages
from webcorpus.plans import collect, fixtures as fx, oracle, queries as plans
from webcorpus.session import written
from webcorpus.sources import articles as article_io
from webcorpus.sources import messages as message_io
from webcorpus.sources import store as store_module
from webcorpus.streaming import ingest, messages as consumers, stats

SF = "/root/testdata/sf0.001"


def test_ingest_in_batches_equals_one_batch(spark, folder):
    source, store, mark = folder + "/pages", folder + "/store", folder + "/mark"
    fx.pages(spark, SF).orderBy("page_id").repartitionByRange(3, "page_id").write.parquet(source)
    want = {r.content_fp for r in collect.good_articles(fx.pages(spark, SF)).collect()}

    def run():
        stream = article_io.pages_stream(spark, source, files_per_batch=1)
        ingest.stream_ingest(stream, store, mark).awaitTermination()
        return article_io.articles_source(spark, store).collect()

    rows = run()
    assert {r.content_fp for r in rows} == want and len(rows) == len(want)
    assert sorted(r.id for r in rows) == list(range(1, len(want) + 1))
    assert len(run()) == len(want)
    # New files with old contents, and a lost checkpoint, add nothing either.
    fx.pages(spark, SF).write.mode("append").parquet(source)
    assert len(run()) == len(want)
    mark = folder + "/mark2"
    assert len(run()) == len(want)


def test_stateful_dedupe(spark, folder):
    source, mark, out = folder + "/rows", folder + "/mark", folder + "/out"
    rows = fx.articles(spark, SF).select("id", "content_fp")
    rows.repartition(3).write.parquet(source)
    for _ in range(2):
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
        (ingest.stateful_dedupe(stream, "content_fp").writeStream.format("parquet")
         .option("checkpointLocation", mark).trigger(availableNow=True).start(out).awaitTermination())
    got = [r.content_fp for r in spark.read.parquet(out).collect()]
    want = {r.content_fp for r in rows.collect()}
    assert len(got) == len(want) and set(got) == want


def test_publish_and_consume_once(spark, folder):
    store, topic = folder + "/store", folder + "/topic"
    article_io.articles_sink(fx.articles(spark, SF), store, "id")

    def run():
        stream = article_io.articles_stream(spark, store)
        message_io.message_sink(stream, folder + "/mark_a", path=topic).awaitTermination()
        source = message_io.message_source(spark, path=topic, files_per_batch=1)
        consumers.stream_consume(source, folder + "/shown", folder + "/mark_b").awaitTermination()
        return spark.read.parquet(folder + "/shown").count()

    n = article_io.articles_source(spark, store).count()
    assert run() == n
    assert run() == n
    sent = {r.value for r in spark.read.text(topic).collect()}
    assert sent == {r.value for r in article_messages(article_io.articles_source(spark, store)).collect()}


def test_messages_wait_for_their_articles(spark, folder):
    store, topic, out, mark = (folder + f"/{name}" for name in ("store", "topic", "texts", "mark"))
    unique = dedupe.first_wins(fx.articles(spark, SF), "content_fp", "id")
    values = article_messages(unique).select("value")
    values.coalesce(1).write.text(topic)

    def run():
        consumers.stream_fulltext(message_io.message_source(spark, path=topic), store, out, mark).awaitTermination()
        return spark.read.parquet(out).count() if glob.glob(out + "/batch=*") else 0

    assert run() == 0  # no store yet: all wait
    article_io.articles_sink(unique.filter("id <= 60"), store, "id")
    spark.createDataFrame([('{"url": "u", "content_fp": "nowhere"}',), ("{}",), ("broken",)], "value string") \
        .write.mode("append").text(topic)
    early = unique.filter("id <= 60").count()
    assert run() == early
    article_io.articles_sink(unique, store, "id")
    values.limit(1).coalesce(1).write.mode("append").text(topic)  # a message once more
    assert run() == unique.count() + 1
    got = spark.read.parquet(out).drop("batch")
    want = dedupe.fulltext_lookup(message_io.decode_messages(values), unique).select(got.columns)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}


def test_stats_equal_the_batch_reports(spark, folder):
    source = folder + "/articles"
    articles = fx.articles(spark, SF)
    articles.repartition(3).write.parquet(source)
    out, mark = folder + "/stats", folder + "/marks"

    def refresh():
        stream = spark.readStream.schema(articles.schema).option("maxFilesPerTrigger", 1).parquet(source)
        for query in stats.stream_stats(stream, out, mark, trigger={"availableNow": True}).values():
            query.awaitTermination()

    refresh()
    refresh()  # nothing new: the figures stay
    assert stats.totals(spark, out, fx.AS_OF).collect() == analytics.article_totals(articles, fx.AS_OF).collect()
    assert stats.domains(spark, out).collect() == analytics.domain_top10(articles).collect()
    assert stats.trend(spark, out).collect() == analytics.daily_trend(articles).collect()
    # One more article, a day later: today starts again, the total goes on.
    before = stats.totals(spark, out, fx.AS_OF).first().total
    articles.limit(1).withColumn("crawled_at", F.lit("2031-05-06 07:00:00").cast("timestamp")) \
        .write.mode("append").parquet(source)
    refresh()
    assert tuple(stats.totals(spark, out, "2031-05-06").first()) == (before + 1, 1)


def test_reports_of_ids_whose_minutes_pass_an_int(spark, folder):
    asked, sql = plans.all_queries(), oracle.all_sql()
    for low in (3_469_200, 20_000_000):
        sf = f"{folder}/{low}"
        fx.table(spark, SF, "documents").withColumn("doc_id", F.col("doc_id") + low) \
            .coalesce(1).write.parquet(f"{sf}/made")
        shutil.copy(glob.glob(f"{sf}/made/part-*.parquet")[0], f"{sf}/documents.parquet")
        db = compare.connect(sf)
        for name in ("stream_stats", "article_totals", "daily_trend", "kpi_cards"):
            assert compare.differences(asked[name](spark, sf), db, sql[name]) == ""


def test_default_refresh_interval():
    assert settings.STATS_INTERVAL == "15 seconds"


def test_streams_read_tables_in_one_file_or_in_a_folder_of_files(spark, folder):
    sizes = {"documents": 7, "pages": 5}
    for name, n in sizes.items():
        fx.table(spark, SF, name).limit(n).repartition(3).write.parquet(f"{folder}/many/{name}.parquet")
        os.makedirs(f"{folder}/one", exist_ok=True)
        fx.table(spark, f"{folder}/many", name).coalesce(1).write.parquet(f"{folder}/single/{name}")
        shutil.copy(glob.glob(f"{folder}/single/{name}/part-*.parquet")[0], f"{folder}/one/{name}.parquet")
    asked = plans.all_queries()
    for at in ("many", "one"):
        got = {(r.view, r.name): r.value for r in asked["stream_stats"](spark, f"{folder}/{at}").collect()}
        assert got["totals", "total"] == 7
        assert asked["stream_consume"](spark, f"{folder}/{at}").count() == 7
        pages = article_io.pages_stream(spark, f"{folder}/{at}", glob="pages.parquet")
        shown, mark = f"{folder}/shown_{at}", f"{folder}/mark_{at}"
        pages.writeStream.format("parquet").option("checkpointLocation", mark) \
            .trigger(availableNow=True).start(shown).awaitTermination()
        assert spark.read.parquet(shown).count() == 5


def test_batches_of_the_queries_are_written_by_many_tasks(spark, folder, monkeypatch):
    for name in ("documents", "pages"):
        fx.table(spark, SF, name).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    made = {}
    monkeypatch.setattr(plans, "fresh_dir", lambda _, name: made.setdefault(name, f"{folder}/{name}"))
    asked, db = plans.all_queries(), compare.connect(SF)
    monkeypatch.setattr(plans, "written", lambda df, name: written(df.repartition(3), name))  # as of larger tables
    for name, source, batches in (("stream_dedupe", "articles", 4), ("stream_ingest_runs", "pages", 4),
                                  ("fulltext_lookup_stream", "topic", 3)):
        made.clear()
        made.update({x: f"{folder}/{name}/{x}" for x in (source, "checkpoint")})
        got = asked[name](spark, folder)
        assert compare.differences(got, db, oracle.all_sql()[name]) == ""
        assert len(glob.glob(f"{made[source]}/part-*")) > batches  # one file each came from one task
        assert len(glob.glob(f"{made['checkpoint']}/commits/[0-9]*")) == batches


def test_many_messages_meet_bodies_that_were_not_moved_before(spark, folder, monkeypatch):
    store, topic, out, mark = (folder + f"/{name}" for name in ("store", "topic", "texts", "mark"))
    unique = dedupe.first_wins(fx.articles(spark, SF), "content_fp", "id")
    article_io.articles_sink(unique, store, "id")
    article_messages(unique.filter("id % 3 = 0")).select("value").write.text(topic)
    monkeypatch.setattr(store_module, "SENT", 10)
    monkeypatch.setattr(consumers, "fulltext_lookup", lambda asked, stored: plan_of.append(
        stored._jdf.queryExecution().executedPlan().toString()) or dedupe.fulltext_lookup(asked, stored))
    plan_of = []
    consumers.stream_fulltext(message_io.message_source(spark, path=topic), store, out, mark).awaitTermination()
    assert len(plan_of) == 1 and "Exchange" not in plan_of[0]
    got = spark.read.parquet(out).drop("batch")
    want = unique.filter("id % 3 = 0").select(got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert not spark.read.parquet(out + ".waiting").count()
