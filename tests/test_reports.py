import datetime

import pytest
from pyspark.sql import functions as F

from webcorpus import schemas
from webcorpus.operators import analytics, jobs, messages
from webcorpus.plans import collect
from webcorpus.sources import seeds as seed_io


def store(spark, n=45):
    rows = [(i, f"http://h{i % 12}.com/x", f"u{i}", "" if i % 2 else f"t{i}", "" if i % 3 else "d",
             "字" * i, f"c{i}", datetime.datetime(2023 + i % 2, 5, 1 + i % 3, 6, 7, 8))
            for i in range(1, n + 1)]
    return spark.createDataFrame(rows, schemas.ARTICLE).repartition(4)


@pytest.mark.parametrize("block", [1 << 16, 7, 1])
def test_paging(spark, block):
    articles = store(spark)

    def ids(**where):
        return [r.id for r in analytics.article_page(articles, block=block, **where).collect()]

    assert ids() == list(range(45, 25, -1))
    assert ids(page=3) == [5, 4, 3, 2, 1]
    assert ids(page=4) == []
    assert ids(page=-2, size=0) == [45]
    assert ids(page=0, size=1000) == list(range(45, 0, -1))
    row = analytics.article_page(articles, size=1).first()
    assert row.title == "(无标题)" and row.published == "d" and row.content_len == 45
    assert row.crawled_at == "2024-05-01 06:07"


def test_pages_of_a_list_with_gaps(spark, folder):
    articles = store(spark, 200).filter("id % 7 > 2 AND id NOT BETWEEN 60 AND 120")
    analytics.id_blocks(articles, 16).write.parquet(folder + "/blocks")
    blocks = spark.read.parquet(folder + "/blocks")
    want = sorted((r.id for r in articles.collect()), reverse=True)
    for page in (1, 3, 6, 9, 10, 11, 99):
        got = analytics.article_page(articles, page, 8, blocks, 16).collect()
        assert [r.id for r in got] == want[8 * page - 8:8 * page]
    plan = analytics.article_page(articles, 9, 8, blocks, 16)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") < 12 and "Sort [id#" in plan


def test_run_is_counted_in_one_read(spark, folder):
    path = folder + "/in"
    articles = store(spark, 60).withColumn("content_md", F.concat(F.lit("长" * 300), F.col("id") % 20)) \
        .withColumn("content_fp", F.sha1("content_md")).withColumn("url", F.when(F.col("id") % 10 == 3, "http://h/error").otherwise(F.col("url")))
    articles.write.parquet(path)
    stored = spark.read.schema(schemas.ARTICLE).parquet(path)
    reads = []

    def watched(frame):
        reads.append(frame)
        return frame

    got = collect.ingest_articles(watched(stored), folder + "/store", "id")
    assert got == {"dropped": 6, "duplicate": 36, "inserted": 18, "sent": 18}
    again = collect.ingest_articles(stored, folder + "/store", "id")
    assert again == {"dropped": 6, "duplicate": 54, "inserted": 0, "sent": 0}
    assert collect.ingest_articles(stored.limit(0), folder + "/store", "id") == dict.fromkeys(got, 0)


def test_sketches_of_several_loads(spark):
    loads = [spark.range(k * 4000, k * 4000 + 10000).select(
        F.sha1((F.col("id") % 9000).cast("string")).alias("url_fp"), F.sha1(F.col("id").cast("string")).alias("content_fp"))
        for k in range(4)]
    sketches = [analytics.fingerprint_sketch(load) for load in loads]
    merged = sketches[0].union(sketches[1]).union(sketches[2]).union(sketches[3])
    got = analytics.sketched_cardinality(merged).first()
    assert abs(got.urls - 9000) < 0.05 * 9000 and abs(got.contents - 22000) < 0.05 * 22000
    row = sketches[0].first()
    assert len(row.urls) < 8192


def test_detail(spark):
    row = analytics.article_detail(store(spark), 4).first()
    assert (row.title, row.published, row.content_md) == ("t4", "-", "字" * 4)
    assert analytics.article_detail(store(spark), 999).collect() == []


def test_totals_domains_trend(spark):
    articles = store(spark)
    assert tuple(analytics.article_totals(articles, "2024-05-01").first()) == (45, 8)
    top = [tuple(r) for r in analytics.domain_top10(articles).collect()]
    assert top[:3] == [("h1.com", 4), ("h2.com", 4), ("h3.com", 4)] and len(top) == 10
    assert [tuple(r) for r in analytics.daily_trend(articles).collect()] == [
        ("05-01", 15), ("05-02", 15), ("05-03", 15)]
    assert tuple(analytics.kpi_cards(articles, "2024-05-01").first()) == (45, 8, 10, 15)
    assert abs(sum(r.share for r in analytics.domain_share(articles).collect()) - 100) < 0.01


def test_empty_store(spark):
    empty = spark.createDataFrame([], schemas.ARTICLE)
    assert tuple(analytics.kpi_cards(empty).first()) == (0, 0, 0, 0)
    assert analytics.article_page(empty).collect() == []
    assert tuple(analytics.fingerprint_cardinality(empty).first()) == (0, 0)
    assert tuple(analytics.ingest_run_stats(empty, empty).first()) == (0, 0, 0, 0)


def test_approximate_cardinality_is_close(spark):
    frame = spark.range(20_000).select(F.sha1(F.col("id").cast("string")).alias("url_fp"),
                                       F.lit("x").alias("content_fp"))
    urls, contents = analytics.fingerprint_cardinality(frame, approximate=True).first()
    assert abs(urls - 20_000) < 2_000 and contents == 1


def test_messages_carry_no_body(spark):
    value = messages.article_messages(store(spark).filter("id = 2")).first().value
    assert value == ('{"url":"http://h2.com/x","url_fp":"u2","title":"t2","published":"",'
                     '"content_fp":"c2"}')
    sent = spark.createDataFrame([(value.encode(),), (b'{"title":"","url":"z"}',)], "value binary")
    shown = messages.message_rows(messages.decode_messages(sent)).collect()
    assert [tuple(r) for r in shown] == [("t2", "http://h2.com/x"), ("(无标题)", "z")]


def test_seed_lines(spark, folder):
    path = folder + "/seeds.txt"
    with open(path, "w", encoding="utf-8") as f:
        f.write("# comment\n  # another\n\n   \n http://a.com/x  \nhttp://b.com   # entry\n")
    assert sorted(r.url for r in seed_io.seeds_source(spark, path).collect()) == [
        "http://a.com/x", "http://b.com   # entry"]
    assert [r.url for r in seed_io.seeds_source(spark, path, " http://c.com ").collect()] == [
        "http://c.com"]
    assert seed_io.seeds_source(spark, folder + "/none.txt").collect() == []
    hosts = seed_io.host_list(spark.createDataFrame([("a, b,,c",), (" ,a",)], "hosts string"))
    assert sorted(r.host for r in hosts.collect()) == ["a", "b", "c"]


def test_jobs(spark):
    rows = [(i, f"{i:08d}rest", None if i == 1 else "article", s, "2026-08-01 10:00:00.123456", None)
            for i, s in enumerate(["pending", "finished", "running"] * 7)]
    frame = spark.createDataFrame(rows, "seq long, id string, spider string, state string,"
                                        "start_time string, end_time string")
    got = jobs.recent_jobs(frame).collect()
    assert sorted(r.seq for r in got if r.state == "finished") == [7, 10, 13, 16, 19]
    assert sum(r.state != "finished" for r in got) == 14
    first = next(r for r in got if r.seq == 0)
    assert (first.id, first.start_time, first.end_time) == ("00000000", "2026-08-01 10:00:00", "")
    assert jobs.job_briefs(frame).filter("seq = 1").first().spider == ""
    times = spark.createDataFrame([(125.9,), (0.0,), (6000.0,)], "s double").select(
        jobs.elapsed_mmss(F.col("s")))
    assert [r[0] for r in times.collect()] == ["02:05", "00:00", "100:00"]
