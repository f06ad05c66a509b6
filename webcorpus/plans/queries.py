"""One query per operator, each over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus import schemas
from webcorpus.functions import addresses, urls
from webcorpus.operators import (
    admission, analytics, comments, dedupe, extract, frontier, jobs, links, messages, numbering,
    quality)
from webcorpus.plans import collect, fixtures as fx
from webcorpus.session import fresh_dir, written
from webcorpus.sources import articles as article_io
from webcorpus.sources import comments as comment_io
from webcorpus.sources import links as link_io
from webcorpus.sources import messages as message_io
from webcorpus.sources import seeds as seed_io
from webcorpus.sources.files import streamed
from webcorpus.sources.store import KeyedTable
from webcorpus.streaming import ingest, messages as consumers, stats

Query = Callable[[SparkSession, str], DataFrame]
_ALL: dict[str, Query] = {}


def query(name: str):
    def add(build: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(spark, sf.rstrip("/"))
        _ALL[name] = run
        return build
    return add


def all_queries() -> dict[str, Query]:
    return dict(_ALL)


# ---- inputs several queries share ---------------------------------------------------------------

def _document_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    docs = spark.readStream.schema(schema).parquet(streamed(sf, "documents.parquet"))
    return fx.articles_from(docs)


def _known_split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Articles stored before the run, and the incoming rest."""
    articles = fx.articles(spark, sf)
    return articles.filter("id % 37 = 0"), articles.filter("id % 37 <> 0")


def _half_split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A store filled from the first half of the articles, and the second half."""
    articles = fx.articles(spark, sf)
    half = F.floor(articles.agg(F.count("*")).scalar() / 2)
    target = dedupe.first_wins(articles.filter(F.col("id") <= half), "content_fp", "id")
    return target, articles.filter(F.col("id") > half)


def _page_docs(spark: SparkSession, sf: str) -> DataFrame:
    return comments.parse_pages(fx.raw_comment_pages(spark, sf))


def _all_page_docs(spark: SparkSession, sf: str) -> DataFrame:
    return _page_docs(spark, sf).unionByName(comments.parse_pages(fx.empty_comment_pages(spark, sf)))


def _comments(spark: SparkSession, sf: str) -> DataFrame:
    return comments.flatten_comments(_page_docs(spark, sf))


def _known_comments(spark: SparkSession, sf: str) -> DataFrame:
    talk = fx.table(spark, sf, "conversations").filter("turn = 0 AND conv_id % 5 = 0")
    return talk.select((F.col("conv_id") * 1000 + F.col("turn")).cast("string").alias("id"))


def _posts(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("post")).distinct()


def _page_hosts(spark: SparkSession, sf: str) -> DataFrame:
    return fx.pages(spark, sf).select("page_id", "url", urls.host_of(F.col("url")).alias("host"))


def _allowed_page_hosts(spark: SparkSession, sf: str) -> DataFrame:
    return _page_hosts(spark, sf).filter("page_id % 3 = 0").select("host").distinct()


def _frontier(spark: SparkSession, sf: str, **options) -> DataFrame:
    """From every fiftieth page, with scheme, host and address as for any URL that is to be collected."""
    seeds = fx.link_pages(spark, sf).filter("page_id % 50 = 0").select("url")
    table = link_io.store_links(fx.link_pages(spark, sf), fresh_dir(spark, "links"))
    allowed = spark.createDataFrame([("news.example.com",)], "host string")
    hosts = written(admission.host_table(allowed, fx.site_lookups(spark, sf)), "hosts")

    def admit(df: DataFrame) -> DataFrame:
        return admission.admission_by(df, hosts).filter("reject_reason IS NULL").drop("reject_reason")

    return frontier.crawl_frontier(seeds, table, admit, **options)


def _as_store(df: DataFrame) -> DataFrame:
    """Store columns with the body as length and fingerprint and the time as text."""
    return df.select("id", "url", "url_fp", "title", "published",
                     F.length("content_md").cast("long").alias("content_len"), "content_fp",
                     F.date_format("crawled_at", "yyyy-MM-dd HH:mm:ss").alias("crawled_at"))


# ---- sources and sinks --------------------------------------------------------------------------

def _seed_file(spark: SparkSession, sf: str) -> str:
    path = fresh_dir(spark, "seeds")
    page = F.col("page_id")
    fx.pages(spark, sf).select(
        F.when(page % 5 == 0, F.concat(F.lit(" # "), "url"))
         .when(page % 7 == 0, F.lit(" \t"))
         .otherwise(F.concat(F.lit("　\t"), F.col("url"), F.lit("  # entry  ")))).write.text(path)
    return path


@query("seeds_source")
def _(spark, sf):
    return seed_io.seeds_source(spark, _seed_file(spark, sf))


@query("seed_override")
def _(spark, sf):
    entry = fx.pages(spark, sf).agg(F.min_by("url", "page_id")).first()[0]
    return seed_io.seeds_source(spark, _seed_file(spark, sf), seed_url=f"  {entry} ")


@query("host_list")
def _(spark, sf):
    lists = _page_hosts(spark, sf).select(
        F.concat("host", F.lit(", ,　www."), "host", F.lit(" ,")).alias("hosts"))
    return seed_io.host_list(lists)


@query("pages_source")
def _(spark, sf):
    return article_io.pages_source(spark, f"{sf}/pages.parquet").select(
        "page_id", "url", F.length("html").cast("long").alias("html_len"),
        F.sha1("html").alias("html_fp"))


@query("articles_source")
def _(spark, sf):
    path = fresh_dir(spark, "store")
    fx.articles(spark, sf).write.parquet(path)
    return _as_store(article_io.articles_source(spark, path))


@query("articles_ddl")
def _(spark, sf):
    path = fresh_dir(spark, "table")
    name = "articles_" + path[-8:]
    article_io.articles_ddl(spark, name, path)
    fx.articles(spark, sf).select(schemas.ARTICLE_FIELDS).write.insertInto(name)
    article_io.articles_ddl(spark, name, path)
    return _as_store(article_io.articles_source(spark, name))


@query("articles_sink")
def _(spark, sf):
    path = fresh_dir(spark, "store")
    first = article_io.articles_sink(fx.articles(spark, sf), path, "id")
    again = article_io.articles_sink(fx.articles(spark, sf), path, "id")
    return article_io.articles_source(spark, path).agg(
        F.count("*").alias("stored"), F.count_distinct("content_fp").alias("contents"),
        F.max("id").alias("last_id"),
    ).select("*", F.lit(first).cast("long").alias("inserted"),
             F.lit(again).cast("long").alias("inserted_again"))


@query("articles_sink_runs")
def _(spark, sf):
    """A large load, two small ones with contents of the first among theirs, and a compaction."""
    path = fresh_dir(spark, "store")
    articles = fx.articles(spark, sf)
    for part in ("id % 3 <> 0", "id % 60 = 0", "id % 3 = 0 OR id % 100 = 1"):
        article_io.articles_sink(articles.filter(part), path, "id")
    article_io.article_table(spark, path).compact()
    return _as_store(article_io.articles_source(spark, path))


def _published(spark: SparkSession, sf: str) -> str:
    path = fresh_dir(spark, "topic")
    message_io.message_sink(_document_stream(spark, sf), fresh_dir(spark, "checkpoint"),
                            path=path).awaitTermination()
    return path


@query("message_sink")
def _(spark, sf):
    return spark.read.text(_published(spark, sf))


@query("message_source")
def _(spark, sf):
    out = fresh_dir(spark, "decoded")
    (message_io.message_source(spark, path=_published(spark, sf)).writeStream.format("parquet")
     .option("path", out).option("checkpointLocation", fresh_dir(spark, "checkpoint"))
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(schemas.MESSAGE).parquet(out)


def _comment_csv(spark: SparkSession, sf: str) -> str:
    path = fresh_dir(spark, "comments")
    comment_io.comments_csv_sink(comments.comment_dedupe(_comments(spark, sf)), path)
    return path


@query("comments_csv_sink")
def _(spark, sf):
    return comment_io.comments_csv_source(spark, _comment_csv(spark, sf))


@query("seen_comment_ids")
def _(spark, sf):
    return comment_io.seen_comment_ids(spark, _comment_csv(spark, sf))


@query("comment_pages_source")
def _(spark, sf):
    path = fresh_dir(spark, "pages")
    _page_docs(spark, sf).write.json(path)
    return comment_io.comment_pages_source(spark, path).select(
        "post", "page", F.size("data").cast("long").alias("comments"), "max_id")


@query("progress_store")
def _(spark, sf):
    path = fresh_dir(spark, "progress")
    docs = _page_docs(spark, sf)
    comment_io.save_progress(comments.comment_progress(comments.page_cap(docs, 2)), path)
    comment_io.save_progress(comments.comment_progress(docs), path)
    return comment_io.load_progress(spark, path)


# ---- projections --------------------------------------------------------------------------------

@query("normalize_urls")
def _(spark, sf):
    return extract.normalize_urls(fx.page_urls(spark, sf))


@query("url_fingerprints")
def _(spark, sf):
    return extract.url_fingerprints(fx.page_urls(spark, sf)).select("page_id", "url_fp")


@query("url_parts")
def _(spark, sf):
    return extract.url_parts(fx.page_urls(spark, sf)).select("page_id", "scheme", "host")


@query("url_domain")
def _(spark, sf):
    return extract.url_domain(fx.page_urls(spark, sf)).select("page_id", "domain")


@query("extract_links")
def _(spark, sf):
    return links.extract_links(fx.pages_to_extract(spark, sf))


@query("resolve_links")
def _(spark, sf):
    return links.resolve_links(links.extract_links(fx.pages_to_extract(spark, sf)))


@query("extract_text")
def _(spark, sf):
    return extract.extract_text(fx.pages_to_extract(spark, sf)).select("page_id", "content_md")


@query("extract_metadata")
def _(spark, sf):
    return extract.extract_metadata(fx.pages_to_extract(spark, sf)).select("page_id", "title", "published")


@query("build_articles")
def _(spark, sf):
    return extract.build_articles(fx.pages_to_extract(spark, sf))


@query("extract_text_unmarked")
def _(spark, sf):
    return extract.extract_text(fx.unmarked_pages(spark, sf)).select("page_id", "content_md")


@query("extract_metadata_linked")
def _(spark, sf):
    return extract.extract_metadata(fx.unmarked_pages(spark, sf)).select("page_id", "title", "published")


@query("build_articles_unmarked")
def _(spark, sf):
    return extract.build_articles(fx.unmarked_pages(spark, sf))


@query("article_messages")
def _(spark, sf):
    return messages.article_messages(fx.articles(spark, sf))


@query("article_rows")
def _(spark, sf):
    return analytics.article_rows(fx.articles(spark, sf))


@query("article_detail")
def _(spark, sf):
    return analytics.article_detail(fx.articles(spark, sf), 14)


@query("flatten_comments")
def _(spark, sf):
    return _comments(spark, sf)


@query("next_page_token")
def _(spark, sf):
    return comments.next_page_token(_page_docs(spark, sf))


@query("job_briefs")
def _(spark, sf):
    return jobs.job_briefs(fx.jobs(spark, sf))


@query("elapsed_mmss")
def _(spark, sf):
    seconds = F.col("value") * 60 + F.col("seq") % 60
    return fx.jobs(spark, sf).select("seq", jobs.elapsed_mmss(seconds).alias("elapsed"))


@query("content_length_meta")
def _(spark, sf):
    return analytics.content_length_meta(fx.articles(spark, sf))


# ---- filters ------------------------------------------------------------------------------------

@query("filter_scheme")
def _(spark, sf):
    return admission.filter_scheme(fx.candidate_urls(spark, sf))


@query("filter_hosts")
def _(spark, sf):
    return admission.filter_hosts(fx.page_urls(spark, sf), _allowed_page_hosts(spark, sf))


@query("filter_domain_suffix")
def _(spark, sf):
    return admission.filter_domain_suffix(fx.page_urls(spark, sf), "example.com")


@query("filter_blocked_ips")
def _(spark, sf):
    return admission.filter_blocked_ips(fx.addresses(spark, sf))


@query("filter_blocked_ips_table")
def _(spark, sf):
    """The fixed ranges and own ones as a table: nested, overlapping and repeated ranges, single addresses."""
    ranges = spark.createDataFrame(addresses.default_ranges() + fx.OWN_RANGES, "cidr string, blocked boolean")
    return admission.filter_blocked_ips(fx.addresses(spark, sf), ranges)


@query("admission")
def _(spark, sf):
    judged = admission.admission(fx.candidate_urls(spark, sf), fx.allowed_hosts(spark, sf),
                                 fx.host_lookups(spark, sf))
    return judged.select("c_custkey", F.coalesce("reject_reason", F.lit("")).alias("reject_reason"))


@query("seed_admission")
def _(spark, sf):
    judged = admission.seed_admission(fx.candidate_urls(spark, sf), fx.allowed_hosts(spark, sf))
    return judged.select("c_custkey", "url",
                         F.coalesce("reject_reason", F.lit("")).alias("reject_reason"))


def _resolved(spark: SparkSession, sf: str) -> DataFrame:
    return links.resolve_links(links.extract_links(fx.link_pages(spark, sf))).select(
        "page_id", "abs_url")


@query("article_url_filter")
def _(spark, sf):
    return links.article_url_filter(_resolved(spark, sf))


@query("error_link_filter")
def _(spark, sf):
    return links.error_link_filter(_resolved(spark, sf))


@query("page_link_distinct")
def _(spark, sf):
    return links.page_link_distinct(fx.link_pages(spark, sf)).select("page_id", "abs_url")


@query("min_article_chars")
def _(spark, sf):
    text = extract.extract_text(fx.pages_to_extract(spark, sf).unionByName(fx.link_pages(spark, sf)))
    return extract.min_article_chars(text).select(
        "page_id", "url", F.length("content_md").cast("long").alias("content_len"))


def _rule(name: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rules = dict(quality.QualityRules().ordered())
        return fx.articles(spark, sf).filter(rules[name]).select("id")
    return run


query("quality_title")(_rule("title"))
query("quality_error_url")(_rule("error"))
query("quality_min_chars")(_rule("short"))
query("quality_nav")(_rule("nav"))


@query("quality_filter")
def _(spark, sf):
    return quality.quality_filter(fx.articles(spark, sf)).select("id", "content_fp")


# ---- joins, dedupe, upsert ----------------------------------------------------------------------

@query("host_semi_join")
def _(spark, sf):
    return admission.host_semi_join(_page_hosts(spark, sf), _allowed_page_hosts(spark, sf))


@query("resolve_hosts")
def _(spark, sf):
    hosts = fx.candidate_urls(spark, sf).select("c_custkey", urls.host_of(F.col("url")).alias("host"))
    return admission.resolve_hosts(hosts, fx.host_lookups(spark, sf))


@query("unseen_urls")
def _(spark, sf):
    return dedupe.unseen_urls(fx.page_urls(spark, sf), "page_id", fx.known_urls(spark, sf))


@query("content_dedupe")
def _(spark, sf):
    known, incoming = _known_split(spark, sf)
    return dedupe.content_dedupe(incoming, "id", known).select("id", "url", "content_fp")


@query("comment_dedupe")
def _(spark, sf):
    return comments.comment_dedupe(_comments(spark, sf), _known_comments(spark, sf)).select(
        "post", "page", "id")


@query("fulltext_lookup")
def _(spark, sf):
    stored = dedupe.first_wins(fx.articles(spark, sf), "content_fp", "id")
    sent = messages.decode_messages(messages.article_messages(stored))
    return dedupe.fulltext_lookup(sent, stored)


@query("fulltext_lookup_stream")
def _(spark, sf):
    """Three batches of messages, two of them ahead of the articles that are stored later."""
    articles = fx.articles(spark, sf)
    first = written(dedupe.first_wins(articles.drop("content_md"), "content_fp", "id"), "first")
    stored = first.join(articles.select("id", "content_fp", "content_md"), ["id", "content_fp"])
    topic, store, out, mark = (fresh_dir(spark, name) for name in ("topic", "store", "texts", "checkpoint"))
    sent = messages.article_messages(first).select("value", F.pmod(F.xxhash64("key"), F.lit(3)).alias("part"))
    for part, load in ((0, "id % 4 = 0"), (1, None), (2, "id % 4 <> 0")):
        if load:
            article_io.articles_sink(stored.filter(load), store, "id")
        sent.filter(F.col("part") == part).select("value").write.mode("append").text(topic)
        consumers.stream_fulltext(message_io.message_source(spark, path=topic), store, out, mark).awaitTermination()
    return spark.read.parquet(out).drop("batch")


@query("pending_posts")
def _(spark, sf):
    progress = comments.comment_progress(comments.page_cap(_page_docs(spark, sf), 2))
    posts = _posts(spark, sf).union(spark.createDataFrame([("-1",)], "post string"))
    return comments.pending_posts(posts, progress)


@query("insert_if_absent")
def _(spark, sf):
    target, incoming = _half_split(spark, sf)
    return _as_store(dedupe.insert_if_absent(target, incoming, "id"))


@query("rank_duplicates")
def _(spark, sf):
    known, incoming = _known_split(spark, sf)
    return dedupe.rank_duplicates(incoming, known)


# ---- aggregations -------------------------------------------------------------------------------

@query("article_totals")
def _(spark, sf):
    return analytics.article_totals(fx.articles(spark, sf), fx.AS_OF)


@query("domain_top10")
def _(spark, sf):
    return analytics.domain_top10(fx.articles(spark, sf))


@query("domain_top10_pages")
def _(spark, sf):
    return collect.top_domains(fx.pages_to_extract(spark, sf))


@query("daily_trend")
def _(spark, sf):
    return analytics.daily_trend(fx.articles(spark, sf))


@query("kpi_cards")
def _(spark, sf):
    return analytics.kpi_cards(fx.articles(spark, sf), fx.AS_OF)


@query("domain_share")
def _(spark, sf):
    return analytics.domain_share(fx.articles(spark, sf))


@query("quality_drop_stats")
def _(spark, sf):
    return quality.quality_drop_stats(fx.articles(spark, sf))


@query("ingest_run_stats")
def _(spark, sf):
    known, incoming = _known_split(spark, sf)
    return analytics.ingest_run_stats(incoming, known)


@query("fingerprint_cardinality")
def _(spark, sf):
    return analytics.fingerprint_cardinality(fx.articles(spark, sf))


@query("ingest_run_observed")
def _(spark, sf):
    """The same counts, taken while a run into a store goes on."""
    known, incoming = _known_split(spark, sf)
    store = fresh_dir(spark, "store")
    article_io.articles_sink(known, store, "id")
    counts = collect.ingest_articles(incoming, store, "id")
    return spark.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in counts.items()])


@query("fingerprint_sketches")
def _(spark, sf):
    """Sketches of five loads against the exact sizes: within four standard errors of them."""
    path, articles = fresh_dir(spark, "sketches"), fx.articles(spark, sf)
    for load in range(5):
        analytics.fingerprint_sketch(articles.filter(F.col("id") % 5 >= load)).write.mode("append").parquet(path)
    merged = analytics.sketched_cardinality(spark.read.parquet(path))
    exact = analytics.fingerprint_cardinality(articles)
    far = 4 * 1.04 / 2 ** (analytics.SKETCH / 2)
    return exact.select("urls", "contents", *[
        (F.abs(merged.select(c).scalar() - F.col(c)) <= F.ceil(far * F.col(c))).alias(f"{c}_close")
        for c in ("urls", "contents")])


@query("comment_page_totals")
def _(spark, sf):
    return comments.comment_page_totals(_all_page_docs(spark, sf), _known_comments(spark, sf))


@query("comment_progress")
def _(spark, sf):
    return comments.comment_progress(_page_docs(spark, sf))


@query("article_count")
def _(spark, sf):
    return analytics.article_count(fx.articles(spark, sf))


@query("seen_count")
def _(spark, sf):
    return comments.seen_count(_comments(spark, sf))


# ---- sequences ----------------------------------------------------------------------------------

@query("first_wins")
def _(spark, sf):
    return dedupe.first_wins(fx.articles(spark, sf), "content_fp", "id").select("id", "content_fp")


@query("comment_page_log")
def _(spark, sf):
    return comments.comment_page_log(_all_page_docs(spark, sf), _known_comments(spark, sf))


@query("assign_ids")
def _(spark, sf):
    target, incoming = _half_split(spark, sf)
    fresh = dedupe.content_dedupe(incoming, "id", target).select(F.col("id").alias("arrival"))
    return numbering.assign_ids(fresh, "arrival", dedupe.max_id(target))


# ---- sort, limit, frontier ----------------------------------------------------------------------

@query("article_page")
def _(spark, sf):
    return analytics.article_page(fx.articles(spark, sf), page=2, size=20)


@query("article_page_deep")
def _(spark, sf):
    """A page in the last tenth of the list, with stored counts of small blocks."""
    articles, path = fx.articles(spark, sf), fresh_dir(spark, "blocks")
    analytics.id_blocks(articles, 64).write.parquet(path)
    pages = articles.count() // 7
    return analytics.article_page(articles, pages * 9 // 10, 7, spark.read.parquet(path), 64)


@query("recent_jobs")
def _(spark, sf):
    return jobs.recent_jobs(fx.jobs(spark, sf))


@query("crawl_frontier")
def _(spark, sf):
    return _frontier(spark, sf)


@query("link_graph")
def _(spark, sf):
    """Three loads, the last with pages of the first two among its own: the stored links are each page's once."""
    path, pages = fresh_dir(spark, "links"), fx.link_pages(spark, sf)
    for part in ("page_id % 3 = 0", "page_id % 3 = 1", "page_id % 2 = 0 OR page_id % 3 = 2"):
        link_io.store_links(pages.filter(part), path)
    return link_io.link_table(spark, path).rows().select("src_fp", F.inline_outer("links"))


@query("frontier_budget")
def _(spark, sf):
    return frontier.frontier_budget(_frontier(spark, sf), fx.link_pages(spark, sf),
                                    page_budget=5, item_budget=3)


@query("follow_links_switch")
def _(spark, sf):
    return _frontier(spark, sf, follow_links=False)


@query("page_cap")
def _(spark, sf):
    return comments.comment_progress(comments.page_cap(_page_docs(spark, sf), 2))


@query("frontier_host_cap")
def _(spark, sf):
    return frontier.frontier_host_cap(_page_hosts(spark, sf), "page_id", per_host=2)


@query("retry_candidates")
def _(spark, sf):
    return frontier.retry_candidates(fx.fetch_log(spark, sf))


# ---- sets ---------------------------------------------------------------------------------------

@query("register_fingerprints")
def _(spark, sf):
    incoming = extract.url_fingerprints(fx.page_urls(spark, sf))
    return dedupe.register_fingerprints(fx.known_urls(spark, sf), incoming)


@query("new_fingerprints")
def _(spark, sf):
    incoming = extract.url_fingerprints(fx.page_urls(spark, sf))
    return dedupe.new_fingerprints(fx.known_urls(spark, sf), incoming)


# ---- streaming ----------------------------------------------------------------------------------

@query("stream_ingest")
def _(spark, sf):
    store = fresh_dir(spark, "store")
    source = article_io.pages_stream(spark, sf, glob="pages.parquet")
    ingest.stream_ingest(source, store, fresh_dir(spark, "checkpoint")).awaitTermination()
    return article_io.articles_source(spark, store).select(
        "id", "url", "url_fp", "title", "published", "content_fp")


@query("stream_ingest_runs")
def _(spark, sf):
    """Four batches: the pages in three parts, then copies of every third page under other addresses."""
    source, store, mark = (fresh_dir(spark, name) for name in ("pages", "store", "checkpoint"))
    for part in fx.page_runs(spark, sf):
        part.write.mode("append").parquet(source)
        ingest.stream_ingest(article_io.pages_stream(spark, source), store, mark).awaitTermination()
    article_io.article_table(spark, store).compact()
    return article_io.articles_source(spark, store).select(
        "id", "url", "url_fp", "title", "published", "content_fp")


@query("stream_dedupe")
def _(spark, sf):
    """Four batches: a run for each, which goes on from the checkpoint of the one before."""
    source, out, mark = (fresh_dir(spark, name) for name in ("articles", "unique", "checkpoint"))
    rows = written(fx.articles(spark, sf).select("id", "url", "content_fp"), "rows")
    for part in range(4):
        rows.filter((F.floor(F.col("id") / 64) % 4 == part)).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        ingest.stream_dedupe(stream, "content_fp", "id", out, mark).awaitTermination()
    return KeyedTable(spark, out, rows.schema, "content_fp").rows().select("id", "content_fp")


@query("stream_consume")
def _(spark, sf):
    out = fresh_dir(spark, "shown")
    consumers.stream_consume(message_io.message_source(spark, path=_published(spark, sf)), out,
                             fresh_dir(spark, "checkpoint")).awaitTermination()
    return spark.read.schema("title string, url string").parquet(out)


@query("stream_stats")
def _(spark, sf):
    out = fresh_dir(spark, "stats")
    running = stats.stream_stats(_document_stream(spark, sf), out, fresh_dir(spark, "checkpoint"),
                                 trigger={"availableNow": True})
    for refresh in running.values():
        refresh.awaitTermination()
    totals = stats.totals(spark, out, fx.AS_OF).select(F.inline(F.array(
        F.struct(F.lit("total").alias("name"), F.col("total").alias("value")),
        F.struct(F.lit("today").alias("name"), F.col("today").alias("value")))))
    return (totals.select(F.lit("totals").alias("view"), "name", "value")
            .union(stats.domains(spark, out).select(F.lit("domains"), "name", "value"))
            .union(stats.trend(spark, out).select(F.lit("trend"), "date", "count")))


@query("resume")
def _(spark, sf):
    store, progress = fresh_dir(spark, "comments"), fresh_dir(spark, "progress")
    posts, docs = _posts(spark, sf), _page_docs(spark, sf)
    collect.collect_comments(spark, posts, docs, store, progress, cap=2)
    collect.collect_comments(spark, posts, docs, store, progress)
    return comment_io.comments_csv_source(spark, store).select("id", "region", "text")
