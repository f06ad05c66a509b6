"""Derived inputs (see FIXTURES.md), computed by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webcorpus.operators.extract import url_fingerprints
from webcorpus.session import written
from webcorpus.sources.files import spread

AS_OF = "2024-01-02"
SITE = "http://news.example.com"

# Addresses at the edges of the blocked ranges.
EDGE_ADDRESSES = [
    "0.0.0.1", "9.255.255.255", "10.0.0.0", "10.255.255.255", "11.0.0.0", "100.64.0.1",
    "127.0.0.1", "169.254.1.1", "172.15.255.255", "172.16.0.0", "172.31.255.255", "172.32.0.0",
    "192.0.0.8", "192.0.0.9", "192.0.0.10", "192.0.2.1", "192.168.1.1", "198.17.255.255",
    "198.18.0.1", "198.20.0.0", "198.51.100.1", "203.0.113.1", "223.255.255.255", "224.0.0.1",
    "239.255.255.255", "240.0.0.1", "255.255.255.255",
]

# Ranges of one's own: inside each other, across the fixed ones, listed twice, single addresses.
OWN_RANGES = [
    ("8.0.0.0/5", True), ("9.128.0.0/9", False), ("9.255.255.255/32", True), ("10.64.0.0/10", False),
    ("10.64.0.0/10", False), ("10.96.0.0/11", True), ("20.0.0.0/6", True), ("20.0.0.0/6", False),
    ("224.0.0.0/4", False), ("64.0.0.0/2", True), ("100.0.0.0/8", False), ("127.0.0.1/32", False),
]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages")


def pages_to_extract(spark: SparkSession, sf: str) -> DataFrame:
    return spread(pages(spark, sf))


def articles_from(documents: DataFrame) -> DataFrame:
    """D1: an article per document, with every quality rule, copies and gaps planted."""
    doc = F.col("doc_id")

    def every(n: int):
        return doc % n == 0

    lead = F.substring("text", 1, 20)
    month = F.lpad((1 + doc % 12).cast("string"), 2, "0")
    site = F.concat(F.lit("http://"), F.col("source"), F.lit(".example.com/"))
    minutes = doc * 619  # more than an int from document 3,469,279 on, and intervals are made of ints
    made = documents.select(
        doc,
        F.when(every(31), F.concat(site, F.lit("other/weather_error_404.html")))
         .otherwise(F.concat(site, F.lit("2024/"), month, F.lit("/"), doc.cast("string"),
                             F.lit(".shtml"))).alias("url"),
        F.when(every(13), F.lit(""))
         .when(every(17), F.concat(lead, F.lit("-生活")))
         .when(every(19), F.concat(lead, F.lit("-图片频道")))
         .when(every(23), F.concat(F.lit("视频"), lead))
         .otherwise(F.concat(lead, F.lit("-资讯"))).alias("title"),
        F.when(every(29), F.concat(F.col("text"), F.lit("\n热门城市")))
         .otherwise(F.col("text")).alias("content_md"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(
            days=F.floor(minutes / 1440), mins=F.pmod(minutes, F.lit(1440)))).alias("crawled_at"))
    return made.select(
        (doc + 1).alias("id"), "url", F.sha1("url").alias("url_fp"), "title",
        F.when(every(5), F.lit("")).otherwise(F.date_format("crawled_at", "yyyy-MM-dd"))
         .alias("published"),
        "content_md", F.sha1("content_md").alias("content_fp"), "crawled_at")


def articles(spark: SparkSession, sf: str) -> DataFrame:
    return articles_from(table(spark, sf, "documents"))


def link_pages(spark: SparkSession, sf: str) -> DataFrame:
    """D2: one page per stored page; its article links lead to three others. Even pages hold text."""
    src = spread(pages(spark, sf).select("page_id", F.col("url").alias("text")))
    n = src.agg(F.count("*")).scalar()
    page = F.col("page_id")

    def path(number) -> F.Column:
        return F.concat(F.lit("/2024/01/"), number.cast("string"), F.lit(".shtml"))

    def anchor(target, before='<a href="') -> F.Column:
        return F.concat(F.lit(before), target, F.lit('">x</a>'))

    first = path((page * 7 + 1) % n)
    text = F.concat(F.lit("<article><p>Gr&uuml;n &rarr; caf&eacute; <img alt='1>0'>"),
                    *[F.concat(F.col("text"), F.lit(" "))] * 4,
                    F.lit("</p></article>"))
    html = F.concat(
        F.lit('<html><body><div title="<!-- "></div><nav>'),
        anchor(first, '<a title="see href=/no, 2 > 1" href="'),
        anchor(path((page * 3 + 2) % n), '<a class="x<y"href="'),
        F.lit("<noscript>"), anchor(path((page + 5) % n), "<A\nID=k data-href='/no' HREF = \""),
        F.lit("</noscript>"),
        anchor(F.concat(F.lit(SITE), first)), anchor(F.lit("/2024/01/error/9.shtml")),
        anchor(F.lit("/list/")), anchor(F.lit("http://evil.example.org/2024/01/417.shtml")),
        F.lit("</nav>"), F.when(page % 2 == 0, text).otherwise(F.lit("")),
        F.lit("</body></html>"))
    return src.select("page_id", F.concat(F.lit(SITE), path(page)).alias("url"),
                      html.alias("html"))


def unmarked_pages(spark: SparkSession, sf: str) -> DataFrame:
    """D8: the stored pages without marked parts, with references of all kinds and JSON-LD.

    Dates are in the JSON-LD alone, and so are the headlines of every fifth page. It comes as an object,
    in an array behind a list of links, in a graph, and below the entity of a site.
    """
    page = F.col("page_id")
    article = F.concat(F.lit('{"@type": ["Thing", "NewsArticle"], "headline": "Headline &#8470; '), page,
                       F.lit('", "datePublished": "2024-'), F.lpad((page % 12 + 1).cast("string"), 2, "0"),
                       F.lit('-03T08:00:00Z"}'))
    crumbs = '{"@type": "BreadcrumbList", "itemListElement": [{"item": {"name": "Home", "dateCreated": "1999"}}]}'
    data = F.when(page % 4 == 0, article) \
        .when(page % 4 == 1, F.concat(F.lit(f"[{crumbs}, "), article, F.lit("]"))) \
        .when(page % 4 == 2, F.concat(F.lit('{"@graph": ['), article, F.lit(f", {crumbs}]}}"))) \
        .otherwise(F.concat(F.lit('{"@type": "WebSite", "mainEntity": '), article, F.lit("}")))
    head = F.concat(F.lit("<script>broken {</script><script type='application/ld+json'>{broken</script>"
                          '<script id=d type="application/ld+json">'), data, F.lit("</script></head>"))
    bare = F.regexp_replace("html", "<(/?)(?:article|main|nav|footer)>", "<$1div>")
    bare = F.replace(bare, F.lit("</title>"), F.lit(" &hellip &star;&#x2019</title>"))
    bare = F.replace(bare, F.lit("</h1>"), F.lit(" It&#146;s &#8217 &check;&lbrace; &copy 2020 caf&eacute&notit;</h1>"))
    untitled = F.regexp_replace(F.regexp_replace(bare, "(?s)<title>.*?</title>", ""), "<(/?)h1>", "<$1h2>")
    return spread(pages(spark, sf)).select(
        "page_id", "url", F.replace(F.when(page % 5 == 0, untitled).otherwise(bare), F.lit("</head>"), head).alias("html"))


def page_runs(spark: SparkSession, sf: str) -> list[DataFrame]:
    """D9: the pages in the order of their collection: three parts, then every third one again elsewhere."""
    stored = pages(spark, sf)
    n = stored.agg(F.count("*")).scalar()
    page = F.col("page_id")
    parts = [stored.filter((page * 3 >= k * n) & (page * 3 < (k + 1) * n)) for k in range(3)]
    again = stored.filter(page % 3 == 0).select(
        (page + n).alias("page_id"), F.concat("url", F.lit("?again")).alias("url"), "html")
    return [*parts, again]


def raw_comment_pages(spark: SparkSession, sf: str) -> DataFrame:
    """D3: (post, page, body) with one JSON document per page, as stored by a collector.

    A page holds three turns of a conversation, so the lists collected here have at most three
    entries; it repeats the last comment of the page before. Pages meet their neighbours on
    (conversation, page), which is unique, so a long conversation spreads over all tasks.
    """
    comment = F.struct(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.struct(F.col("role").alias("screen_name")).alias("user"),
        F.concat(F.lit("来自"), F.col("role"), F.lit("客户端")).alias("source"),
        F.col("text").alias("text_raw"))
    own = table(spark, sf, "conversations").groupBy(
        "conv_id", (F.floor(F.col("turn") / 3) + 1).alias("page")).agg(
        F.array_sort(F.collect_list(comment)).alias("data"))
    before = own.select("conv_id", (F.col("page") + 1).alias("page"),
                        F.slice("data", -1, 1).alias("repeated"))
    after = own.select("conv_id", (F.col("page") - 1).alias("page"), F.lit(True).alias("more"))
    data = F.when(F.col("repeated").isNull(), F.col("data")).otherwise(F.concat("repeated", "data"))
    token = F.when(F.col("more"), F.col("page")).otherwise(0)
    pages = own.join(before, ["conv_id", "page"], "left").join(after, ["conv_id", "page"], "left")
    return written(pages.select(
        F.col("conv_id").cast("string").alias("post"), "page",
        F.to_json(F.struct(data.alias("data"), token.alias("max_id"))).alias("body")), "comments")


def empty_comment_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages without comments: a late one of every third post, and posts that have no other."""
    first = table(spark, sf, "conversations").filter("turn = 0 AND conv_id % 3 = 0")
    post = F.col("conv_id").cast("string")
    rows = F.array(F.struct(post.alias("post"), F.lit(99).cast("long").alias("page")),
                   F.struct(F.concat(F.lit("empty-"), post).alias("post"), F.lit(1).cast("long").alias("page")))
    return first.select(F.inline(rows)).withColumn("body", F.lit('{"data": [], "max_id": 0}'))


def jobs(spark: SparkSession, sf: str) -> DataFrame:
    """D4: a job per event."""
    stamp = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    begin = F.col("ts").cast("timestamp")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("seq"), F.md5(F.col("event_id").cast("string")).alias("id"),
        F.lit("article").alias("spider"),
        F.when(F.col("event_type") == "signup", "pending")
         .when(F.col("event_type") == "view", "running").otherwise("finished").alias("state"),
        F.date_format(begin, stamp).alias("start_time"),
        F.date_format(begin + F.make_dt_interval(secs=F.floor("value")), stamp).alias("end_time"),
        "value")


def host_lookups(spark: SparkSession, sf: str) -> DataFrame:
    """D5: (host, ip, ord); every tenth host does not resolve, the others have two addresses."""
    key = F.col("c_custkey")
    octets = [key % 256, (key * 37) % 256, (key * 11) % 256, key % 254 + 1]
    ip = F.concat_ws(".", *[o.cast("string") for o in octets])
    hosts = table(spark, sf, "customer").filter(key % 10 != 0).select(
        _host(key).alias("host"), F.explode(F.array(
            F.struct(ip.alias("ip"), F.lit(0).alias("ord")),
            F.struct(F.lit("10.9.9.9").alias("ip"), F.lit(1).alias("ord")))).alias("a"))
    return hosts.select("host", "a.*")


def _host(key) -> F.Column:
    return F.concat(F.lit("h"), key.cast("string"), F.lit(".example.com"))


def candidate_urls(spark: SparkSession, sf: str) -> DataFrame:
    """D5: a URL per customer host."""
    key = F.col("c_custkey")
    scheme = F.when(key % 7 == 0, "ftp").otherwise("http")
    return table(spark, sf, "customer").select(
        key, F.concat(F.lit("  "), scheme, F.lit("://"), F.upper(_host(key)), F.lit(":8080/x"))
        .alias("url"))


def allowed_hosts(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf, "customer").filter(key % 3 != 0).select(_host(key).alias("host"))


def site_lookups(spark: SparkSession, sf: str) -> DataFrame:
    """D5 with the site of D2, which was looked up twice."""
    site = spark.createDataFrame([("news.example.com", "93.184.215.14", 0)] * 2,
                                 "host string, ip string, ord int")
    return host_lookups(spark, sf).unionByName(site)


def addresses(spark: SparkSession, sf: str) -> DataFrame:
    """D5: the first address of every host, and the edge addresses."""
    edges = spark.createDataFrame([(f"edge-{ip}", ip) for ip in EDGE_ADDRESSES],
                                  "host string, ip string")
    return host_lookups(spark, sf).filter("ord = 0").select("host", "ip").unionByName(edges)


def fetch_log(spark: SparkSession, sf: str) -> DataFrame:
    """D6: every event is one attempt; of six events in a row the URLs get one, two and three."""
    event = F.col("event_id")
    place = event % 6
    slot = F.when(place == 0, 0).when(place <= 2, 1).otherwise(2)
    first = F.when(place == 0, 0).when(place <= 2, 1).otherwise(3)
    number = F.floor(event / 6) * 3 + slot
    status = F.when(F.col("event_type") == "error", F.element_at(
        F.array(*[F.lit(s) for s in (429, 403, 500, 502, 503, 504)]),
        (F.floor(event / 2) % 6 + 1).cast("int"))).when(F.col("event_type") == "view", 404).otherwise(200)
    return table(spark, sf, "events").select(
        F.concat(F.lit("http://h"), (number % 50).cast("string"), F.lit(".example.com/"),
                 number.cast("string")).alias("url"),
        (place - first + 1).alias("attempt"), status.cast("long").alias("status"),
        F.col("ts").cast("timestamp").alias("fetched_at"))


def page_urls(spark: SparkSession, sf: str) -> DataFrame:
    """D7: every page URL, every fourth one a second time with a fragment."""
    src = pages(spark, sf).select("page_id", "url")
    n = src.agg(F.count("*")).scalar()
    again = src.filter(F.col("page_id") % 4 == 0).select(
        (F.col("page_id") + n).alias("page_id"), F.concat("url", F.lit("#frag")).alias("url"))
    return src.unionByName(again)


def known_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints registered before the run."""
    before = pages(spark, sf).filter(F.col("page_id") % 10 == 0).select("url")
    return url_fingerprints(before).select("url_fp")
