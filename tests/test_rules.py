import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from webcorpus.functions import addresses
from webcorpus.operators import admission, quality
from webcorpus.operators.joins import hot_keys, lookup

URL = "http://news.site.example/2026/08/1.shtml"


def reason(spark, title="", url=URL, body="字" * 400, **options):
    frame = spark.createDataFrame([(title, url, body)], "title string, url string, content_md string")
    rules = quality.QualityRules(**options)
    tagged = quality.tag_quality(frame, rules).first().drop_reason
    assert quality.quality_filter(frame, rules).count() == (tagged is None)
    return tagged


@pytest.mark.parametrize("item, want", [
    ({"title": "湖边晚霞-图片频道"}, "title"),
    ({"title": "山里人家-生活"}, "title"),
    ({"title": "桥梁抢修完成-资讯"}, None),
    ({"title": "生活-资讯"}, None),
    ({"title": "赛事视频集"}, "title"),
    ({"body": "热门城市\n选择省市\n" + "街上很热闹" * 80}, "nav"),
    ({"url": "https://www.site.example/other/an_error.html"}, "error"),
    ({"body": "这一页不见了呀" * 15}, "short"),
    ({"title": "周末市集开张", "body": "市" * 417}, None),
    ({"title": "专题", "url": "http://error/", "body": "短"}, "title"),
    ({"url": "http://error/", "body": "热门城市"}, "error"),
    ({"body": "热门城市"}, "short"),
    ({"body": "雨" * 299}, "short"),
    ({"body": "雨" * 300}, None),
    ({"body": "雨" * 20, "min_chars": 10}, None),
    ({"title": None, "body": "雨" * 300}, None),
])
def test_quality_rules(spark, item, want):
    assert reason(spark, **item) == want


def test_further_rules_come_last(spark):
    ads = [("ads", F.col("content_md").contains("广告"))]
    assert reason(spark, body="广告" * 200, further=ads) == "ads"
    assert reason(spark, body="广告", further=ads) == "short"


def judge(spark, urls, allowed, lookups=()):
    frame = spark.createDataFrame([(u, "h", "i") for u in urls], "url string, host string, ip string")
    hosts = spark.createDataFrame([(h,) for h in allowed], "host string")
    table = spark.createDataFrame(list(lookups), "host string, ip string, ord int")
    judged = {r.url: r.reject_reason for r in admission.admission(frame, hosts, table).collect()}
    assert len(judged) == len(urls)
    return [judged[u] for u in urls]


def test_admission(spark):
    literals = ["127.8.9.1", "192.168.77.5", "10.20.30.40", "::1"]
    assert judge(spark, ["http://127.8.9.1/a", "https://192.168.77.5:444/b",
                         "http://10.20.30.40/c?d=1", "http://[::1]:81/e"], literals) == ["ip"] * 4
    assert judge(spark, ["file:///srv/notes.txt", "gopher://files.example/pub"], ["files.example"]) == [
        "scheme", "scheme"]
    site = [("www.site.example", "1.2.3.4", 0), ("www.site.example", "10.0.0.1", 1),
            ("bad.com", "10.0.0.1", 0), ("bad.com", "1.2.3.4", 1)]
    assert judge(spark, ["https://other.example/x", "https://WWW.site.example/news/1.html",
                         "https://bad.com/", "https://lost.com/"],
                 ["www.site.example", "bad.com", "lost.com"], site) == [
        "host", None, "ip", "unresolved"]


def test_seed_admission_strips(spark):
    frame = spark.createDataFrame([("　http://a.com/x \n",), ("ftp://a.com",), ("http://b.com",)],
                                  "url string")
    hosts = spark.createDataFrame([("a.com",)], "host string")
    got = sorted(admission.seed_admission(frame, hosts).collect())
    assert [(r.url, r.reject_reason) for r in got] == [
        ("ftp://a.com", "scheme"), ("http://a.com/x", None), ("http://b.com", "host")]


def test_host_filters(spark):
    frame = spark.createDataFrame([("http://social.example/a",), ("http://www.social.example",),
                                   ("http://notsocial.example",), ("http://social.example.evil.org",)], "url string")
    assert admission.filter_domain_suffix(frame, "social.example").count() == 2
    assert admission.filter_hosts(frame, ["social.example"]).columns == ["url"]
    assert admission.filter_hosts(frame, ["social.example"]).count() == 1
    hosts = spark.createDataFrame([("social.example",), ("social.example",)], "host string")
    assert admission.filter_hosts(frame, hosts).count() == 1


@pytest.fixture(params=["10MB", "-1"])
def any_size(spark, request):
    """Run a test with tables that may be broadcast, and with tables that may not."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    saved = spark.conf.get(key)
    spark.conf.set(key, request.param)
    yield request.param
    spark.conf.set(key, saved)


def test_hot_host(spark, any_size):
    """A host with most of the rows: all rows are kept, and each finds what it should."""
    rows = spark.range(0, 60_000, 1, 8).select("id", F.when(
        F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("h"), F.col("id"))).alias("host"))
    assert [r.host for r in hot_keys(rows, "host").collect()] == ["hot"]
    allowed = rows.filter("id % 10 <> 9").select("host")
    got = admission.host_semi_join(rows, allowed)
    assert got.count() == got.distinct().count() == 54_000
    without = admission.host_semi_join(rows, allowed.filter("host <> 'hot'"))
    assert without.count() == 6_000
    table = allowed.distinct().withColumn("n", F.length("host"))
    assert lookup(rows, table, "host").filter("n IS NULL").count() == 6_000
    assert lookup(rows, table, "host", "inner").count() == 54_000


def test_admission_without_broadcast(spark, any_size):
    site = [(f"h{i}.com", "1.2.3.4" if i % 2 else "10.0.0.1", 0) for i in range(1500) if i % 5]
    got = judge(spark, [f"http://h{i}.com/" for i in range(1500)],
                [f"h{i}.com" for i in range(1500) if i % 3], site)
    assert got == ["host" if not i % 3 else "unresolved" if not i % 5 else None if i % 2 else "ip"
                   for i in range(1500)]


def test_a_host_looked_up_twice_counts_once_and_by_a_blocked_address(spark):
    table = spark.createDataFrame([("h", "8.8.8.8", 0), ("h", "10.0.0.9", 0), ("h", "1.1.1.1", 1),
                                   ("i", "9.9.9.9", 0), ("i", "9.9.9.9", 0), ("j", None, 0)],
                                  "host string, ip string, ord int")
    got = {tuple(r) for r in admission.first_addresses(table).collect()}
    assert got == {("h", "10.0.0.9"), ("i", "9.9.9.9")}
    assert admission.first_addresses(table).count() == 2


def test_rows_without_a_key_are_spread(spark, any_size):
    rows = spark.range(0, 4000, 1, 4).select("id", F.when(F.col("id") % 4 == 0, F.concat(F.lit("h"), "id")).alias("host"))
    table = spark.createDataFrame([("h0", 1), ("h8", 2)], "host string, n int")
    got = lookup(rows, table, "host")
    assert got.count() == 4000 and got.filter("n IS NOT NULL").count() == 2
    assert lookup(rows, table, "host", "left_semi").columns == ["host", "id"]
    if any_size == "-1":
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert max(sizes) < 2000


def test_address_table_against_the_standard_library(spark):
    """Nested, overlapping and repeated ranges of both kinds; the most specific one counts."""
    rng = random.Random(8)
    cidrs = list(addresses.default_ranges())
    for _ in range(150):
        if rng.random() < 0.5:
            net = ipaddress.ip_network((rng.choice([10, 11, 192]) << 24 | rng.getrandbits(24), rng.randrange(0, 33)), strict=False)
        else:
            net = ipaddress.ip_network((0x20010DB8 << 96 | rng.getrandbits(96), rng.randrange(0, 129)), strict=False)
        cidrs.append((str(net), rng.random() < 0.5))
    ips = [str(ipaddress.ip_address(rng.choice([10, 11, 12, 192]) << 24 | rng.getrandbits(24))) for _ in range(200)]
    ips += [str(ipaddress.ip_address(0x20010DB8 << 96 | rng.getrandbits(96))) for _ in range(200)]
    ips += [c.split("/")[0] for c, _ in cidrs] + ["::1", "2001:DB8::", "::ffff:10.0.0.1", "no address", "1.2.3", "", None, "10.0.0.1"] * 2

    def blocked(ip):
        try:
            address = ipaddress.ip_address(ip)
        except ValueError:
            return True
        found = [(n.prefixlen, b) for n, b in nets if n.version == address.version and address in n]
        return max(found)[1] if found else True  # of equal ranges a blocked one

    nets = [(ipaddress.ip_network(c), b) for c, b in cidrs]
    table = spark.createDataFrame(cidrs, "cidr string, blocked boolean")
    frame = spark.createDataFrame(list(enumerate(ips)), "n long, ip string").repartition(4)
    judged = admission.judge_addresses(frame, table)
    assert {r.n: r.blocked for r in judged.collect()} == {n: blocked(ip) for n, ip in enumerate(ips)}
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    kept = admission.filter_blocked_ips(frame, table)
    assert sorted(r.n for r in kept.collect()) == [n for n, ip in enumerate(ips) if not blocked(ip)]
    fixed = spark.createDataFrame(addresses.default_ranges(), "cidr string, blocked boolean")
    assert admission.filter_blocked_ips(frame, fixed).exceptAll(admission.filter_blocked_ips(frame)).count() == 0
    assert admission.filter_blocked_ips(frame).exceptAll(admission.filter_blocked_ips(frame, fixed)).count() == 0
    assert admission.filter_blocked_ips(frame, table.limit(0)).count() == 0


@pytest.mark.parametrize("cidr", ["10.0.0.0", "10.0.0.0/33", "10.0/8", "x/8", None, "::/129", "10.0.0.0/-1"])
def test_ranges_that_are_none(spark, cidr):
    with pytest.raises(Exception, match="no CIDR range"):
        admission.prefixes(spark.createDataFrame([(cidr, True)], "cidr string, blocked boolean")).collect()
