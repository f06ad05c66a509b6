import html.entities as std
import random
import time
from html import unescape

from pyspark.sql import functions as F

from webcorpus.functions import html
from webcorpus.operators import extract, links
from webcorpus.plans import collect
from webcorpus.sources import articles as article_io

BODY = "河上的新桥今天通车，两岸居民不必再绕路。" * 3


def pages(spark, *rows):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)],
                                 "page_id long, url string, html string")


def test_article_page_and_copy(spark):
    page = f"<html><body><article><h1>新桥通车</h1><p>{BODY}</p></article></body></html>"
    a, b = extract.build_articles(pages(
        spark, ("https://www.site.example/news/a.html", page),
        ("https://www.site.example/news/b.html", page))).orderBy("page_id").collect()
    assert a.title == "新桥通车" and a.published == ""
    assert a.content_md == f"# 新桥通车\n\n{BODY}"
    assert len(a.content_fp) == 40 and a.content_fp == b.content_fp and a.url_fp != b.url_fp


def test_navigation_page_yields_nothing(spark):
    page = pages(spark, ("https://www.site.example/",
                         "<html><body><ul><li>甲</li><li>乙</li></ul></body></html>"))
    assert extract.build_articles(page).count() == 0
    assert links.article_links(page).count() == 0


def test_link_discovery(spark):
    page = pages(spark, ("https://gazette.example/front", """<body><p>Read
      <a href="2027/11/305.shtml">on</a>, <a href="https://gazette.example/2027/11/305.shtml">too</a>
      or <a href="//mirror.example/2026/12/40.shtml">there</a>.</p>
      <!-- <a href="/2027/10/9.shtml">old</a> -->
      <a href="/about/">us</a><a href="/2027/11/an_error_page.shtml">broken</a></body>"""))
    assert sorted(r.abs_url for r in links.article_links(page).collect()) == [
        "https://gazette.example/2027/11/305.shtml", "https://mirror.example/2026/12/40.shtml"]
    assert links.extract_links(page).count() == 5
    assert links.page_link_distinct(page).count() == 4


def test_href_spellings(spark):
    page = pages(spark, ("http://h/", """<a class=x href='/a?x=1&amp;y=2'>1</a><A HREF=/b>2</A>
      <a href="">3</a><a name="n">no link</a><a data-href="/no" href = "/c">4</a><abbr href="/no">"""))
    assert [r.href for r in links.extract_links(page).collect()] == ["/a?x=1&y=2", "/b", "", "/c"]


def test_links_in_difficult_tags(spark):
    page = pages(spark, ("http://h/", """<div title="<!-- "><a title="1 > 0" href="/gt">a</a>
      <a title='x<y' href="/lt">b</a><a title="see href=/no" href="/own">c</a><a class="x"href="/glued">d</a>
      <noscript><a href="/plain">e</a></noscript><i title="<a href='/no'>">f</i><!-- <a href="/no"> -->
      <script>'<a href="/no">'</script><a href>g</a><article href="/no"></article><a
      href = /bare?q=1/>h</a><a href="/last" title="open>"""))
    got = [r.href for r in links.extract_links(page).collect()]
    assert got == ["/gt", "/lt", "/own", "/glued", "/plain", "/bare?q=1/", "/last"]


def test_named_references_and_quoted_brackets(spark):
    page = pages(spark, ("http://h/", "<title>Caf&eacute; &lt;b&gt;</title><body><img alt='a>b'>M&uuml;ller "
                         "<nav title='a>b'>x</nav>&rarr; &szlig; &Omega; &apos; &nosuch; &amp;eacute; AT&T</body>"))
    article = extract.extract_text(page).first()
    assert article.content_md == "Müller → ß Ω ' &nosuch; &eacute; AT&T"


def test_text_regions_and_blocks(spark):
    def text(markup):
        return extract.extract_text(pages(spark, ("http://h/", markup))).first().content_md

    assert text("<body><nav>menu</nav><main><h2>T</h2><p>a&nbsp; b</p></main><p>out</p></body>") == (
        "## T\n\na b")
    assert text("<body><header>x</header><p>one<br>two</p><ul><li>p<li>q</ul>"
                "<footer>y</footer></body>") == "one\n\ntwo\n\n- p\n- q"
    assert text("<p>kept</p><script>if (a < b) { lost }") == "kept"
    assert text("<p>1 < 2 &amp;&lt;b&gt; &amp;lt; &#27743;&#x6C5F; &bogus; &#0;</p>") == (
        "1 < 2 &<b> &lt; 江江 &bogus; \ufffd")
    assert text("<article>a</article><aside>x</aside><article>b</article>") == "a\n\nb"
    assert text("no markup at all") == "no markup at all"


def test_pages_without_html(spark):
    page = pages(spark, ("http://h/", None), ("http://h/", ""))
    assert extract.build_articles(page).count() == 0 and links.extract_links(page).count() == 0
    assert [(r.title, r.published) for r in extract.extract_metadata(page).collect()] == [("", "")] * 2


def test_stages_run_by_number(spark):
    frame = spark.createDataFrame([("x",)], "s string")

    def add(letter):
        return lambda df: df.withColumn("s", F.concat("s", F.lit(letter)))

    assert collect.run_stages(frame, {add("c"): 300, add("a"): 50, add("b"): 100}).first().s == "xabc"


def test_metadata(spark):
    def meta(markup):
        row = extract.extract_metadata(pages(spark, ("http://h/", markup))).first()
        return row.title, row.published

    assert meta("<title> a\n b　</title><h1>c</h1>") == ("a b", "")
    assert meta("<title></title><h1>c <b>d</b></h1>") == ("c d", "")
    assert meta('<meta property="article:published_time" content="2026-08-01T06:00">')[1] == (
        "2026-08-01T06:00")
    assert meta('<meta content="2026-08-02" name=pubdate >')[1] == "2026-08-02"
    assert meta('<meta name="author" content="x"><time class="t" datetime="2026-08-03">y</time>')[1] == (
        "2026-08-03")


def test_references_are_those_of_browsers(spark):
    """Against the standard library, which follows the same rules of HTML 5."""
    rng = random.Random(3)
    names = list(std.html5)
    texts = ["It&#146;s &#8217 &check; &lbrace; &copy 2020 caf&eacute", "&notit; &notin; &amp;lt; &ampx &; &#; &#x; &bne; a&b",
             "&#0; &#x1F600; &#xD800; &#1; &#11; &#13; &#65534; &#99999999999; &#x00000041 &nosuch; & &"]
    for _ in range(800):
        text = ""
        for _ in range(rng.randrange(1, 6)):
            name = "&" + rng.choice(names) + rng.choice(["", ";", "x", " ", "="])
            code = rng.choice([str(rng.randrange(400)), str(rng.randrange(0x120000)), f"x{rng.randrange(0x110005):x}"])
            text += rng.choice([name, name, f"&#{code}" + rng.choice([";", "", " ", "g"]), rng.choice(["&", "a;", "é&", "&#;"])])
        texts.append(text)
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in frame.select(html.decode_entities(F.col("t"))).collect()] == [unescape(t) for t in texts]
    strict = frame.select(html.decode_entities(F.col("t"), strict=True)).first()[0]
    assert strict == "It\u2019s &#8217 \u2713 { &copy 2020 caf&eacute"


MENU = "<ul>" + "".join(f"<li><a href='/s{k}'>Section {k}</a></li>" for k in range(8)) + "</ul>"
PARA = "The river rose by two metres over night and the town closed the old bridge for all traffic until noon. " * 2


def test_pages_without_marks_keep_the_article(spark):
    def text(markup):
        return extract.extract_text(pages(spark, ("http://h/", markup))).first().content_md

    para = PARA.strip()
    notice = "<div>We use cookies to make this page work better for you and for our many partners worldwide.</div>"
    article = (f"<h1>Flood</h1><h2>Bridge closed</h2><p>{PARA}</p><p>Short one.</p><p>{PARA}<a href='/x'>more on this</a></p>"
               f"<ul><li>{PARA}</li></ul><p><a href='/y'>{PARA}</a></p><p>{PARA * 3}</p>")
    page = f"<body>{notice}<div>{MENU}</div><div>{article}</div><div>{MENU}<p>Copyright Gazette</p></div></body>"
    assert text(page) == (f"# Flood\n\n## Bridge closed\n\n{para}\n\nShort one.\n\n{para} more on this"
                          f"\n\n- {para}\n\n{(PARA * 3).strip()}")
    assert text(f"<body>{MENU}</body>") == ""  # links only
    assert text("<body><p>one</p><p>two</p></body>") == "one\n\ntwo"  # nothing pays: all but links
    assert text(f"<body><a href='/x'><div>{PARA}</div><div>{PARA}</div></a><p>{PARA * 2}</p></body>") == (PARA * 2).strip()
    assert text(f"<a href=x>open {PARA}<p>{PARA}") == para  # a link that never ends, ends with its block
    assert text(f"<p><a name='top'>{PARA}</p>") == para  # no link
    body = "河上的新桥今天通车，两岸居民不必再绕路，桥上禁止停车。"
    assert text(f"<body>{MENU}<p>{body}</p>{MENU}</body>") == body
    assert text(f"<body>\x02\x03{PARA}\x04\x011</body>") == para + " 1"


def test_linked_data(spark):
    def meta(markup):
        row = extract.extract_metadata(pages(spark, ("http://h/", markup))).first()
        return row.title, row.published

    def script(value):
        return f'<script type="application/ld+json">{value}</script>'

    one = '{"@type": "NewsArticle", "headline": "Head &amp; line", "datePublished": " 2026-08-01"}'
    want = ("Head & line", "2026-08-01")
    assert meta(script(one)) == want
    assert meta(script(f'[{{"@type": "Person", "name": "N", "dateCreated": "1999"}}, {one}]')) == want
    assert meta(script(f'{{"@graph": [{{"name": "N"}}, {{"mainEntity": [{one}]}}]}}')) == want
    assert meta(script("{broken") + script("null") + script("3") + script(one)) == want
    assert meta(script('{"name": "Only name", "dateCreated": "2025"}')) == ("Only name", "2025")
    assert meta(f"<!-- {script(one)} --><title>T</title>") == ("T", "")
    assert meta(script('{"@type": "Article", "headline": {"a": 1}, "datePublished": 5}')) == ("", "")
    assert meta(f"<title>T</title><time datetime='2020'>{script(one)}") == ("T", "2026-08-01")
    assert meta(f"<meta name=date content='2021'>{script(one)}") == ("Head & line", "2021")
    assert meta('<meta title="a>b" property="article:published_time" content="2026-01-01">')[1] == "2026-01-01"
    deep = '{"@graph": ' * 9 + one + "}" * 9
    assert meta(script(deep)) == ("", "")


def test_long_pages_are_read_whole(spark):
    long = "word " * 400_000
    page = pages(spark, ("http://h/", f"<body><article><p>{long}</p><p>end</p></article></body>"))
    got = extract.extract_text(page).first().content_md
    assert got.endswith("end") and len(got) == len(long) - 1 + 5


def test_broken_pages_take_linear_time(spark):
    broken = [x * (1_000_000 // len(x)) for x in (
        "<script>", "<!--", "<nav>", "<form><aside>", "<article>", "<title>", "<h1>", "<a ", "<li", "<",
        "<meta ", "&", " ", "\n", "<a href=", "</nav>", "&#", "</article>", "<!---->", "<nav ", "<article ",
        "<title ", "<a '<b ", '<a "', "<nav </nav>", "<meta name=date ", "&#99", "<time ",
        "<script type='application/ld+json'>{", "<script type=application/ld+json ")]
    page = pages(spark, *[("http://h/", "<main><p>a</p></main>" + r) for r in broken],
                 *[("http://h/", "<p>a</p>" + r) for r in broken]).repartition(16).cache()
    start = time.monotonic()
    texts = {r.page_id: r.content_md for r in extract.extract_text(page).collect()}
    assert len(texts) == 2 * len(broken)
    # An article that follows is the article; all else stands outside of <main>.
    assert {texts[k][:1] for k in range(len(broken)) if not broken[k].startswith("<article")} == {"a"}
    extract.extract_metadata(page).collect()
    links.page_link_distinct(page).collect()
    assert time.monotonic() - start < 90


def test_long_and_short_pages_lose_the_same_parts(spark):
    body = ("<p>one</p><NAV class='x'>m<p>m</p></nav><header>h</header><p>two</p><nav>n<nav>n</nav>"
            "<p>kept</p></nav><form>f</form><footer>x<aside>y</aside></footer><p>three</p><nav>open")
    pad = "<p>" + "z" * 70_000 + "</p>"
    short, long = (r.content_md for r in extract.extract_text(
        pages(spark, ("u", f"<main>{body}</main>"), ("u", f"<main>{body + pad}</main>"))).orderBy("page_id").collect())
    assert short == "one\n\ntwo\n\nkept\n\nthree\n\nopen"
    assert long == short + "\n\n" + "z" * 70_000


def test_text_is_extracted_once_per_row(spark):
    """The pattern chain must not be copied into the filters on its result."""
    source = pages(spark, ("http://h/", "<p>x</p>"))
    plan = collect.good_articles(source)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?<=</form>)") == 1 and plan.count("<title") == 1


def test_run_into_a_store(spark, folder):
    page = f"<body><article><h1>新桥通车</h1><p>{BODY * 6}</p></article></body>"
    rows = [(f"http://n.com/2026/08/{i}.shtml", page + f"<article>{i // 2}</article>")
            for i in range(6)]
    store = folder + "/store"
    assert collect.ingest_pages(pages(spark, *rows), store) == 3
    assert collect.ingest_pages(pages(spark, *rows), store) == 0
    stored = article_io.articles_source(spark, store).orderBy("id").collect()
    assert [r.id for r in stored] == [1, 2, 3]
    assert [r.url[-7:] for r in stored] == ["0.shtml", "2.shtml", "4.shtml"]
    assert all(r.crawled_at is not None for r in stored)
    assert article_io.articles_source(spark, folder + "/none").count() == 0


def test_ddl_can_run_twice(spark, folder):
    for _ in range(2):
        article_io.articles_ddl(spark, "made_twice", folder + "/made")
    assert spark.table("made_twice").count() == 0
    assert [c.name for c in spark.catalog.listColumns("made_twice")][:2] == ["id", "url"]
    spark.sql("DROP TABLE made_twice")


def test_min_chars_counts_code_points(spark):
    frame = spark.createDataFrame([("😀" * 50,), ("😀" * 49,), (None,)], "content_md string")
    assert extract.min_article_chars(frame).count() == 1
    assert frame.select(F.length("content_md")).first()[0] == 50
