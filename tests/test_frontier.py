from webcorpus.operators import admission, extract, frontier
from webcorpus.sources.links import link_table, store_links

SITE = "http://n.com/2024/01/{}.shtml"


def site(spark, graph):
    rows = [(i, SITE.format(i), "".join(f'<a href="{t if isinstance(t, str) else SITE.format(t)}">x</a>'
                                        for t in targets)) for i, targets in graph.items()]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def admit(df):
    return admission.filter_hosts(df, ["n.com"])


def reached(frame):
    return sorted((r.depth, r.url) for r in frame.collect())


def seeds(spark, *numbers):
    return spark.createDataFrame([(SITE.format(n),) for n in numbers], "url string")


def test_levels_cycles_and_limits(spark, folder):
    pages = store_links(site(spark, {0: [1, 2, "/2024/01/1.shtml", "http://other.example/2024/01/9.shtml"], 1: [0, 3],
                         2: [3, 2], 3: [4], 4: [5]}), folder + "/links")
    start = seeds(spark, 0, 0)
    full = [(0, SITE.format(0)), (1, SITE.format(1)), (1, SITE.format(2)), (2, SITE.format(3))]
    assert reached(frontier.crawl_frontier(start, pages, admit)) == full
    assert reached(frontier.crawl_frontier(start, pages, admit, depth_limit=9)) == full + [
        (3, SITE.format(4)), (4, SITE.format(5))]
    assert reached(frontier.crawl_frontier(start, pages, admit, follow_links=False)) == full[:1]
    assert reached(frontier.crawl_frontier(start, pages, admit, depth_limit=0)) == full[:1]


def test_known_urls_are_skipped_even_as_seeds(spark, folder):
    pages = store_links(site(spark, {0: [1, 2], 1: [3], 2: [4]}), folder + "/links")
    known = extract.url_fingerprints(seeds(spark, 1)).select("url_fp")
    got = frontier.crawl_frontier(seeds(spark, 0, 1), pages, admit, known=known)
    assert reached(got) == [(0, SITE.format(0)), (1, SITE.format(2)), (2, SITE.format(4))]


def test_links_are_stored_once_and_pages_are_not_read_again(spark, folder):
    path = folder + "/links"
    assert frontier.crawl_frontier(seeds(spark, 0), link_table(spark, path), admit).count() == 1  # no graph yet
    store_links(site(spark, {0: [1], 1: []}), path)
    store_links(site(spark, {0: [7], 2: [3], 1: [5]}), path)  # pages that are known keep their links
    rows = {r.src_fp: [x.url for x in r.links] for r in link_table(spark, path).rows().collect()}
    prints = {r.url: r.url_fp for r in extract.url_fingerprints(seeds(spark, 0, 1, 2)).collect()}
    assert rows == {prints[SITE.format(0)]: [SITE.format(1)], prints[SITE.format(1)]: [], prints[SITE.format(2)]: [SITE.format(3)]}
    got = frontier.crawl_frontier(seeds(spark, 0, 2), link_table(spark, path), admit)
    assert [depth for depth, _ in reached(got)] == [0, 0, 1, 1]


def test_budgets(spark):
    rows = [(i, SITE.format(i), "<p>" + "text " * (20 if i in (1, 2, 5) else 1)) for i in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    prints = {r.page_id: r.url_fp for r in extract.url_fingerprints(pages).collect()}
    visits = spark.createDataFrame([(str(i), prints[i], i) for i in range(9)],
                                   "url string, url_fp string, depth long")

    def left(page_budget, item_budget):
        got = frontier.frontier_budget(visits, pages, page_budget, item_budget)
        return sorted(int(r.url) for r in got.collect())

    assert left(200, 30) == list(range(9))
    assert left(4, 30) == [0, 1, 2, 3]
    assert left(200, 2) == [0, 1, 2]
    assert left(2, 2) == [0, 1]


def test_host_cap_and_retries(spark):
    frame = spark.createDataFrame([(i, "hot" if i % 3 else f"h{i}") for i in range(12)],
                                  "page_id long, host string")
    got = frontier.frontier_host_cap(frame, "page_id", per_host=2).collect()
    assert sorted(r.page_id for r in got) == [0, 1, 2, 3, 6, 9]
    log = spark.createDataFrame([("a", 1, 500), ("b", 1, 500), ("b", 2, 200), ("c", 1, 200),
                                 ("d", 1, 503), ("d", 2, 429), ("e", 3, 403), ("e", 1, 403),
                                 ("f", 1, 404)], "url string, attempt long, status long")
    assert sorted(map(tuple, frontier.retry_candidates(log).collect())) == [("a", 1, 500), ("d", 2, 429)]
