import codecs
import glob
import json
import random

import pytest

from webcorpus.operators import comments
from webcorpus.plans import collect
from webcorpus.sources import comments as io

def docs(spark, *pages):
    raw = spark.createDataFrame([(post, page, json.dumps(body)) for post, page, body in pages],
                                "post string, page long, body string")
    return comments.parse_pages(raw)


def talk(seed):
    """(post, page, body) of random pages: ids as numbers and as text, repeats, missing parts, empty pages."""
    rng = random.Random(seed)
    pages = []
    for post in ("x9", "x10", "y"):
        for page in range(1, rng.randrange(3, 7)):
            body = {"max_id": rng.choice([page, page, 0, None])}
            if rng.random() < 0.9:
                body["data"] = [{
                    "id": rng.choice([n, str(n)]), "source": rng.choice(["来自海边", "海边来自", "", None]),
                    "user": rng.choice([{"screen_name": f"n{n}"}, {"screen_name": None}, {}, None]),
                    "text_raw": rng.choice([f"words {n}", None, "a,\"b\"\n c", "来自"])}
                    for n in (rng.randrange(500, 530) for _ in range(rng.randrange(5)))]
            pages.append((post, page, body))
    return pages


def said(pages):
    """(post, page, pos, id, screen_name, region, text) of every comment."""
    return [(post, page, pos, str(c["id"]), (c["user"] or {}).get("screen_name") or "",
             (c["source"] or "").replace("来自", ""), c["text_raw"] or "")
            for post, page, body in pages for pos, c in enumerate(body.get("data") or [])]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_pages(spark, seed):
    pages = talk(seed)
    frame = docs(spark, *pages).repartition(3)
    rows = comments.flatten_comments(frame)
    fields = ["post", "page", "pos", "id", "screen_name", "region", "text"]
    assert sorted(map(tuple, rows.select(fields).collect())) == sorted(said(pages))
    assert {(r.post, r.page): r.next_max_id for r in comments.next_page_token(frame).collect()} == {
        (post, page): body["max_id"] or 0 for post, page, body in pages}
    known = {str(n) for n in range(500, 530, 4)}
    first = {}
    for post, page, pos, name, *_ in sorted(said(pages)):
        if name not in known:
            first.setdefault(name, (post, page, pos))
    new = comments.comment_dedupe(rows, spark.createDataFrame([(k,) for k in known], "id string"))
    assert {r.id: (r.post, r.page, r.pos) for r in new.collect()} == first
    assert comments.seen_count(rows).first().seen == len({r[3] for r in said(pages)})


def test_missing_and_null_values(spark):
    page = docs(spark, ("p", 1, {"data": [{"id": "7", "user": None, "source": None},
                                          {"source": "来自来自x"}, {}]}), ("p", 2, {"data": None}), ("p", 3, {}))
    rows = comments.flatten_comments(page).orderBy("pos").collect()
    assert [(r.id, r.screen_name, r.region, r.text) for r in rows] == [
        ("7", "", "", ""), ("", "", "x", ""), ("", "", "", "")]
    assert [r.next_max_id for r in comments.next_page_token(page).collect()] == [0, 0, 0]


def test_csv_of_several_loads(spark, folder):
    path, loads = folder + "/csv", [said(talk(seed)) for seed in (4, 5, 6)]
    assert io.seen_comment_ids(spark, path).count() == 0
    for load in loads:
        frame = spark.createDataFrame([r[3:] for r in load], "id string, screen_name string, region string, text string")
        io.comments_csv_sink(frame.repartition(2), path)
        for part in glob.glob(path + "/*.csv"):
            raw = open(part, "rb").read()
            text = raw.decode("utf-8-sig")
            assert raw.startswith(codecs.BOM_UTF8) and text.startswith(header := "评论id,昵称,地区,评论\n")
            assert text.count(header) == 1 and "\ufeff" not in text
    assert sorted(tuple(r) for r in io.comments_csv_source(spark, path).collect()) == sorted(
        r[3:] for load in loads for r in load)
    assert {r.id for r in io.seen_comment_ids(spark, path).collect()} == {r[3] for load in loads for r in load}


def test_csv_keeps_any_text(spark, folder):
    nasty = ['a "quoted", text', "line one\nline two\r\nthree", "", " padded ", '"', "\\", "a\\\"b", "，"]
    frame = spark.createDataFrame([(str(i), "n", "", t) for i, t in enumerate(nasty)],
                                  "id string, screen_name string, region string, text string")
    io.comments_csv_sink(frame, folder + "/csv")
    back = {r.id: r.text for r in io.comments_csv_source(spark, folder + "/csv").collect()}
    assert [back[str(i)] for i in range(len(nasty))] == nasty


def test_dedupe_compares_ids_as_text(spark):
    none, both = {"data": [], "max_id": 0}, {"data": [{"id": 41}, {"id": "07"}]}
    pages = docs(spark, ("p", 1, both), ("p", 2, both), ("p", 3, none), ("q", 1, both), ("r", 1, none), ("r", 2, {}))
    rows = comments.flatten_comments(pages)
    known = spark.createDataFrame([("7",), ("41",)], "id string")
    assert [(r.post, r.page, r.id) for r in comments.comment_dedupe(rows, known).collect()] == [
        ("p", 1, "07")]
    log = comments.comment_page_log(pages, known).orderBy("post", "page").collect()
    assert [(r.post, r.page, r.n_rows, r.n_new, r.total) for r in log] == [
        ("p", 1, 2, 1, 1), ("p", 2, 2, 0, 1), ("p", 3, 0, 0, 1), ("q", 1, 2, 0, 0), ("r", 1, 0, 0, 0), ("r", 2, 0, 0, 0)]
    assert {tuple(r) for r in comments.comment_page_totals(pages, known).collect()} == {
        ("p", 4, 1), ("q", 2, 0), ("r", 0, 0)}
    assert comments.seen_count(rows).first().seen == 2


def feed(spark, last=4):
    def page(post, n):
        return (post, n, {"data": [{"id": f"{post}{n}{i}"} for i in range(3)] + [{"id": f"{post}{n - 1}0"}],
                          "max_id": 0 if n == last else n * 10})
    return docs(spark, *[page(post, n) for post in "ab" for n in range(1, last + 1)])


def test_progress(spark, folder):
    path = folder + "/progress"
    assert io.load_progress(spark, path).count() == 0
    pages = feed(spark)
    capped = comments.comment_progress(comments.page_cap(pages, 3))
    assert sorted(map(tuple, capped.select("post", "max_id", "page", "done").collect())) == [
        ("a", 30, 3, False), ("b", 30, 3, False)]
    io.save_progress(capped, path)
    io.save_progress(comments.comment_progress(pages).filter("post = 'a'"), path)
    assert sorted(map(tuple, io.load_progress(spark, path).collect())) == [
        ("a", 0, 4, True), ("b", 30, 3, False)]
    posts = spark.createDataFrame([("a",), ("b",), ("new",)], "post string")
    assert sorted(map(tuple, comments.pending_posts(posts, io.load_progress(spark, path)).collect())) == [
        ("b", 30, 3), ("new", 0, 0)]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_collection_resumes_where_it_stopped(spark, folder, fmt):
    store, progress = folder + "/store", folder + "/progress"
    posts = spark.createDataFrame([("a",), ("b",)], "post string")
    collect.collect_comments(spark, posts, feed(spark), store, progress, cap=2, fmt=fmt)
    assert io.comments_source(spark, store, fmt).count() == 14  # 2 posts, 3 + 3 ids, one from page 0
    for _ in range(2):
        collect.collect_comments(spark, posts, feed(spark), store, progress, fmt=fmt)
    ids = [r.id for r in io.comments_source(spark, store, fmt).collect()]
    assert len(ids) == len(set(ids)) == 26
    assert all(r.done for r in io.load_progress(spark, progress).collect())


def test_progress_stops_before_a_gap(spark):
    feed_ = docs(spark, *[("p", n, {"data": [], "max_id": 0 if n == 5 else 10 + n}) for n in (1, 2, 4, 5)],
                 ("q", 3, {"data": [], "max_id": 0}))
    got = {r.post: (r.page, r.max_id, r.done) for r in comments.comment_progress(feed_).collect()}
    assert got == {"p": (2, 12, False)}
    start = spark.createDataFrame([("p", 3), ("q", 1)], "post string, page long")
    got = {r.post: (r.page, r.max_id, r.done) for r in comments.comment_progress(feed_, start).collect()}
    assert got == {"p": (5, 0, True)}
