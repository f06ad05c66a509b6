import datetime
import random

from pyspark.sql import functions as F

from webcorpus.operators import dedupe
from webcorpus.operators.numbering import assign_ids, running_total


def items(spark, rows):
    return spark.createDataFrame(rows, "id long, content_fp string")


def kept(frame):
    return sorted((r.id, r.content_fp) for r in frame.collect())


def test_earliest_row_of_a_body_stays(spark):
    frame = items(spark, [(4, "oak"), (9, "elm"), (7, "oak"), (5, "fir"), (8, "elm")])
    assert kept(dedupe.content_dedupe(frame)) == [(4, "oak"), (5, "fir"), (8, "elm")]
    assert kept(dedupe.content_dedupe(frame, known=items(spark, [(2, "oak")]))) == [(5, "fir"), (8, "elm")]


def test_order_does_not_matter_and_twice_is_once(spark):
    rng = random.Random(3)
    rows = [(i, f"fp{rng.randrange(40) if rng.random() < .6 else 0}") for i in range(500)]
    best = {}
    for i, fp in rows:
        best.setdefault(fp, i)
    want = sorted((i, fp) for fp, i in best.items())
    rng.shuffle(rows)
    once = dedupe.first_wins(items(spark, rows).repartition(8), "content_fp", "id")
    assert kept(once) == want
    assert kept(dedupe.first_wins(once, "content_fp", "id")) == want


def test_copies_are_cut_before_the_shuffle(spark):
    frame = spark.range(0, 100_000, 1, 8).select("id", F.concat(F.lit("fp"), (F.col("id") % 2).cast("string")).alias("content_fp"))
    first = dedupe.first_wins(frame, "content_fp", "id")
    assert kept(first) == [(0, "fp0"), (1, "fp1")]
    plan = first._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("WindowGroupLimit", plan.index("Exchange"))
    assert "Partial" in plan[partial:partial + 200]


def test_rank_duplicates(spark):
    frame = items(spark, [(1, "a"), (2, "a"), (3, "a"), (4, "b"), (5, "c")])
    assert sorted(map(tuple, dedupe.rank_duplicates(frame).collect())) == [("a", 2)]
    known = items(spark, [(0, "a"), (0, "b")])
    assert sorted(map(tuple, dedupe.rank_duplicates(frame, known).collect())) == [("a", 3), ("b", 1)]


def test_fingerprint_sets(spark):
    old = spark.createDataFrame([("a",), ("b",)], "url_fp string")
    new = spark.createDataFrame([("b",), ("c",), ("c",)], "url_fp string")
    assert sorted(r[0] for r in dedupe.register_fingerprints(old, new).collect()) == ["a", "b", "c"]
    assert [r[0] for r in dedupe.new_fingerprints(old, new).collect()] == ["c"]


def article(spark, rows):
    now = datetime.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(i, f"u{i}", f"f{i}", "t", "", fp * 3, fp, now) for i, fp in rows],
        "id long, url string, url_fp string, title string, published string, content_md string,"
        "content_fp string, crawled_at timestamp")


def test_insert_if_absent(spark):
    target = article(spark, [(1, "a"), (7, "b")])
    new = dedupe.insert_if_absent(
        target, article(spark, [(50, "c"), (20, "a"), (40, "d"), (45, "c"), (10, "e")]), "id")
    assert sorted((r.id, r.content_fp, r.url) for r in new.collect()) == [
        (8, "e", "u10"), (9, "d", "u40"), (10, "c", "u45")]
    empty = target.limit(0)
    first = dedupe.insert_if_absent(empty, target, "id")
    assert sorted(r.id for r in first.collect()) == [1, 2]
    assert dedupe.insert_if_absent(target, target, "id").count() == 0


def test_running_total_over_many_blocks(spark):
    rng = random.Random(4)
    rows = [(k, o, rng.randrange(-5, 9)) for k in ("x", "y", "z")
            for o in rng.sample(range(-50, 400), 90 if k == "x" else 11)]
    want, total = {}, {}
    for k, o, v in sorted(rows):
        total[k] = total.get(k, 0) + v
        want[k, o] = total[k]
    frame = spark.createDataFrame(rows, "k string, o long, v long").repartition(5)
    for block in (1, 3, 64, 1 << 16):
        got = running_total(frame, ["k"], "o", F.col("v"), "t", block).collect()
        assert {(r.k, r.o): r.t for r in got} == want


def test_ids_are_dense_and_in_order_of_arrival(spark):
    arrivals = random.Random(5).sample(range(10_000), 500)
    frame = spark.createDataFrame([(a,) for a in arrivals], "a long").repartition(7)
    got = {r.a: r.id for r in assign_ids(frame, "a", after=100).collect()}
    assert got == {a: 101 + i for i, a in enumerate(sorted(arrivals))}


def test_ids_of_sparse_arrivals_need_few_ranges(spark):
    frame = spark.range(5000).select(F.xxhash64("id").alias("a"))
    got = assign_ids(frame, "a").orderBy("a").collect()
    assert [r.id for r in got] == list(range(1, 5001))
    tied = spark.createDataFrame([(7, "y"), (7, "x"), (3, "z")], "a long, b string")
    assert {r.b: r.id for r in assign_ids(tied, ["a", "b"]).collect()} == {"z": 1, "x": 2, "y": 3}
    assert assign_ids(frame.limit(0), "a").count() == 0
