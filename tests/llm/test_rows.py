"""Any column names, ids of any type, the whole pipeline, and pages that are hard to parse."""

import random
import time

import duckdb
import pyarrow as pa
import pytest

import corpus_pipeline
from webcorpus.llm import decontaminate, dom, line_dedup, mixing, queries, simhash, wrappers
from webcorpus.llm.common import docs

SF = "/root/testdata/sf0.001"
ITEM = "the quick brown fox jumps over the lazy dog and goes home for a long sleep"
PROSE = ("It was a bright cold day in April and the clocks were striking thirteen when he came home through the "
         "doors of the old house by the river though not quickly enough to keep out the swirl of dust.")
# Names that operators have used for columns of their own.
CLASHING = ["_id", "_th", "th", "_starts", "starts", "_text", "n_removed", "row", "key", "gone_id", "gone_th", "a.b",
            "changed", "fp", "item_id", "begin", "size", "target"]


def clashing(spark, texts, kind="long"):
    made = spark.createDataFrame([(str(k), t) for k, t in texts.items()], "doc_id string, text string").selectExpr(
        f"CAST(doc_id AS {kind}) AS doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars",
        *[f"concat('{c}', doc_id) AS `{c}`" for c in CLASHING])
    return made.repartition(3)


def held(frame):
    """Rows by id, with the clashing columns checked to be as they were."""
    for row in frame.collect():
        assert all(row[c] == f"{c}{row.doc_id}" for c in CLASHING if c in frame.columns)
    return {str(r.doc_id): r.text for r in frame.collect()}


@pytest.mark.parametrize("kind", ["long", "string"])
def test_stages_keep_columns_of_any_name(spark, kind):
    lines = "\n".join(["first long line", "second long line", "third long line"])
    texts = {1: f"intro one\n{lines}", 2: f"intro two\n{lines}", 3: f"Say {ITEM} again", 4: PROSE, 5: PROSE.upper()}
    table = clashing(spark, texts, kind)
    got = held(line_dedup.line_dedup(table).drop("n_removed"))
    assert got == {"1": texts[1], "2": "intro two", "3": texts[3], "4": PROSE, "5": PROSE.upper()}
    assert held(simhash.keep_one(table.filter("doc_id IN (3, 4, 5)"))) == {"3": texts[3], "4": PROSE}
    items = spark.createDataFrame([("mmlu/1", ITEM)], "item_id string, text string")
    assert held(decontaminate.clean(table, items)) == {str(k): t for k, t in texts.items() if k != 3}
    found = decontaminate.contaminated(table, items).collect()
    assert [(str(r.doc_id), r.item_id, r.begin, r.edits) for r in found] == [("3", "mmlu/1", 4, 0)]
    assert mixing.mix(table).count() == 5
    stage = dict(corpus_pipeline.STAGES)
    assert held(stage["line_dedup"](spark, table, SF))["2"] == "intro two"


def test_decontamination_of_odd_rows_and_without_items(spark):
    rows = [(None, ITEM), (1, None), (2, ""), (3, ITEM), (3, ITEM), (4, "x " * 100000 + ITEM)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(7, ITEM), (8, None), (None, ""), (9, "ab")], "item_id long, text string")
    found = sorted((str(r.doc_id), r.item_id, r.begin, r.edits) for r in decontaminate.contaminated(table, items).collect())
    assert found == [("3", 7, 0, 0), ("3", 7, 0, 0), ("4", 7, 200000, 0), ("None", 7, 0, 0)]
    assert {r.doc_id for r in decontaminate.clean(table, items).collect()} == {1, 2}
    assert decontaminate.contaminated(table, items.limit(0)).count() == 0
    assert decontaminate.clean(table, items.limit(0)).count() == len(rows)
    assert decontaminate.contaminated(table.limit(0), items).count() == 0


def test_the_whole_pipeline_step_by_step(spark):
    """run() against the operators one by one, the last by its SQL; each stage on what the one before kept."""
    kept = docs(spark, SF)
    good = {r.doc_id for r in queries.op4_fertility(spark, SF).filter("kept").collect()}
    kept = kept.filter(kept.doc_id.isin(list(good)))
    stage = dict(corpus_pipeline.STAGES)
    assert {r.doc_id for r in stage["quality_rules"](spark, docs(spark, SF), SF).collect()} == good
    kept = spark.createDataFrame(stage["line_dedup"](spark, kept, SF).collect(), kept.schema)
    firsts = {r.component_id for r in simhash.simhash_components(kept).collect()}
    kept = kept.filter(kept.doc_id.isin(list(firsts)))
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    leaks = {r.doc_id for r in decontaminate.contaminated(kept, items).collect()}
    kept = kept.filter(~kept.doc_id.isin(list(leaks)))
    db = duckdb.connect()
    rows = kept.collect()
    db.register("documents", pa.table({c: [r[c] for r in rows] for c in kept.columns}))
    want = {r[0]: r for r in db.execute(f"SELECT doc_id, size, source_size, round(target, 6), taken FROM ({mixing.SQL})").fetchall()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: (r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in got} == want
    assert 50 < len(got) < 200


def test_the_whole_pipeline_on_odd_and_no_rows(spark, tmp_path):
    odd = [(1, None), (2, ""), (None, PROSE), (None, None), (3, PROSE), (3, PROSE), (4, "word " * 50000)]
    for name, rows in (("odd", odd), ("none", [])):
        table = clashing(spark, {}).drop("doc_id", "text").limit(0)
        frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
            "doc_id", "text", "'en' AS lang", "CAST(NULL AS STRING) AS source", "CAST(length(text) AS BIGINT) AS n_chars", "'x' AS row")
        frame.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        got = [r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()]
        assert table.count() == 0 and set(got) <= {3} and len(got) <= 2


# ---- pages ----------------------------------------------------------------------------------------

def test_quotes_open_values_only_behind_an_equals_sign():
    for page, text in {
            '<p title="x>Hello</p><p>rest</p>': "Hello rest", '<a href="x"">Lost words</a>': "Lost words",
            "<div data-x=5'>two</div>": "two", "<p a='b>c' d = \"e>f\">g</p>": "g", "<p a=b'c>d</p><p>e'</p>": "d e'",
            "1 < 2 <3 <": "1 < 2 <3 <", "<p>a<b c": "a"}.items():
        assert wrappers.texts_of([page], False) == [text], page


def test_broken_pages_are_parsed_in_one_pass():
    for piece in ("<a '<b ", '<a "', "<a b='", '<a b="', "<div>", "</p>", "<b><h1>", "<li>", "<!--", "<![CDATA[", "<!x ",
                  "<td><tr>", "&amp", "<", "<a b ", "<script>", "<p><b>"):
        start = time.process_time()
        wrappers.texts_of([piece * (300_000 // len(piece))], False)
        assert time.process_time() - start < 20, piece
    start = time.process_time()
    wrappers.texts_of(["<b>" * 30000 + "</p>" * 30000 + "<h1>" * 30000], False)
    assert time.process_time() - start < 20


def random_tree(rng, depth=0):
    tag = rng.choice("abc")
    inner = "".join(random_tree(rng, depth + 1) for _ in range(rng.choice([0, 1, 2, 3]) if depth < 4 else 0))
    return f"<x{tag}>{rng.choice(['', 'u', 'v'])}{inner}</x{tag}>"


def naive_weight(a, b, x=0, y=0):
    """Simple tree matching as it is defined: a table over the children of every pair, by recursion."""
    if a.nodes[x].tag != b.nodes[y].tag:
        return 0.0
    left, right = a.kids[x], b.kids[y]
    table = [[0.0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for m in range(1, len(left) + 1):
        for n in range(1, len(right) + 1):
            table[m][n] = max(table[m - 1][n], table[m][n - 1],
                              table[m - 1][n - 1] + naive_weight(a, b, left[m - 1], right[n - 1]))
    return 1.0 + (a.names[x] == b.names[y]) + (a.texts[x] == b.texts[y]) + table[-1][-1]


def test_matching_weighs_as_much_as_by_definition():
    rng = random.Random(6)
    for _ in range(150):
        a, b = (dom.Tree(dom.parse("".join(random_tree(rng) for _ in range(3)))) for _ in range(2))
        pairs = dom.match(a, b)
        weight = sum(1.0 + (a.names[i] == b.names[j]) + (a.texts[i] == b.texts[j]) for i, j in pairs.items())
        assert weight == naive_weight(a, b)
        parent = {k: p for p, kids in enumerate(a.kids) for k in kids}
        other = {k: p for p, kids in enumerate(b.kids) for k in kids}
        assert all(pairs[parent[i]] == other[j] for i, j in pairs.items() if i)
        assert len(set(pairs.values())) == len(pairs)


def test_matching_by_levels_finds_the_same_pairs(monkeypatch):
    rng = random.Random(8)
    for k in range(120):
        trees = 3 if k % 5 else 30
        a, b = (dom.Tree(dom.parse("".join(random_tree(rng) for _ in range(trees)))) for _ in range(2))
        want = dom.match(a, b)
        with monkeypatch.context() as few:  # all by levels; tables in parts, weights kept or not
            few.setattr(dom, "CELLS", (0, 4)[k % 2])
            few.setattr(dom, "ALL_CELLS", -1)
            few.setattr(dom, "KEPT", (0, 30, 1 << 22)[k % 3])
            few.setattr(dom, "PARTS", (2, 3, 16)[k % 3])
            assert dom.match(a, b) == want
        assert trees > 3 or sum(1.0 + (a.names[i] == b.names[j]) + (a.texts[i] == b.texts[j])
                   for i, j in want.items()) == naive_weight(a, b)


def test_long_runs_of_siblings_match_with_most_weight():
    rng = random.Random(9)
    left, right = ([rng.randrange(9) for _ in range(1100)] for _ in range(2))  # no subtree is there once
    a, b = (dom.Tree(dom.parse("<ul>" + "".join(f"<li><b>{v}</b></li>" for v in run))) for run in (left, right))
    pairs = dom.match(a, b)
    weight = sum(1 + (a.names[i] == b.names[j]) + (a.texts[i] == b.texts[j]) for i, j in pairs.items())
    best = [0] * (len(right) + 1)
    for x in left:
        row = [0]
        for n, y in enumerate(right):
            row.append(max(row[n], best[n + 1], best[n] + 5 + (x == y)))  # li 3, b 2, and its text
        best = row
    assert weight == best[-1] + 6  # the root and the list


def test_deep_and_long_pages_match_by_levels():
    rng = random.Random(10)
    pages = ["<div>" * 2500 + "".join(f"<li>{rng.randrange(9)}" for _ in range(1200)) for _ in range(2)]
    a, b = (dom.Tree(dom.parse(page)) for page in pages)
    pairs = dom.match(a, b)
    assert len(pairs) > 2501 + 1100 and all(a.nodes[i].tag == b.nodes[j].tag for i, j in pairs.items())


def test_a_host_reads_the_same_whatever_other_hosts_there_are(spark):
    page = "<html><body><div>Head of {0}</div><article><h1>T {1}</h1><p>Body {1}</p><p>Part {2}</p></article></body></html>"
    rows = [(f"p{h}/{k}", f"http://h{h}/{k}", page.format(h, k, k % 7)) for h, n in ((0, 400), (1, 150), (2, 9), (3, 1))
            for k in range(n)] + [("x", "http:h/5", "<p>a"), ("y", "5", "<p>b")]
    frame = spark.createDataFrame(rows, "page_id string, url string, html string")
    whole = {r.page_id: r.text for r in wrappers.extract(frame).collect()}
    assert len(whole) == len(rows)
    for host in ("p1/", "p2/", "p3/"):
        alone = {r.page_id: r.text for r in wrappers.extract(frame.filter(frame.page_id.startswith(host))).collect()}
        assert alone == {i: t for i, t in whole.items() if i.startswith(host)}
