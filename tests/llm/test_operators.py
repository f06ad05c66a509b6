"""The operators against SQL or brute force, on odd rows and on small tables."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import compare
import corpus_pipeline
from webcorpus.llm import (classifier, components, decontaminate, fertility, line_dedup, mixing, perspectives,
                           queries, simhash, token_counts, toxicity, wrappers)
from webcorpus.llm.queries import tokenizer
from webcorpus.session import written

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, f string, n_words long"
LONG = "river stone " * 20000
ODD = [
    (1, None, "en", "a", 0, "x", 1), (2, "", None, None, 0, None, None), (None, "one two", "en", "b", 7, "", 2),
    (None, "one two", "en", "b", 7, "", 2), (3, " \n\t ", "de", "a", 4, "", 0), (4, LONG, "en", "a", 240000, "", 0),
    (5, "a\nb\nc\nd", "fr", None, 7, "", 0), (6, "a\nb\nc\nd", "fr", "c", 7, "", 0),
    (6, "a\nb\nc\nd", "fr", "c", 7, "", 0), (7, "x\nx\nx\nx\nx", "es", "c", 9, "", 0),
]


def table(spark, rows=ODD, schema=DOCS):
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def db():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(queries.all_sql()))
def test_query_against_sql(spark, db, name):
    assert compare.differences(queries.all_queries()[name](spark, SF), db, queries.all_sql()[name]) == ""


@pytest.mark.parametrize("operator", [
    lambda s, d: token_counts.token_counts(d, tokenizer("word_bpe_49k.json")),
    lambda s, d: mixing.mix(d),
    lambda s, d: fertility.quality(d, tokenizer("piece_bpe_32k.model")),
    lambda s, d: line_dedup.line_dedup(d),
    lambda s, d: simhash.simhash_components(d),
    lambda s, d: toxicity.toxicity(d, labels(s)),
    lambda s, d: classifier.classify(d, labels(s)),
])
def test_odd_and_no_rows(spark, operator):
    assert operator(spark, table(spark)).count() == len(ODD)
    assert operator(spark, table(spark, [])).count() == 0


def items(spark, rows=((0, "the quick brown fox jumps over the lazy dog and goes home"), (1, None), (2, "ab"))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_pipeline_stages_on_odd_and_no_rows(spark, tmp_path):
    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, table(spark), str(tmp_path)).columns == table(spark).columns
        assert stage(spark, table(spark, []), str(tmp_path)).count() == 0


def test_token_counts_splice_like_one_encoding():
    path = tokenizer("word_bpe_49k.json")
    plain = token_counts.load(path)
    rng = random.Random(3)
    words = ["Water", "naïve", "it's", "<|endoftext|>", "日本語", "x1", "...", "́e", "ΣΑΣ"]
    for chunk, overlap in ((300, 4), (1000, 64)):
        for _ in range(4):
            text = "".join(rng.choice(words) + rng.choice([" ", "\n", "  ", ""]) for _ in range(900))
            want = len(plain.encode(text, add_special_tokens=False).ids)
            assert token_counts.count_spliced(plain, text, chunk, overlap) == want
            assert token_counts.Counter(path)([text]) == [want]
    assert token_counts.count_spliced(plain, "ab" * 3000, 200, 8) == len(
        plain.encode("ab" * 3000, add_special_tokens=False).ids)


def test_mixture_meets_its_targets(spark):
    rows = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    taken, target = Counter(), {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(target[s] - 1 < taken[s] <= target[s] for s in target)
    assert abs(sum(target.values()) - sum(r.size for r in rows)) < 1e-3


def test_fertility_figures_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in fertility.quality(docs, tokenizer("piece_bpe_32k.model")).collect():
        text = texts[r.doc_id]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
        covered = {k + d for k in range(len(words) - 4) for d in range(5)
                   if windows[tuple(words[k:k + 5])] > 1}
        lines = [x for x in text.split("\n") if x.split()]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words))


def prose(rng, n):
    words = ("the water of this river runs down from a mountain and people there have always known how "
             "to find stones under its green bank while children play near old houses every summer").split()
    return " ".join(rng.choice(words) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


def kept_by_quality(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    return {r.doc_id for r in fertility.quality(frame, tokenizer("piece_bpe_32k.model")).collect() if r.kept}


def test_copies_do_not_close_the_bands(spark):
    rng = random.Random(11)
    rows = [(k, prose(rng, rng.randint(300, 360)), "en") for k in range(100)]
    alone = kept_by_quality(spark, rows)
    assert len(alone) >= 95
    copy = rows[min(alone)][1]
    for n in (50, 300):  # a third of all rows, and three quarters
        assert kept_by_quality(spark, rows + [(1000 + k, copy, "en") for k in range(n)]) >= alone


def test_thin_classes_borrow_a_band(spark):
    rng = random.Random(12)
    rows = [(k, prose(rng, rng.randint(300, 360)), "en") for k in range(80)]
    junk = " ".join(f"{rng.randrange(10**6):x}|{rng.randrange(10**6)}" for _ in range(700))
    rows += [(200, prose(rng, 700), "en"), (201, junk, "en"), (202, prose(rng, 320), "xx"), (203, junk, "xx"),
             (204, prose(rng, 30), "en"), (205, prose(rng, 30), "xx")]
    assert kept_by_quality(spark, rows) & set(range(200, 206)) == {200, 202, 204, 205}


def edits(a, b):
    """Fewest edits between a and any part of b."""
    row = np.zeros(len(b) + 1, dtype=int)
    for k, x in enumerate(a, 1):
        new = [k]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination_finds_all_within_the_budget(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeiou") for _ in range(rng.randint(2, 8)))
    bench = [(k, " ".join(word() for _ in range(rng.randint(8, 25)))) for k in range(12)]
    rows = []
    for k in range(60):
        name, text = rng.choice(bench)
        chars = list(text)
        for _ in range(rng.randint(0, 9)):
            at = rng.randrange(len(chars))
            chars[at:at + rng.randint(0, 1)] = rng.choice(["", "z", "zz"])
        rows.append((k, f"{word()} {word()} " + "".join(chars).upper() + f"\n{word()}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    frame = spark.createDataFrame(bench, "item_id long, text string")
    for block in (1 << 20, 400):
        got = {(r.doc_id, r.item_id): r.edits
               for r in decontaminate.contaminated(docs, frame, block=block).collect()}
        for d, text in rows:
            for i, item in bench:
                best, limit = edits(item, decontaminate.normal(text)), decontaminate.budget(len(item))
                assert ((d, i) in got) == (best <= limit), (d, i, best, limit)
                assert got.get((d, i), best) == best
    kept = {r.doc_id for r in decontaminate.clean(docs, frame).collect()}
    assert kept == {d for d, _ in rows} - {d for d, _ in got}


def test_shared_qgrams_are_counted_in_portions(monkeypatch):
    items = [(0, "ab" * 100), (1, "a" * 150), (2, "the quick brown fox jumps over it"), (3, "xyz" * 40)]
    texts = ["a" * 3000 + " b", "ab" * 2000, "say the quick brown fox jumps over it and " + "a" * 149 + "q", "", "ab"]
    block = decontaminate.Block(items)
    at_once = [sorted(block.regions(decontaminate.codes(t))) for t in texts]
    found = [block.matches(t) for t in texts]
    assert {m[0] for m in found[0]} == {1} and {m[0] for m in found[1]} == {0}
    assert {m[0] for m in found[2]} == {1, 2} and found[3] == found[4] == []
    monkeypatch.setattr(decontaminate, "HITS", 50)
    assert [sorted(block.regions(decontaminate.codes(t))) for t in texts] == at_once


def test_line_windows(spark):
    rows = [(1, "p\na\nb\nc\nq"), (2, "r\na\n\n b \nc\ns"), (3, "x\nx\nx\nx\nx"), (4, "a\nb")]
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "p\na\nb\nc\nq", 2: "r\ns", 3: "x", 4: "a\nb"}


def test_short_texts_are_windows_of_their_own(spark):
    line = " ".join(f"w{k}" for k in range(60))
    rows = [(1, line), (2, f" {line}\n\n"), (3, f"a\n\n{line}"), (4, f"a\n{line}\n"), (5, f"{line}\na"), (6, ""), (7, ""),
            (8, f"p\n{line}\nq")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(frame, short=True).collect()}
    assert got.pop(2).strip() == got.pop(4).strip() == ""
    assert got == {d: t for d, t in rows if d not in (2, 4)}
    assert {r.doc_id: r.text for r in line_dedup.line_dedup(frame).collect()} == dict(rows)


def test_simhash_by_brute_force(spark):
    rng = random.Random(7)
    rows = [(k, " ".join(f"w{rng.randrange(60)}" for _ in range(40))) for k in range(60)]
    for k in range(60):
        words = rows[k][1].split() * 8
        words[rng.randrange(40)] = "Changed"
        rows += [(100 + 2 * k, " ".join(words)), (101 + 2 * k, " ".join(words + ["end"]))]
    rows += [(300, ""), (301, None), (302, "ONE"), (303, "one")]

    def fingerprint(text):
        words = [w.lower() for w in (text or "").split()]
        shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    fps = {d: fingerprint(t) for d, t in rows}
    root = {d: d for d in fps}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in combinations(sorted(fps), 2):
        if bin(fps[a] ^ fps[b]).count("1") <= 2:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    for crowded in (512, 1):
        got = simhash.simhash_components(spark.createDataFrame(rows, "doc_id long, text string"),
                                         crowded=crowded).collect()
        assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
            d: (f"{fps[d]:016x}", find(d)) for d in fps}


def test_dense_balls_of_fingerprints(spark):
    rng = random.Random(9)
    base = rng.getrandbits(64)
    fps = {base ^ rng.choice([0, 1 << rng.randrange(64)]) ^ (1 << rng.randrange(12)) ^ (1 << rng.randrange(40))
           for _ in range(300)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = {(a, b) for a, b in combinations(sorted(signed), 2) if bin((a ^ b) & (2**64 - 1)).count("1") <= 2}
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    for crowded in (3, 512):
        assert {tuple(r) for r in simhash.links(frame, crowded).collect()} == want


def exploded_and_broadcast(df):
    """Lines of the plan of `df` that explode rows below a broadcast."""
    found, inside = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        inside = None if inside is not None and depth <= inside else inside
        if inside is None and "BroadcastExchange" in line:
            inside = depth
        elif inside is not None and "Generate" in line:
            found.append(line)
    return found


def test_near_copies_are_found_without_broadcasting_exploded_rows(spark, monkeypatch):
    """Catalyst takes an exploded table for as small as it was before, and so would broadcast it."""
    made = []
    for module in (simhash, components):
        monkeypatch.setattr(module, "written", lambda df, name: made.append(df) or written(df, name))
    rows = [(k, f"{k % 7} two three four five six seven {k % 3} nine", "en", "a", 0, "", 0) for k in range(60)]
    kept = corpus_pipeline.without_near_copies(spark, table(spark, rows), "")
    assert kept.count() == 21
    assert any("Generate explode" in d._jdf.queryExecution().executedPlan().toString() for d in made)
    assert [exploded_and_broadcast(d) for d in made if exploded_and_broadcast(d)] == []


def test_enumerated_balls_are_never_broadcast(spark):
    """2,080 rows of each crowded fingerprint, where the table they are looked up in looks no smaller."""
    fps = written(spark.range(300).select(F.xxhash64("id").alias("fp")), "fps")
    for crowded in (0, 512):
        found = simhash.links(fps, crowded)
        assert exploded_and_broadcast(found) == []
        probes = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "LeftSemi" in x]
        assert len(probes) == 1  # so the side asked for can't be broadcast, whatever the sizes


def test_keep_one_leaves_other_texts_of_an_id(spark):
    text, copy = "one two three four five", "ONE two three four five"
    rows = [(1, text), (None, copy), (None, "a text found nowhere else"), (2, text), (2, "quite different words here"),
            (None, None)]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {tuple(r) for r in got} == {rows[0], rows[2], rows[4], rows[5]}


def test_factors_learn_what_linear_weights_miss():
    rng = np.random.default_rng(1)
    x = (rng.random((1500, 6)) < 0.4).astype(float)
    y = ((x[:, 0] == 1) & (x[:, 1] == 1)).astype(float)
    y[(x[:, 0] + x[:, 1]) == 0] = 1  # an exclusive-or pattern, invisible to additive weights
    bias, linear, factors = toxicity.train(x, y, rounds=600)
    right = ((toxicity.raw_scores(x, bias, linear, factors) > 0) == (y > 0.5)).mean()
    bias, linear, factors = toxicity.train(x, y, factors=1, rounds=600)
    alone = ((bias + x @ linear > 0) == (y > 0.5)).mean()
    assert right > 0.97 > alone


def test_machine_by_an_explicit_sum_over_pairs():
    rng = np.random.default_rng(4)
    x, w, v = (rng.random((30, 9)) < 0.5).astype(float), rng.normal(size=9), rng.normal(size=(9, 3))
    want = [0.3 + sum(w[i] * r[i] for i in range(9)) + sum(
        r[i] * r[j] * sum(v[i, f] * v[j, f] for f in range(3)) for i, j in combinations(range(9), 2)) for r in x]
    assert np.allclose(toxicity.raw_scores(x, 0.3, w, v), want)


def test_words_that_mean_something_only_together(spark):
    """Each word alone says nothing: a text is toxic when exactly one of the two is in it."""
    rng = random.Random(21)
    rows, marks = [], []
    for k in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = [f"w{rng.randrange(3000)}" for _ in range(20)] + ["insultword"] * a + ["groupword"] * b
        rng.shuffle(words)
        rows.append((k, " ".join(words)))
        marks.append((k, int(a != b)))
    got = toxicity.toxicity(spark.createDataFrame(rows, "doc_id long, text string").repartition(4),
                            spark.createDataFrame(marks, "doc_id long, toxic int")).filter("held_out").collect()
    truth = dict(marks)
    assert len(got) > 400 and sum(r.predicted == truth[r.doc_id] for r in got) >= 0.97 * len(got)


def test_filters_by_a_naive_convolution():
    rng = np.random.default_rng(5)
    shapes = [(256, classifier.EMBED), (classifier._INPUTS, classifier.FILTERS), (classifier.FILTERS,),
              (classifier.FILTERS,), (1,)]
    net = classifier.Network([rng.normal(size=s) for s in shapes])
    data = rng.integers(0, 256, (3, classifier.CHUNK), dtype=np.uint8)
    heard = rng.random((3, classifier.CHUNK)) < 0.2
    top, _ = net.pooled(data, heard)
    table, filters = net.params[0], net.params[1].reshape(classifier.WIDTH, classifier.EMBED + 1, classifier.FILTERS)
    want = [[max(sum(float(np.dot([*table[data[c, at + k]], heard[c, at + k]], filters[k, :, f])) for k in range(classifier.WIDTH))
                 for at in range(0, classifier.CHUNK - classifier.WIDTH + 1, classifier.STEP))
             for f in (0, 3, classifier.FILTERS - 1)] for c in range(3)]
    assert np.allclose(top[:, [0, 3, classifier.FILTERS - 1]], want, atol=1e-3)


@pytest.mark.parametrize("name, label, least", [
    ("op9_toxicity", "toxic", 0.95), ("op10_quality_classifier", "quality", 0.97)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.all_queries()[name](spark, sf).collect() if r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= least * len(held)


def test_chunks_cover_every_byte():
    rng = np.random.default_rng(2)
    for n in (0, 1, 7, 511, 512, 513, 1018, 5000):
        data = rng.integers(1, 255, n).astype(np.uint8)
        parts, _, fresh = classifier.chunks_of(data)
        hop = classifier.CHUNK - classifier.WIDTH + classifier.STEP
        back = np.concatenate([p[:hop] for p in parts[:-1]] + [parts[-1]])
        assert (back[:n] == data).all() and not back[n:].any() and (fresh > 0).all()


PAGE = """<html><head><title>t</title></head><body><div id="top">Daily &amp; Co</div>
<nav><a>Home</a></nav><div class="c">{}</div><div>All rights reserved</div>
<div class="user-comments"><p>nice</p></div><form><p>mail</p></form></body></html>"""


def test_wrappers_by_alignment_and_by_marks():
    bodies = [f"<h1>Title {k}</h1><p>First &eacute;{k}<br>line</p><p>Body <b>{k}</b>{k}" for k in range(6)]
    got = wrappers.texts_of([PAGE.format(b) for b in bodies])
    assert got == [f"Title {k} First é{k} line Body {k}{k}" for k in range(6)]
    same = [PAGE.format(bodies[0])] * 3  # copies tell nothing: only marked parts go
    assert wrappers.texts_of(same) == [f"Daily & Co {got[0]} All rights reserved"] * 3
    marked = "<body><p>menu<article class=post><h1>A</h1><div class='ad'>buy</div>x<p>y<script>z</script></article>w"
    assert wrappers.texts_of([marked, ""]) == ["A x y", ""]


def test_copies_and_small_hosts_are_aligned_whatever_the_partitions(spark):
    body = "<article><h1>Title {0}</h1><p>First {0} line</p><p>Unmarked notice</p></article>"
    pages = [PAGE.format(body.format(k)) for k in range(3)]
    want = [f"Title {k} First {k} line" for k in range(3)]
    assert wrappers.texts_of(pages) == want  # fewer than five pages
    assert wrappers.texts_of([pages[0]] * 6 + pages[1:] * 2) == [want[0]] * 6 + want[1:] * 2
    rows = [(h * 1000 + k, f"http://h{h}/{k}", PAGE.format(body.format(k))) for h, n in enumerate((300, 2, 3, 6)) for k in range(n)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("3", "97"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = {r.page_id: r.text for r in wrappers.extract(frame).collect()}
            assert got == {i: f"Title {i % 1000} First {i % 1000} line" for i, _, _ in rows}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_large_and_deep_pages_are_aligned():
    rows = ["".join(f"<li><i>n{(7 * j + k) % 9001}</i> of page {k}</li><li>Fixed {j}</li>" for j in range(2500)) for k in range(2)]
    got = wrappers.texts_of([f"<div>Unmarked menu</div><ul>{r}</ul><div>All rights</div>" for r in rows])
    assert all("menu" not in t and "rights" not in t and "Fixed" not in t and f"of page {k}" in t
               for k, t in enumerate(got))
    deep = [f"<p>Unmarked menu</p>{'<div>' * 3000}own {k}{'</div>' * 3000}" for k in range(3)]
    assert wrappers.texts_of(deep) == ["own 0", "own 1", "own 2"]


def test_code_in_scripts_is_no_markup():
    for code in ("for(var i=0;i<n;i++){f(i)}", "var s='<!--';", "if(a<b){x='</p>'}", "<![CDATA[ <style>", "a='</scripts>'"):
        page = f"<body><p>before<SCRIPT>{code}</Script ><p>article <style>{code}</style>end"
        assert wrappers.texts_of([page]) == ["before article end"], code
    assert wrappers.texts_of(["<p>a<script>i<n; b</p><p>c"]) == ["a"]
    assert wrappers.texts_of(["<title>x<y</title><p>a"]) == ["a"]


def test_wrappers_on_odd_pages(spark):
    rows = [(1, None, None), (None, "http://h/x", "<p>a"), (2, "nohost", "<p>b"), (2, "nohost", "<p>b"),
            (3, "http://h/y", "<" * 500), (4, "http://h/z", "<div>" * 3000 + "deep")]
    schema = "page_id long, url string, html string, text string"
    got = wrappers.extract(spark.createDataFrame([(*r, "clash") for r in rows], schema)).collect()
    assert len(got) == len(rows) and {r.text for r in got if r.page_id in (2, 4)} == {"b", "deep"}
    assert wrappers.extract(spark.createDataFrame([], schema)).count() == 0


def test_perspectives_on_odd_turns(spark):
    rows = [(1, 0, "a b", "hi <|im_end|>", 1), (1, 1, "bot", None, 1), (1, 1, "bot", None, 1), (1, None, None, "?", 1),
            (None, 0, "system", "only", 1), (2, 0, None, "x", 1)]
    schema = "conv_id long, turn long, role string, text string, speaker int"
    got = {r.speaker: r for r in perspectives.rotate(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {"a b", "bot"}
    view = got["bot"]
    assert view.text == ("<|im_start|>user name=a_b\nhi <im_end><|im_end|>\n"
                         + "<|im_start|>assistant\n<|im_end|>\n" * 2
                         + "<|im_start|>user name=unknown\n?<|im_end|>\n")
    spans = [tuple(map(int, s.split(":"))) for s in view.masks.split(",")]
    assert [view.text[a:b] for a, b in spans] == ["<|im_end|>"] * 2
    assert perspectives.rotate(spark.createDataFrame([], schema)).count() == 0


def test_long_dialogues_come_in_parts(spark):
    rows = [(1, k, "u" if k % 2 else "v", f"turn {k} " * 3) for k in range(200)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    whole = {r.speaker: r.text for r in perspectives.rotate(frame).collect()}
    parts = sorted((r.speaker, r.part, r.text) for r in perspectives.rotate(frame, part=500).collect())
    assert len(parts) > 10
    assert {s: "".join(t for x, _, t in parts if x == s) for s in "uv"} == whole
