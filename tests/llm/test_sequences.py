"""Byte-level BPE, fill-in-the-middle and the prefix trie against the library, brute force and SQL."""

import base64
import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import compare
from webcorpus.llm import byte_bpe, fill_middle, prefix_trie, queries
from webcorpus.llm.queries import tokenizer

SF = "/root/testdata/sf0.001"
RANKS = "byte_bpe_50k.tiktoken"
# Newer and older letters, blanks of all kinds, controls, marks, astral characters.
ODD = [chr(c) for c in (0x1C, 0x1F, 0x85, 0xA0, 0x558, 0x58B, 0x88F, 0x200B, 0x2029, 0x3000, 0x301, 0x11DE0, 0x1F600)]
ODD += list("aab  \n\t'sSrelvd019_-=.éßñ日本")


def own(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(made):
    return [np.frombuffer(m, dtype=np.int32).tolist() for m in made]


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(tokenizer(RANKS))


def test_ids_are_those_of_the_library(ranks):
    rng = random.Random(1)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["", "a" * 30000, "=" * 30001, " " * 20000 + "x", "\n" * 777 + "ab" * 9000, "it's <|endoftext|>"]
    library = own(ranks)
    assert ids(byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)(texts)) == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("wide", [1, 1000])
@pytest.mark.parametrize("seed", range(40))
def test_replay_where_a_merge_makes_a_lower_rank(seed, wide, monkeypatch):
    """Vocabularies in no order of merges: low ranks appear late, one token splits in several ways."""
    monkeypatch.setattr(byte_bpe, "WIDE", wide)
    rng = random.Random(seed)
    made = set()
    while len(made) < 25:
        made.add(bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6))))
    made = sorted(made)
    rng.shuffle(made)
    ranks = {bytes([b]): b for b in range(256)} | {t: 256 + k for k, t in enumerate(made)}
    texts = [" ".join("".join(rng.choice("abc") for _ in range(rng.randrange(1, 30))) for _ in range(5))
             for _ in range(30)]
    library = own(ranks)
    assert ids(byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)(texts)) == [library.encode_ordinary(t) for t in texts]


def test_blocks_runs_and_forgotten_words_change_nothing(ranks, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("etaoin") for _ in range(rng.randrange(1, 90))) for _ in range(200))
             for _ in range(10)]
    whole = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)(texts)
    for name, value in (("BLOCK", 50), ("RUN", 7), ("KEPT", 3), ("WIDE", 2)):
        monkeypatch.setattr(byte_bpe, name, value)
        encoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
        assert [i for t in texts for i in encoder([t])] == whole


def test_a_vocabulary_without_a_byte_is_refused(ranks):
    with pytest.raises(KeyError):
        byte_bpe.Merges({t: r for t, r in ranks.items() if t != b"!"})


def test_bpe_query_against_the_library(spark, ranks):
    library, want = own(ranks), {}
    for row in spark.read.parquet(f"{SF}/documents.parquet").collect():
        made = library.encode_ordinary(row.text or "")
        want[row.doc_id] = (len(made), hashlib.sha256(" ".join(map(str, made)).encode()).hexdigest(),
                            hashlib.sha256(library.decode_bytes(made)).hexdigest())
    got = queries.op11_byte_bpe(spark, SF).collect()
    assert len(got) == len(want)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want


ROWS = [("1", None, 0, None), (None, "", 1, "x"), ("2", "a b", 2, "y"), ("2", "a b", 2, "y"),
        ("3", "x<S>y", 3, ""), ("5", "日本 river " * 20000, 0, "z"), ("6", "\x00 \n", 0, "n")]


def table(spark, rows=ROWS):
    """Text ids, and names that the operators use themselves."""
    return spark.createDataFrame(rows, "doc_id string, text string, ids int, output string").repartition(3)


def test_bpe_of_odd_rows_and_none(spark, ranks):
    path = tokenizer(RANKS)
    made = byte_bpe.decode(byte_bpe.encode(table(spark), path, public_tokenizers.PATTERN), path)
    library = own(ranks)
    want = sorted((str(d), library.encode_ordinary(t or ""), (t or "").encode()) for d, t, *_ in ROWS)
    assert sorted((str(r.doc_id), r.ids, bytes(r.decoded)) for r in made.collect()) == want
    assert byte_bpe.encode(table(spark, []), path, public_tokenizers.PATTERN).count() == 0
    null = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {bytes(r.decoded) for r in byte_bpe.decode(null, path).collect()} == {b""}
    for wrong in (50256, -1, None):
        frame = spark.createDataFrame([(1, [5, wrong])], "doc_id long, ids array<int>")
        with pytest.raises(Exception, match="not in the vocabulary"):
            byte_bpe.decode(frame, path).collect()


def brute_cut(text, key):
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = [int(hashlib.sha256(f"1:{key}".encode()).hexdigest()[k:k + 8], 16) for k in range(0, 32, 8)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_cuts_for_blocks_of_any_size():
    rng = random.Random(4)
    for n in range(600):
        text = "".join(rng.choice("abcXYZ  \né日😀<PSM>\x00") for _ in range(rng.randrange(200)))
        for block in (1, 2, 3, 7, 64, 4096):
            assert fill_middle.transform(text, f"1:{n}", block=block) == brute_cut(text, n)


def test_every_cut_of_a_text():
    text = "aé b日cd" * 5
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    for block in (1, 4, 16):
        held = fill_middle.Units(text.encode(), block)
        for k in range(len(units) + 1):
            before = "".join(units[:k])
            assert held.cut(k) == (len(before.encode()), len(before))


def test_fenwick_against_sums():
    rng = random.Random(5)
    for size in range(40):
        counts = [rng.randrange(4) for _ in range(size)]
        tree = fill_middle.Fenwick(counts)
        assert [tree.before(k) for k in range(size + 1)] == [sum(counts[:k]) for k in range(size + 1)]
        for number in range(sum(counts) + 2):
            place = max(k for k in range(size + 1) if sum(counts[:k]) <= number)
            assert tree.descend(number) == (place, number - sum(counts[:place]))


def test_fill_in_middle_of_odd_rows_and_none(spark):
    made = fill_middle.fill_in_middle(table(spark))
    rows = made.select("*", fill_middle.restored(made.output, made.form).alias("back")).collect()
    want = sorted(((str(d), *brute_cut(t or "", d or ""), t or "") for d, t, *_ in ROWS), key=str)
    assert sorted(((str(r.doc_id), *r[1:]) for r in rows), key=str) == want
    assert fill_middle.fill_in_middle(table(spark, [])).count() == 0
    shares = fill_middle.fill_in_middle(spark.range(2000).selectExpr("id AS doc_id", "'a b c' AS text"))
    counts = {r["form"]: r["count"] for r in shares.groupBy("form").count().collect()}
    assert abs(counts["plain"] - 200) < 60 and abs(counts["spm"] - 360) < 80


@pytest.mark.parametrize("name", ["op12_fill_in_middle", "op13_prefix_trie"])
def test_query_against_sql_at_the_next_size(spark, name):
    sf = SF.replace("0.001", "0.01")
    assert compare.differences(queries.all_queries()[name](spark, sf), compare.connect(sf), queries.all_sql()[name]) == ""


def brute_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "",
                                hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    plain = {c: [(r, t) for *_, r, _, t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for c, own_turns in plain.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        built[c] = tuple(plain.get(base, [])[:h] + own_turns[h:])
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        ends = ",".join(str(c) for c in sorted(convs) if built[c] == node)
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                    sum(len(n) == len(node) + 1 for n in below),
                    sum(not any(len(m) > len(n) and m[:len(n)] == n for m in below) for n in below),
                    sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def odd_conversations(seed):
    """Few words and short dialogues, so that prefixes, copies, ties, nulls and negative ids abound."""
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(-50, 100), 60):
        for turn in range(rng.choice([1, 1, 2, 3, 4, 6])):
            rows.append((conv, rng.choice([turn, turn, turn, None, 2]), rng.choice(["user", "user", None, ""]),
                         rng.choice(["a", "a", "b c", None, " \t", "x\ny z"])))
    rows += [(None, 1, "user", "lost"), (7, 1, "user", "tie"), (7, 1, "user", "tie"), (7, 1, "user", "tie a")]
    rows += [(40, k, "user", f"w{k % 3}") for k in range(300)] + [(41, k, "user", f"w{k % 3}") for k in range(299)]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_against_brute_force_and_sql(spark, seed):
    rows = odd_conversations(seed)
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA + ", node string, row int, place int")
    got = prefix_trie.digests(frame.repartition(5))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_trie(rows)
    import duckdb
    import pyarrow as pa
    db = duckdb.connect()
    db.register("conversations", pa.table({name: [r[k] for r in rows] for k, name in enumerate(
        ("conv_id", "turn", "role", "text"))}))
    assert compare.differences(got, db, prefix_trie.SQL) == ""


def test_trie_of_none_of_copies_and_of_turnless_conversations(spark):
    assert prefix_trie.digests(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie.digests(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).count() == 0
    rows = [(20 * k, t, "user", "same words") for k in range(200) for t in range(3)]
    got = prefix_trie.digests(spark.createDataFrame(rows, SCHEMA))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_trie(rows)
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    got = prefix_trie.digests(spark.createDataFrame([(lone, 1, "user", "only turn")], SCHEMA)).collect()
    assert [(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_leaves, r.saved_tokens) for r in got] == [
        (lone, 0, None, 1, 1, 0)]


def test_end_lists_come_in_parts(spark):
    members = spark.range(1000).selectExpr("id * 3 AS conv_id", "CASE WHEN id < 900 THEN 'hot' ELSE 'n' || id END AS node")
    lists = prefix_trie.end_lists(members, part=64)
    held = sorted((r.node, r.part, r.ids) for r in lists.collect())
    assert max(len(i) for *_, i in held) <= 64
    assert [i for n, _, part in held if n == "hot" for i in part] == [3 * k for k in range(900)]
    made = {r.node: r.ends_sha256 for r in prefix_trie.ends_digests(lists).collect()}
    assert made["hot"] == hashlib.sha256(",".join(str(3 * k) for k in range(900)).encode()).hexdigest()
    assert len(made) == 101


def test_rank_files_are_read_as_they_are(tmp_path):
    lines = [b"%s %d" % (base64.b64encode(bytes([b])), b) for b in range(256)]
    (tmp_path / "r").write_bytes(b"\n".join(lines))
    assert byte_bpe.read_ranks(str(tmp_path / "r")) == {bytes([b]): b for b in range(256)}
