"""Prefix trie of conversations: whole sequences collapse first, then weighted prefixes are summed.

A turn is known by a digest of its place, role and text, and a sequence of turns by its length and
the sums of the digests' four 32-bit parts: 128 bits, with the places in them, so that the prefixes
of a long conversation are sums over ranges and no conversation passes through one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from webcorpus.llm.common import map_batches, partitions, prefix_sums, word_count
from webcorpus.operators.joins import lookup
from webcorpus.session import written

# A conversation takes fewer than HEADS first turns from the first conversation of its GROUP ids.
GROUP, HEADS = 20, 4
# Ids of a part of an end list.
PART = 1 << 12
LANES = ["lane0", "lane1", "lane2", "lane3"]


def _slim(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, said, digest, words): what is needed of a turn, without its text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return turns.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.sha2(said, 256).alias("digest"), word_count(text).alias("words"),
        role.alias("role"), F.sha2(text, 256).alias("said"))


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id), and their turns (conv_id, place, digest, words) with shared heads.

    Conversation c begins with the first h turns of conversation c - c % 20, fewer if it has fewer
    and none if it does not exist, and goes on with its own turns after its first h; h is the
    unsigned crc32 of the decimal c, modulo 4. Turns come by turn (null first), ties by role and
    by digest of the text; equal rows are repeated turns. A null role or text is empty. Rows without a
    conv_id belong to no conversation. A conversation may be left without turns; it still counts.
    """
    own = written(_slim(turns).withColumn("row", F.monotonically_increasing_id()), "turns")
    heads = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS))
    order = [F.col("turn").asc_nulls_first(), "role", "said", "row"]
    # A filter on row numbers is a group limit before the shuffle: a long conversation sends few rows.
    first = written(own.withColumn("nth", F.row_number().over(W.partitionBy("conv_id").orderBy(*order)))
                    .filter(F.col("nth") < HEADS), "heads")
    conversations = written(own.select("conv_id").distinct(), "conversations")
    taken = conversations.withColumn("h", heads).withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
    shared = taken.alias("c").join(
        first.alias("f"), (F.col("c.base") == F.col("f.conv_id")) & (F.col("f.nth") <= F.col("c.h"))) \
        .select("c.conv_id", F.lit(0).alias("later"), F.lit(None).cast("long").alias("turn"),
                F.lit("").alias("role"), F.lit("").alias("said"), F.col("f.nth").cast("long").alias("row"),
                "f.digest", "f.words")
    rest = own.join(first.filter(F.col("nth") <= heads).select("row"), "row", "left_anti").select(
        "conv_id", F.lit(1).alias("later"), F.col("turn").cast("long").alias("turn"), "role", "said", "row", "digest", "words")
    placed = prefix_sums(
        written(shared.unionByName(rest), "rebuilt"), ["conv_id"],
        [F.col("later"), F.col("turn").isNotNull(), F.col("turn"), F.col("role"), F.col("said"), F.col("row")],
        "placed", place=F.lit(1).cast("long"))
    return conversations, placed.select("conv_id", (F.col("place") + 1).alias("place"), "digest", "words")


def _key(depth: Column, lanes: list[Column]) -> Column:
    return F.concat_ws("-", depth, *lanes)


ROOT = "-".join("0" * (1 + len(LANES)))


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, node, parent, before, words): a row for every non-empty prefix of every
    conversation of (conv_id, place, digest, words); `before` sums the words of the turns above."""
    mixed = F.sha2(F.concat_ws(":", "place", "digest"), 256)
    lanes = [F.conv(F.substring(mixed, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(len(LANES))]
    rows = written(turns.withColumns(dict(zip(LANES, lanes))).drop("digest"), "lanes")
    summed = prefix_sums(rows, ["conv_id"], [F.col("place")], "paths", before=F.col("words"),
                         **{f"above_{name}": F.col(name) for name in LANES})
    above = [F.col(f"above_{name}") for name in LANES]
    return summed.select(
        "conv_id", F.col("place").alias("depth"),
        _key(F.col("place"), [a + F.col(name) for a, name in zip(above, LANES)]).alias("node"),
        _key(F.col("place") - 1, above).alias("parent"), "before", "words")


def collapse(conversations: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (conv_id, node) and sequences (node, conv_id, weight, length, total): each
    conversation's last prefix, and the different ones of these with the smallest member."""
    last = rows.groupBy("conv_id").agg(F.max("depth").alias("length"), F.max(F.col("before") + F.col("words")).alias("total"),
                                       F.max_by("node", "depth").alias("node"))
    members = written(conversations.join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("node", F.lit(ROOT)).alias("node"),
        F.coalesce("length", F.lit(0)).alias("length"), F.coalesce("total", F.lit(0)).alias("total")), "members")
    sequences = members.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"),
        F.first("length").alias("length"), F.first("total").alias("total"))
    return members.select("conv_id", "node"), written(sequences, "sequences")


def trie(conversations: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens)
    and members (conv_id, node), the node at which each conversation ends.

    `conversations` lists the conv_ids, each once, and `turns` their turns as rebuild() gives them;
    a conversation without turns ends at the root. No conversations have no nodes. Copies collapse
    into one sequence with a weight. A sequence that is a proper prefix of another is no leaf.

    A node's conv_id is its smallest member. Words saved below a node, (n_convs - 1) times the words
    of each turn, are those that its sequences have from it on, by weight, less those of each turn
    once; a turn counts for the sequence whose conv_id its node bears, and these turns are the end
    of that sequence's path. So every figure is one sum over the prefixes of the different sequences.
    """
    rows = written(paths(turns), "prefixes")
    members, sequences = collapse(conversations, rows)
    own = lookup(rows, sequences.select("conv_id", F.col("length")), "conv_id", "inner")
    roots = sequences.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("node"),
        F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("before"),
        F.lit(0).cast("long").alias("words"), "length")
    prefixes = written(own.unionByName(roots), "sequence_prefixes")
    inner = prefixes.filter(F.col("depth") < F.col("length")).select("node").distinct()
    leaves = sequences.join(inner, "node", "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    begins = prefixes.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.min("before").alias("before")) \
        .groupBy("conv_id").agg(F.min("before").alias("begin"))
    facts = written(
        sequences.join(leaves, "conv_id", "left").join(begins, "conv_id", "left").select(
            "conv_id", "weight", "total", F.coalesce("leaf", F.lit(0)).alias("leaf"),
            F.coalesce("begin", "total").alias("begin")), "sequence_facts")
    saved = (F.col("weight") * (F.col("total") - F.col("before"))
             - (F.col("total") - F.greatest("before", "begin")))
    nodes = written(
        lookup(prefixes, facts, "conv_id", "inner").groupBy("node").agg(
            F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"),
            F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"), F.sum(saved).alias("saved_tokens")),
        "nodes")
    children = nodes.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")) \
        .agg(F.count("*").alias("n_children"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return lookup(nodes, above, "parent").join(children, "node", "left").select(
        "node", "conv_id", "depth", "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens"), members


def end_lists(members: DataFrame, part: int = PART) -> DataFrame:
    """(node, part, ids): the conversations that end at a node, ascending, in parts of `part` ids.

    Ranks come from range sums, so a node at which a third of all conversations end is spread."""
    ranked = prefix_sums(members, ["node"], [F.col("conv_id")], "ends", rank=F.lit(1).cast("long"))
    return ranked.groupBy("node", F.floor(F.col("rank") / part).alias("part")) \
        .agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))


def ends_digests(lists: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of each node's decimal ids, comma-joined.

    A digest takes its bytes in order, so the parts of a node pass one task, one after the other; they
    are sorted on disk and none is kept.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, hashlib.sha256()
        for batch in batches:
            made: list[tuple[str, str]] = []
            for name, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if name != node:
                    if node is not None:
                        made.append((node, digest.hexdigest()))
                    node, digest = name, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pydict({"node": pa.array([m[0] for m in made], pa.string()),
                                              "ends_sha256": pa.array([m[1] for m in made], pa.string())})
        if node is not None:
            yield pa.RecordBatch.from_pydict({"node": [node], "ends_sha256": [digest.hexdigest()]})

    joined = lists.select("node", "part", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    dealt = joined.repartition(partitions(lists), "node").sortWithinPartitions("node", "part")
    return map_batches(dealt, task, "node string, ends_sha256 string")


def digests(turns: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations, a row per node, end lists as digests."""
    conversations, rebuilt = rebuild(turns)
    nodes, members = trie(conversations, rebuilt)
    ends = ends_digests(end_lists(members))
    return nodes.join(ends, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


SQL = r"""
WITH ranked AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
           ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
           lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda a, b: xor(a >> 1, (a & 1) * 3988292384))), 4294967295) % 4 AS h
  FROM ranked
), rebuilt AS (
  SELECT c.conv_id, 0 AS later, pos, role, text FROM convs c JOIN ranked r ON r.conv_id = c.base AND pos <= h
  UNION ALL
  SELECT c.conv_id, 1, pos, role, text FROM convs c JOIN ranked r ON r.conv_id = c.conv_id AND pos > h
), paths AS (
  SELECT conv_id, list({'role': role, 'text': text}) OVER w AS path,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY later, pos ROWS UNBOUNDED PRECEDING)
  UNION ALL
  SELECT conv_id, [], 0 FROM convs
), nodes AS (
  SELECT path, len(path) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM paths GROUP BY path
), children AS (
  SELECT path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), above AS (
  SELECT path[1:k] AS path, (n_convs - 1) * words AS saved, n IS NULL AS leaf
  FROM (SELECT n.*, c.n, unnest(range(0, depth + 1)) AS k FROM nodes n LEFT JOIN children c USING (path))
), sums AS (
  SELECT path, sum(saved)::BIGINT AS saved, count(*) FILTER (leaf) AS leaves FROM above GROUP BY path
), ends AS (
  SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS sha
  FROM (SELECT conv_id, arg_max(path, len(path)) AS path FROM paths GROUP BY conv_id) GROUP BY path
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
       leaves AS n_leaves, saved AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256
FROM nodes n JOIN sums USING (path) LEFT JOIN children c USING (path) LEFT JOIN ends USING (path)
     LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
"""
