"""Benchmark decontamination by the q-gram lemma.

A region of a text within k edits of an item of m characters shares at least m - q + 1 - k q of the
item's q-grams with it, on diagonals (place in the text minus place in the item) that lie within
k of each other. So shared q-grams are counted in overlapping bands of 2 (k + 1) diagonals; bands
that reach the bound are verified by banded alignment. Items are held in blocks of bounded size;
each block goes through all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, LongType, StructType

from webcorpus.llm.common import map_batches, pieces, without_rows
from webcorpus.session import written

Q = 12
# Edits allowed, as a share of the item's characters.
EDITS = 0.05
# Characters of items in a block: what a task holds at once.
BLOCK = 1 << 23
# Characters of a text that are looked up at once.
STRIDE = 1 << 20
# Shared q-grams that are counted at once: a text and an item of one repeated letter share
# as many as the product of their lengths.
HITS = 1 << 20
# Bits of the filter's places.
_BITS = 22
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str) -> str:
    """Lower case, white space runs as one blank."""
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def qgrams(chars: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of every q consecutive characters."""
    n = len(chars) - q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    made, width, factor = chars * _FACTOR, 1, np.array([_FACTOR])
    out, done = None, 0
    while width <= q:  # powers of two of q, joined from the left
        if q & width:
            part = made[done:done + n]
            out = part.copy() if out is None else out * factor + part
            done += width
        if 2 * width <= q:
            made = made[:-width] * factor + made[width:]
        width *= 2
        factor = factor * factor
    return out ^ (out >> np.uint64(29))


def budget(m: int, q: int = Q, edits: float = EDITS) -> int:
    """Edits allowed for an item of m characters: its share, as long as the lemma's bound is not 0."""
    return min(int(m * edits), max(0, (m - q) // q))


class Block:
    """An index of the q-grams of some items."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, edits: float = EDITS) -> None:
        self.items = [(i, codes(t), t) for i, t in items]
        self.q = q
        lengths = np.array([len(c) for _, c, _ in self.items], dtype=np.int64)
        self.budgets = np.array([budget(int(m), q, edits) for m in lengths], dtype=np.int64)
        self.bounds = lengths - q + 1 - self.budgets * q
        grams = [qgrams(c, q) for _, c, _ in self.items]
        hashes = np.concatenate(grams) if grams else np.zeros(0, dtype=np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else item
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.item, self.place = hashes[order], item[order], place[order]
        self.filter = np.zeros(1 << _BITS, dtype=bool)
        self.filter[self.hashes >> np.uint64(64 - _BITS)] = True

    def _hits(self, chars: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(item, diagonal) of every q-gram that the text shares with an item, about HITS at a time."""
        for start in range(0, len(chars), STRIDE):
            grams = qgrams(chars[start:start + STRIDE + self.q - 1], self.q)
            at = np.flatnonzero(self.filter[grams >> np.uint64(64 - _BITS)])
            low = np.searchsorted(self.hashes, grams[at], "left")
            n = np.searchsorted(self.hashes, grams[at], "right") - low
            at, low, n = at[n > 0], low[n > 0], n[n > 0]
            group = np.cumsum(n) // HITS
            for cut in np.split(np.arange(len(n)), np.flatnonzero(np.diff(group)) + 1):
                if len(cut):
                    m = n[cut]
                    entry = np.repeat(low[cut] - (np.cumsum(m) - m), m) + np.arange(m.sum())
                    yield self.item[entry], np.repeat(at[cut], m) + start - self.place[entry]

    def regions(self, chars: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, lowest diagonal, highest diagonal) of bands that reach the lemma's bound."""
        pairs, counts = np.zeros((2, 0), dtype=np.int64), np.zeros(0, dtype=np.int64)
        for item, diagonal in self._hits(chars):
            # Each hit counts in two bands: the one that begins at its step, and the one before.
            cell = np.floor_divide(diagonal, self.budgets[item] + 1)
            new, n = _counted(np.r_[item, item], np.r_[cell, cell - 1])
            pairs, counts = _counted(*np.c_[pairs, new], np.r_[counts, n])
        for k in np.flatnonzero(counts >= self.bounds[pairs[0]]):
            i, c = int(pairs[0, k]), int(pairs[1, k])
            width = int(self.budgets[i]) + 1
            yield i, c * width, (c + 2) * width - 1

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, begin, end, edits) of verified regions; of overlapping ones of an item, the best."""
        chars = codes(text)
        found: set[tuple[int, int, int, int]] = set()  # (item, edits, begin, end)
        for i, low, high in self.regions(chars):
            _, item, plain = self.items[i]
            k = int(self.budgets[i])
            begin, end = max(0, low - k), min(len(chars), high + k + len(item))
            exact = text.find(plain, begin, end)
            if exact >= 0:
                found.add((i, 0, exact, exact + len(item)))
            elif best := aligned(item, chars[begin:end], low - begin, high - begin, k):
                found.add((i, best[0], best[1] + begin, best[2] + begin))
        kept: list[tuple[int, int, int, int]] = []
        for i, edits, begin, end in sorted(found):
            if not any(i == j and begin < z and a < end for j, _, a, z in kept):
                kept.append((i, edits, begin, end))
        return [(self.items[i][0], begin, end, edits) for i, edits, begin, end in kept]


def _counted(item: np.ndarray, cell: np.ndarray,
             n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The different (item, cell), and how often each occurs, or the sum of its `n`."""
    order = np.lexsort((cell, item))
    i, c = item[order], cell[order]
    starts = np.flatnonzero(np.r_[np.ones(len(i[:1]), bool), (i[1:] != i[:-1]) | (c[1:] != c[:-1])])
    sums = np.diff(np.r_[starts, len(i)]) if n is None or not len(i) else np.add.reduceat(n[order], starts)
    return np.stack([i[starts], c[starts]]), sums


def aligned(item: np.ndarray, text: np.ndarray, low: int, high: int,
            k: int) -> tuple[int, int, int] | None:
    """(edits, begin, end) of the best alignment of the whole item inside `text`, or None above k.

    Only diagonals from low - k to high + k are filled in, row after row.
    """
    first, width = low - k, high - low + 2 * k + 1
    far = np.int64(1 << 30)
    place = first + np.arange(width)  # number of text characters used before item character 0
    cost = np.where((place >= 0) & (place <= len(text)), 0, far)
    origin = place.copy()
    steps = np.arange(width)
    for row in range(1, len(item) + 1):
        used = place + row
        valid = (used >= 0) & (used <= len(text))
        inside = (used >= 1) & (used <= len(text))
        same = np.zeros(width, dtype=bool)
        same[inside] = text[used[inside] - 1] == item[row - 1]
        match = np.where(inside, cost + ~same, far)
        skip = np.r_[cost[1:], far] + 1  # the item's character has no partner
        better = skip < match
        new = np.where(better, skip, match)
        start = np.where(better, np.r_[origin[1:], 0], origin)
        new = np.where(valid, new, far)
        # Text characters without partner: the best cell to the left, one edit a step.
        lead = np.minimum.accumulate((new - steps) * width + steps)
        left, from_ = lead // width + steps, lead % width
        take = valid & (left < new)
        cost = np.where(take, left, new)
        origin = np.where(take, start[from_], start)
    best = int(np.argmin(cost))
    if cost[best] > k:
        return None
    return int(cost[best]), int(origin[best]), int(place[best] + len(item))


def _blocks(benchmark: DataFrame, q: int, size: int) -> Iterator[list[tuple]]:
    """The items in blocks of about `size` characters, each small enough for the driver and a task.

    The number of blocks follows the table; no more than one block is in memory at a time.
    """
    items = benchmark.filter(F.length("text") >= q).select("item_id", "text")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // size) if total else 0
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        yield [(r.item_id, t) for r in rows if len(t := normal(r.text)) >= q]


def _matched(documents: DataFrame, block: list[tuple], q: int, edits: float, item_type: DataType) -> DataFrame:
    """The columns of `documents` but the text, and (item_id, begin, end, edits) of each region found."""
    arrow_type = to_arrow_type(item_type)
    shared = documents.sparkSession.sparkContext.broadcast(block)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Block(shared.value, q, edits)
        for batch in pieces(batches):
            rows = [(k, *m) for k, t in enumerate(batch.column("text").to_pylist()) if t
                    for m in index.matches(normal(t))]
            if rows:
                at, item, begin, end, off = zip(*rows)
                yield pa.RecordBatch.from_pydict({
                    **{c: batch.column(c).take(pa.array(at)) for c in batch.schema.names if c != "text"},
                    "item_id": pa.array(item, arrow_type), "begin": pa.array(begin, pa.int64()),
                    "end": pa.array(end, pa.int64()), "edits": pa.array(off, pa.int64())})

    schema = StructType([f for f in documents.schema if f.name != "text"]).add("item_id", item_type)
    for name in ("begin", "end", "edits"):
        schema = schema.add(name, LongType())
    return map_batches(documents, scan, schema)


def contaminated(documents: DataFrame, benchmark: DataFrame, q: int = Q, edits: float = EDITS,
                 block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, begin, end, edits): the regions of texts that repeat a benchmark item.

    Texts and items are compared in lower case with white space runs as one blank; begin and end
    count characters of the text in that form. A region counts when the whole item fits it with
    at most `edits` of the item's characters changed, lost or added (never more than the lemma
    allows for `q`). Items of fewer than `q` characters, empty or null ones are too short to be told
    from ordinary language and match nothing. Null and empty texts have no rows; repeated documents
    have theirs each; repeated items too. An item's repeats in a text are told apart by place.
    Without items the result is empty. Ids may be of any type. Texts of any
    length are scanned whole; of equal alignments the one that ends first counts. Other columns are not read.
    """
    rows, kind = documents.select("doc_id", "text"), benchmark.schema["item_id"].dataType
    found = [_matched(rows, items, q, edits, kind) for items in _blocks(benchmark, q, block)]
    if not found:
        found = [_matched(rows.limit(0), [], q, edits, kind)]
    return reduce(DataFrame.unionByName, found)


def clean(documents: DataFrame, benchmark: DataFrame, q: int = Q, edits: float = EDITS,
          block: int = BLOCK) -> DataFrame:
    """The documents in which no benchmark item is found, all columns.

    Rows are told by (doc_id, hash of the text): every copy of a contaminated row goes. The texts
    are read once for the search and once more here; only keys of contaminated rows move. Columns of
    any name are kept as they are.
    """
    keyed = documents.select("doc_id", F.xxhash64("text").alias("th"), "text")
    kind = benchmark.schema["item_id"].dataType
    found = [_matched(keyed, items, q, edits, kind) for items in _blocks(benchmark, q, block)]
    if not found:
        return documents
    gone = written(reduce(DataFrame.unionByName, found).select("doc_id", "th").distinct(), "leaks")
    return without_rows(documents, gone)
