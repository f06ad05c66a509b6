"""Token counts of whole texts; huge texts are encoded in overlapping chunks and spliced.

The tokenizer drops white space and never lets a token reach across it (its normaliser, special
tokens and pre-tokenizer all stop there), so a gap of ASCII white space is a boundary at which two
encodings of the same text may be joined, provided both of them show it.
"""

from __future__ import annotations

import os
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from webcorpus.llm.common import map_batches, pieces

# Characters of a chunk and of the first overlap; texts above one chunk are spliced.
CHUNK = 1 << 15
OVERLAP = 1 << 8
# Tokens that must agree on each side of a boundary before it is trusted.
AGREE = 4
# Words whose counts a task keeps.
KEPT = 1 << 20
GAP = " \t\n\x0b\f\r"


def load(path: str):
    """The tokenizer of a .json file, without truncation or padding, on the task's one core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _tokens(tokenizer, text: str, start: int, stop: int) -> list[tuple[int, int, int]]:
    """(begin, end, id) of the tokens of text[start:stop], with offsets into `text`."""
    made = tokenizer.encode(text[start:stop], add_special_tokens=False)
    return [(a + start, b + start, i) for (a, b), i in zip(made.offsets, made.ids)]


def _boundary(text: str, left: list, right: list, low: int, high: int) -> tuple[int, int] | None:
    """Where both encodings show the same gap inside [low, high): numbers of tokens before it.

    The AGREE tokens on each side of the gap are the same in both, in place and id.
    """
    at = {token: k for k, token in enumerate(right)}
    for i in range(bisect_left(left, (low,)), len(left) - AGREE + 1):
        if left[i][0] >= high:
            return None
        j = at.get(left[i])
        if (j is not None and i >= AGREE and j >= AGREE
                and text[left[i][0] - 1] in GAP and left[i - 1][1] < left[i][0]
                and left[i - AGREE:i + AGREE] == right[j - AGREE:j + AGREE]):
            return i, j
    return None


def count_spliced(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a huge text: chunks overlap, meet at a proven boundary, and overlap more if none is.

    An overlap widens to the left and to the right until a boundary is proven; in the worst case (a
    text without white space) it ends in one encoding of the whole text.
    """
    total, done = 0, 0  # tokens counted; characters they cover
    stop = min(len(text), chunk)
    left = _tokens(tokenizer, text, 0, stop)
    while stop < len(text):
        wide, low = overlap, stop
        while True:
            low = max(done, stop - wide)
            end = min(len(text), stop + max(chunk, wide))
            right = _tokens(tokenizer, text, low, end)
            met = _boundary(text, left, right, low, stop)
            if met or low == done:
                break
            wide *= 2
        if met:
            i, j = met
            total += i
            done = right[j][0]
            left, stop = right[j:], end
        else:  # nothing in all of the left chunk: encode it again, twice as long
            stop = min(len(text), stop + max(chunk, stop - done))
            left = _tokens(tokenizer, text, done, stop)
    return total + len(left)


class Counter:
    """Counts tokens of texts; keeps the counts of words it has met, up to KEPT of them."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> None:
        self.tokenizer, self.chunk, self.overlap = load(path), chunk, overlap
        self.known: dict[bytes, int] = {}

    def short(self, texts: list[str]) -> list[int]:
        """Texts up to a chunk: the sum over their words, as no token reaches across white space."""
        words = [t.encode().split() for t in texts]
        known = self.known
        if len(known) > KEPT:
            known.clear()
        new = list({w for ws in words for w in ws if w not in known})
        for k in range(0, len(new), 4096):
            part = new[k:k + 4096]
            made = self.tokenizer.encode_batch_fast([w.decode() for w in part],
                                                    add_special_tokens=False)
            known.update(zip(part, [len(e) for e in made]))
        return [sum(map(known.__getitem__, ws)) for ws in words]

    def __call__(self, texts: list[str]) -> list[int]:
        small = iter(self.short([t for t in texts if len(t) <= self.chunk]))
        return [next(small) if len(t) <= self.chunk
                else count_spliced(self.tokenizer, t, self.chunk, self.overlap) for t in texts]


@cache
def _counter(path: str, chunk: int, overlap: int) -> Counter:
    """One for each Python worker: later tasks find the words that earlier ones have met."""
    return Counter(path, chunk, overlap)


def token_counts(documents: DataFrame, path: str, limit: int = 2048, chunk: int = CHUNK,
                 overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row, repeated rows included.

    `path` names a tokenizer file that every executor has. A null text counts as empty: 0 bytes
    and 0 tokens. doc_id may be null or repeated; other columns are not read.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, chunk, overlap)
        for batch in pieces(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n = np.array(counter(texts), dtype=np.int64)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
                "n_tokens": pa.array(n), "over_limit": pa.array(n > limit)})

    kind = documents.schema["doc_id"].dataType.simpleString()
    return map_batches(documents.select("doc_id", "text"), count,
                       f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
