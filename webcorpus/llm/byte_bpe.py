"""Byte-level BPE: merges replayed over all words of a block of texts at once, and decoding.

A task cuts its texts into words, sets the words it has not met side by side, and replays the merges
over all of them together: an index leads from each rank to the places whose token pair it joins,
ranks are applied in order, and an applied merge looks at its two neighbours only. Texts stay where
they are: no shuffle, and a lost task is simply run again.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import cache
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import map_batches

# Bytes of new words that one replay takes (a longer word alone is one replay).
BLOCK = 1 << 21
# Characters of texts whose new words are replayed together (a longer text alone is one block).
TEXTS = 1 << 23
# Words whose ids a task keeps from one block of texts to the next.
KEPT = 3 << 17
# Words of a text that are numbered together, and places of a rank that are worth whole arrays.
RUN, WIDE = 1 << 16, 48
NONE = np.iinfo(np.int32).max


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: a token in base64 and its rank on every line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@cache
def _class(name: str) -> list[tuple[int, int]]:
    """Ranges of the code points of a character class, as the tokenizer library's own patterns read it.

    Python's tables follow another version of Unicode, so new letters would be cut differently.
    """
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    probe = tiktoken.Encoding("class", pat_str=name, special_tokens={},
                              mergeable_ranks={bytes([b]): b for b in range(256)})
    codes = np.array([ord(c) for c in bytes(probe.encode_ordinary(every)).decode()])
    breaks = np.flatnonzero(np.diff(codes) != 1)
    return list(zip(codes[np.append(0, breaks + 1)].tolist(), codes[np.append(breaks, -1)].tolist()))


def _spelled(pattern: str, last: int) -> re.Pattern:
    """`pattern` with \\p{..}, \\s and \\S as ranges of the code points up to `last`."""
    made, inside = [], False
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.S):
        if part.startswith((r"\p", r"\s", r"\S")):
            ranges = "".join(f"\\U{a:08x}-\\U{min(b, last):08x}"
                             for a, b in _class(part.replace("S", "s")) if a <= last)
            if inside and part == r"\S":
                raise ValueError(r"\S inside a class")
            part = ranges if inside else f"[{'^' * (part == chr(92) + 'S')}{ranges}]"
        elif part in "[]":
            inside = part == "["
        made.append(part)
    return re.compile("".join(made))


class Merges:
    """The merges of a vocabulary: which rank joins a pair of tokens."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks, self.size = ranks, max(ranks.values()) + 1
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left * self.size + right] = rank
        self.keys = np.array(sorted(self.pairs), dtype=np.int64)
        self.values = np.array([self.pairs[k] for k in self.keys.tolist()], dtype=np.int32)

    def joined(self, left: np.ndarray | int, right: np.ndarray) -> np.ndarray:
        """Rank that joins each pair of tokens, NONE where there is none."""
        if not len(self.keys):
            return np.full(len(right), NONE, dtype=np.int32)
        wanted = np.int64(self.size) * left + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.values[at], NONE)

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Token ids of each of the words, which are not empty, as bytes of 32-bit integers."""
        return _Replay(self, words).run()


class _Replay:
    """Merges over words set side by side.

    An index holds, for every rank, the places of the pairs that it joins. The lowest rank is applied to
    its places from left to right; a place that has changed since is passed over, and a merge looks
    at the two pairs it makes. Should one of these have a lower rank, it comes first: the word's
    further places go back to the index.
    """

    def __init__(self, merges: Merges, words: list[bytes]) -> None:
        self.merges = merges
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        total = int(self.starts[-1])
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        # The same memory as arrays for single places and for many.
        self.ids = array("i", merges.of_byte[data].tobytes())
        self.after = array("i", np.arange(1, total + 1, dtype=np.int32).tobytes())
        self.before = array("i", np.arange(-1, total - 1, dtype=np.int32).tobytes())
        self.all_ids, self.all_after, self.all_before = (
            np.frombuffer(x, dtype=np.int32) for x in (self.ids, self.after, self.before))
        self.all_after[self.starts[1:] - 1] = -1
        self.all_before[self.starts[:-1]] = -1
        self.word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        self.index: dict[int, array] = {}
        self.heap: list[int] = []

    def _list(self, ranks: np.ndarray, places: np.ndarray) -> None:
        """Put places under the ranks that join their pairs."""
        some = ranks != NONE
        ranks, places = ranks[some], places[some]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, held = ranks[order], memoryview(places[order].astype(np.int32).tobytes())
        cuts = [0, *(np.flatnonzero(np.diff(ranks)) + 1).tolist(), len(ranks)]
        for rank, a, b in zip(ranks[cuts[:-1]].tolist(), cuts, cuts[1:]):
            if rank not in self.index:
                self.index[rank] = array("i")
                heappush(self.heap, rank)
            self.index[rank].frombytes(held[4 * a:4 * b])

    def _apply_all(self, rank: int, places: np.ndarray) -> list[int]:
        """Apply a rank to many places at once; returns those whose words need one step at a time."""
        ids, after, before = self.all_ids, self.all_after, self.all_before
        following = after[places]
        good = (ids[places] >= 0) & (following >= 0)
        places, following = places[good], following[good]
        good = self.merges.joined(ids[places], ids[following]) == rank
        places, following = places[good], following[good]
        beyond, prior = after[following], before[places]
        right = np.where(beyond >= 0, self.merges.joined(rank, ids[beyond]), NONE)
        left = np.where(prior >= 0, self.merges.joined(ids[prior], np.int64(rank)), NONE)
        careful = (right < rank) | (left < rank)
        near = (following[:-1] == places[1:]) | (beyond[:-1] == places[1:])
        careful[1:] |= near
        careful[:-1] |= near
        apart: list[int] = []
        if careful.any():
            held = np.isin(self.word[places], self.word[places[careful]])
            apart, free = places[held].tolist(), ~held
            places, following, beyond, prior = places[free], following[free], beyond[free], prior[free]
            right, left = right[free], left[free]
        ids[places], ids[following], after[places] = rank, -1, beyond
        inner = beyond >= 0
        before[beyond[inner]] = places[inner]
        self._list(np.concatenate([right, left]), np.concatenate([places, prior]))
        return apart

    def _apply(self, rank: int, places: list[int]) -> None:
        """Apply a rank to places in ascending order, one at a time."""
        ids, after, before, pairs, size = self.ids, self.after, self.before, self.merges.pairs, self.merges.size
        held = 0
        for place in places:
            following = after[place]
            if (ids[place] < 0 or following < 0
                    or pairs.get(ids[place] * size + ids[following]) != rank):
                continue
            if place < held:
                self._wait(rank, place)
                continue
            ids[place], ids[following] = rank, -1
            beyond = after[place] = after[following]
            touched = []
            if beyond >= 0:
                before[beyond] = place
                touched.append((place, rank * size + ids[beyond]))
            if before[place] >= 0:
                touched.append((before[place], ids[before[place]] * size + rank))
            for at, pair in touched:
                made = pairs.get(pair)
                if made is not None:
                    self._wait(made, at)
                    if made < rank:
                        held = int(self.starts[self.word[place] + 1])

    def _wait(self, rank: int, place: int) -> None:
        if rank not in self.index:
            self.index[rank] = array("i")
            heappush(self.heap, rank)
        self.index[rank].append(place)

    def run(self) -> list[bytes]:
        first = np.flatnonzero(self.all_after >= 0)
        self._list(self.merges.joined(self.all_ids[first], self.all_ids[first + 1]), first)
        while self.heap:
            rank = heappop(self.heap)
            places = self.index.pop(rank)
            if len(places) >= WIDE:
                self._apply(rank, self._apply_all(rank, np.unique(np.frombuffer(places, dtype=np.int32))))
            else:
                self._apply(rank, sorted(places))
        kept = np.concatenate([[0], np.cumsum(self.all_ids >= 0)])[self.starts].tolist()
        ids = memoryview(self.all_ids[self.all_ids >= 0].tobytes())
        return [bytes(ids[4 * a:4 * b]) for a, b in zip(kept, kept[1:])]


class Encoder:
    """Ids of texts; keeps those of the words it has met, up to KEPT of them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.merges = Merges(ranks)
        self.patterns = [(chr(last), _spelled(pattern, last)) for last in (0x7F, 0xFFFF, 0x10FFFF)]
        self.number: dict[str, int] = {}
        self.ids: list[bytes] = []

    def _learn(self, words: list[str]) -> None:
        """Ids of words not met before, in the order of their numbers."""
        block: list[tuple[int, bytes]] = []
        held = 0
        for word in [*words, None]:
            coded = b"" if word is None else word.encode()
            if block and (word is None or held + len(coded) > BLOCK):
                for (k, _), made in zip(block, self.merges.replay([w for _, w in block])):
                    self.ids[k] = made
                block, held = [], 0
            if word is not None:
                whole = self.merges.ranks.get(coded)  # a word that is a token is this token
                self.ids.append(b"" if whole is None else np.int32(whole).tobytes())
                if whole is None:
                    block.append((len(self.ids) - 1, coded))
                    held += len(coded)

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes of 32-bit integers."""
        if len(self.number) > KEPT:
            self.number, self.ids = {}, []
        number, new, made = self.number, [], []
        for text in texts:
            highest = "" if text.isascii() else max(text)
            cut = next(p for last, p in self.patterns if highest <= last)  # few ranges match faster
            found = (m.group() for m in cut.finditer(text))
            numbers = array("i")
            while run := list(islice(found, RUN)):
                for word in set(run).difference(number):
                    number[word] = len(number)
                    new.append(word)
                numbers.extend(map(number.__getitem__, run))
            made.append(numbers)
        self._learn(new)
        return [b"".join(map(self.ids.__getitem__, numbers)) for numbers in made]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Rows and their texts, up to TEXTS characters together."""
    for batch in batches:
        start, texts, held = 0, [], 0
        for k, value in enumerate(batch.column("text")):
            text = value.as_py() or ""
            if held and held + len(text) > TEXTS:
                yield batch.slice(start, k - start), texts
                start, texts, held = k, [], 0
            texts.append(text)
            held += len(text)
        yield batch.slice(start), texts


@cache
def _encoder(path: str, pattern: str) -> Encoder:
    """One for each Python worker: later tasks find the words that earlier ones have met."""
    return Encoder(read_ranks(path), pattern)


def encode(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) for every row, repeated rows included.

    `path` names a rank file that every executor has; `pattern` cuts a text into words, each encoded
    separately, and what it does not match is left out. Special tokens are ordinary text here. A null
    or empty text has no ids; doc_id may be null or of any type; other columns are not read; no rows
    give no rows. Pairs of one rank in a word are joined from left to right. A text of any length is
    cut into words in runs, and a word of any length costs time in proportion to its length (times its
    logarithm) and some 30 bytes of memory for each of its own.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch, texts in _blocks(batches):
            ids = encoder(texts)
            ends = np.cumsum([0, *(len(i) // 4 for i in ids)], dtype=np.int32)
            values = pa.array(np.frombuffer(b"".join(ids), dtype=np.int32))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "ids": pa.ListArray.from_arrays(pa.array(ends), values)})

    kind = documents.schema["doc_id"].dataType.simpleString()
    return map_batches(documents.select("doc_id", "text"), task, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded binary): the bytes of the ids, which need not be whole characters.

    Null ids have no bytes; an id that is null or not in the vocabulary is an error. Native: the
    vocabulary, of fixed size, is an array of hexadecimal texts that is split once.
    """
    tokens = {rank: token.hex() for token, rank in read_ranks(path).items()}
    unknown = "-"
    listed = F.split(F.lit(" ".join(tokens.get(k, unknown) for k in range(max(tokens) + 1))), " ")
    hexed = F.transform(F.coalesce("ids", F.array().cast("array<int>")), lambda i: F.get(listed, i))
    wrong = F.raise_error(F.lit("an id that is not in the vocabulary"))
    whole = F.unhex(F.array_join(hexed, "", unknown))  # null for any text that is not hexadecimal
    return encoded.select("doc_id", "ids", F.coalesce(whole, wrong).alias("decoded"))
