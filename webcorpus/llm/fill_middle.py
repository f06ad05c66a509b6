"""Fill-in-the-middle: a text is cut at two places and its middle moved to the end.

Cuts are given in units, a run of ASCII letters or any other single character. A text is held as
UTF-8 in blocks of a fixed number of bytes; two Fenwick trees count the units that begin in the
blocks and their code points. A descent finds the block of a cut, and only this block is read again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import map_batches, pieces

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Bytes of a block.
BLOCK = 1 << 12
# Texts of 100 that are cut, and of 100 cut texts those that put the suffix first.
CUT, SUFFIX_FIRST = 90, 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


class Fenwick:
    """Prefix sums of counts, and the place where they reach a number."""

    def __init__(self, counts: list[int]) -> None:
        self.tree = [0, *counts]
        for k in range(1, len(self.tree)):
            above = k + (k & -k)
            if above < len(self.tree):
                self.tree[above] += self.tree[k]

    def before(self, place: int) -> int:
        """Sum of the first `place` counts."""
        total = 0
        while place:
            total += self.tree[place]
            place &= place - 1
        return total

    def descend(self, number: int) -> tuple[int, int]:
        """The most counts whose sum is `number` or less, and what of `number` they leave."""
        place, step = 0, 1 << len(self.tree).bit_length()
        while step := step >> 1:
            if place + step < len(self.tree) and self.tree[place + step] <= number:
                place += step
                number -= self.tree[place]
        return place, number


class Units:
    """A text by its units: how many, and where a number of them ends."""

    def __init__(self, text: bytes, block: int = BLOCK) -> None:
        self.text, self.block = text, block
        units, points = [], []
        for k in range(-(-len(text) // block)):
            starts, firsts = self._marks(k)
            units.append(int(starts.sum()))
            points.append(int(firsts.sum()))
        self.units, self.points = Fenwick(units), Fenwick(points)
        self.count, self.blocks = sum(units), len(units)

    def _marks(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For each byte of block k: whether a unit begins there, and whether a code point does."""
        start = k * self.block
        held = np.frombuffer(self.text, dtype=np.uint8, offset=start,
                             count=min(self.block, len(self.text) - start))
        letter = _LETTER[held]
        follows = np.empty_like(letter)
        follows[1:] = letter[:-1]
        follows[0] = start > 0 and _LETTER[self.text[start - 1]]
        first = (held & 0xC0) != 0x80
        return first & ~(letter & follows), first

    def cut(self, units: int) -> tuple[int, int]:
        """(bytes, code points) of the first `units` units."""
        if units >= self.count:
            return len(self.text), self.points.before(self.blocks)
        k, left = self.units.descend(units)
        starts, firsts = self._marks(k)
        place = int(np.flatnonzero(starts)[left])
        return k * self.block + place, self.points.before(k) + int(firsts[:place].sum())


def _draws(key: str) -> list[int]:
    """The first four groups of eight hexadecimal digits of the key's SHA-256."""
    digest = hashlib.sha256(key.encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]


def transform(text: str | None, key: str, cut: int = CUT, suffix_first: int = SUFFIX_FIRST,
              block: int = BLOCK) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of prefix, of middle, output) of one text."""
    text = text or ""
    held = text.encode()
    units = Units(held, block)
    one, two, apply, order = _draws(key)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or apply % 100 >= cut:
        return units.count, "plain", None, None, text
    low, high = sorted((one % (units.count + 1), two % (units.count + 1)))
    (a, a_points), (b, b_points) = units.cut(low), units.cut(high)
    prefix, middle, suffix = held[:a].decode(), held[a:b].decode(), held[b:].decode()
    if order % 100 < suffix_first:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return units.count, form, a_points, b_points - a_points, output


def fill_in_middle(documents: DataFrame, seed: int = 1, cut: int = CUT,
                   suffix_first: int = SUFFIX_FIRST, block: int = BLOCK) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row, repeated rows included.

    n counts units. The draws of a document come from `seed` and its doc_id alone (a null doc_id
    counts as ''), so reruns and other partitions agree, and repeated rows with one id are cut alike
    where their texts are. An empty or null text, one that holds a marker and 100 - `cut` of 100
    others stay as they are: form plain, lengths null. Equal cuts give an empty middle. A text of any
    length is one row; beside the text and its output a task holds two numbers per block. Other
    columns are not read; no rows give no rows.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            keys = ["" if i is None else str(i) for i in batch.column("doc_id").to_pylist()]
            made = [transform(t, f"{seed}:{k}", cut, suffix_first, block)
                    for t, k in zip(batch.column("text").to_pylist(), keys)]
            n, form, prefix, middle, output = zip(*made) if made else ((),) * 5
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n": pa.array(n, pa.int64()),
                "form": pa.array(form, pa.string()), "prefix_chars": pa.array(prefix, pa.int64()),
                "middle_chars": pa.array(middle, pa.int64()), "output": pa.array(output, pa.string())})

    kind = documents.schema["doc_id"].dataType.simpleString()
    return map_batches(documents.select("doc_id", "text"), task, f"doc_id {kind}, n long, form string, "
                       "prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from; a cut text holds no marker and none overlaps another."""
    def between(opening: str, closing: str) -> Column:
        return F.substring_index(F.substring_index(output, closing, 1), opening, -1)

    middle = F.substring_index(output, MIDDLE, -1)
    return F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))) \
        .when(form == "spm", F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))) \
        .otherwise(output)


SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), drawn AS (
  SELECT *, len(units)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM cut
), placed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, array_to_string(units[1:low], '') AS prefix, array_to_string(units[low + 1:high], '') AS middle,
         array_to_string(units[high + 1:], '') AS suffix
  FROM placed
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
         WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
