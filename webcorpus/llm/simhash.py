"""SimHash fingerprints and the components of fingerprints a few bits apart.

Multi-index hashing: a 64-bit fingerprint is cut into two segments of 32 bits. Two fingerprints at
2 or fewer differing bits differ by at most one bit in the first segment, or agree in the second.
So the table of first segments is asked for a ball of radius 1 (33 keys), the table of second
segments for the key itself; what is fetched is verified over all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import map_batches, pieces, without_rows
from webcorpus.llm.components import components
from webcorpus.session import written

SEED = 42
DISTANCE = 2
# A segment value with more distinct fingerprints than this is crowded.
CROWDED = 512
# How often each bit is set in a byte value.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little") \
    .astype(np.int64)


def fingerprint_of(text: str, width: int) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included; 0 without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) > width:
        shingles = map(b" ".join, zip(*[words[k:] for k in range(width)]))
    else:
        shingles = [b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8")
    bytes_of = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(bytes_of[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, th, fp) for every row; th is the text's hash, fp a signed long.

    Null and empty texts have fingerprint 0.
    """
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            fps = [fingerprint_of(t or "", width) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "th": batch.column("th"),
                "fp": pa.array(np.array(fps, dtype=np.uint64).view(np.int64))})

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", F.xxhash64("text").alias("th"), "text")
    return map_batches(rows, make, f"doc_id {kind}, th long, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _balls(bits: int, radius: int) -> list[int]:
    """Masks of at most `radius` bits among the lowest `bits`."""
    masks, last = [0], [(0, 0)]
    for _ in range(radius):
        last = [(m | 1 << b, b + 1) for m, low in last for b in range(low, bits)]
        masks += [m for m, _ in last]
    return masks


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(fps: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(a, b), a < b: all pairs of distinct fingerprints at 2 or fewer differing bits.

    `fps` is a stored table (fp) without repeats. A pair of which neither end lies in a crowded
    segment value is found by the segment tables, where a key then fetches `crowded` entries at
    most. The rest, pairs with an end in a crowded value, are found exactly and without comparing
    the members with each other: that end enumerates its whole ball (2,081 fingerprints), and
    each is looked up as it is.

    Catalyst does not know how many rows an explode makes, so it would broadcast the probes. They are
    merged, or stand on the left of a semi join, of which only the right side may be broadcast.
    """
    first, second = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(0xFFFFFFFF)
    segments = fps.select("fp", first.alias("s0"), second.alias("s1"))

    def many(segment: str) -> DataFrame:
        return written(segments.groupBy(segment).agg(F.count("*").alias("n"))
                       .filter(F.col("n") > crowded).select(segment), "crowded")

    marked = segments
    for segment in ("s0", "s1"):
        marked = marked.join(many(segment).withColumn(f"c_{segment}", F.lit(True)), segment, "left")
    marked = written(marked.select("fp", "s0", "s1", (
        F.col("c_s0").isNotNull() | F.col("c_s1").isNotNull()).alias("heavy")), "segments")
    light = marked.filter(~F.col("heavy"))
    near = (F.col("a") < F.col("b")) & (_distance(F.col("a"), F.col("b")) <= DISTANCE)

    table0 = light.select(F.col("fp").alias("b"), F.col("s0").alias("key"))
    ball = F.array(*[F.lit(m).cast("long") for m in _balls(32, 1)])
    probe0 = light.select(F.col("fp").alias("a"), "s0", F.explode(ball).alias("mask")) \
        .select("a", F.col("s0").bitwiseXOR(F.col("mask")).alias("key"))
    found0 = probe0.join(table0.hint("merge"), "key").filter(near).select("a", "b")

    table1 = light.select(F.col("fp").alias("b"), F.col("s1").alias("key"))
    probe1 = light.select(F.col("fp").alias("a"), F.col("s1").alias("key"))
    found1 = probe1.join(table1, "key").filter(near).select("a", "b")

    whole = F.array(*[F.lit(_signed(m)).cast("long") for m in _balls(64, DISTANCE)[1:]])
    asked = marked.filter("heavy").select(F.col("fp").alias("x"), F.explode(whole).alias("mask")) \
        .select("x", F.col("x").bitwiseXOR(F.col("mask")).alias("fp"))
    found = asked.join(marked.select("fp"), "fp", "left_semi").select(
        F.least("x", "fp").alias("a"), F.greatest("x", "fp").alias("b"))
    return found0.union(found1).union(found).distinct()


def simhash_components(documents: DataFrame, width: int = 3, crowded: int = CROWDED) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row, repeated rows included.

    Fingerprints link at 2 or fewer differing bits; component_id is the smallest doc_id that can
    be reached (null where no row of a component has a doc_id). Texts with the same fingerprint
    are one node, so thousands of copies cost one comparison. Null, empty and blank texts have
    fingerprint 0 and link like any other. Other columns are not read.
    """
    return _placed(written(fingerprints(documents, width), "fingerprints"), crowded).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _placed(rows: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """The stored rows (doc_id, fp, ...) with the component_id of their fingerprint."""
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "nodes")
    roots = components(links(nodes.select("fp"), crowded))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    placed = written(placed, "placed")
    ids = written(placed.groupBy("root").agg(F.min("low").alias("component_id")), "ids")
    of = written(placed.join(ids, "root").select("fp", "component_id"), "components")
    return rows.join(of, "fp")


def keep_one(documents: DataFrame, width: int = 3) -> DataFrame:
    """The documents without near-copies: of each component, the row of its smallest doc_id.

    Components are those of `simhash_components`. Rows without a doc_id stay only when their whole
    component has none, and then all of them do. Of repeated rows with the component's doc_id, each
    stays, as they are the same document. Rows are told by (doc_id, hash of the text): another text
    under the same or no doc_id is not touched. Texts of any length count whole, no documents give
    none, and columns of any name are kept as they are.
    """
    places = _placed(written(fingerprints(documents, width), "fingerprints"))
    gone = written(places.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
                   .select("doc_id", "th").distinct(), "copies")
    return without_rows(documents, gone)
