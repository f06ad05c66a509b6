"""Quality rules on what a public tokenizer makes of a text.

Each text is measured by characters per token, share of byte-fallback tokens and entropy of its
tokens. Two kinds of bands reject: wide ones per script, fixed here, and narrow ones per language
and length that are read off all documents, as median and median deviation. Markup, tables, noise
and repetition leave the narrow bands, as their tokens are shorter and less varied than those of
prose of that length. Texts are encoded word by word: each different word of a batch once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from webcorpus.llm.common import map_batches, pieces
from webcorpus.session import written

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
# Accepted per script: least and most characters per token, most byte-fallback tokens in a hundred,
# least entropy as a share of what 512 tokens, or all if fewer, could have at most.
SCRIPT_BANDS = {
    "latin": (1.0, 9.0, 10.0, 0.40),
    "cyrillic": (0.8, 9.0, 10.0, 0.40),
    "greek": (0.6, 9.0, 20.0, 0.40),
    "cjk": (0.25, 4.0, 80.0, 0.35),
    "other": (0.2, 9.0, 95.0, 0.30),
}
# Accepted per language and length: deviations from the median, below and above.
CORPUS_BANDS = {"chars_per_token": (8.0, 8.0), "token_entropy": (4.0, 8.0)}
# Steps in which the corpus is counted, and fewest texts that make a band.
STEPS = {"chars_per_token": 0.002, "token_entropy": 0.005}
FEWEST = 50
# Least median deviation: many near copies of one text must not close the band on themselves.
LEAST_SPREAD = {"chars_per_token": 0.03, "token_entropy": 0.03}
# Code points that start and end the letters of a script.
_RANGES = {"latin": [(0x41, 0x5B), (0x61, 0x7B), (0xC0, 0x250), (0x1E00, 0x1F00)],
           "cyrillic": [(0x400, 0x530)], "greek": [(0x370, 0x400), (0x1F00, 0x2000)],
           "cjk": [(0x3040, 0x3100), (0x3400, 0xA000), (0xAC00, 0xD7B0), (0x20000, 0x32000)]}
SCRIPTS = [*_RANGES, "other"]
# Words whose tokens a worker keeps, and characters encoded at once.
KEPT = 1 << 18
BATCH = 1 << 22


def script_of(word: str) -> int:
    """Place in SCRIPTS of the first letter's script; -1 for a word without letters."""
    for char in word:
        if char.isalpha():
            code = ord(char)
            return next((k for k, spans in enumerate(_RANGES.values())
                         if any(a <= code < b for a, b in spans)), len(_RANGES))
    return -1


class Vocabulary:
    """A sentencepiece model with byte fallback; keeps the tokens of words it has met."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        self.is_byte = np.array([self.model.is_byte(k) for k in range(self.size)])
        self.known: dict[bytes, tuple] = {}

    def __call__(self, words: list[bytes]) -> list[tuple]:
        """(tokens, characters, symbols, script) of each word."""
        if len(self.known) > KEPT:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        plain = [w.decode() for w in new]
        for word, text, ids in zip(new, plain, self.model.encode(plain, num_threads=1)):
            self.known[word] = (np.array(ids, dtype=np.int32), len(text),
                                sum(map(text.count, SYMBOLS)), script_of(text))
        return [self.known[w] for w in words]


@cache
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _spread(groups: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Entropy in bits of the values of each of n groups."""
    order = np.lexsort((values, groups))
    g, v = groups[order], values[order]
    starts = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (v[1:] != v[:-1])])[:len(g)]
    counts = np.diff(np.r_[starts, len(g)]).astype(float)
    total = np.bincount(groups, minlength=n).astype(float)
    of = g[starts]
    share = counts / total[of]
    # Without any value bincount() gives whole numbers.
    return np.bincount(of, weights=-share * np.log2(share), minlength=n).astype(float)


def _repeated(groups: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
    """Words of each group inside a window of WINDOW words that the group has twice or more."""
    last = len(words) - WINDOW + 1
    if last <= 0:
        return np.zeros(n, dtype=np.int64)
    at = np.flatnonzero(groups[:last] == groups[WINDOW - 1:])
    ids = np.zeros(len(at), dtype=np.int64)
    for k in range(WINDOW):  # number the windows by their words, one word after the other
        _, ids = np.unique(ids * np.int64(words.max() + 1) + words[at + k], return_inverse=True)
    pair = groups[at] * np.int64(len(words) + 1) + ids
    _, inverse, counts = np.unique(pair, return_inverse=True, return_counts=True)
    covered = np.zeros(len(words), dtype=bool)
    for k in range(WINDOW):
        covered[at[counts[inverse] > 1] + k] = True
    return np.bincount(groups[covered], minlength=n)


def _duplicate_lines(text: str) -> int:
    seen: set[bytes] = set()
    n = 0
    for line in text.encode().split(b"\n"):
        if line.split(None, 1):
            n += line in seen
            seen.add(line)
    return n


def measure(texts: list[str], vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """All figures of some whole texts, by the names in FIGURES."""
    n = len(texts)
    split = [t.encode().split() for t in texts]
    n_words = np.array([len(ws) for ws in split], dtype=np.int64)
    places, different = pd.factorize(np.array([w for ws in split for w in ws], dtype=object))
    places = places.astype(np.int64)
    made = vocabulary(list(different))
    of = np.repeat(np.arange(n), n_words)

    def figure(k: int) -> np.ndarray:
        return np.array([m[k] for m in made], dtype=np.int64)

    def sums(per_word: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=per_word[places], minlength=n).astype(np.int64)

    lengths = np.array([len(m[0]) for m in made], dtype=np.int64)
    flat = np.concatenate([m[0] for m in made]) if made else np.zeros(0, dtype=np.int32)
    each = lengths[places]
    offset = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    tokens = flat[np.repeat((np.cumsum(lengths) - lengths)[places], each) + offset]
    token_of = np.repeat(of, each)
    n_tokens, word_chars = sums(lengths), sums(figure(1))
    some = np.maximum(n_tokens, 1)
    script = figure(3)[places]
    lettered = script >= 0
    votes = np.bincount(of[lettered] * len(SCRIPTS) + script[lettered],
                        minlength=n * len(SCRIPTS)).reshape(n, -1)
    script = np.where(votes.any(axis=1), votes.argmax(axis=1), len(SCRIPTS) - 1)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": sums(figure(2)),
        "n_dup_lines": np.array([_duplicate_lines(t) for t in texts], dtype=np.int64),
        "n_repeat_words": _repeated(of, places, n), "n_tokens": n_tokens,
        "chars_per_token": word_chars / some,
        "byte_percent": 100 * np.bincount(token_of[vocabulary.is_byte[tokens]], minlength=n) / some,
        "token_entropy": _spread(token_of, tokens, n),
        "script": np.array(SCRIPTS, dtype=object)[script],
    }


def _portions(texts: list[str]) -> Iterator[slice]:
    """Consecutive texts of about BATCH characters together; a longer text comes alone."""
    start = size = 0
    for k, text in enumerate(texts):
        if k > start and size + len(text) > BATCH:
            yield slice(start, k)
            start, size = k, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


FIGURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "n_tokens long, chars_per_token double, byte_percent double, token_entropy double, "
           "script string")


def figures(rows: DataFrame, path: str) -> DataFrame:
    """Add a struct `f` of FIGURES to rows that have a column `text`."""
    names = [c.split()[0] for c in FIGURES.split(", ")]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for batch in pieces(batches, 1024):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for part in _portions(texts):
                made = measure(texts[part], vocabulary)
                f = pa.StructArray.from_arrays([pa.array(made[k]) for k in names], names)
                own = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([*own.columns, f], [*own.schema.names, "f"])

    kinds = ", ".join(f"{c.name} {c.dataType.simpleString()}" for c in rows.schema)
    own = FIGURES.replace(" ", ":").replace(",:", ", ")
    return map_batches(rows, add, f"{kinds}, f struct<{own}>")


def _base_failed() -> Column:
    return (F.col("f.n_words") < MIN_WORDS) | (100 * F.col("f.n_repeat_words")
                                               > 20 * F.col("f.n_words"))


def _length_class() -> Column:
    return F.round(F.log2(F.greatest(F.col("f.n_tokens"), F.lit(1)))).cast("int")


def _median(counts: DataFrame, value: str, keys: list[str], out: str) -> DataFrame:
    """Per keys, the lowest value that half of the `n` documents do not exceed, and their number."""
    upto = W.partitionBy(*keys).orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    return (counts.withColumns({"_upto": F.sum("n").over(upto),
                                "_all": F.sum("n").over(W.partitionBy(*keys))})
            .filter(2 * F.col("_upto") >= F.col("_all"))
            .groupBy(*keys).agg(F.min(value).alias(out), F.max("_all").alias("documents")))


def corpus_bands(measured: DataFrame) -> DataFrame:
    """(kind, length, far_, lo_, hi_<figure>): accepted bands, read off all measured rows.

    Each different text of a kind counts once, however many copies it has. A length with fewer
    than FEWEST texts takes in the lengths next to it, as far as it needs; far_ says whether it went
    beyond the next ones. Kinds are languages, and each script over all its texts (`#` and its name).

    The texts are counted per step of a figure; only these counts, at most some thousand per kind
    and length, are ordered. Rows that fail the base rule say nothing about prose and are left out.
    """
    keys = ["kind", "length"]

    def both(rows: DataFrame, *columns: str) -> DataFrame:
        kinds = F.array(F.col("kind"), F.concat(F.lit("#"), F.col("script")))
        return rows.select(F.explode(kinds).alias("kind"), "length", *columns)

    texts = measured.filter(~_base_failed()).select(*keys, "th", F.col("f.script").alias("script"), *[
        F.round(F.col(f"f.{figure}") / step).cast("long").alias(figure)
        for figure, step in STEPS.items()]).distinct()
    texts = written(texts.groupBy(*keys, "script", *STEPS).agg(F.count("*").alias("n")), "texts")
    sizes = written(both(texts, "n").groupBy(*keys).agg(F.sum("n").alias("n")), "sizes")
    asked = both(measured.select(*keys, F.col("f.script").alias("script")).distinct()).distinct()
    distance = F.abs(F.col("length") - F.col("source"))
    upto = W.partitionBy(*keys).orderBy("away").rangeBetween(W.unboundedPreceding, -1)
    near = asked.join(sizes.withColumnRenamed("length", "source"), "kind").withColumn("away", distance)
    bands = None
    for figure, (below, above) in CORPUS_BANDS.items():
        step = STEPS[figure]
        # Entropy grows with the length: longer texts than the next length say nothing about it.
        usable = near.filter("source <= length + 1") if figure == "token_entropy" else near
        # A length is taken in while those nearer than it are too few.
        sources = written(usable.withColumn("_nearer", F.coalesce(F.sum("n").over(upto), F.lit(0)))
                          .filter(F.col("_nearer") < FEWEST).select(*keys, "source", "away"), "sources")
        counts = both(texts.withColumnRenamed(figure, "v"), "v", "n").withColumnRenamed("length", "source")
        counts = written(counts.join(sources, ["kind", "source"]).groupBy(*keys, "v")
                         .agg(F.sum("n").alias("n"), F.max("away").alias("away")), "counts")
        far = counts.groupBy(*keys).agg((F.max("away") > 1).alias(f"far_{figure}"))
        middle = _median(counts, "v", keys, "mid").filter(F.col("documents") >= FEWEST)
        away = F.abs(F.col("v") - F.col("mid"))
        off = counts.join(middle.select(*keys, "mid"), keys).withColumn("off", away).groupBy(*keys, "mid", "off").agg(F.sum("n").alias("n"))
        spread = _median(off, "off", [*keys, "mid"], "mad")
        # 1.4826 makes the median deviation that of a normal distribution.
        scale = 1.4826 * F.greatest(F.col("mad") * step, F.lit(LEAST_SPREAD[figure]))
        most = F.col("mid") * step + above * scale
        if figure == "token_entropy":
            most = F.when(F.col(f"far_{figure}"), F.lit(float("inf"))).otherwise(most)
        own = spread.join(far, keys).select(
            *keys, f"far_{figure}", (F.col("mid") * step - below * scale).alias(f"lo_{figure}"),
            most.alias(f"hi_{figure}"))
        bands = own if bands is None else bands.join(own, keys, "full")
    return written(bands, "bands")


def judged(rows: DataFrame, path: str, *dropped: str) -> DataFrame:
    """Rows (text, lang, ...) with figures `f`, `base_failed` and `kept`, without `dropped` columns.

    A language counts by its code in `lang`, or by the text's script where that is null. Languages
    with fewer than FEWEST texts of about a length are judged by the band of the text's script over
    all languages, then by the nearest lengths; only a script with fewer has no band but its wide one.
    """
    measured = written(figures(rows, path).withColumns({
        "kind": F.coalesce(F.col("lang"), F.col("f.script")), "length": _length_class(),
        "th": F.xxhash64("text")}).drop(*dropped), "figures")
    bands = corpus_bands(measured)
    general = bands.select(F.col("kind").alias("_script"), "length", *[
        F.col(c).alias(f"_{c}") for c in bands.columns[2:]])
    limits = F.create_map(*[x for script, band in SCRIPT_BANDS.items() for x in (
        F.lit(script), F.array(*[F.lit(float(b)) for b in band]))])
    limit = F.element_at(limits, F.col("f.script"))
    most = F.log2(F.least(F.greatest(F.col("f.n_tokens"), F.lit(2)), F.lit(512)).cast("double"))
    fits = (F.col("f.chars_per_token").between(limit[0], limit[1])
            & (F.col("f.byte_percent") <= limit[2])
            & (F.col("f.token_entropy") >= limit[3] * most))
    for figure in CORPUS_BANDS:
        low, high = [F.coalesce(*[F.when(~F.col(f"{of}far_{figure}"), F.col(f"{of}{side}_{figure}")) for of in ("", "_")],
                                f"{side}_{figure}", f"_{side}_{figure}") for side in ("lo", "hi")]
        fits &= F.coalesce(F.col(f"f.{figure}").between(low, high), F.lit(True))
    return (measured.withColumn("_script", F.concat(F.lit("#"), F.col("f.script")))
            .join(bands, ["kind", "length"], "left").join(general, ["_script", "length"], "left")
            .withColumn("base_failed", _base_failed()).withColumn("kept", ~F.col("base_failed") & fits))


def quality(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, the base figures, base_failed, kept, the tokenizer's figures) for every row.

    `path` names a sentencepiece model with byte fallback that every executor has. A null text
    counts as empty: no words, so it fails the base rule. Rows are judged by their text and
    language alone, so repeated rows and null ids are judged like others. Further columns are
    not read.
    """
    rows = judged(documents.select("doc_id", "text", "lang"), path, "text")
    return rows.select("doc_id", *[f"f.{c}" for c in ("n_words", "word_chars", "n_symbols",
                                                      "n_dup_lines", "n_repeat_words")],
                       "base_failed", "kept", "f.n_tokens", "f.chars_per_token",
                       "f.byte_percent", "f.token_entropy", "f.script")


def good(documents: DataFrame, path: str) -> DataFrame:
    """The rows of `documents` that `quality` keeps, with all their columns, whatever their names."""
    rows = documents.select("text", "lang", F.struct(*[
        F.col(f"`{c}`") for c in documents.columns if c != "text"]).alias("row"))
    return judged(rows, path).filter("kept").select(*[
        F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in documents.columns])
