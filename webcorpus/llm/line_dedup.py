"""Line dedup by overlapping windows of three lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.functions.text import let, once
from webcorpus.session import written

WIDTH = 3
_BLANK = " \t\r\x0b\f"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _full(lines: Column) -> Column:
    """Places, from 0, of the lines that are not blank."""
    places = F.transform(lines, lambda line, i: F.when(F.trim(line, F.lit(_BLANK)) != "", i))
    return F.filter(places, lambda i: i.isNotNull())


def _windows(text: Column, short: bool) -> Column:
    """(at, h1, h2) of every three consecutive lines that are not blank; a 128-bit hash.

    Lines are compared without the white space around them. With `short`, the lines of a text that
    has one or two form a window; the hashes pass over lines that are not there.
    """
    def of(hashes: Column) -> Column:
        def window(i: Column) -> Column:
            three = [F.get(hashes, i + k) for k in range(WIDTH)]
            return F.struct(i.alias("at"),
                            F.xxhash64(*[x["a"] for x in three]).alias("h1"),
                            F.xxhash64(*[x["b"] for x in three]).alias("h2"))

        return F.transform(F.sequence(F.lit(0), F.greatest(F.size(hashes) - WIDTH, F.lit(0))), window)

    full = F.filter(F.transform(_lines(text), lambda x: F.trim(x, F.lit(_BLANK))), lambda x: x != "")
    hashed = F.transform(full, lambda x: F.struct(
        F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b")))
    return let(hashed, lambda h: F.when(F.size(h) >= (1 if short else WIDTH), of(h)))


def _without(text: Column, starts: Column) -> Column:
    """The text without the lines that the windows at `starts` (sorted, no repeats) cover."""
    def cut(lines: Column) -> Column:
        def with_full(full: Column) -> Column:
            def is_begin(x: Column, i: Column) -> Column:
                return (i == 0) | (x - F.get(starts, i - 1) > WIDTH)

            def is_end(x: Column, i: Column) -> Column:
                return (i == F.size(starts) - 1) | (F.get(starts, i + 1) - x > WIDTH)

            begins = F.transform(F.filter(starts, is_begin), lambda x: F.get(full, x))
            ends = F.transform(F.filter(starts, is_end),
                               lambda x: F.get(full, F.least(x + (WIDTH - 1), F.size(full) - 1)) + 1)
            spans = F.arrays_zip(F.concat(F.array(F.lit(0)), ends).alias("a"),
                                 F.concat(begins, F.array(F.size(lines))).alias("b"))
            kept = F.transform(spans, lambda s: F.slice(lines, s["a"] + 1, s["b"] - s["a"]))
            return F.array_join(F.flatten(kept), "\n")

        return let(_full(lines), with_full)

    return let(_lines(text), cut)


def line_dedup(documents: DataFrame, short: bool = False) -> DataFrame:
    """The documents without repeated passages, with `n_removed`, the number of windows found again.

    A window is three consecutive lines; blank lines are passed over. Of all windows with the same
    lines, in the order of (doc_id, hash of the text, place), the first stays; every line that a
    later one covers is removed, with blank lines in between. Some copy of each line always stays.

    Null texts stay as they are, and so do texts of fewer than three lines, unless `short` makes all
    lines of such a text one window. Rows without a doc_id come
    last in the order. Rows with the same doc_id and text are one document: they lose the same
    lines. A text may end up empty, one of any length is read whole, and no documents give none. All
    columns of `documents` are kept, `text` changed, but for one that is named `n_removed`.

    Hot windows are never gathered: counting them combines before the shuffle, and the join that
    finds their later places is between two stored tables, which adaptive execution can split.
    The texts meet their covered lines by a merge join at every size, which grows in proportion.
    """
    key = documents.select("doc_id", F.xxhash64("text").alias("th"), _windows(F.col("text"), short).alias("w"))
    places = key.select("doc_id", "th", F.inline("w"))
    repeated = written(places.groupBy("h1", "h2").agg(F.count("*").alias("n"))
                       .filter("n > 1").select("h1", "h2"), "repeated")
    again = written(places.join(repeated, ["h1", "h2"]).select("h1", "h2", F.struct(
        F.col("doc_id").isNull().alias("x"), "doc_id", "th", "at").alias("place")), "again")
    first = written(again.groupBy("h1", "h2").agg(F.min("place").alias("first")), "first")
    later = again.join(first, ["h1", "h2"]).filter(F.col("place") > F.col("first"))
    covered = written(later.select("place.doc_id", "place.th", "place.at").groupBy("doc_id", "th")
                      .agg(F.sort_array(F.collect_set("at")).alias("starts")), "covered")
    # The row is held as one value, so that no column's name can clash.
    held = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    joined = held.join(covered.hint("shuffle_merge"), F.col("row.doc_id").eqNullSafe(F.col("doc_id"))
                       & (F.xxhash64("row.text") == F.col("th")), "left")
    changed = once(joined.select("row", "starts"), changed=F.when(
        F.col("starts").isNull(), F.col("row.text")).otherwise(_without(F.col("row.text"), F.col("starts"))))
    return changed.select(
        *[(F.col("changed") if c == "text" else F.col("row")[c]).alias(c) for c in documents.columns if c != "n_removed"],
        F.coalesce(F.size("starts"), F.lit(0)).alias("n_removed"))


SQL = r"""
WITH split AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), placed AS (
  SELECT doc_id, text, lines,
         list_filter(range(len(lines)), lambda i: trim(lines[i + 1], chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) <> '') AS nonblank
  FROM split
), windows AS (
  SELECT doc_id, text, pos, trim(lines[nonblank[pos + 1] + 1], chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) || chr(10) ||
         trim(lines[nonblank[pos + 2] + 1], chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) || chr(10) ||
         trim(lines[nonblank[pos + 3] + 1], chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) AS w
  FROM (SELECT *, unnest(range(len(nonblank) - 2)) AS pos FROM placed WHERE len(nonblank) >= 3)
), ordered AS (
  SELECT doc_id, pos, w, min((doc_id, pos)) OVER (PARTITION BY w) AS first FROM windows
), covered AS (
  SELECT doc_id, list(DISTINCT pos) AS starts FROM ordered WHERE (doc_id, pos) > first GROUP BY doc_id
), removed AS (
  SELECT doc_id, list(DISTINCT p) AS gone FROM (
    SELECT p.doc_id, unnest(range(
      -- from the first covered line to the last one of each window, blank ones included
      CAST(p.nonblank[s + 1] AS BIGINT), CAST(p.nonblank[s + 3] AS BIGINT) + 1)) AS p
    FROM (SELECT doc_id, unnest(starts) AS s FROM covered) c JOIN placed p USING (doc_id)
  ) GROUP BY doc_id
)
SELECT p.doc_id, coalesce(len(c.starts), 0)::INTEGER AS n_removed,
       CASE WHEN r.gone IS NULL THEN p.text ELSE array_to_string(
         list_transform(list_filter(range(len(p.lines)), lambda i: NOT list_contains(r.gone, i)),
                        lambda i: p.lines[i + 1]), chr(10)) END AS text
FROM placed p LEFT JOIN covered c USING (doc_id) LEFT JOIN removed r USING (doc_id)
"""
