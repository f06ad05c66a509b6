"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws a key -ln(u) / w with u from a hash of the document and w its quality weight;
the smallest keys of a source come first. A source whose target exceeds its size is taken whole
once, twice or three times; what is left of the target goes to the first keys, in words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import WORD, prefix_sums, word_count
from webcorpus.session import written

WEIGHTS = (5, 2, 1)
MOST = 3


def quality_weight(text: Column) -> Column:
    """Share of letters in the text, times share of lines that are not repeats; at least 0.05."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", "")) / F.length(text)
    lines = F.split(text, "\n")
    fresh = F.size(F.array_distinct(lines)) / F.size(lines)
    return F.coalesce(F.when(text != "", F.greatest(F.lit(0.05), letters * fresh)), F.lit(0.05))


def uniform(doc_id: Column, text: Column) -> Column:
    """A number in (0, 1) that depends on the document alone, so that reruns agree."""
    seen = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(" "),
                    F.coalesce(text, F.lit("")))
    drawn = F.conv(F.substring(F.md5(seen), 1, 13), 16, 10).cast("double")
    return (drawn + 0.5) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from stored (source, source_size), one row per source.

    Sources in code point order, null last, weigh `weights`, repeating, and share the whole size.
    No target exceeds `most` times its source's size; the excess goes to the others by weight.
    With L the level at which the shares min(weight * L, most * size) use up the total, sources by
    rising ratio most * size / weight reach their bound one after the other; L is the largest of
    the levels that the bounds of the sources before would leave.
    """
    ranked = prefix_sums(sizes, [], [F.col("source").isNull(), F.col("source")], "ranks",
                         rank=F.lit(1))
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = written(ranked.select(
        "source", "source_size",
        F.get(cycle, (F.col("rank") % len(weights)).cast("int")).cast("long").alias("weight")),
        "weighed")
    before = prefix_sums(weighed, [], [most * F.col("source_size") / F.col("weight")], "levels",
                         bound=most * F.col("source_size"), share=F.col("weight"))
    whole = weighed.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight"))
    size, weight = [whole.select(c).scalar() for c in ("size", "weight")]
    level = before.agg(F.max((size - F.col("bound")) / (weight - F.col("share"))).alias("l")).scalar()
    return weighed.select("source", "source_size", F.least(
        F.col("weight") * level, (most * F.col("source_size")).cast("double")).alias("target"))


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, epochs) for every row.

    `size` is the number of words (0 for a null text), `taken` how many words the mix takes, repeats
    counted: whole epochs of the source first, then the smallest keys until the target is used up,
    the last document in part. Targets are fractions, words are not: a source's taken words are
    its target rounded down. Empty texts are never taken. A null source is a source like others;
    rows with the same doc_id and text draw the same key. Other columns are not read.

    The texts are read once into a slim stored table. A source with a third of all rows is
    sorted by range over many tasks.
    """
    text = F.col("text")
    weight = quality_weight(text)
    slim = written(documents.select(
        "doc_id", "source", word_count(text).alias("size"),
        (-F.ln(uniform(F.col("doc_id"), text)) / weight).alias("_draw")), "draws")
    sizes = written(slim.groupBy("source").agg(F.sum("size").alias("source_size")), "sizes")
    aims = written(targets(sizes, weights, most), "targets")
    before = prefix_sums(slim, ["source"], [F.col("_draw"), F.col("doc_id"), F.col("size")],
                         "prefixes", before=F.col("size"))
    joined = before.alias("d").join(
        aims.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).select(
            "d.*", "t.source_size", "t.target")
    epochs = F.when(F.col("source_size") > 0,
                    F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.floor(F.col("target")) - F.col("epochs") * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    return (joined.withColumn("epochs", epochs).withColumn("rest", rest.cast("long"))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"),
                    "source", "epochs"))


SQL = rf"""
WITH slim AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ' ' || coalesce(text, '')), 1, 13))::BIGINT
              + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
         / coalesce(CASE WHEN text <> '' THEN greatest(0.05::DOUBLE,
             (length(regexp_replace(text, '[^\p{{L}}]+', '', 'g'))::DOUBLE / length(text))
             * (len(list_distinct(string_split(text, chr(10))))::DOUBLE
                / len(string_split(text, chr(10))))) END, 0.05::DOUBLE) AS draw
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS weight
  FROM slim GROUP BY source
), levels AS (
  SELECT max(((SELECT sum(source_size) FROM sizes)::BIGINT - bound)::DOUBLE
             / ((SELECT sum(weight) FROM sizes)::BIGINT - share)::DOUBLE) AS level
  FROM (SELECT coalesce(sum(3 * source_size) OVER w, 0)::BIGINT AS bound,
               coalesce(sum(weight) OVER w, 0)::BIGINT AS share
        FROM sizes WINDOW w AS (ORDER BY 3 * source_size / weight::DOUBLE, source
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
), targets AS (
  SELECT source, source_size,
         least(weight * level, (3 * source_size)::DOUBLE) AS target FROM sizes, levels
), ordered AS (
  SELECT d.*, t.source_size, t.target,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
         CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs
  FROM slim d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, source, epochs,
       (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - before)))::BIGINT
         AS taken
FROM ordered
"""
