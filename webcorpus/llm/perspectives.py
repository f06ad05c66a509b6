"""Chat formatting: every participant's view of a dialogue, with that speaker as the assistant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus.llm.common import prefix_sums
from webcorpus.session import written

# Roles that direct a dialogue without taking part: never the assistant, never named users.
NARRATORS = ("system",)
# Characters of a part: a long dialogue is cut, between turns, at multiples of this.
PART = 1 << 16
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _neutral(text: Column) -> Column:
    """Markers inside a text lose their bar, so that a turn cannot end early."""
    return F.replace(F.replace(text, F.lit(OPEN), F.lit("<im_start>")),
                     F.lit(CLOSE), F.lit("<im_end>"))


def _name(role: Column) -> Column:
    """A speaker's name inside a header: no blanks, no marker characters."""
    return F.regexp_replace(role, r"[\s<>|]+", "_")


def rotate(turns: DataFrame, narrators: tuple[str, ...] = NARRATORS, part: int = PART) -> DataFrame:
    """(conv_id, speaker, part, n_turns, n_own, first_turn, text, n_chars, masks), native throughout.

    One view for each participant (different non-null role but `narrators`) of a conversation.
    In a view, the speaker's turns are headed `assistant`, those of others `user name=<role>`,
    narrators' turns keep their role, and a null role is `user name=unknown`. `masks` lists
    begin:end of what the speaker is to learn, text and end marker of the own turns, counted in
    characters of `text`, separated by commas; '' if there are none in this part.

    Turns come by (turn, role, text), nulls last, so that ties have an order; repeated rows are
    repeated turns. A null text is empty. A conversation whose roles are all narrators or null has
    no view. Null conv_ids form a conversation. Other columns are not read.

    A dialogue of any length is cut into parts of about `part` characters, between turns; joined in
    order the parts are the whole dialogue. Offsets come from sums over ranges, so a conversation
    with a third of all rows is spread over tasks. A view for each participant repeats the dialogue
    that many times by nature; turns meet the list of their participants by one join.
    """
    rows = turns.select("conv_id", "turn", "role", _neutral(F.coalesce("text", F.lit(""))).alias("said"))
    people = written(
        rows.filter(F.col("role").isNotNull() & ~F.col("role").isin(*narrators))
        .select("conv_id", F.col("role").alias("speaker")).distinct(), "speakers")
    views = rows.alias("r").join(people.alias("p"), F.col("r.conv_id").eqNullSafe(F.col("p.conv_id"))) \
        .select("r.*", "p.speaker")
    own = F.col("role").eqNullSafe(F.col("speaker"))
    header = F.when(own, F.lit("assistant")).when(F.col("role").isin(*narrators), F.col("role")) \
        .otherwise(F.concat(F.lit("user name="), _name(F.coalesce("role", F.lit("unknown")))))
    head = F.concat(F.lit(OPEN), header, F.lit("\n"))
    segment = F.concat(F.col("head"), F.col("said"), F.lit(CLOSE + "\n"))
    shaped = views.withColumn("own", own).withColumn("head", head).select(
        "conv_id", "speaker", "turn", "role", "own", segment.alias("segment"),
        F.length("head").alias("from"), (F.length("head") + F.length("said") + len(CLOSE)).alias("to"))
    order = [F.col("turn").isNull(), F.col("turn"), F.col("role").isNull(), F.col("role"),
             F.col("segment")]
    placed = prefix_sums(shaped, ["conv_id", "speaker"], order, "turns",
                         start=F.length("segment"), rank=F.lit(1))
    piece = F.struct("rank", "start", "turn", "own", "from", "to", "segment")
    grouped = placed.groupBy("conv_id", "speaker", F.floor(F.col("start") / part).alias("part")) \
        .agg(F.sort_array(F.collect_list(piece)).alias("p"))
    first = F.col("p")[0]["start"]
    mine = F.filter("p", lambda x: x["own"])
    spans = F.transform(mine, lambda x: F.concat_ws(
        ":", (x["start"] - first + x["from"]).cast("string"),
        (x["start"] - first + x["to"]).cast("string")))
    text = F.array_join(F.transform("p", lambda x: x["segment"]), "")
    return grouped.select(
        "conv_id", "speaker", "part", F.size("p").cast("long").alias("n_turns"),
        F.size(mine).cast("long").alias("n_own"), F.col("p")[0]["turn"].alias("first_turn"),
        text.alias("text"), F.length(text).cast("long").alias("n_chars"),
        F.array_join(spans, ",").alias("masks"))


SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, role,
         replace(replace(coalesce(text, ''), '<|im_start|>', '<im_start>'), '<|im_end|>', '<im_end>') AS said
  FROM conversations
), people AS (
  SELECT DISTINCT conv_id, role AS speaker FROM rows WHERE role IS NOT NULL AND role <> 'system'
), shaped AS (
  SELECT r.*, speaker, role IS NOT DISTINCT FROM speaker AS own,
         '<|im_start|>' || CASE WHEN role IS NOT DISTINCT FROM speaker THEN 'assistant'
           WHEN role = 'system' THEN role
           ELSE 'user name=' || regexp_replace(coalesce(role, 'unknown'), '[\s<>|]+', '_', 'g') END
           || chr(10) AS head
  FROM rows r JOIN people p ON r.conv_id IS NOT DISTINCT FROM p.conv_id
), cut AS (
  SELECT *, head || said || '<|im_end|>' || chr(10) AS segment FROM shaped
), placed AS (
  SELECT *, coalesce(sum(length(segment)) OVER w, 0)::BIGINT AS start, row_number() OVER w2 AS rank
  FROM cut WINDOW
    w AS (PARTITION BY conv_id, speaker ORDER BY turn NULLS LAST, role NULLS LAST, segment
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    w2 AS (PARTITION BY conv_id, speaker ORDER BY turn NULLS LAST, role NULLS LAST, segment)
), parts AS (
  SELECT *, start // 65536 AS part,
         min(start) OVER (PARTITION BY conv_id, speaker, start // 65536) AS first
  FROM placed
)
SELECT conv_id, speaker, part, count(*) AS n_turns, count(*) FILTER (own) AS n_own,
       arg_min(turn, rank) AS first_turn,
       string_agg(segment, '' ORDER BY rank) AS text, sum(length(segment))::BIGINT AS n_chars,
       coalesce(string_agg((start - first + length(head)) || ':' ||
         (start - first + length(head) + length(said) + 10), ',' ORDER BY rank) FILTER (own), '') AS masks
FROM parts GROUP BY conv_id, speaker, part
"""
