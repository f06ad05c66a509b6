"""Text helpers as column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """Drop leading and trailing Unicode white space (trim() would only drop blanks)."""
    return F.regexp_replace(text, rf"(?U)^{BLANK}+|{BLANK}+\z", "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a costly value to a name: `body` may use it many times, it is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def or_default(text: Column, default: str) -> Column:
    """`default` when the text is missing or empty."""
    return F.when(or_empty(text) == "", F.lit(default)).otherwise(text)


def contains_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words], F.lit(False))


def ends_with_any(text: Column, suffixes: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.endswith(s) for s in suffixes], F.lit(False))


def once(df: DataFrame, **exprs: Column) -> DataFrame:
    """Add costly columns so that each is computed exactly once per row.

    A plain projection would be inlined into every filter pushed below it, and the whole
    expression would run again there. A one-element generator is not inlined.
    """
    made = F.struct(*[expr.alias(name) for name, expr in exprs.items()])
    return df.select("*", F.inline(F.array(made)))
