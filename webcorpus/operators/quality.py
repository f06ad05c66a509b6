"""Ordered quality rules: the first rule an article breaks is the reason it is dropped."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcorpus import settings
from webcorpus.functions.text import contains_any, ends_with_any


@dataclass(frozen=True)
class QualityRules:
    """Word lists and limits of the built-in rules; `further` adds (reason, test) pairs after them."""

    min_chars: int = settings.QUALITY_MIN_CHARS
    title_words: list[str] = field(default_factory=lambda: settings.TITLE_WORDS)
    title_suffixes: list[str] = field(default_factory=lambda: settings.TITLE_SUFFIXES)
    nav_markers: list[str] = field(default_factory=lambda: settings.NAV_MARKERS)
    error_word: str = settings.ERROR_WORD
    further: list[tuple[str, Column]] = field(default_factory=list)

    def bad_title(self) -> Column:
        title = F.col("title")
        return contains_any(title, self.title_words) | ends_with_any(title, self.title_suffixes)

    def error_page(self) -> Column:
        return F.col("url").contains(self.error_word)

    def too_short(self) -> Column:
        return F.length("content_md") < self.min_chars

    def navigation(self) -> Column:
        return contains_any(F.col("content_md"), self.nav_markers)

    def ordered(self) -> list[tuple[str, Column]]:
        """(reason, test) in the order in which they are tried."""
        return [("title", self.bad_title()), ("error", self.error_page()),
                ("short", self.too_short()), ("nav", self.navigation()), *self.further]

    def reason(self) -> Column:
        return F.coalesce(*[F.when(test, F.lit(reason)) for reason, test in self.ordered()])


def tag_quality(articles: DataFrame, rules: QualityRules | None = None) -> DataFrame:
    """Add `drop_reason`; NULL for articles that pass."""
    return articles.withColumn("drop_reason", (rules or QualityRules()).reason())


def quality_filter(articles: DataFrame, rules: QualityRules | None = None) -> DataFrame:
    """Articles that break no rule."""
    broken = F.lit(False)
    for _, test in (rules or QualityRules()).ordered():
        broken = broken | test
    return articles.filter(~F.coalesce(broken, F.lit(False)))


def quality_drop_stats(articles: DataFrame, rules: QualityRules | None = None) -> DataFrame:
    """Number of dropped articles per reason."""
    return (tag_quality(articles, rules).filter(F.col("drop_reason").isNotNull())
            .groupBy("drop_reason").agg(F.count("*").alias("dropped")))
