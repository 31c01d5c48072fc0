"""Weekly feeds to clean facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharemill.asof import AsOf
from sharemill.functions.text import cast_long, numeric_text
from sharemill.operators.checks import rejected_numbers, with_unique_key
from sharemill.operators.dimensions import exclude_marker, exclude_zero
from sharemill.operators.enrich import enrich
from sharemill.settings import CleanSettings
from sharemill.sources.tables import period_slice


def clean_channel_facts(
    feed: DataFrame, master: DataFrame, asof: AsOf, settings: CleanSettings = CleanSettings()
) -> DataFrame:
    """One week of the channel feed, numbers parsed and master attributes attached (matched ignoring case).

    The slice tests the feed's own ``week_no``; the output's ``week_no`` is taken from ``week``.
    """
    facts = (
        period_slice(feed, asof)
        .transform(exclude_marker, "channel", ignore_case=settings.ignore_case)
        .select(
            "channel",
            cast_long(F.col("week"), settings.numbers).alias("week_no"),
            "targets",
            "regions",
            _number("rat%", settings).alias("grp"),
            _number("shr%", settings).alias("share_pct"),
            cast_long(F.col("year_of_week"), settings.numbers).alias("year_of_week"),
        )
    )
    return _enriched(facts, master, True, settings)


def clean_genre_facts(
    feed: DataFrame, master: DataFrame, settings: CleanSettings = CleanSettings(), asof: AsOf | None = None
) -> DataFrame:
    """The whole genre feed (``slice_genre`` cuts it to ``asof``), parsed and enriched on exact names."""
    if settings.slice_genre:
        if asof is None:
            raise ValueError("slice_genre needs an as-of period")
        feed = period_slice(feed, asof, week="week")
    facts = feed.transform(exclude_marker, "channel", ignore_case=settings.ignore_case)
    # Whether the job fails must not depend on where a filter runs, so no filter looks at a number that may raise:
    # a strict number is never NULL, and zeros are told by the lenient one.
    if settings.drop_zero:
        lenient = numeric_text(F.col("`shr%`"), "lenient", settings.python_numbers)
        facts = facts.where((lenient != 0) | (lenient.isNull() & F.lit(settings.numbers == "strict")))
    facts = facts.select(
        "channel",
        F.col("week").alias("week_no"),
        "regions",
        _number("shr%", settings).alias("share_pct"),
        cast_long(F.col("year_of_week"), settings.numbers).alias("year_of_week"),
    )
    if settings.numbers == "lenient" and not settings.drop_zero:
        facts = facts.transform(exclude_zero, "share_pct")
    return _enriched(facts, master, False, settings)


def rejected_rows(
    feed: DataFrame,
    texts: tuple[str, ...],
    settings: CleanSettings = CleanSettings(),
    asof: AsOf | None = None,
    week: str = "week_no",
) -> DataFrame:
    """Feed rows, of one period or of all, with a number the lenient mode turns into NULL."""
    if asof is not None:
        feed = period_slice(feed, asof, week=week)
    feed = feed.transform(exclude_marker, "channel", ignore_case=settings.ignore_case)
    return rejected_numbers(feed, texts, lambda text: numeric_text(text, "lenient", settings.python_numbers))


def _number(name: str, settings: CleanSettings) -> Column:
    return numeric_text(F.col(f"`{name}`"), settings.numbers, settings.python_numbers)


def _enriched(facts: DataFrame, master: DataFrame, ignore_case: bool, settings: CleanSettings) -> DataFrame:
    ignore_case = ignore_case or settings.normalise_key
    trim = settings.normalise_key
    if settings.unique_master:
        key = F.trim("channel") if trim else F.col("channel")
        master = with_unique_key(master, F.upper(key) if ignore_case else key)
    return enrich(facts, master, ignore_case=ignore_case, trim=trim)
