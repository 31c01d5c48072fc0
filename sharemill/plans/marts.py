"""The three share-and-rank marts over the accumulated clean facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharemill.asof import AsOf
from sharemill.functions.classify import bucket_code, classify, has_prefix, parent_override, rolled_up
from sharemill.functions.measures import fixed_point, null_to_zero, percent_of, truncate6
from sharemill.functions.periods import Windows, oldest_year, period_index
from sharemill.operators.aggregates import period_pivot, sum_by
from sharemill.operators.dimensions import (
    drop_any_null,
    filter_eq,
    keep_groups,
    keep_members,
    keep_prefixes,
    trim_dims,
)
from sharemill.operators.ranks import rank_few, rank_many
from sharemill.operators.totals import normalise_100, normalise_kept, total_few
from sharemill.rules import DEFAULT_RULES, Rules
from sharemill.settings import MartSettings

TRIMMED = ("network", "channel", "genre", "regions", "targets")
WEEK = ("year_of_week", "week_no")


def network_share(
    facts: DataFrame, asof: AsOf, rules: Rules = DEFAULT_RULES, settings: MartSettings = MartSettings()
) -> DataFrame:
    """Share and rank of the reported networks in one universe.

    Measures are averages of weekly sums. The groups are cut to the reported ones before ranking; that test
    only reads the group key, so Spark moves it below both aggregations to the scan side.
    """
    windows = Windows.at(asof, settings)
    weekly = (
        facts.transform(filter_eq, rules.universe, trimmed=True)
        .transform(trim_dims, TRIMMED)
        .transform(_needed, windows, settings)
        .transform(
            sum_by,
            [classify(_owner(rules), rules.network_labels).alias("network"), _period_if_needed(windows, settings)],
            "share_pct",
        )
    )
    return _network_mart(weekly, asof, rules, settings)


def network_sums(facts: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """What ``network_share`` needs of the facts of some weeks: sums by owner and week in the universe."""
    return (
        facts.transform(filter_eq, rules.universe, trimmed=True)
        .transform(trim_dims, TRIMMED)
        .transform(sum_by, [_owner(rules).alias("network"), *WEEK], "share_pct")
    )


def network_share_from_sums(
    sums: DataFrame, asof: AsOf, rules: Rules = DEFAULT_RULES, settings: MartSettings = MartSettings()
) -> DataFrame:
    """``network_share`` from the kept sums of all weeks; a week may be in several pieces."""
    windows = Windows.at(asof, settings)
    weekly = sums.transform(_needed, windows, settings).transform(
        sum_by,
        [classify(F.col("network"), rules.network_labels).alias("network"), _period_if_needed(windows, settings)],
        "share_pct",
    )
    return _network_mart(weekly, asof, rules, settings)


def _network_mart(weekly: DataFrame, asof: AsOf, rules: Rules, settings: MartSettings) -> DataFrame:
    windows = Windows.at(asof, settings)
    share = fixed_point(F.col("share_pct"), settings.overflow)
    ranked = (
        weekly.transform(
            period_pivot, ["network"], windows, ("mkt_share_cw", share), ("share_l4w", share), ("share_ytd", share)
        )
        .transform(keep_groups, "network", rules.kept_labels)
        # at most one row per spelling of the kept labels is left
        .transform(rank_few, "mkt_share_cw")
    )
    return ranked.select(
        "network",
        F.lit(asof.week).alias("week_no"),
        "rank",
        _cut("mkt_share_cw", settings),
        truncate6(null_to_zero(F.col("share_l4w")), settings.null_measures).alias("share_l4w"),
        _cut("share_ytd", settings),
    )


def genre_share(
    facts: DataFrame, asof: AsOf, rules: Rules = DEFAULT_RULES, settings: MartSettings = MartSettings()
) -> DataFrame:
    """Share and rank of the reported networks over all regions.

    The current week averages percentages of each region's total; the other two measures average plain sums
    and are then normalised to 100 over all networks, before the unreported ones are dropped.
    """
    windows = Windows.at(asof, settings)
    sums = (
        facts.transform(trim_dims, TRIMMED)
        .transform(_needed, windows, settings)
        .transform(sum_by, ["regions", _owner(rules).alias("network"), _period(settings)], "share_pct")
    )
    return _genre_mart(sums, asof, rules, settings)


def genre_sums(facts: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """What ``genre_share`` needs of the facts of some weeks: sums by region, owner and week."""
    return facts.transform(trim_dims, TRIMMED).transform(
        sum_by, ["regions", _owner(rules).alias("network"), *WEEK], "share_pct"
    )


def genre_share_from_sums(
    sums: DataFrame, asof: AsOf, rules: Rules = DEFAULT_RULES, settings: MartSettings = MartSettings()
) -> DataFrame:
    """``genre_share`` from the kept sums of all weeks; a week may be in several pieces."""
    weekly = sums.transform(_needed, Windows.at(asof, settings), settings).transform(
        sum_by, ["regions", "network", _period(settings)], "share_pct"
    )
    return _genre_mart(weekly, asof, rules, settings)


def _genre_mart(sums: DataFrame, asof: AsOf, rules: Rules, settings: MartSettings) -> DataFrame:
    windows = Windows.at(asof, settings)
    shares = (
        # rows without a network count in the total and are dropped after it; a region's week has a row for each network
        sums.transform(total_few, ["regions", "period"], "share_pct", "total_pct")
        .transform(drop_any_null)
    )
    share = fixed_point(F.col("share_pct"), settings.overflow)
    of_total = fixed_point(percent_of(F.col("share_pct"), F.col("total_pct")), settings.overflow)
    pivoted = shares.transform(
        period_pivot,
        [classify(F.col("network"), rules.genre_labels).alias("network")],
        windows,
        ("mkt_share_cw", of_total),
        ("share_l4w", share),
        ("share_ytd", share),
    )
    # If every kept prefix belongs to a label, only the labels are left. Other rules may leave any number.
    if all(any(_covers(pattern, prefix) for pattern, _ in rules.genre_labels) for prefix in rules.kept_prefixes):
        reported = has_prefix(F.col("network"), rules.kept_prefixes)
        kept = pivoted.transform(normalise_kept, ["share_l4w", "share_ytd"], reported, settings.overflow)
        ranked = rank_few(kept, "mkt_share_cw")
    else:
        normalised = pivoted.transform(normalise_100, ["share_l4w", "share_ytd"], settings.overflow)
        ranked = normalised.transform(keep_prefixes, "network", rules.kept_prefixes).transform(rank_many, "mkt_share_cw")
    return ranked.select(
        "network", "rank", _cut("mkt_share_cw", settings), _cut("share_l4w", settings), _cut("share_ytd", settings)
    )


def channel_details(
    facts: DataFrame, asof: AsOf, rules: Rules = DEFAULT_RULES, settings: MartSettings = MartSettings()
) -> DataFrame:
    """Rating points of the listed channels per market and demography, ranked within their bucket.

    The rank looks at the current week before missing values become zero. ``update_date`` is the time of the
    run.
    """
    windows = Windows.at(asof, settings)
    weekly = (
        facts.transform(trim_dims, TRIMMED)
        .transform(keep_members, "channel", rules.members)
        .transform(_needed, windows, settings)
        .transform(
            sum_by,
            [
                "network",
                rolled_up(F.col("channel"), F.col("genre_fta_pay"), rules.roll_up).alias("channel"),
                F.col("genre_fta_pay").alias("genre"),
                F.col("regions").alias("market"),
                F.col("targets").alias("demography"),
                _period_if_needed(windows, settings),
            ],
            "grp",
        )
    )
    return _details_mart(weekly, asof, rules, settings)


def detail_sums(facts: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """What ``channel_details`` needs of the facts of some weeks: sums by its groups and week."""
    channel = rolled_up(F.col("channel"), F.col("genre_fta_pay"), rules.roll_up).alias("channel")
    places = [F.col("genre_fta_pay").alias("genre"), F.col("regions").alias("market"), F.col("targets").alias("demography")]
    return (
        facts.transform(trim_dims, TRIMMED)
        .transform(keep_members, "channel", rules.members)
        .transform(sum_by, ["network", channel, *places, *WEEK], "grp")
    )


def channel_details_from_sums(
    sums: DataFrame, asof: AsOf, rules: Rules = DEFAULT_RULES, settings: MartSettings = MartSettings()
) -> DataFrame:
    """``channel_details`` from the kept sums of all weeks; a week may be in several pieces."""
    windows = Windows.at(asof, settings)
    weekly = sums.transform(_needed, windows, settings).transform(
        sum_by,
        ["network", "channel", "genre", "market", "demography", _period_if_needed(windows, settings)],
        "grp",
    )
    return _details_mart(weekly, asof, rules, settings)


def _details_mart(weekly: DataFrame, asof: AsOf, rules: Rules, settings: MartSettings) -> DataFrame:
    windows = Windows.at(asof, settings)
    grp = F.col("grp")
    pivoted = weekly.transform(
        period_pivot,
        ["network", "channel", "genre", "market", "demography"],
        windows,
        ("grp", grp),
        ("grp_l4w", grp),
        ("grp_ytd", grp),
    ).withColumn("bucket", bucket_code(F.col("channel"), rules.buckets))
    # one row for each listed channel, network and genre in a market and demography: as many as the rules list channels,
    # times the networks and genres the master has for one
    ranked = rank_few(pivoted, "grp", ["bucket", "market", "demography"])

    def points(name: str) -> Column:
        # only a missing value becomes zero: a value without a fixed-point form (NaN) is still a NULL
        value = F.when(F.col(name).isNotNull(), fixed_point(F.col(name), settings.overflow)).otherwise(F.lit(0))
        return truncate6(value, settings.null_measures).alias(name)

    return ranked.select(
        "network",
        "channel",
        "genre",
        "market",
        "demography",
        "rank",
        F.lit(asof.week).alias("week_no"),
        F.current_timestamp().alias("update_date"),
        points("grp_ytd"),
        points("grp"),
        points("grp_l4w"),
    )


def _owner(rules: Rules) -> Column:
    return parent_override(F.col("network"), F.col("network1"), rules.parent)


def _period(settings: MartSettings) -> Column:
    year, week = F.col("year_of_week").cast("bigint"), F.col("week_no").cast("bigint")
    return period_index(year, week, settings.calendar).alias("period")


def _period_if_needed(windows: Windows, settings: MartSettings) -> Column:
    """NULL for all periods that no average looks at.

    A group's older history then shrinks to one row in the partial sums, however long it is; that row keeps the
    group in the result and is in none of its averages.
    """
    period = _period(settings)
    return F.when(windows.is_needed(period), period).alias("period")


def _needed(facts: DataFrame, windows: Windows, settings: MartSettings) -> DataFrame:
    if not settings.prune_history:
        return facts
    # the bound on the plain column follows from the exact test (weeks go up to 53) and can reach the scan
    oldest = oldest_year(min(windows.trailing_from, windows.current, windows.ytd_from), settings.calendar)
    if settings.year_folder is not None:
        facts = facts.where(F.col(settings.year_folder) >= oldest)
    return facts.where((F.col("year_of_week") >= oldest) & windows.is_needed(_period(settings)))


def _cut(name: str, settings: MartSettings) -> Column:
    return truncate6(F.col(name), settings.null_measures).alias(name)


def _covers(pattern: str, prefix: str) -> bool:
    """Whether every name starting with ``prefix`` matches the LIKE pattern."""
    stem = pattern.removesuffix("%")
    if stem == pattern or "%" in stem or len(stem) > len(prefix):
        return False
    return all(wanted in ("_", found) for wanted, found in zip(stem, prefix))
