"""Column expressions and period arithmetic on small literal inputs."""

from __future__ import annotations

import hashlib
import math
from datetime import date, timedelta
from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sharemill import DEFAULT_RULES, AsOf, MartSettings
from sharemill.functions import classify as names
from sharemill.functions import measures, text
from sharemill.functions.periods import Windows, index_of, oldest_year, period_index


def each(spark, values, kind, expression):
    """The expression's result for each value, in order."""
    rows = spark.createDataFrame([(i, value) for i, value in enumerate(values)], f"i int, c {kind}")
    return [row.result for row in rows.select("i", expression(F.col("c")).alias("result")).orderBy("i").collect()]


# --- numbers in text ---


def test_commas_are_stripped(spark):
    found = each(spark, ["1,234.50", "12,34,567", " 7 ", "-0.5", "1e3"], "string", text.numeric_text)
    assert found == [1234.5, 1234567.0, 7.0, -0.5, 1000.0]


def test_names_of_special_numbers(spark):
    found = each(spark, ["nan", "inf", "-inf"], "string", text.numeric_text)
    assert math.isnan(found[0]) and found[1:] == [math.inf, -math.inf]


@pytest.mark.parametrize("bad", [None, "", "abc", "1_000"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_numbers_fail_in_any_mode(spark, bad, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a number"):
            each(spark, ["1", bad], "string", text.numeric_text)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_lenient_numbers_become_null(spark):
    found = each(spark, [None, "", "abc", "1,0"], "string", lambda c: text.numeric_text(c, "lenient"))
    assert found == [None, None, None, 10.0]


def test_python_number_rules(spark):
    values = ["1_000", "12d", "1__0", "_1", "5.", ".5", "Infinity", "0x10", "1e5_0"]
    found = each(spark, values, "string", lambda c: text.numeric_text(c, "lenient", python_numbers=True))
    assert found == [1000.0, None, None, None, 5.0, 0.5, math.inf, None, 1e50]


def test_unknown_mode_is_refused():
    with pytest.raises(ValueError):
        text.numeric_text(F.lit("1"), "loose")


# --- names ---


def test_first_pattern_wins_and_others_stay(spark):
    values = ["Star India", "sony", "Viacom18", "SUN", "Zee Ent", "zee x entertainment y", "My Star", None, ""]
    found = each(spark, values, "string", lambda c: names.classify(c, DEFAULT_RULES.network_labels))
    assert found == ["Star", "Sony", "Viacom", "Sun", "Zee Ent", "Zee", "My Star", None, ""]


def test_wide_pattern_takes_more(spark):
    found = each(spark, ["Zee Ent", "zee"], "string", lambda c: names.classify(c, DEFAULT_RULES.genre_labels))
    assert found == ["Zee", "Zee"]


def test_no_rules_leave_names_alone(spark):
    assert each(spark, ["a"], "string", lambda c: names.classify(c, ())) == ["a"]
    assert each(spark, ["a"], "string", lambda c: names.bucket_code(c, {})) == [None]


def test_parent_override_needs_exact_case(spark):
    rows = spark.createDataFrame([("a", "Star"), ("b", "STAR"), ("c", None), (None, "Star")], "n string, p string")
    found = rows.select(names.parent_override(F.col("n"), F.col("p"), "Star").alias("r")).collect()
    assert [row.r for row in found] == ["Star", "b", "c", "Star"]


def test_sports_roll_up(spark):
    rows = spark.createDataFrame(
        [
            ("sony six(v)", "Sports"), ("EUROSPORT", "SPORTS"), ("1Sports", "sports"), ("DD SPORTS", "Sports"),
            ("NEO PRIME(NA)", "Sports"), ("Sony Six(V)", "Movies"), ("Sony Six(V)", None),
        ],
        "c string, g string",
    )
    found = rows.select(names.rolled_up(F.col("c"), F.col("g"), DEFAULT_RULES.roll_up).alias("r")).collect()
    assert [row.r for row in found] == [
        "Sony Sports", "Other Sports", "Other Sports", "Star Sports Channels", "Star Sports Channels", "Sony Six(V)",
        "Sony Six(V)",
    ]


def test_buckets(spark):
    values = ["&tv", "Dangal", "sony sports", "TOONAMI(NA)", "DD SPORTS", None]
    found = each(spark, values, "string", lambda c: names.bucket_code(c, DEFAULT_RULES.buckets))
    assert found == [1, 2, 7, 10, None, None]


def test_rule_lists_have_the_known_sizes():
    assert [len(members) for members in DEFAULT_RULES.buckets.values()] == [9, 7, 13, 12, 10, 8, 3, 8, 6, 13]
    assert len(DEFAULT_RULES.members) == len(set(DEFAULT_RULES.members)) == 103
    bucketed = {name for members in DEFAULT_RULES.buckets.values() for name in members}
    assert len(bucketed) == 89
    assert len(set(DEFAULT_RULES.members) - bucketed) == 17
    assert "1SPORTS" not in DEFAULT_RULES.members


def _digest(names) -> str:
    return hashlib.md5("\n".join(names).encode()).hexdigest()


def test_rules_are_the_agreed_ones():
    """Digests of every name and pattern: a changed one shows here, whatever else is built from the rules."""
    rules = DEFAULT_RULES
    assert _digest(sorted(rules.members)) == "d0682c28f4ac1cb6ce94f55651d3ccda"
    assert _digest(f"{code}:{name}" for code, names in sorted(rules.buckets.items()) for name in names) == (
        "4fdf8a948c51bd932d6e199ef53a0f73"
    )
    labels = [f"{pattern}>{label}" for pattern, label in (*rules.network_labels, *rules.genre_labels)]
    roll_up = [f"{label}:{name}" for label, names in rules.roll_up.labels for name in names]
    names = [rules.roll_up.genre, rules.roll_up.otherwise, rules.parent]
    universe = [f"{column}={value}" for column, value in rules.universe.items()]
    assert _digest([*labels, *rules.kept_labels, *rules.kept_prefixes, *roll_up, *names, *universe]) == (
        "c4fcee7252a8060d7fb04c3d017766e8"
    )


# --- measures ---


def test_truncation_goes_down(spark):
    values = [Decimal("1.2345678"), Decimal("-1.2345678"), Decimal("0.0000009"), None]
    found = each(spark, values, "decimal(18,7)", measures.truncate6)
    assert found == [1.234567, -1.234568, 0.0, None]


def test_null_measure_can_fail_the_job(spark):
    with pytest.raises(Exception, match="measure is NULL"):
        each(spark, [Decimal(1), None], "decimal(18,7)", lambda c: measures.truncate6(c, "fail"))


def test_fixed_point_rounds_half_up_and_drops_nan(spark):
    found = each(spark, [0.00000005, 1.0, float("nan"), None], "double", measures.fixed_point)
    assert found == [Decimal("0.0000001"), Decimal("1.0000000"), None, None]


def test_overflow(spark):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|out of range|cannot be represented"):
        each(spark, [1e12], "double", measures.fixed_point)
    assert each(spark, [1e12], "double", lambda c: measures.fixed_point(c, "null")) == [None]


def test_zero_total_gives_null(spark):
    rows = spark.createDataFrame([(5.0, 0.0), (5.0, 20.0), (None, 1.0)], "v double, t double")
    found = rows.select(measures.percent_of(F.col("v"), F.col("t")).alias("r")).collect()
    assert [row.r for row in found] == [None, 25.0, None]


# --- periods ---


def test_week_53_meets_week_1_of_the_next_year():
    assert index_of(1998, 53) == index_of(1999, 1) == 103949
    assert index_of(1999, 1, "iso") - index_of(1998, 53, "iso") == 1


@given(st.dates(min_value=date(1971, 1, 1), max_value=date(2099, 12, 31)))
def test_iso_index_counts_weeks(day):
    year, week, _ = day.isocalendar()
    later_year, later_week, _ = (day + timedelta(weeks=1)).isocalendar()
    assert index_of(later_year, later_week, "iso") == index_of(year, week, "iso") + 1


@given(st.integers(1971, 2099), st.integers(1, 53), st.sampled_from(["compat", "iso"]))
def test_oldest_year_loses_no_week(year, week, calendar):
    index = index_of(year, week, calendar)
    assert oldest_year(index, calendar) <= year


def test_column_and_number_agree(spark):
    weeks = [(1998, 53), (1999, 1), (2004, 53), (2020, 53), (2021, 1), (1970, 1), (2000, 0)]
    rows = spark.createDataFrame(weeks, "y long, w long")
    for calendar in ("compat", "iso"):
        found = rows.select(period_index(F.col("y"), F.col("w"), calendar).alias("r"))
        assert found.schema["r"].dataType.simpleString() == "int"
        assert [row.r for row in found.collect()] == [index_of(year, week, calendar) for year, week in weeks]


def test_windows():
    windows = Windows.at(AsOf(1999, 3))
    now = 52 * 1999 + 3
    assert windows == Windows(now, now - 4, now - 1, 52 * 1999 + 14, None)
    assert Windows.at(AsOf(1999, 20), MartSettings(ytd_upper="asof")).ytd_to == 52 * 1999 + 20
    with pytest.raises(ValueError):
        Windows.at(AsOf(1999, 3), MartSettings(ytd_upper="never"))


def test_as_of():
    assert str(AsOf.parse("1998-W5")) == "1998-W05"
    assert AsOf.week_before(date(2020, 1, 1)) == AsOf(2020, 0)
    assert AsOf.previous_iso_week(date(2021, 1, 4)) == AsOf(2020, 53)
    for bad in ("1998-40", "W40"):
        with pytest.raises(ValueError):
            AsOf.parse(bad)
    with pytest.raises(ValueError):
        AsOf(1998, 54)
