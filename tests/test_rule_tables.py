"""Classification by tables of rules, against the expressions for lists of rules."""

from __future__ import annotations

import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from sharemill import DEFAULT_RULES, AsOf
from sharemill.functions.classify import bucket_code, classify
from sharemill.functions.periods import previous_iso_week, week_before
from sharemill.operators.rule_tables import bucket_by_table, classify_by_table, rules_met

NAMES = ["Star India", "star", "SONY", "Zee Entertainment", "ZEE x ENTERTAINMENT y", "Zeemedia", "Sun", "", None, "other", "100%", "a_b", "axb", "Star India"]


def rules_frame(spark, rules):
    return spark.createDataFrame([(at, *rule) for at, rule in enumerate(rules)], "position int, pattern string, label string")


@pytest.mark.parametrize("rules", [DEFAULT_RULES.network_labels, DEFAULT_RULES.genre_labels, (("%EE%", "e"), ("S_AR%", "s"), ("A\\_B", "escaped"), ("A_B", "any"), ("%", "rest")), ()])
def test_labels_equal_those_of_the_expression(spark, rules):
    rows = spark.createDataFrame([(n, name) for n, name in enumerate(NAMES)], "n int, name string")
    found = classify_by_table(rows, "name", rules_frame(spark, rules))
    assert sorted(map(str, found.collect())) == sorted(map(str, rows.withColumn("label", classify(F.col("name"), rules)).collect()))


def test_repeated_and_empty_rules(spark):
    rows = spark.createDataFrame([("abc",), ("x",)], "name string")
    rules = spark.createDataFrame([(3, "A%", "late"), (1, "A%", None), (0, None, "never"), (9, "X", "x")], "position int, pattern string, label string")
    # the first rule that matches has no label
    assert {tuple(r) for r in classify_by_table(rows, "name", rules).collect()} == {("abc", None), ("x", "x")}


def test_names_meet_few_of_many_rules_that_begin_alike(spark):
    """Ends tell rules apart that share their beginning: the rules a name meets don't grow with the rules there are."""
    names = [f"NAME#{n:05d}" for n in range(500)]
    met = {}
    for many in (50, 500):
        rules = [p for n in range(many) for p in (f"NAME#0%{n:03d}", f"N_ME#{n:05d}", f"NAME#{n:05d}%", f"%#{n:05d}")]
        found = rules_met(spark.createDataFrame([(n,) for n in names], "_name string"), rules_frame(spark, [(p, p) for p in rules]))
        met[many] = found.groupBy("_name").count().agg(F.max("count")).first()[0]
    assert met == {50: 4, 500: 4}


def test_many_rules_equal_a_plain_search(spark):
    """Patterns of all kinds that share beginnings, ends or both, next to a search through the rules in their order."""
    r = random.Random(3)
    wild = ["%", "_", "%%", "_%", "__", "\\%", "\\_", "\\\\", "A", "B", "AB", "É", "\n", "𝄞"]
    patterns = ["".join(r.choice(wild) for _ in range(r.randint(0, 6))) for _ in range(400)]
    names = ["".join(r.choice("abAB%_\\é\n𝄞") for _ in range(r.randint(0, 7))) for _ in range(600)]

    def regex(pattern):
        parts = re.findall(r"\\.|.", pattern, re.S)
        return re.compile("".join(".*" if p == "%" else "." if p == "_" else re.escape(p[-1]) for p in parts), re.S)

    for step in (1, 40):  # many rules, of which early ones match most names, and few
        rules = [(p, f"{at} {p}") for at, p in enumerate(patterns) if p.strip("%") and at % step == 0]
        ordered = [(regex(p), label) for p, label in rules]
        wanted = {(n, next((label for p, label in ordered if p.fullmatch(n.upper())), n)) for n in names}
        found = classify_by_table(spark.createDataFrame([(n,) for n in names], "name string"), "name", rules_frame(spark, rules))
        assert {tuple(x) for x in found.collect()} == wanted and len(wanted) == len(set(names))


def test_buckets_equal_those_of_the_expression(spark):
    members = [(code, name) for code, names in DEFAULT_RULES.buckets.items() for name in names] + [(99, "&TV"), (1, None)]
    rows = spark.createDataFrame([(name.lower(),) for _, name in members[:-1]] + [("none",), (None,)], "name string")
    found = bucket_by_table(rows, "name", spark.createDataFrame(members, "code int, name string"))
    assert sorted(map(str, found.collect())) == sorted(map(str, rows.withColumn("bucket", bucket_code(F.col("name"), DEFAULT_RULES.buckets)).collect()))


def test_facts_meet_no_pattern(spark):
    """The facts take part in one join, on equal names; no join compares all with all."""
    facts = spark.range(1000).select(F.concat(F.lit("name"), F.col("id") % 7).alias("name"))
    rules = spark.range(300).select(F.col("id").alias("position"), F.concat(F.lit("NAME"), F.col("id"), F.lit("%")).alias("pattern"), F.col("id").cast("string").alias("label"))
    text = classify_by_table(facts, "name", rules)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("NestedLoop|Cartesian", text) and text.count("LeftOuter") == 1


def test_weeks_of_days_equal_those_of_the_command_line(spark):
    days = [date(1998, 12, 20) + timedelta(days=n) for n in range(800)]
    (year, week), (before_year, before_week) = week_before(F.col("day")), previous_iso_week(F.col("day"))
    rows = spark.createDataFrame([(d,) for d in days], "day date").select("day", year, week, before_year, before_week).collect()
    for day, *found in rows:
        one, other = AsOf.week_before(day), AsOf.previous_iso_week(day)
        assert found == [one.year, one.week, other.year, other.week]
    assert any(r[2] == 0 for r in rows)
