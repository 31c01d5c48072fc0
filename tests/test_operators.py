"""DataFrame steps on small literal inputs: nulls, ties, duplicates, hot groups."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sharemill.operators import checks, dimensions, ranks, totals
from sharemill.operators.aggregates import sum_by
from sharemill.operators.enrich import MASTER_ATTRIBUTES, enrich


def master(spark, *channels):
    rows = [(channel, *[f"{channel}-{name}" for name in MASTER_ATTRIBUTES]) for channel in channels]
    return spark.createDataFrame(rows, "channel string, " + ", ".join(f"{name} string" for name in MASTER_ATTRIBUTES))


def channels(spark, *names):
    return spark.createDataFrame([(name,) for name in names], "channel string")


def pairs(df, *columns):
    return Counter(tuple(row) for row in df.select(*columns).collect())


# --- names and filters ---


def test_trim_takes_spaces_only_and_skips_missing_columns(spark):
    found = dimensions.trim_dims(channels(spark, "  a ", "\tb "), ["channel", "targets"])
    assert pairs(found, "channel") == Counter([("a",), ("\tb",)])


def test_trim_finds_columns_in_any_case(spark):
    found = dimensions.trim_dims(channels(spark, " a").withColumnRenamed("channel", "Channel"), ["channel"])
    assert [tuple(row) for row in found.collect()] == [("a",)]


def test_marker_is_lower_case_only(spark):
    rows = channels(spark, "a(na)", "b(NA)", "c", None)
    assert pairs(dimensions.exclude_marker(rows, "channel"), "channel") == Counter([("b(NA)",), ("c",)])
    assert pairs(dimensions.exclude_marker(rows, "channel", ignore_case=True), "channel") == Counter([("c",)])


def test_zero_test_on_rendered_number_removes_nothing(spark):
    rows = spark.createDataFrame([(0.0,), (-0.0,), (1.0,), (None,)], "s double")
    assert dimensions.exclude_zero(rows, "s").count() == 3
    assert [row.s for row in dimensions.exclude_zero(rows, "s", drop_zero=True).collect()] == [1.0]


def test_filter_eq_trimmed_equals_trim_then_filter(spark):
    rows = channels(spark, " a", "a  ", "A", "ab", "a", None, "\ta")
    found = dimensions.filter_eq(rows, {"channel": "a"}, trimmed=True)
    assert pairs(found, "channel") == Counter([(" a",), ("a  ",), ("a",)])


def test_members_as_list_and_as_table(spark):
    rows = channels(spark, "a", "A", "b", None)
    table = spark.createDataFrame([("A",), ("A",)], "name string")
    expected = Counter([("a",), ("A",)])
    assert pairs(dimensions.keep_members(rows, "channel", ["A"]), "channel") == expected
    assert pairs(dimensions.keep_members(rows, "channel", table), "channel") == expected


def test_prefixes(spark):
    rows = channels(spark, "Zee x", "xzee", "SUN", None)
    assert pairs(dimensions.keep_prefixes(rows, "channel", ["ZEE", "SUN"]), "channel") == Counter([("Zee x",), ("SUN",)])


def test_drop_any_null_drops_nan_too(spark):
    rows = spark.createDataFrame([("a", 1.0), (None, 1.0), ("b", None), ("c", float("nan"))], "k string, v double")
    assert pairs(dimensions.drop_any_null(rows), "k") == Counter([("a",)]) == pairs(rows.na.drop(), "k")


# --- joins ---


def test_exact_join_keeps_unknown_and_null(spark):
    found = enrich(channels(spark, "a", "A", "x", None), master(spark, "a"))
    assert pairs(found, "channel", "network") == Counter([("a", "a-network"), ("A", None), ("x", None), (None, None)])
    assert found.columns == ["channel", *MASTER_ATTRIBUTES]


def test_case_insensitive_join_fans_out_and_does_not_trim(spark):
    found = enrich(channels(spark, "A", " a"), master(spark, "a", "A"), ignore_case=True)
    assert pairs(found, "channel", "network") == Counter([("A", "a-network"), ("A", "A-network"), (" a", None)])


def test_null_master_keys_never_match(spark):
    assert pairs(enrich(channels(spark, None), master(spark, None)), "network") == Counter([(None,)])


def test_hot_channel_joins_whole(spark):
    """A third of all facts share one key, and neither side may be broadcast."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 500)).alias("channel")
    )
    known = master(spark, "hot", *[f"c{i}" for i in range(0, 500, 2)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = enrich(rows, known).groupBy("network").count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_network = {row.network: row["count"] for row in found}
    assert by_network["hot-network"] == 10_000 and sum(by_network.values()) == 30_000


def test_unique_key_check(spark):
    rows = master(spark, "a", "A", None, None)
    assert checks.with_unique_key(rows, F.col("channel")).count() == 4
    with pytest.raises(Exception, match="duplicate master keys: 1"):
        checks.with_unique_key(rows, F.upper("channel")).collect()
    assert pairs(checks.duplicate_keys(rows, F.upper("channel")), "key", "n") == Counter([("A", 2)])


# --- checks ---


def test_schema_check(spark):
    rows = spark.createDataFrame([(1, "a", 2.0)], "Week int, channel string, extra double")
    declared = StructType().add("week", "integer").add("channel", "string")
    assert checks.check_schema(rows, declared) is rows
    with pytest.raises(ValueError, match="week: expected bigint, found int; share: expected double, missing"):
        checks.check_schema(rows, StructType().add("week", "long").add("share", "double"))


def test_declared_types_are_cast(spark):
    rows = spark.createDataFrame([(1, "a", 2.0)], "week int, channel string, extra double")
    found = checks.as_declared(rows, StructType().add("week", "string").add("channel", "string"))
    assert [tuple(row) for row in found.collect()] == [("1", "a", 2.0)]
    with pytest.raises(ValueError, match="missing columns: share"):
        checks.as_declared(rows, StructType().add("share", "double"))


def test_disagreeing_weeks(spark):
    rows = spark.createDataFrame([("05", "5"), ("6", "7"), ("x", "x"), (None, "1")], "week string, week_no string")
    assert pairs(checks.disagreeing_weeks(rows), "week") == Counter([("6",), (None,)])


def test_preview_is_ordered(spark):
    rows = spark.range(100)
    assert [row.id for row in checks.preview(rows, 3, [F.desc("id")]).collect()] == [99, 98, 97]


# --- totals ---


def test_partition_total_with_null_keys(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 4.0), (None, 5.0), ("b", None)], "k string, v double")
    found = totals.partition_total(rows, ["k"], "v", "t")
    assert pairs(found, "k", "v", "t") == Counter(
        [("a", 1.0, 3.0), ("a", 2.0, 3.0), (None, 4.0, 9.0), (None, 5.0, 9.0), ("b", None, None)]
    )


def test_shares_add_up_to_100(spark):
    rows = sum_by(
        spark.range(5000).select((F.col("id") % 7).alias("region"), (F.col("id") % 13).alias("net"), F.col("id").alias("v")),
        ["region", "net"],
        "v",
    )
    with_share = totals.partition_total(rows, ["region"], "v", "t").withColumn("s", F.col("v") * 100 / F.col("t"))
    assert all(abs(row.s - 100) < 1e-9 for row in with_share.groupBy("region").agg(F.sum("s").alias("s")).collect())


def test_normalise_keeps_nulls_and_survives_zero(spark):
    rows = spark.createDataFrame([("a", 1, 0), ("b", 3, 0), ("c", None, 0)], "k string, v int, z int")
    rows = rows.withColumns({name: F.col(name).cast("decimal(22,11)") for name in ("v", "z")})
    found = {row.k: row for row in totals.normalise_100(rows, ["v", "z"]).collect()}
    assert [found[k].v and float(found[k].v) for k in "abc"] == [25.0, 75.0, None]
    assert [found[k].z for k in "abc"] == [None, None, None]


def test_normalise_of_nothing(spark):
    rows = spark.createDataFrame([], "v decimal(22,11)")
    assert totals.normalise_100(rows, ["v"]).collect() == []


# --- ranks ---

ALL_RANKS = {
    "few": lambda df, keys: ranks.rank_few(df, "v"),
    "many": lambda df, keys: ranks.rank_many(df, "v", keys),
}


@pytest.mark.parametrize("how", ALL_RANKS)
def test_ties_leave_gaps_and_null_is_last(spark, how):
    values = [5.0, 5.0, float("nan"), None, None, 7.0, -0.0, 0.0]
    rows = spark.createDataFrame([(i, value) for i, value in enumerate(values)], "i int, v double")
    found = ALL_RANKS[how](rows, [])
    assert found.schema["rank"].dataType.simpleString() == "int"
    assert {row.i: row["rank"] for row in found.collect()} == {0: 3, 1: 3, 2: 1, 3: 7, 4: 7, 5: 2, 6: 5, 7: 5}


@pytest.mark.parametrize("how", ["many"])
def test_null_keys_are_a_group(spark, how):
    rows = spark.createDataFrame([(None, 1), (None, 2), (1, 5), (1, 4), (1, 5)], "k int, v int")
    found = ALL_RANKS[how](rows, ["k"])
    assert pairs(found, "k", "v", "rank") == Counter(
        [(None, 1, 2), (None, 2, 1), (1, 5, 1), (1, 4, 3), (1, 5, 1)]
    )


@pytest.mark.parametrize("keys", [[], ["k"], ["k", "j"]])
def test_ranks_of_skewed_groups_match_brute_force(spark, keys):
    """A third of all rows in one group, a third of all values equal."""
    chance = random.Random(7)
    rows = []
    for i in range(6000):
        group = "hot" if i % 3 == 0 else f"g{chance.randrange(40)}"
        value = 1 if i % 3 == 1 else chance.choice([None, *range(-200, 200)])
        rows.append((i, group, i % 2 or None, value))
    df = spark.createDataFrame(rows, "i int, k string, j int, v int")
    position = {"k": 1, "j": 2}
    grouped = {}
    for row in rows:
        grouped.setdefault(tuple(row[position[key]] for key in keys), []).append(row)
    expected = {}
    for members in grouped.values():
        values = sorted((row[3] is None, -(row[3] or 0)) for row in members)
        first = {}
        for place, value in enumerate(values, 1):
            first.setdefault(value, place)
        expected.update({row[0]: first[(row[3] is None, -(row[3] or 0))] for row in members})
    found = ranks.rank_many(df, "v", keys).collect()
    assert len(found) == len(rows)
    assert {row.i: row["rank"] for row in found} == expected


def test_ranking_nothing(spark):
    rows = spark.createDataFrame([], "k int, v int")
    assert ranks.rank_many(rows, "v", ["k"]).collect() == []
