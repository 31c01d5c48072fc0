"""Ranks of groups of any size, against Spark's own window over a group, and how many rows a task sorts for them."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sharemill.operators.ranks import prefixes, rank_few, rank_many

INFINITY = float("inf")


def doubles():
    odd = [None, 0.0, -0.0, INFINITY, -INFINITY, float("nan"), 5e-324, -5e-324, 1e-310, 2.2250738585072014e-308, 1.7976931348623157e308]
    return random.choice([*odd, random.uniform(0, 2e-4), random.gauss(0, 1e10), float(random.randint(-5, 5)), 1.0 + random.randint(0, 4) * 2**-52])


def decimals(digits: int, scale: int):
    wide = random.randint(1 - 10**digits, 10**digits - 1)
    return random.choice([None, Decimal(wide).scaleb(-scale), Decimal(random.randint(-9, 9)).scaleb(-scale), Decimal(random.randint(-9999, 9999)).scaleb(-scale)])


KINDS = {
    "double": doubles,
    "float": lambda: random.choice([None, 0.5, -0.25, random.randint(-50, 50) / 8]),
    "int": lambda: random.choice([None, 2**31 - 1, -(2**31), random.randint(-9, 9)]),
    "bigint": lambda: random.choice([None, 2**63 - 1, -(2**63), random.randint(-(2**63), 2**63 - 1), random.randint(-9, 9)]),
    "decimal(18,7)": lambda: decimals(18, 7),
    "decimal(22,11)": lambda: decimals(22, 11),
    "decimal(38,0)": lambda: decimals(38, 0),
    "decimal(38,18)": lambda: decimals(38, 18),
}


@pytest.mark.parametrize("keys", [[], ["k"], ["k", "j"]])
@pytest.mark.parametrize("kind", KINDS)
def test_ranks_equal_those_of_one_window(spark, kind, keys):
    random.seed(5)
    rows = spark.createDataFrame([(random.choice([None, "a", "b"]), random.choice([None, 1]), KINDS[kind]()) for _ in range(800)], f"k string, j int, v {kind}")
    found = rank_many(rows, "v", keys, "place")
    assert found.columns == ["k", "j", "v", "place"]
    assert sorted(map(str, found.collect())) == sorted(map(str, rank_few(rows, "v", keys, "place").collect()))
    assert rank_many(rows.limit(0), "v", keys).collect() == []


def test_texts_have_no_rank(spark):
    with pytest.raises(TypeError, match="string"):
        rank_many(spark.createDataFrame([("a",)], "v string"), "v")


@pytest.mark.parametrize("value", ["id * 2e-10", "rand(1) * 2e-4", "exp(-id / 2000)", "cast(id * 1e-7 as decimal(18,7))", "id * 1e9", "1 + id * pow(2D, -52)"])
def test_no_task_sorts_many_of_a_million_values(spark, value):
    """However the values lie, a task sorts at most 2^22 prefixes or values under one; of values below 0.0002, far fewer."""
    rows = spark.range(0, 1_000_000, 1, 8).selectExpr(f"{value} as v")
    found = rows.distinct().withColumns(prefixes(F.col("v"), rows.schema["v"].dataType)).groupBy("_prefix_0", "_prefix_1").agg(F.count("v").alias("n"))
    under = found.groupBy("_prefix_0").agg(F.max("n").alias("values"), F.count("n").alias("prefixes"))
    most = under.agg(F.max("values"), F.max("prefixes"), F.count("prefixes")).first()
    assert max(most) <= 2**22 and (max(most) <= 100_000 or "2e-" not in value)


def test_a_million_small_values(spark):
    rows = spark.range(0, 1_000_000, 1, 8).selectExpr("id", "(id div 2) * 2e-10 as v")
    wrong = rank_many(rows, "v").where("rank <> 1000000 - (id div 2) * 2 - 1")
    assert wrong.count() == 0
