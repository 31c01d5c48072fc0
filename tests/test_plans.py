"""What Spark plans for the operators: pushed filters, pruned columns, no Python, no gathered groups."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from parity.queries import CHANNEL_FEED, QUERIES
from parity.stand_in import RULES, channel_master, facts
from sharemill import AsOf, MartSettings
from sharemill.functions.text import numeric_text
from sharemill.operators import dimensions
from sharemill.operators.enrich import enrich
from sharemill.operators.ranks import rank_many
from sharemill.plans import cleaning, marts
from sharemill.sources import schemas
from sharemill.sources.sinks import write_periods
from sharemill.sources.tables import open_table, period_slice

AS_OF = AsOf(1998, 40)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df) -> str:
    """The long form, which does not shorten scan properties."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    """Channel facts as a table of weekly folders."""
    base = str(tmp_path_factory.mktemp("history"))
    names = schemas.CHANNEL_FACTS.fieldNames()
    rows = facts(spark, "/root/testdata/sf0.001", [n for n in names if not n.startswith("genre_") and n != "language"])
    filled = rows.withColumns({n: F.lit("x") for n in names if n.startswith("genre_") or n == "language"})
    write_periods(filled.select(*names), base)
    return open_table(spark, base, schemas.CHANNEL_FACTS)


@pytest.mark.parametrize("name", ["clean_channel_facts", "clean_genre_facts", "truncate6", "network_share"])
def test_no_python_in_the_plan(spark, sf_dir, name):
    assert not re.search("EvalPython|InPandas|InArrow|PythonUDF", plan(QUERIES[name](spark, sf_dir)))


def test_marker_and_universe_reach_the_scan(spark, history):
    scan = scans(dimensions.exclude_marker(history, "channel"))
    assert "Not(StringContains(channel,(na)))" in scan
    scan = scans(marts.network_share(history, AS_OF, RULES))
    assert "StringStartsWith(targets,BUILDING)" in scan and "StringStartsWith(regions,ASIA)" in scan


def test_marts_read_only_their_columns(spark, history):
    read = re.search(r"ReadSchema: struct<([^>]*)>", scans(marts.network_share(history, AS_OF, RULES)))[1]
    assert {column.split(":")[0] for column in read.split(",")} == {
        "network", "network1", "targets", "regions", "year_of_week", "week_no", "share_pct"
    }


def test_period_slice_prunes_folders(spark, history):
    sliced = period_slice(history, AS_OF, year="P_YEAR_OF_WEEK", week="P_WEEK_NO")
    partition_filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan(sliced))[1]
    assert "P_YEAR_OF_WEEK" in partition_filters and "P_WEEK_NO" in partition_filters
    weeks = sliced.select("year_of_week", "week_no").distinct().collect()
    assert [tuple(row) for row in weeks] == [(1998, 40)]
    assert len(sliced.inputFiles()) >= 1


def test_catalog_slice_prunes_though_types_differ(spark, sf_dir):
    """The declared week is text and the catalog's an int; the cast does not cost the pruning."""
    rows = facts(spark, sf_dir, {**CHANNEL_FEED, "week_no": "week_no", "year_of_week": "year_of_week"})
    kept = rows.where("year_of_week = 1998 and week_no between 38 and 41")
    kept = kept.withColumns({name: F.col(name).cast("int") for name in ("year_of_week", "week_no")})
    kept.write.mode("overwrite").partitionBy("year_of_week", "week_no").saveAsTable("weekly_feed")
    table = open_table(spark, "weekly_feed", schemas.RAW_CHANNEL_FEED)
    sliced = period_slice(table, AS_OF)
    assert sliced.count() == kept.where("week_no = 40").count() > 0
    assert all("week_no=40" in file for file in sliced.inputFiles())
    assert any("week_no=38" in file for file in table.inputFiles())


def test_pruned_history_skips_folders(spark, history):
    settings = MartSettings(prune_history=True, year_folder="P_YEAR_OF_WEEK")
    pruned = marts.network_share(history, AsOf(2000, 20), RULES, settings)
    partition_filters = re.search(r"PartitionFilters: \[([^\n]*)", scans(pruned))[1]
    assert "P_YEAR_OF_WEEK" in partition_filters and ">= 2000" in partition_filters
    plain = marts.network_share(history, AsOf(2000, 20), RULES, MartSettings(prune_history=True))
    assert sorted(map(str, pruned.collect())) == sorted(map(str, plain.collect()))


def test_master_is_broadcast_by_size_only(spark, sf_dir):
    # a written master has a known size; the fact side is not shuffled for a small one
    rows = facts(spark, sf_dir, ("channel", "share_pct"))
    master = channel_master(spark, sf_dir)
    assert "BroadcastHashJoin" in plan(enrich(rows, master, ignore_case=True))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = plan(enrich(rows, spark.read.schema(schemas.CHANNEL_MASTER).parquet(f"{sf_dir}/part.parquet")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in shuffled and "BroadcastHashJoin" not in shuffled


def test_numbers_stay_in_generated_code(spark):
    rows = spark.range(10).select(F.col("id").cast("string").alias("t"))
    assert plan(rows.select(numeric_text(F.col("t")))).startswith("*(1)")


def test_cleaning_shuffles_no_facts(spark, sf_dir, tmp_path):
    feed = str(tmp_path / "feed")
    facts(spark, sf_dir, CHANNEL_FEED).write.parquet(feed)
    master = str(tmp_path / "master")
    channel_master(spark, sf_dir).write.parquet(master)
    cleaned = cleaning.clean_channel_facts(
        open_table(spark, feed, schemas.RAW_CHANNEL_FEED), open_table(spark, master, schemas.CHANNEL_MASTER), AS_OF
    )
    exchanges = re.findall(r"\w*Exchange", plan(cleaned).split("Initial Plan")[0])
    assert set(exchanges) == {"BroadcastExchange"}


def test_sums_are_partial_before_the_shuffle(spark, history):
    details = plan(marts.network_share(history, AS_OF, RULES))
    assert details.count("partial_sum") >= 1 and details.count("partial_avg") >= 3


def test_a_mart_reads_the_facts_once(spark, history):
    """No copy of the sums for totals, normalisation or ranks; three shuffles at most after the sums."""
    for mart, shuffles in ((marts.network_share, 2), (marts.genre_share, 5), (marts.channel_details, 3)):
        text = plan(mart(history, AS_OF, RULES))
        assert text.count("FileScan parquet") == 1 and "Join" not in text
        assert len(re.findall(r"\bExchange ", text)) <= shuffles + 1


def test_ranking_groups_of_any_size_takes_few_shuffles(spark):
    rows = spark.range(10).selectExpr("id % 2 as k", "id / 7 as v")
    assert len(re.findall(r"\bExchange ", plan(rank_many(rows, "v", ["k"])))) < 15
