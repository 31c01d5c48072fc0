"""The weekly jobs from feeds to marts, through catalog tables and folders."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sharemill import AsOf, CleanSettings, MartSettings, jobs
from sharemill.plans import cleaning, marts
from sharemill.sources import schemas
from sharemill.sources.sinks import write_period, write_periods, write_snapshot
from sharemill.sources.staging import Staging, new_folder, period_times, shared_folder, staged
from sharemill.sources.tables import open_table

AS_OF = AsOf(2020, 7)


def feed(spark, schema, *rows):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def tables(spark, tmp_path):
    paths = {name: str(tmp_path / name) for name in ("channel_feed", "genre_feed", "master", "output")}
    # channel, week, week_no, year, targets, regions, rat%, shr%
    feed(
        spark,
        schemas.RAW_CHANNEL_FEED,
        ("&TV", "7", "7", "2020", "Universe", "India", "1,000.5", "2.5"),
        ("colors", "8", "7", "2020", "Universe", "India", "3", "4"),  # the slice tests week_no, the output has week
        ("gone(na)", "7", "7", "2020", "Universe", "India", "bad", "bad"),
        ("&TV", "6", "6", "2020", "Universe", "India", "1", "1"),
    ).write.parquet(paths["channel_feed"])
    feed(
        spark,
        schemas.RAW_GENRE_FEED,
        ("&TV", "7", "2020", "India", "60"),
        ("COLORS", "7", "2020", "India", "40"),
        ("colors", "6", "2020", "India", "0.00"),  # no exact match in the master
    ).write.parquet(paths["genre_feed"])
    spark.createDataFrame(
        [("&TV", "Zee Entertainment", None, "g", "FTA", None, None, None, None),
         ("COLORS", "Viacom18", None, "g", "FTA", None, None, None, None)],
        schemas.CHANNEL_MASTER,
    ).write.parquet(paths["master"])
    return paths


def test_feeds_to_marts(spark, tables):
    output = tables["output"]
    paths = jobs.clean(spark, AS_OF, **tables)
    assert paths["LA_CHANNEL_TBL"].endswith("/LA_CHANNEL_TBL/P_YEAR_OF_WEEK=2020/P_WEEK_NO=7")
    channels = open_table(spark, f"{output}/LA_CHANNEL_TBL", schemas.CHANNEL_FACTS)
    assert sorted((row.channel, row.week_no, row.grp, row.network) for row in channels.collect()) == [
        ("&TV", 7, 1000.5, "Zee Entertainment"),
        ("colors", 8, 3.0, "Viacom18"),
    ]
    genres = open_table(spark, f"{output}/LA_CHANNEL_TBL_GENRE", schemas.GENRE_FACTS)
    assert sorted((row.channel, row.week_no, row.share_pct, row.network) for row in genres.collect()) == [
        ("&TV", "7", 60.0, "Zee Entertainment"),
        ("COLORS", "7", 40.0, "Viacom18"),
        ("colors", "6", 0.0, None),
    ]

    checks = jobs.main(["marts", "--as-of", "2020-W07", "--output", output, "--ytd-week", "5"], spark)
    assert checks["channel_details_rows"] == 2
    # weeks 6 and 7 have the same mean per network; the week without a network is in no row
    assert checks["genre_share_ytd"] == pytest.approx(100.0, abs=1e-5)
    network = open_table(spark, f"{output}/LA_NETWORK_SHARE", schemas.NETWORK_SHARE)
    assert sorted(tuple(row) for row in network.collect()) == [
        ("Viacom", 7, 2, None, 0.0, 4.0, 0, 0),
        ("Zee", 7, 1, 2.5, 0.0, 2.5, 0, 0),
    ]
    again = jobs.main(["marts", "--as-of", "2020-W07", "--output", output, "--ytd-week", "5"], spark)
    assert again == checks


def test_lenient_job_keeps_rejects(spark, tables, tmp_path):
    feed(
        spark, schemas.RAW_CHANNEL_FEED, ("x", "7", "7", "2020", "Universe", "India", "n/a", "1"),
        ("y", "6", "6", "2020", "Universe", "India", "n/a", "1"),
    ).write.mode("append").parquet(tables["channel_feed"])
    with pytest.raises(Exception, match="not a number: n/a"):
        jobs.clean(spark, AS_OF, **tables)
    options = [f"--{name.replace('_', '-')}={path}" for name, path in tables.items()]
    paths = jobs.main(["clean", "--as-of", "2020-W7", "--numbers", "lenient", *options], spark)
    assert [row.channel for row in spark.read.parquet(paths["LA_CHANNEL_TBL_REJECTED"]).collect()] == ["x"]
    assert spark.read.parquet(paths["LA_CHANNEL_TBL_GENRE_REJECTED"]).count() == 0
    assert spark.read.parquet(paths["LA_CHANNEL_TBL"]).count() == 3


def test_options_change_the_genre_facts(spark, tables):
    settings = CleanSettings(drop_zero=True, normalise_key=True, unique_master=True)
    paths = jobs.clean(spark, AS_OF, **tables, settings=settings)
    assert spark.read.parquet(paths["LA_CHANNEL_TBL_GENRE"]).count() == 2
    paths = jobs.clean(spark, AsOf(2020, 6), **tables, settings=CleanSettings(normalise_key=True, slice_genre=True))
    assert [row.network for row in spark.read.parquet(paths["LA_CHANNEL_TBL_GENRE"]).collect()] == ["Viacom18"]


def test_catalog_tables(spark, tables):
    """A catalog may keep the week as a number; it is brought to the declared type."""
    spark.sql("create database if not exists feeds")
    spark.read.parquet(tables["channel_feed"]).selectExpr(
        "channel", "cast(week as int) week", "cast(week_no as int) week_no", "cast(year_of_week as int) year_of_week",
        "targets", "regions", "`rat%`", "`shr%`",
    ).write.mode("overwrite").saveAsTable("feeds.channel_feed")
    paths = jobs.clean(spark, AS_OF, **{**tables, "channel_feed": "feeds.channel_feed"})
    assert spark.read.parquet(paths["LA_CHANNEL_TBL"]).count() == 2


@pytest.mark.parametrize("flags, week", [([], AsOf(2020, 0)), (["--previous-iso-week"], AsOf(2019, 52))])
def test_default_week(monkeypatch, flags, week):
    class January(jobs.date):
        @classmethod
        def today(cls):
            return cls(2020, 1, 1)

    asked = []
    monkeypatch.setattr(jobs, "date", January)
    monkeypatch.setattr(jobs, "build_marts", lambda spark, asof, **rest: asked.append(asof))
    jobs.main(["marts", "--output", "/x", *flags], spark=object())
    assert asked == [week]


def test_default_settings_match_the_command_line():
    import argparse

    for kind in (CleanSettings, MartSettings):
        parser = argparse.ArgumentParser()
        jobs._add_settings(parser, kind())
        assert jobs._chosen(kind, parser.parse_args([])) == kind()


def test_period_is_replaced_even_by_nothing(spark, tmp_path):
    base = str(tmp_path / "facts")
    rows = spark.createDataFrame([(1,)], "x int")
    write_period(rows, base, AsOf(2020, 5))
    write_period(rows, base, AsOf(2020, 15))
    write_period(rows.where("x > 1"), base, AsOf(2020, 5), cluster=["x"])
    assert [tuple(row) for row in open_table(spark, base, rows.schema).collect()] == [(1, 2020, 15)]


@pytest.mark.parametrize("advised", ["64MB", "20KB"])
def test_clustered_files_hold_rows_alike(spark, tmp_path, advised):
    """A key lies in one file, unless that grew over the advised size; no row is lost either way."""
    rows = spark.range(0, 60_000, 1, 8).selectExpr("if(id % 3 = 0, 0, id % 50) as k", "id as x")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", advised)
    try:
        path = write_period(rows, str(tmp_path / "facts"), AsOf(2020, 5), cluster=["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    written = spark.read.parquet(path)
    assert written.count() == written.select("x").distinct().count() == 60_000
    per_file = written.selectExpr("input_file_name() as file", "k").distinct().groupBy("k").count()
    files = {row.k: row["count"] for row in per_file.collect()}
    assert files[0] > 1 if advised == "20KB" else set(files.values()) == {1}


def test_only_periods_in_the_rows_are_replaced(spark, tmp_path):
    base = str(tmp_path / "facts")
    rows = spark.createDataFrame([(1, 2020, 5), (2, 2020, 6)], "x int, year_of_week int, week_no int")
    write_periods(rows, base)
    write_periods(rows.where("week_no = 6").selectExpr("x * 10 as x", "year_of_week", "week_no"), base)
    assert sorted(row.x for row in spark.read.parquet(base).collect()) == [1, 20]


def test_snapshot_is_one_small_file(spark, tmp_path):
    path = write_snapshot(spark.range(1000).repartition(7), str(tmp_path / "mart"))
    assert path.endswith("P_YEAR_OF_WEEK=0000/P_WEEK_NO=00")
    assert len(list((tmp_path / "mart").rglob("*.parquet"))) == 1


def test_staged_tables_lie_in_the_shared_folder(spark):
    table = staged(spark.range(5), "probe")
    shared = spark.conf.get("spark.checkpoint.dir")
    assert table.count() == 5 and all(shared in file for file in table.inputFiles())
    assert new_folder(spark, "a") != new_folder(spark, "a")


def test_feed_folders_of_other_types(spark, tables):
    """A week kept as int in the files is read as the declared text, also by the job."""
    for name in ("channel_feed", "genre_feed"):
        rows = spark.read.parquet(tables[name])
        kinds = {c: rows[c].cast("int") for c in ("week", "week_no", "year_of_week") if c in rows.columns}
        rows.withColumns(kinds).write.parquet(tables[name] + "_int")
    paths = {**tables, "channel_feed": tables["channel_feed"] + "_int", "genre_feed": tables["genre_feed"] + "_int"}
    jobs.clean(spark, AS_OF, **paths)
    assert open_table(spark, f"{tables['output']}/LA_CHANNEL_TBL", schemas.CHANNEL_FACTS).count() == 2
    assert open_table(spark, f"{tables['output']}/LA_CHANNEL_TBL_GENRE", schemas.GENRE_FACTS).count() == 3


def test_bad_numbers_of_excluded_rows_never_fail_the_job(spark, tables):
    """Also where the feed is a join, whose rows Spark may test in any order; a bad number that is kept fails."""
    feed = spark.read.parquet(tables["genre_feed"])
    bad = spark.createDataFrame([("gone(na)", "7", "2020", "India", "oops")], feed.schema)
    names = spark.createDataFrame([("&TV",), ("COLORS",), ("colors",), ("gone(na)",)], "channel string")
    master = spark.read.parquet(tables["master"])
    for settings in (CleanSettings(), CleanSettings(drop_zero=True)):
        cleaned = cleaning.clean_genre_facts(feed.union(bad).join(names, "channel"), master, settings)
        assert cleaned.count() == (2 if settings.drop_zero else 3)
        kept = feed.union(bad.withColumn("channel", F.lit("&TV"))).join(names, "channel")
        with pytest.raises(Exception, match="not a number: oops"):
            cleaning.clean_genre_facts(kept, master, settings).collect()


def test_building_a_mart_runs_no_job(spark, tables):
    output = tables["output"]
    jobs.clean(spark, AS_OF, **tables)
    channels = open_table(spark, f"{output}/LA_CHANNEL_TBL", schemas.CHANNEL_FACTS)
    genres = open_table(spark, f"{output}/LA_CHANNEL_TBL_GENRE", schemas.GENRE_FACTS)
    spark.sparkContext.setJobGroup("building", "")
    built = [marts.network_share(channels, AS_OF), marts.genre_share(genres, AS_OF), marts.channel_details(channels, AS_OF)]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert built and not spark.sparkContext.statusTracker().getJobIdsForGroup("building")


def test_marts_from_kept_sums(spark, tables):
    """The same marts as from all facts; adding a week reads that week's folder alone, also when it is repeated."""
    output = tables["output"]
    for week in (6, 7, 7):
        jobs.clean(spark, AsOf(2020, week), **tables)
        paths = jobs.update_sums(spark, AsOf(2020, week), facts=output, output=output)
        assert all(path.endswith(f"P_YEAR_OF_WEEK=2020/P_WEEK_NO={week}") for path in paths.values())
    found = jobs.marts_from_sums(spark, AS_OF, sums=output)
    channels = open_table(spark, f"{output}/LA_CHANNEL_TBL", schemas.CHANNEL_FACTS)
    genres = open_table(spark, f"{output}/LA_CHANNEL_TBL_GENRE", schemas.GENRE_FACTS)
    expected = {
        "LA_NETWORK_SHARE": marts.network_share(channels, AS_OF),
        "LA_NETWORK_GENRE_SHARE": marts.genre_share(genres, AS_OF),
        "LA_CHANNEL_DETAILS": marts.channel_details(channels, AS_OF),
    }
    for name, mart in expected.items():
        rows, same = ([str(r) for r in x.drop("update_date").collect()] for x in (mart, found[name]))
        assert rows and sorted(rows) == sorted(same)


def mart_rows(spark, output):
    return {name: sorted(str(r) for r in spark.read.schema(schema).parquet(f"{output}/{name}").drop("update_date").collect()) for name, schema in jobs.DECLARED.items()}


def test_the_sums_job_reads_what_changed(spark, tables):
    """New weeks, late ones and ones written again, and nothing else; the marts from sums are those from all facts."""
    output = tables["output"]
    for week in (6, 7):
        jobs.clean(spark, AsOf(2020, week), **tables)
    first = jobs.main(["sums", "--output", output], spark)["refreshed"]
    assert set(first) == {(name, AsOf(2020, week)) for name in jobs.SUMS for week in (6, 7)}
    assert jobs.main(["sums", "--output", output], spark)["refreshed"] == []
    late = spark.read.parquet(tables["channel_feed"]).where("week_no = '6'").withColumns({"week": F.lit("5"), "week_no": F.lit("5")})
    late.write.mode("append").parquet(tables["channel_feed"])
    jobs.clean(spark, AsOf(2020, 5), **tables)
    assert {week for _, week in jobs.refresh_sums(spark, facts=output, output=output)} == {AsOf(2020, 5)}
    marts_job = ["marts", "--as-of", "2020-W07", "--ytd-week", "5", "--output", output]
    from_sums = jobs.main([*marts_job, "--from-sums"], spark)
    before = mart_rows(spark, output)
    assert jobs.main(marts_job, spark) == from_sums and mart_rows(spark, output) == before
    # an old week is written again: its sums are, and the marts change with them
    path = f"{output}/LA_CHANNEL_TBL/P_YEAR_OF_WEEK=2020/P_WEEK_NO=6"
    again = spark.createDataFrame(spark.read.parquet(path).withColumn("share_pct", F.col("share_pct") * 3).collect(), spark.read.parquet(path).schema)
    again.write.mode("overwrite").parquet(path)
    assert {week for _, week in jobs.refresh_sums(spark, facts=output, output=output)} == {AsOf(2020, 6)}
    jobs.main([*marts_job, "--from-sums"], spark)
    changed = mart_rows(spark, output)
    assert changed["LA_NETWORK_SHARE"] != before["LA_NETWORK_SHARE"]
    jobs.main(marts_job, spark)
    assert mart_rows(spark, output) == changed


def test_one_week_of_sums_scans_one_folder(spark, tables, monkeypatch):
    output = tables["output"]
    for week in (6, 7):
        jobs.clean(spark, AsOf(2020, week), **tables)
    read = []
    write = jobs.write_period
    monkeypatch.setattr(jobs, "write_period", lambda rows, *a, **k: read.append(rows.inputFiles()) or write(rows, *a, **k))
    jobs.main(["sums", "--as-of", "2020-W07", "--output", output], spark)
    assert len(read) == 3 and all(files and all("P_WEEK_NO=7" in file for file in files) for files in read)


def test_sums_of_a_removed_week_go(spark, tables):
    output = tables["output"]
    for week in (6, 7):
        jobs.clean(spark, AsOf(2020, week), **tables)
    jobs.refresh_sums(spark, facts=output, output=output)
    import shutil

    shutil.rmtree(f"{output}/LA_CHANNEL_TBL/P_YEAR_OF_WEEK=2020/P_WEEK_NO=6")
    assert len(jobs.refresh_sums(spark, facts=output, output=output)) == 2
    assert set(period_times(spark, f"{output}/LA_NETWORK_SHARE_SUMS")) == {(2020, 7)}
    assert period_times(spark, f"{output}/none") == {}


def exists(spark, path):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def test_staging_deletes_its_tables(spark):
    with Staging(spark) as staging:
        table, other = staging.table(spark.range(5), "one"), staging.folder("two")
        kept = list(staging.folders)
        assert table.count() == 5 and exists(spark, kept[0]) and kept[1] == other
    assert staging.folders == [] and not any(exists(spark, path) for path in kept)
    with pytest.raises(Exception, match="stop"), Staging(spark) as staging:
        staging.table(spark.range(5), "good")
        kept = staging.folders[:1]
        bad = spark.range(5).select(F.raise_error(F.lit("stop")).alias("x").cast("int"))
        staging.table(bad, "bad")
    assert staging.folders == [] and not exists(spark, kept[0])


def test_a_cluster_needs_a_shared_folder():
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://one:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster)
