"""The two weekly jobs: open the tables, build, check, write.

    spark-submit --py-files sharemill.zip job.py clean --as-of 2019-W07 --channel-feed db.feed \\
        --genre-feed db.genre_feed --master db.master --output /shared/output
    spark-submit --py-files sharemill.zip job.py marts --as-of 2019-W07 --output /shared/output

Or, so that a weekly run reads the facts of new weeks only, with sums that are kept from week to week:

    spark-submit --py-files sharemill.zip job.py sums --output /shared/output
    spark-submit --py-files sharemill.zip job.py marts --from-sums --as-of 2019-W07 --output /shared/output

Tables are catalog names or Parquet folders. Every output is one write that replaces what it covers, so a job
that failed half-way is simply run again.
"""

from __future__ import annotations

import argparse
import dataclasses
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from sharemill.asof import AsOf
from sharemill.operators.checks import check_count, check_schema, check_total
from sharemill.plans import cleaning, marts
from sharemill.rules import DEFAULT_RULES, Rules
from sharemill.settings import CleanSettings, MartSettings
from sharemill.sources import schemas
from sharemill.sources.sinks import period_path, write_period, write_snapshot
from sharemill.sources.staging import period_times, remove
from sharemill.sources.tables import open_table, written_table

# Folder names of the outputs.
CHANNEL_FACTS = "LA_CHANNEL_TBL"
GENRE_FACTS = "LA_CHANNEL_TBL_GENRE"
NETWORK_SHARE = "LA_NETWORK_SHARE"
GENRE_SHARE = "LA_NETWORK_GENRE_SHARE"
CHANNEL_DETAILS = "LA_CHANNEL_DETAILS"

# What the network share mart filters on.
CLUSTER = ("targets", "regions")


def clean(
    spark: SparkSession,
    asof: AsOf,
    *,
    channel_feed: str,
    genre_feed: str,
    master: str,
    output: str,
    settings: CleanSettings = CleanSettings(),
) -> dict[str, str]:
    """Write one period of both fact tables; in lenient mode also the feed rows with unreadable numbers."""
    output = output.rstrip("/")
    feeds = {
        CHANNEL_FACTS: (open_table(spark, channel_feed, schemas.RAW_CHANNEL_FEED), ("rat%", "shr%")),
        GENRE_FACTS: (open_table(spark, genre_feed, schemas.RAW_GENRE_FEED), ("shr%",)),
    }
    master_rows = open_table(spark, master, schemas.CHANNEL_MASTER)
    facts = {
        CHANNEL_FACTS: cleaning.clean_channel_facts(feeds[CHANNEL_FACTS][0], master_rows, asof, settings),
        GENRE_FACTS: cleaning.clean_genre_facts(feeds[GENRE_FACTS][0], master_rows, settings, asof),
    }
    declared = {CHANNEL_FACTS: schemas.CHANNEL_FACTS, GENRE_FACTS: schemas.GENRE_FACTS}
    sliced = {CHANNEL_FACTS: True, GENRE_FACTS: settings.slice_genre}
    paths = {}
    for name, rows in facts.items():
        rows = check_schema(rows, declared[name])
        # a sliced feed leaves few rows per task; an unsliced one is written as it is read
        cluster = [column for column in CLUSTER if column in rows.columns] if sliced[name] else None
        paths[name] = write_period(rows, f"{output}/{name}", asof, cluster)
        if settings.numbers == "lenient":
            feed, texts = feeds[name]
            week = "week_no" if name == CHANNEL_FACTS else "week"
            rejected = cleaning.rejected_rows(feed, texts, settings, asof if sliced[name] else None, week)
            paths[f"{name}_REJECTED"] = write_period(rejected, f"{output}/{name}_REJECTED", asof, cluster=())
    return paths


def build_marts(
    spark: SparkSession,
    asof: AsOf,
    *,
    channel_facts: str | None = None,
    genre_facts: str | None = None,
    sums: str | None = None,
    output: str,
    rules: Rules = DEFAULT_RULES,
    settings: MartSettings = MartSettings(),
) -> dict[str, object]:
    """Write the three marts from the facts, or from the kept sums below ``sums``; returns the check values, read from what
    was written.

    They are not collected while writing, because metrics of a running job can count a repeated task twice.
    """
    output = output.rstrip("/")
    if sums is not None:
        built = marts_from_sums(spark, asof, sums=sums, rules=rules, settings=settings)
    else:
        channels = open_table(spark, channel_facts, schemas.CHANNEL_FACTS)
        genres = open_table(spark, genre_facts, schemas.GENRE_FACTS)
        # a genre folder may hold weeks of any year, so its name says nothing about the rows
        genre_settings = dataclasses.replace(settings, year_folder=None)
        built = {
            NETWORK_SHARE: marts.network_share(channels, asof, rules, settings),
            GENRE_SHARE: marts.genre_share(genres, asof, rules, genre_settings),
            CHANNEL_DETAILS: marts.channel_details(channels, asof, rules, settings),
        }
    written = {}
    for name, mart in built.items():
        mart = check_schema(mart, DECLARED[name])
        written[name] = written_table(spark, write_snapshot(mart, f"{output}/{name}"), DECLARED[name])
    return {
        "genre_share_ytd": check_total(written[GENRE_SHARE], "share_ytd").first()[0],
        "channel_details_rows": check_count(written[CHANNEL_DETAILS]).first()[0],
    }


DECLARED = {
    NETWORK_SHARE: schemas.NETWORK_SHARE,
    GENRE_SHARE: schemas.GENRE_SHARE,
    CHANNEL_DETAILS: schemas.CHANNEL_DETAILS,
}

# Folder names of the kept sums, the facts that each is computed from, and what computes it and its mart.
SUMS = {
    f"{NETWORK_SHARE}_SUMS": (CHANNEL_FACTS, marts.network_sums, marts.network_share_from_sums),
    f"{GENRE_SHARE}_SUMS": (GENRE_FACTS, marts.genre_sums, marts.genre_share_from_sums),
    f"{CHANNEL_DETAILS}_SUMS": (CHANNEL_FACTS, marts.detail_sums, marts.channel_details_from_sums),
}
FACTS = {CHANNEL_FACTS: schemas.CHANNEL_FACTS, GENRE_FACTS: schemas.GENRE_FACTS}


def update_sums(
    spark: SparkSession, asof: AsOf, *, facts: str, output: str, rules: Rules = DEFAULT_RULES, names: Iterable[str] = tuple(SUMS)
) -> dict[str, str]:
    """Add one folder of the fact tables that ``clean`` wrote below ``facts`` to the kept sums, or replace it there.

    Only that folder is read, so a weekly run doesn't grow with the history. A genre folder may hold weeks of any
    year; its sums keep their own weeks, and the marts add them over folders.
    """
    paths = {}
    for name in names:
        table, build, _ = SUMS[name]
        rows = written_table(spark, period_path(f"{facts.rstrip('/')}/{table}", asof), FACTS[table])
        paths[name] = write_period(build(rows, rules), f"{output.rstrip('/')}/{name}", asof, cluster=())
    return paths


def refresh_sums(spark: SparkSession, *, facts: str, output: str, rules: Rules = DEFAULT_RULES) -> list[tuple[str, AsOf]]:
    """Bring the kept sums up to date: every folder of facts that came or was written again since its sums were, however
    old its week is. Returns what was computed anew; a second run finds nothing to do, and so does the rest of one that
    failed half-way find what it left.

    Folders are told apart by the times of their files. Sums of a folder that is no more are removed. Changed rules need
    new sums: take another ``output``.
    """
    done = []
    for name, (table, _, _) in SUMS.items():
        source, kept = (period_times(spark, f"{base.rstrip('/')}/{x}") for base, x in ((facts, table), (output, name)))
        for year, week in sorted(source):
            if kept.get((year, week), -1) <= source[year, week]:
                update_sums(spark, AsOf(year, week), facts=facts, output=output, rules=rules, names=[name])
                done.append((name, AsOf(year, week)))
        for year, week in sorted(kept.keys() - source.keys()):
            remove(spark, period_path(f"{output.rstrip('/')}/{name}", AsOf(year, week)))
            done.append((name, AsOf(year, week)))
    return done


def marts_from_sums(
    spark: SparkSession, asof: AsOf, *, sums: str, rules: Rules = DEFAULT_RULES, settings: MartSettings = MartSettings()
) -> dict[str, DataFrame]:
    """The three marts, by folder name, over the sums kept below ``sums``."""
    # their rows keep their own weeks, and a folder of genre sums may hold any
    settings = dataclasses.replace(settings, year_folder=None)
    tables = {name: spark.read.parquet(f"{sums.rstrip('/')}/{name}").drop("P_YEAR_OF_WEEK", "P_WEEK_NO") for name in SUMS}
    return {name.removesuffix("_SUMS"): mart(tables[name], asof, rules, settings) for name, (_, _, mart) in SUMS.items()}


def _add_settings(parser: argparse.ArgumentParser, settings: object) -> None:
    for field in dataclasses.fields(settings):
        option = "--" + field.name.replace("_", "-")
        default = getattr(settings, field.name)
        if isinstance(default, bool):
            parser.add_argument(option, action="store_true")
        else:
            parser.add_argument(option, type=type(default) if default is not None else str, default=default)


def _chosen(kind: type, options: argparse.Namespace):
    return kind(**{field.name: getattr(options, field.name) for field in dataclasses.fields(kind)})


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, object]:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)
    cleaning_job, mart_job, sums_job = (jobs.add_parser(name) for name in ("clean", "marts", "sums"))
    sums_job.add_argument("--as-of", type=AsOf.parse, default=None, help="only this week; default: all that changed")
    sums_job.add_argument("--facts", default=None, help="default: what the clean job wrote below --output")
    sums_job.add_argument("--output", required=True)
    for job in (cleaning_job, mart_job):
        job.add_argument("--as-of", type=AsOf.parse, default=None, help="YYYY-Www; default: the week before today's")
        job.add_argument("--previous-iso-week", action="store_true", help="default to the real week before, not week 0")
        job.add_argument("--output", required=True)
    for option in ("--channel-feed", "--genre-feed", "--master"):
        cleaning_job.add_argument(option, required=True)
    _add_settings(cleaning_job, CleanSettings())
    for option in ("--channel-facts", "--genre-facts"):
        mart_job.add_argument(option, default=None, help="default: what the clean job wrote below --output")
    mart_job.add_argument("--from-sums", action="store_true", help="from the sums that the sums job keeps below --output")
    _add_settings(mart_job, MartSettings())
    options = parser.parse_args(arguments)

    spark = spark or SparkSession.builder.appName(f"sharemill {options.job}").getOrCreate()
    if options.job == "sums":
        source = options.facts or options.output
        if options.as_of is not None:
            return update_sums(spark, options.as_of, facts=source, output=options.output)
        return {"refreshed": refresh_sums(spark, facts=source, output=options.output)}
    week_before = AsOf.previous_iso_week if options.previous_iso_week else AsOf.week_before
    asof = options.as_of or week_before(date.today())
    if options.job == "clean":
        return clean(
            spark,
            asof,
            channel_feed=options.channel_feed,
            genre_feed=options.genre_feed,
            master=options.master,
            output=options.output,
            settings=_chosen(CleanSettings, options),
        )
    return build_marts(
        spark,
        asof,
        channel_facts=options.channel_facts or f"{options.output}/{CHANNEL_FACTS}",
        genre_facts=options.genre_facts or f"{options.output}/{GENRE_FACTS}",
        sums=options.output if options.from_sums else None,
        output=options.output,
        settings=_chosen(MartSettings, options),
    )
