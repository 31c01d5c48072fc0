"""The three marts on hand-computed facts: the order of the steps shows in the results."""

from __future__ import annotations

import dataclasses

import pytest
from pyspark.sql import functions as F

from sharemill import DEFAULT_RULES, AsOf, MartSettings
from sharemill.plans import marts
from sharemill.sources import schemas

AS_OF = AsOf(2020, 20)


def channel_facts(spark, *rows):
    """Rows are dicts of the interesting columns."""
    base = dict(
        channel="&TV", week_no=20, targets="Universe", regions="India", grp=1.0, share_pct=1.0, year_of_week=2020,
        network="Star", network1=None, genre="x", genre_fta_pay="FTA",
    )
    names = schemas.CHANNEL_FACTS.fieldNames()
    return spark.createDataFrame([tuple({**base, **row}.get(name) for name in names) for row in rows], schemas.CHANNEL_FACTS)


def genre_facts(spark, *rows):
    base = dict(channel="c", week_no="20", regions="India", share_pct=1.0, year_of_week=2020, network="Star")
    names = schemas.GENRE_FACTS.fieldNames()
    return spark.createDataFrame([tuple({**base, **row}.get(name) for name in names) for row in rows], schemas.GENRE_FACTS)


def by(df, key):
    rows = df.collect()
    found = {row[key]: row for row in rows}
    assert len(found) == len(rows)
    return found


# --- network share ---


def test_network_share_by_hand(spark):
    facts = channel_facts(
        spark,
        dict(network=" Star India ", share_pct=10.0),
        dict(network="anything", network1="Star", share_pct=5.0),
        dict(network="Sony Max", share_pct=15.0),
        dict(network="Sony Max", share_pct=3.0, week_no=19),
        dict(network="SONY", share_pct=4.0, week_no=16),
        dict(network="SONY", share_pct=100.0, week_no=15),
        dict(network="SONY", share_pct=7.0, week_no=13),
        dict(network="Zee Media", share_pct=99.0),
        dict(network="Sun", share_pct=1.0, regions="Delhi"),
        dict(network="Sun", share_pct=2.0, regions=" India ", targets=" Universe"),
    )
    found = by(marts.network_share(facts, AS_OF), "network")
    assert {name: tuple(row)[1:] for name, row in found.items()} == {
        # Star's two rows of the week are one sum; no trailing rows count as zero
        "Star": (20, 1, 15.0, 0.0, 15.0),
        # trailing mean over the two weeks present, 16 and 19; year to date starts at week 14
        "Sony": (20, 1, 15.0, 3.5, 30.5),
        "Sun": (20, 3, 2.0, 0.0, 2.0),
    }


def test_network_without_current_week(spark):
    facts = channel_facts(spark, dict(network="Sun", week_no=3, year_of_week=2011), dict(network="Star"))
    found = by(marts.network_share(facts, AS_OF), "network")
    assert tuple(found["Sun"])[1:] == (20, 2, None, 0.0, None)
    with pytest.raises(Exception, match="measure is NULL"):
        marts.network_share(facts, AS_OF, settings=MartSettings(null_measures="fail")).collect()
    pruned = marts.network_share(facts, AS_OF, settings=MartSettings(prune_history=True))
    assert list(by(pruned, "network")) == ["Star"]


def test_kept_name_in_other_case_stays_apart(spark):
    """Only the label is compared upper-cased, so a network spelled ZEE is a group of its own."""
    facts = channel_facts(spark, dict(network="zee"), dict(network="ZEE", share_pct=3.0), dict(network="Zee Entertainment"))
    assert set(by(marts.network_share(facts, AS_OF), "network")) == {"zee", "ZEE", "Zee"}


def test_year_to_date_is_open_above_by_default(spark):
    facts = channel_facts(spark, dict(share_pct=2.0), dict(share_pct=4.0, week_no=30), dict(share_pct=6.0, year_of_week=2021))
    share = lambda **options: marts.network_share(facts, AS_OF, settings=MartSettings(**options)).first().share_ytd
    assert share() == 4.0
    assert share(ytd_upper="asof") == 2.0
    assert share(ytd_week=25) == 5.0


def test_week_53_is_merged_unless_the_calendar_is_iso(spark):
    facts = channel_facts(spark, dict(share_pct=2.0, week_no=53), dict(share_pct=4.0, week_no=1, year_of_week=2021))
    assert marts.network_share(facts, AsOf(2021, 1)).first().mkt_share_cw == 6.0
    iso = marts.network_share(facts, AsOf(2021, 1), settings=MartSettings(calendar="iso")).first()
    assert (iso.mkt_share_cw, iso.share_l4w) == (4.0, 2.0)


def test_week_0_is_the_last_week_of_a_52_week_year(spark):
    facts = channel_facts(spark, dict(share_pct=2.0, week_no=52, year_of_week=2019))
    assert marts.network_share(facts, AsOf(2020, 0)).first().mkt_share_cw == 2.0


# --- genre share ---


def test_genre_share_by_hand(spark):
    facts = genre_facts(
        spark,
        dict(network="Star", share_pct=30.0),
        dict(network="Zee Media", share_pct=10.0),
        dict(network=None, share_pct=60.0),  # unmatched, but in the total
        dict(network="Star", share_pct=50.0, regions=" Delhi"),
        dict(network="Other", share_pct=50.0, regions="Delhi"),
        dict(network="Star", share_pct=8.0, week_no="19"),
        dict(network="Other", share_pct=2.0, week_no="19"),
    )
    found = by(marts.genre_share(facts, AS_OF), "network")
    # current: Star (30% + 50%) / 2; trailing 8 of 8 + 2; year to date (30+50+8)/3, (50+2)/2, 10
    year = {"Star": 88 / 3, "Other": 26.0, "Zee": 10.0}
    assert set(found) == {"Star", "Zee"}
    star, zee = found["Star"], found["Zee"]
    assert (star["rank"], star.mkt_share_cw, star.share_l4w) == (1, 40.0, 80.0)
    assert (zee["rank"], zee.mkt_share_cw, zee.share_l4w) == (2, 10.0, None)
    assert star.share_ytd == pytest.approx(year["Star"] * 100 / sum(year.values()), abs=1e-6)
    assert zee.share_ytd == pytest.approx(year["Zee"] * 100 / sum(year.values()), abs=1e-6)


def test_nan_takes_its_region_and_week_out(spark):
    facts = genre_facts(
        spark,
        dict(network="Star", share_pct=float("nan")),
        dict(network="Sun", share_pct=5.0),
        dict(network="Sun", share_pct=7.0, regions="Delhi"),
    )
    found = by(marts.genre_share(facts, AS_OF), "network")
    assert list(found) == ["Sun"] and found["Sun"].mkt_share_cw == 100.0


def test_zero_total_is_null_not_an_error(spark):
    found = marts.genre_share(genre_facts(spark, dict(share_pct=0.0)), AS_OF).first()
    assert (found.mkt_share_cw, found.share_ytd) == (None, None)


def test_many_ranked_networks_take_the_general_way(spark):
    rules = dataclasses.replace(DEFAULT_RULES, kept_prefixes=("N",))
    facts = genre_facts(spark, *[dict(network=f"n{i:02d}", share_pct=float(i % 10)) for i in range(40)])
    found = by(marts.genre_share(facts, AS_OF, rules), "network")
    assert {name: row["rank"] for name, row in found.items()} == {f"n{i:02d}": (9 - i % 10) * 4 + 1 for i in range(40)}


# --- channel details ---


def test_channel_details_by_hand(spark):
    facts = channel_facts(
        spark,
        dict(channel=" &tv ", grp=1.1234567),
        dict(channel="&tv", grp=2.0, week_no=18),
        dict(channel="Colors", grp=1.0, week_no=2),  # known, but in no window
        dict(channel="SONY SIX(V)", grp=3.0, genre_fta_pay="Sports"),
        dict(channel="sony ten 1", grp=4.0, genre_fta_pay="Sports"),
        dict(channel="STAR SPORTS 1", grp=9.0, genre_fta_pay="Sports"),
        dict(channel="DD SPORTS", grp=1.0, genre_fta_pay="FTA"),  # no bucket
        dict(channel="NEO SPORTS(NA)", grp=2.0, genre_fta_pay="FTA"),
        dict(channel="Unlisted", grp=99.0),
    )
    details = marts.channel_details(facts, AS_OF)
    found = by(details, "channel")
    assert {name: (row["rank"], row.grp_ytd, row.grp, row.grp_l4w) for name, row in found.items()} == {
        "&tv": (1, 1.561728, 1.123456, 2.0),
        "Colors": (2, 0.0, 0.0, 0.0),
        "Sony Sports": (2, 7.0, 7.0, 0.0),
        "Star Sports Channels": (1, 9.0, 9.0, 0.0),
        "DD SPORTS": (2, 1.0, 1.0, 0.0),
        "NEO SPORTS(NA)": (1, 2.0, 2.0, 0.0),
    }
    assert details.columns == schemas.CHANNEL_DETAILS.fieldNames()


def test_missing_ranks_below_negative_and_zero(spark):
    """The rank sees the value before it is filled with zero."""
    facts = channel_facts(
        spark, dict(channel="COLORS", grp=-1.0), dict(channel="ZEE TV", grp=0.0), dict(channel="&TV", week_no=19)
    )
    found = by(marts.channel_details(facts, AS_OF), "channel")
    assert {name: row["rank"] for name, row in found.items()} == {"ZEE TV": 1, "COLORS": 2, "&TV": 3}
    assert found["&TV"].grp == 0.0


def test_nan_is_not_filled_with_zero(spark):
    facts = channel_facts(spark, dict(grp=float("nan")), dict(channel="COLORS", grp=None))
    found = by(marts.channel_details(facts, AS_OF), "channel")
    assert found["&TV"].grp is None and found["COLORS"].grp == 0.0


def test_one_time_stamp_per_run(spark):
    facts = channel_facts(spark, dict(), dict(channel="COLORS"))
    assert marts.channel_details(facts, AS_OF).select("update_date").distinct().count() == 1


@pytest.mark.parametrize("mart", [marts.network_share, marts.genre_share, marts.channel_details])
def test_empty_history_gives_an_empty_mart(spark, mart):
    empty = spark.createDataFrame([], schemas.CHANNEL_FACTS)
    assert mart(empty, AS_OF).collect() == []


def test_types_are_the_declared_ones(spark):
    facts = channel_facts(spark, dict())
    for mart, declared in (
        (marts.network_share, schemas.NETWORK_SHARE),
        (marts.genre_share, schemas.GENRE_SHARE),
        (marts.channel_details, schemas.CHANNEL_DETAILS),
    ):
        found = mart(facts, AS_OF).schema
        assert [(field.name, field.dataType) for field in found] == [(field.name, field.dataType) for field in declared]


def test_hot_group_of_a_third_of_all_rows(spark):
    """One channel, region and week holds a third of the rows; sums stay whole."""
    members = F.array(*[F.lit(name) for name in DEFAULT_RULES.members])
    member = F.element_at(members, (F.col("id") % len(DEFAULT_RULES.members) + 1).cast("int"))
    rows = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, "&TV").otherwise(member).alias("channel"),
        F.when(F.col("id") % 3 == 0, 20).otherwise(F.col("id") % 30 + 1).cast("long").alias("week_no"),
        F.lit(2020).cast("long").alias("year_of_week"),
        F.lit("Universe").alias("targets"), F.lit("India").alias("regions"), F.lit("Star").alias("network"),
        F.lit(None).cast("string").alias("network1"), F.lit("FTA").alias("genre_fta_pay"),
        F.lit(1.0).alias("grp"), F.lit(1.0).alias("share_pct"),
    )
    expected = rows.where("channel = '&TV' and week_no = 20").count()
    assert expected >= 30_000
    assert by(marts.channel_details(rows, AS_OF), "channel")["&TV"].grp == expected
    in_week = rows.where("week_no = 20").count()
    assert marts.network_share(rows, AS_OF).first().mkt_share_cw == in_week
