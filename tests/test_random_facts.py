"""The marts against their SQL on random facts full of NULLs, padded and oddly spelled names, and hot groups."""

from __future__ import annotations

import random

import duckdb
import pyarrow as pa
import pytest
from compare import differences

from parity import oracle
from sharemill import DEFAULT_RULES, AsOf, MartSettings
from sharemill.plans import marts
from sharemill.sources import schemas

NETWORKS = (
    "Star", " star india", "STARX", "Sony", "sony ", "Viacom18", "Sun", "sun tv", "ZEE", "zee", "Zee Entertainment",
    "Zee News", "Other", "", None,
)
CHANNELS = (
    "&TV", " &tv", "COLORS", "Colors ", "DANGAL", "STAR GOLD", "EUROSPORT", "1SPORTS", "sony six(v)", "SONY TEN 1",
    "DD SPORTS", "NICK(V)", "Unlisted", None,
)
NAMES = schemas.CHANNEL_FACTS.fieldNames()
SETTINGS = {
    "default": MartSettings(),
    "iso": MartSettings(calendar="iso"),
    "closed": MartSettings(ytd_upper="asof", ytd_week=30, trailing=7),
    "pruned": MartSettings(prune_history=True),
}
PERIODS = (AsOf(2020, 30), AsOf(2020, 53), AsOf(2021, 1), AsOf(2021, 0), AsOf(2021, 10))


def random_facts(seed: int, size: int) -> list[dict]:
    chance = random.Random(seed)
    rows = []
    for i in range(size):
        hot = i % 3 == 0  # a third of the rows in one group
        year = chance.choice((2018, 2020, 2020, 2021, None if i % 50 == 0 else 2020))
        last_week = 53 if year == 2020 else 52
        rows.append(
            dict(
                channel="&TV" if hot else chance.choice(CHANNELS),
                network="Star" if hot else chance.choice(NETWORKS),
                network1=chance.choice(("Star", "star", None, "Other")) if i % 5 == 0 else None,
                week_no=chance.randint(1, last_week) if i % 40 else chance.choice((None, 30)),
                year_of_week=year,
                targets=chance.choice(("Universe", " Universe", "universe", "M15+", None)),
                regions="India" if hot else chance.choice(("India", "India ", "Delhi", "INDIA", None)),
                genre_fta_pay=chance.choice(("SPORTS", "Sports", "FTA", "Pay", None)),
                grp=chance.choice((None, *map(float, range(-5, 40)))),
                share_pct=chance.choice((None, 0.0, *map(float, range(0, 30)))),
            )
        )
    return rows


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("chosen", SETTINGS)
def test_marts_equal_sql_on_random_facts(spark, seed, chosen):
    settings, asof = SETTINGS[chosen], PERIODS[seed]
    rows = random_facts(seed, 3000)
    facts = spark.createDataFrame([tuple(row.get(name) for name in NAMES) for row in rows], schemas.CHANNEL_FACTS)
    with duckdb.connect() as engine:
        engine.register("raw_facts", pa.Table.from_pylist(rows))
        source = (
            "select trim(network, ' ') as network, network1, trim(channel, ' ') as channel, genre_fta_pay, "
            "trim(regions, ' ') as regions, trim(targets, ' ') as targets, year_of_week, week_no, grp, share_pct "
            "from raw_facts"
        )
        for name in ("network_share", "genre_share", "channel_details"):
            mart = getattr(marts, name)(facts, asof, DEFAULT_RULES, settings).drop("update_date")
            sql = getattr(oracle, name)(asof, settings, named=True, source=source)
            assert differences(mart, engine, sql) == [], name
