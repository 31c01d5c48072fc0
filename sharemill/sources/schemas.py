"""Declared schemas of every table the jobs read or write."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT, LONG, INT, DOUBLE = StringType(), LongType(), IntegerType(), DoubleType()


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# The attributes of the channel master, all text.
MASTER_ATTRIBUTES = (
    "network", "network1", "genre", "genre_fta_pay", "genre_lang", "genre_consl", "genre_movie_others",
    "language",
)
_MASTER_ATTRIBUTES = dict.fromkeys(MASTER_ATTRIBUTES, TEXT)

RAW_CHANNEL_FEED = _schema(
    **{
        "channel": TEXT, "week": TEXT, "week_no": TEXT, "year_of_week": TEXT, "targets": TEXT, "regions": TEXT,
        "rat%": TEXT, "shr%": TEXT,
    }
)
RAW_GENRE_FEED = _schema(
    **{"channel": TEXT, "week": TEXT, "year_of_week": TEXT, "regions": TEXT, "shr%": TEXT}
)
CHANNEL_MASTER = _schema(channel=TEXT, **_MASTER_ATTRIBUTES)
CHANNEL_FACTS = _schema(
    channel=TEXT, week_no=LONG, targets=TEXT, regions=TEXT, grp=DOUBLE, share_pct=DOUBLE, year_of_week=LONG,
    **_MASTER_ATTRIBUTES,
)
# week_no keeps the type it has in the raw feed
GENRE_FACTS = _schema(
    channel=TEXT, week_no=TEXT, regions=TEXT, share_pct=DOUBLE, year_of_week=LONG, **_MASTER_ATTRIBUTES
)
NETWORK_SHARE = _schema(
    network=TEXT, week_no=INT, rank=INT, mkt_share_cw=DOUBLE, share_l4w=DOUBLE, share_ytd=DOUBLE
)
GENRE_SHARE = _schema(network=TEXT, rank=INT, mkt_share_cw=DOUBLE, share_l4w=DOUBLE, share_ytd=DOUBLE)
CHANNEL_DETAILS = _schema(
    network=TEXT, channel=TEXT, genre=TEXT, market=TEXT, demography=TEXT, rank=INT, week_no=INT,
    update_date=TimestampType(), grp_ytd=DOUBLE, grp=DOUBLE, grp_l4w=DOUBLE,
)
