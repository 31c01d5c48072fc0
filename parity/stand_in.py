"""The star-schema tables in the role of audience feeds: one fact row per line item.

Only the joins that the requested columns need are made. Every line item has its order, customer, part and
supplier, so leaving a join out changes no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sharemill.rules import DEFAULT_RULES, RollUp, Rules

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Rules in the vocabulary of the test tables.
RULES = Rules(
    universe={"targets": "BUILDING", "regions": "ASIA"},
    parent="EUROPE",
    network_labels=(("NATION_1%", "G1"), ("NATION_2%", "G2"), ("EURO%", "Euro")),
    genre_labels=(("NATION_1%", "G1"), ("NATION_2%", "G2"), ("EURO%", "Euro"), ("G%", "G1")),
    kept_labels=("G1", "G2", "EURO"),
    kept_prefixes=("G", "EURO"),
    members=("BRAND#1", "BRAND#2", "BRAND#3", "BRAND#4", "BRAND#5", "BRAND#6"),
    roll_up=RollUp("PROMO", (("Promo A", ("BRAND#1", "BRAND#2")), ("Promo B", ("BRAND#3",))), "Promo Other"),
    buckets={1: ("BRAND#1", "BRAND#2", "BRAND#3"), 2: ("BRAND#4",), 7: ("PROMO A", "PROMO B", "PROMO OTHER")},
)

# The same, with a reported prefix that no label covers: any number of networks may then be ranked.
OPEN_RULES = replace(RULES, genre_labels=RULES.genre_labels[:2], kept_prefixes=("G", "NATION_", "EURO"))

# Names for the tables' keys, so that the default rules see names of every kind they know.
CHANNEL_NAMES = (*DEFAULT_RULES.members, "1SPORTS", "LOCAL NEWS", "PLANET FOLK", "RADIO ONE", "STAR LIFE")
NETWORK_NAMES = (
    "Star", "STAR India", "star vijay", "Sony", "SONY Pictures", "sony max", "Viacom18", "VIACOM Motion",
    "Sun TV", "sun bangla", "Zee Entertainment", "ZEE Network Entertainment Ltd", "Zee Media", "zee", "Zee",
    "TV Today", "Discovery", "Turner", "Asianet", "Raj", "Mahua", "Enterr", "Doordarshan", "My Star", "Odisha",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def iso_year(stamp: str) -> Column:
    return F.extract(F.lit("yearofweek"), F.col(stamp)).cast("bigint")


def iso_week(stamp: str) -> Column:
    return F.weekofyear(F.col(stamp)).cast("bigint")


def _from_list(names: tuple[str, ...], position: Column) -> Column:
    # one literal, which Spark folds into an array of names
    return F.element_at(F.split(F.lit("|".join(names)), "[|]"), position.cast("int") + 1)


def _named_channel() -> Column:
    name = _from_list(CHANNEL_NAMES, F.col("p_partkey") % len(CHANNEL_NAMES))
    return F.when(F.col("p_size") < 25, F.lower(name)).otherwise(F.concat(F.lit(" "), name, F.lit("  ")))


def _marked_brand() -> Column:
    brand, size = F.col("p_brand"), F.col("p_size")
    return (
        F.when(size < 5, F.concat(brand, F.lit("(na)")))
        .when(size.between(5, 9), F.concat(brand, F.lit("(NA)")))
        .otherwise(brand)
    )


LINE, ORDER, PART, SUPPLIER = "line", "order", "part", "supplier"

#: Column name -> the table it comes from and what makes its expression: a query builds only those it asks for.
COLUMNS: dict[str, tuple[str, Callable[[], Column]]] = {
    "l_orderkey": (LINE, lambda: F.col("l_orderkey")),
    "l_linenumber": (LINE, lambda: F.col("l_linenumber")),
    "l_extendedprice": (LINE, lambda: F.col("l_extendedprice")),
    "l_discount": (LINE, lambda: F.col("l_discount")),
    "l_tax": (LINE, lambda: F.col("l_tax")),
    "year_of_week": (LINE, lambda: iso_year("l_shipdate")),
    "week_no": (LINE, lambda: iso_week("l_shipdate")),
    "grp": (LINE, lambda: F.col("l_quantity")),
    "share_pct": (LINE, lambda: F.col("l_quantity")),
    "rat%": (LINE, lambda: F.format_number("l_extendedprice", 2)),
    "shr%": (LINE, lambda: F.format_number("l_quantity", 2)),
    "tax%": (LINE, lambda: F.format_number("l_tax", 2)),
    "spotty%": (
        LINE,
        lambda: F.when(F.col("l_returnflag") == "R", F.lit("n/a")).otherwise(F.format_number("l_extendedprice", 2)),
    ),
    "year_text": (LINE, lambda: iso_year("l_shipdate").cast("string")),
    "week_text": (LINE, lambda: iso_week("l_shipdate").cast("string")),
    "week_padded": (LINE, lambda: F.lpad(iso_week("l_shipdate").cast("string"), 2, "0")),
    "regions": (ORDER, lambda: F.col("customer_region")),
    "targets": (ORDER, lambda: F.col("c_mktsegment")),
    "order_week": (ORDER, lambda: iso_week("o_orderdate").cast("string")),
    "named_regions": (
        ORDER,
        lambda: F.when(F.col("customer_region") == "ASIA", F.lit("India")).otherwise(F.col("customer_region")),
    ),
    "named_targets": (
        ORDER,
        lambda: F.when(F.col("c_mktsegment") == "BUILDING", F.lit("Universe")).otherwise(F.col("c_mktsegment")),
    ),
    "channel": (PART, lambda: F.col("p_brand")),
    "marked_channel": (PART, lambda: _marked_brand()),
    "named_channel": (PART, lambda: _named_channel()),
    "genre": (PART, lambda: F.col("p_type")),
    "genre_fta_pay": (PART, lambda: F.col("p_type")),
    "named_genre_fta_pay": (
        PART,
        lambda: F.when(F.col("p_type") == "PROMO", F.lit("Sports")).otherwise(F.col("p_type")),
    ),
    "network": (SUPPLIER, lambda: F.col("supplier_nation")),
    "network1": (SUPPLIER, lambda: F.col("supplier_region")),
    "padded_network": (SUPPLIER, lambda: F.concat(F.lit("  "), F.col("supplier_nation"), F.lit(" "))),
    "named_network": (SUPPLIER, lambda: _from_list(NETWORK_NAMES, F.col("s_nationkey"))),
    "named_network1": (
        SUPPLIER,
        lambda: F.when(F.col("supplier_region") == "EUROPE", F.lit("Star")).otherwise(F.col("supplier_region")),
    ),
}


FACT_COLUMNS = (
    "channel", "network", "network1", "genre", "genre_fta_pay", "regions", "targets", "year_of_week", "week_no",
    "grp", "share_pct",
)
NAMED = ("channel", "network", "network1", "genre_fta_pay", "regions", "targets")
NAMED_FACTS = {name: f"named_{name}" if name in NAMED else name for name in FACT_COLUMNS}
CHANNEL_FEED = {
    "channel": "marked_channel", "week": "week_padded", "week_no": "week_text", "year_of_week": "year_text",
    "targets": "targets", "regions": "regions", "rat%": "rat%", "shr%": "shr%",
}
GENRE_FEED = {
    "channel": "marked_channel", "week": "week_text", "year_of_week": "year_text", "regions": "regions",
    "shr%": "tax%",
}


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with their regions. Broadcast: the two tables have 25 and 5 rows at every scale factor."""
    regions = F.broadcast(table(spark, sf_dir, "region"))
    return F.broadcast(table(spark, sf_dir, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey")))


def facts(spark: SparkSession, sf_dir: str, columns) -> DataFrame:
    """Line items with the given columns: names from ``COLUMNS``, or a mapping output name -> such a name."""
    names = columns if isinstance(columns, dict) else {name: name for name in columns}
    sources = {COLUMNS[source][0] for source in names.values()}
    rows = table(spark, sf_dir, "lineitem")
    places = _places(spark, sf_dir)
    if PART in sources:
        rows = rows.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if SUPPLIER in sources:
        places_of_suppliers = places.select(
            F.col("n_nationkey").alias("supplier_nationkey"),
            F.col("n_name").alias("supplier_nation"),
            F.col("r_name").alias("supplier_region"),
        )
        rows = rows.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        rows = rows.join(F.broadcast(places_of_suppliers), F.col("s_nationkey") == F.col("supplier_nationkey"))
    if ORDER in sources:
        customers = table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        customers = customers.select("c_custkey", "c_mktsegment", F.col("r_name").alias("customer_region"))
        orders = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(*[COLUMNS[source][1]().alias(name) for name, source in names.items()])


def channel_master(spark: SparkSession, sf_dir: str, lower: bool = False) -> DataFrame:
    """One row per brand; the n-th brand belongs to the n-th nation. Marked brands have no row here."""
    brands = (
        table(spark, sf_dir, "part")
        .groupBy("p_brand")
        .agg(F.min("p_type").alias("first_type"), F.max("p_type").alias("last_type"), F.max("p_name").alias("last_name"))
    )
    places = _places(spark, sf_dir)
    number = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int") - 1
    return brands.join(places, number == F.col("n_nationkey")).select(
        (F.lower("p_brand") if lower else F.col("p_brand")).alias("channel"),
        F.col("n_name").alias("network"),
        F.col("r_name").alias("network1"),
        F.col("first_type").alias("genre"),
        F.col("last_type").alias("genre_fta_pay"),
        F.col("r_name").alias("genre_lang"),
        F.col("first_type").alias("genre_consl"),
        F.col("last_type").alias("genre_movie_others"),
        F.col("last_name").alias("language"),
    )
