"""Every registered query: (spark, folder of the test tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parity.stand_in import (
    CHANNEL_FEED,
    FACT_COLUMNS,
    GENRE_FEED,
    NAMED_FACTS,
    OPEN_RULES,
    RULES,
    channel_master,
    facts,
    iso_week,
    iso_year,
    table,
)
from sharemill import DEFAULT_RULES, AsOf, CleanSettings, MartSettings, jobs
from sharemill.functions import classify as names
from sharemill.functions import measures, text
from sharemill.functions.periods import Windows, period_index, previous_iso_week, week_before
from sharemill.operators import checks, dimensions, ranks, totals
from sharemill.operators.aggregates import period_pivot, sum_by
from sharemill.operators.enrich import enrich
from sharemill.operators.rule_tables import bucket_by_table, classify_by_table
from sharemill.plans import cleaning, marts
from sharemill.sources import schemas, sinks
from sharemill.sources.staging import new_folder
from sharemill.sources.tables import open_table, period_slice

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = AsOf.parse("1998-W40")
EVENTS_AS_OF = AsOf.parse("2024-W05")
LINE = ("l_orderkey", "l_linenumber")
QUERIES: dict[str, Query] = {}


def registered(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def query(function: Query) -> Query:
    return registered(function.__name__)(function)


def _period(calendar: str = "compat") -> Column:
    return period_index(F.col("year_of_week"), F.col("week_no"), calendar).alias("period")


# --- sources and sinks ---


@query
def scan_facts(spark, sf_dir):
    return facts(spark, sf_dir, (*LINE, *FACT_COLUMNS))


@registered("period_slice")
def period_slice_rows(spark, sf_dir):
    feed = facts(spark, sf_dir, {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", **CHANNEL_FEED})
    return period_slice(feed, AS_OF).select(*LINE, "channel", "year_of_week", "week_no")


@query
def partition_sink(spark, sf_dir):
    """All weeks are written, then one of them again with doubled shares."""
    base = new_folder(spark, "sink")
    rows = facts(spark, sf_dir, ("channel", "genre", "share_pct", "year_of_week", "week_no"))
    sinks.write_periods(rows, base)
    one_week = rows.where((F.col("year_of_week") == AS_OF.year) & (F.col("week_no") == AS_OF.week))
    sinks.write_periods(one_week.withColumn("share_pct", F.col("share_pct") * 2), base)
    schema = StructType().add("channel", "string").add("genre", "string").add("share_pct", "double")
    return (
        open_table(spark, base, schema)
        .groupBy("P_YEAR_OF_WEEK", "P_WEEK_NO", "channel")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("share_pct").alias("share_pct"))
    )


@query
def period_sink(spark, sf_dir):
    """One week is written to its own folder, twice, and read back through the folder names."""
    base = new_folder(spark, "sink")
    rows = facts(spark, sf_dir, (*LINE, "channel", "share_pct", "year_of_week", "week_no"))
    one_week = rows.where((F.col("year_of_week") == AS_OF.year) & (F.col("week_no") == AS_OF.week))
    sinks.write_period(rows.where(F.lit(False)), base, AS_OF)
    sinks.write_period(one_week, base, AS_OF)
    return open_table(spark, base, rows.schema)


@query
def snapshot_sink(spark, sf_dir):
    base = new_folder(spark, "sink")
    sinks.write_snapshot(network_share(spark, sf_dir), base)
    return open_table(spark, base, schemas.NETWORK_SHARE)


# --- column derivations ---


@query
def clean_numeric(spark, sf_dir):
    feed = facts(spark, sf_dir, (*LINE, "rat%", "shr%"))
    return feed.select(
        *LINE,
        text.numeric_text(F.col("`rat%`")).alias("grp"),
        text.numeric_text(F.col("`shr%`")).alias("share_pct"),
    )


@query
def clean_numeric_lenient(spark, sf_dir):
    feed = facts(spark, sf_dir, (*LINE, "spotty%"))
    return feed.select(*LINE, text.numeric_text(F.col("`spotty%`"), "lenient").alias("share_pct"))


@query
def clean_numeric_guarded(spark, sf_dir):
    feed = facts(spark, sf_dir, (*LINE, "spotty%"))
    guarded = F.regexp_replace("`spotty%`", r"\.\d*", "d")  # 12d: a number to a cast, none to the guard
    return feed.select(
        *LINE,
        text.numeric_text(guarded, "lenient", python_numbers=True).alias("guarded"),
        text.numeric_text(F.col("`spotty%`"), "lenient", python_numbers=True).alias("share_pct"),
    )


@query
def clean_numeric_underscores(spark, sf_dir):
    """Digits grouped by underscores: no number to a cast, one to the guard."""
    feed = facts(spark, sf_dir, (*LINE, "rat%"))
    grouped = F.translate("`rat%`", ",", "_")
    return feed.select(*LINE, text.numeric_text(grouped, "lenient", python_numbers=True).alias("grp"))


@query
def rejected_rows(spark, sf_dir):
    columns = {**dict(zip(LINE, LINE)), "channel": "marked_channel", "rat%": "rat%", "spotty%": "spotty%"}
    feed = facts(spark, sf_dir, columns)
    return cleaning.rejected_rows(feed, ("rat%", "spotty%"))


@query
def cast_period(spark, sf_dir):
    feed = facts(spark, sf_dir, (*LINE, "year_text", "week_text", "week_padded"))
    return feed.select(
        *LINE,
        text.cast_long(F.col("year_text")).alias("year_of_week"),
        text.cast_long(F.col("week_padded")).alias("week_no"),
    )


@query
def project_rename(spark, sf_dir):
    rows = facts(spark, sf_dir, (*LINE, "channel", "week_no", "regions"))
    return dimensions.rename(
        rows,
        {
            "order_id": "l_orderkey", "line": "l_linenumber", "channel_temp": "channel", "week": "week_no",
            "market": "regions",
        },
    )


@query
def drop_columns(spark, sf_dir):
    return facts(spark, sf_dir, (*LINE, "channel", "genre", "share_pct")).drop("genre", "share_pct")


@query
def trim_dims(spark, sf_dir):
    rows = facts(spark, sf_dir, (*LINE, "padded_network", "named_channel"))
    return dimensions.trim_dims(rows, ["padded_network", "named_channel", "targets"])


@query
def parent_override(spark, sf_dir):
    rows = facts(spark, sf_dir, (*LINE, "network", "network1"))
    owner = names.parent_override(F.col("network"), F.col("network1"), RULES.parent)
    return rows.withColumn("owner", owner)


@query
def classify_prefix(spark, sf_dir):
    rows = facts(spark, sf_dir, {**dict(zip(LINE, LINE)), "network": "named_network"})
    return rows.withColumn("label", names.classify(F.col("network"), DEFAULT_RULES.network_labels))


@query
def classify_prefix_wide(spark, sf_dir):
    rows = facts(spark, sf_dir, {**dict(zip(LINE, LINE)), "network": "named_network"})
    return rows.withColumn("label", names.classify(F.col("network"), DEFAULT_RULES.genre_labels))


def _named_channels(spark, sf_dir):
    rows = facts(
        spark, sf_dir, {**dict(zip(LINE, LINE)), "channel": "named_channel", "genre_fta_pay": "named_genre_fta_pay"}
    )
    return dimensions.trim_dims(rows, ["channel"])


@query
def rollup_members(spark, sf_dir):
    label = names.rolled_up(F.col("channel"), F.col("genre_fta_pay"), DEFAULT_RULES.roll_up)
    return _named_channels(spark, sf_dir).withColumn("label", label)


@query
def bucket_lookup(spark, sf_dir):
    label = names.rolled_up(F.col("channel"), F.col("genre_fta_pay"), DEFAULT_RULES.roll_up)
    return _named_channels(spark, sf_dir).withColumn("group_ch", names.bucket_code(label, DEFAULT_RULES.buckets))


@query
def classify_table(spark, sf_dir):
    """Customers' names of all orders by rules from a table: one for each supplier, some with inner wildcards."""
    number = F.col("s_suppkey") % 997
    pattern = (
        F.when(F.col("s_suppkey") % 4 == 1, F.concat(F.lit("CUSTOMER#0%"), F.lpad((number % 100).cast("string"), 2, "0")))
        .when(F.col("s_suppkey") % 4 == 2, F.concat(F.lit("CUST_MER#000000"), F.lpad(number.cast("string"), 3, "0")))
        .otherwise(F.concat(F.lit("CUSTOMER#"), F.lpad(number.cast("string"), 8, "0"), F.lit("%")))
    )
    rules = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("position"), pattern.alias("pattern"), F.col("s_name").alias("label"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    named = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")
    return classify_by_table(named, "c_name", rules).select("o_orderkey", "label")


@query
def bucket_table(spark, sf_dir):
    """The genre of every line item's part, looked up in lists that are a table: part names by size."""
    members = table(spark, sf_dir, "part").where("p_size > 3").select(F.col("p_size").alias("code"), F.upper("p_name").alias("name"))
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return bucket_by_table(lines.select(*LINE, F.initcap("p_name").alias("name")), "name", members).select(*LINE, "bucket")


@query
def as_of_weeks(spark, sf_dir):
    """The week a run on each order's day reports on, both ways, year ends and week 0 included."""
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    (year, week), (before_year, before_week) = week_before(F.col("day")), previous_iso_week(F.col("day"))
    return days.select(
        "day", year.alias("asof_year"), week.alias("asof_week"), before_year.alias("previous_year"), before_week.alias("previous_week")
    )


@registered("period_index")
def period_index_compat(spark, sf_dir):
    rows = facts(spark, sf_dir, (*LINE, "year_of_week", "week_no"))
    return rows.withColumn("period", _period())


@query
def period_index_iso(spark, sf_dir):
    rows = facts(spark, sf_dir, (*LINE, "year_of_week", "week_no"))
    return rows.withColumn("period", _period("iso"))


@query
def fixed_point(spark, sf_dir):
    rows = facts(spark, sf_dir, (*LINE, "l_extendedprice", "l_discount"))
    return rows.select(*LINE, measures.fixed_point(F.col("l_extendedprice") * F.col("l_discount")).alias("fixed"))


@query
def truncate6(spark, sf_dir):
    rows = facts(spark, sf_dir, (*LINE, "l_extendedprice", "share_pct"))
    exact = (F.col("l_extendedprice") / 7).cast("decimal(18,7)")
    return rows.select(
        *LINE, measures.truncate6(exact).alias("up"), measures.truncate6(-exact).alias("down")
    )


# --- filters ---


@query
def filter_eq(spark, sf_dir):
    return dimensions.filter_eq(facts(spark, sf_dir, (*LINE, "targets", "regions")), RULES.universe)


@query
def filter_eq_trimmed(spark, sf_dir):
    rows = facts(spark, sf_dir, (*LINE, "padded_network"))
    return dimensions.filter_eq(rows, {"padded_network": "NATION_1"}, trimmed=True)


@query
def exclude_like(spark, sf_dir):
    return dimensions.exclude_marker(facts(spark, sf_dir, (*LINE, "marked_channel")), "marked_channel")


@query
def exclude_like_any_case(spark, sf_dir):
    rows = facts(spark, sf_dir, (*LINE, "marked_channel"))
    return dimensions.exclude_marker(rows, "marked_channel", ignore_case=True)


def _taxes(spark, sf_dir):
    rows = facts(spark, sf_dir, (*LINE, "tax%"))
    return rows.select(*LINE, text.numeric_text(F.col("`tax%`")).alias("share_pct"))


@query
def exclude_zero(spark, sf_dir):
    return dimensions.exclude_zero(_taxes(spark, sf_dir), "share_pct")


@query
def exclude_zero_number(spark, sf_dir):
    return dimensions.exclude_zero(_taxes(spark, sf_dir), "share_pct", drop_zero=True)


@query
def whitelist_semi(spark, sf_dir):
    return dimensions.keep_members(_named_channels(spark, sf_dir), "channel", DEFAULT_RULES.members)


@query
def whitelist_table(spark, sf_dir):
    """The list is a table: brands that have a small PROMO part."""
    parts = table(spark, sf_dir, "part").where((F.col("p_type") == "PROMO") & (F.col("p_size") < 3))
    members = parts.select(F.upper("p_brand")).distinct()
    return dimensions.keep_members(facts(spark, sf_dir, (*LINE, "channel")), "channel", members)


@query
def keep_groups(spark, sf_dir):
    return dimensions.keep_groups(classify_prefix(spark, sf_dir), "label", DEFAULT_RULES.kept_labels)


@query
def keep_prefixes(spark, sf_dir):
    return dimensions.keep_prefixes(classify_prefix_wide(spark, sf_dir), "label", DEFAULT_RULES.kept_prefixes)


@query
def drop_any_null(spark, sf_dir):
    return dimensions.drop_any_null(enrich_exact(spark, sf_dir))


# --- joins ---


def _marked(spark, sf_dir):
    return facts(spark, sf_dir, {**dict(zip(LINE, LINE)), "channel": "marked_channel", "share_pct": "share_pct"})


@query
def enrich_ci(spark, sf_dir):
    return enrich(_marked(spark, sf_dir), channel_master(spark, sf_dir, lower=True), ignore_case=True)


@query
def enrich_fan_out(spark, sf_dir):
    """Keys that repeat in the master, once in other letters: every fact comes out once for each."""
    master = channel_master(spark, sf_dir)
    twice = master.unionByName(channel_master(spark, sf_dir, lower=True).withColumn("network", F.lit("again")))
    return enrich(_marked(spark, sf_dir), twice, ignore_case=True)


@query
def enrich_exact(spark, sf_dir):
    return enrich(_marked(spark, sf_dir), channel_master(spark, sf_dir))


@query
def enrich_normalised(spark, sf_dir):
    rows = facts(spark, sf_dir, {**dict(zip(LINE, LINE)), "channel": "channel"})
    padded = rows.withColumn("channel", F.concat(F.lit(" "), F.upper("channel"), F.lit("  ")))
    return enrich(padded, channel_master(spark, sf_dir), ignore_case=True, trim=True)


# --- aggregates ---


def _universe(spark, sf_dir):
    rows = facts(
        spark, sf_dir, ("network", "network1", "targets", "regions", "year_of_week", "week_no", "share_pct")
    )
    owner = names.parent_override(F.col("network"), F.col("network1"), RULES.parent)
    return dimensions.filter_eq(rows, RULES.universe).withColumn("network", owner)


@query
def sum_by_network(spark, sf_dir):
    return sum_by(_universe(spark, sf_dir), ["network", "week_no", "year_of_week"], "share_pct")


@query
def resum_by_group(spark, sf_dir):
    label = names.classify(F.col("network"), RULES.network_labels).alias("network")
    return sum_by(sum_by_network(spark, sf_dir), [label, _period()], "share_pct")


@query
def sum_by_region(spark, sf_dir):
    rows = facts(spark, sf_dir, ("network", "network1", "regions", "year_of_week", "week_no", "share_pct"))
    owner = names.parent_override(F.col("network"), F.col("network1"), RULES.parent).alias("network")
    return sum_by(rows, ["regions", owner, _period()], "share_pct")


@query
def sum_by_channel(spark, sf_dir):
    rows = facts(
        spark,
        sf_dir,
        ("network", "channel", "genre_fta_pay", "regions", "targets", "year_of_week", "week_no", "grp"),
    )
    label = names.rolled_up(F.col("channel"), F.col("genre_fta_pay"), RULES.roll_up).alias("channel")
    rows = dimensions.keep_members(rows, "channel", RULES.members)
    return sum_by(rows, ["network", label, "genre_fta_pay", "regions", "targets", _period()], "grp")


def _pivot(weekly, keys, asof, settings=MartSettings()):
    share = measures.fixed_point(F.col("share_pct"))
    windows = Windows.at(asof, settings)
    return period_pivot(weekly, keys, windows, ("cw", share), ("l4w", share), ("ytd", share))


@registered("period_pivot")
def period_pivot_default(spark, sf_dir):
    return _pivot(resum_by_group(spark, sf_dir), ["network"], AS_OF)


@query
def period_pivot_no_ytd(spark, sf_dir):
    """No event lies in or after week 14, so every year-to-date average is NULL."""
    events = table(spark, sf_dir, "events").select(
        "event_type",
        iso_year("ts").alias("year_of_week"),
        iso_week("ts").alias("week_no"),
        F.col("value").cast("decimal(18,2)").alias("share_pct"),
    )
    weekly = sum_by(events, ["event_type", _period()], "share_pct")
    return _pivot(weekly, ["event_type"], EVENTS_AS_OF)


@query
def period_pivot_closed_ytd(spark, sf_dir):
    return _pivot(resum_by_group(spark, sf_dir), ["network"], AS_OF, MartSettings(ytd_upper="asof"))


@query
def period_pivot_iso(spark, sf_dir):
    """As of 1999-W03 the trailing weeks reach into week 53 of 1998, which the real calendar keeps apart."""
    label = names.classify(F.col("network"), RULES.network_labels).alias("network")
    weekly = sum_by(sum_by_network(spark, sf_dir), [label, _period("iso")], "share_pct")
    return _pivot(weekly, ["network"], AsOf(1999, 3), MartSettings(calendar="iso"))


@query
def null_to_zero(spark, sf_dir):
    pivoted = _pivot(resum_by_group(spark, sf_dir), ["network"], AS_OF)
    return pivoted.select("network", measures.null_to_zero(F.col("cw")).alias("cw"), "l4w")


@query
def check_total(spark, sf_dir):
    # as decimal, so that the sum does not depend on the order of the rows
    mart = genre_share(spark, sf_dir).withColumn("share_ytd", F.col("share_ytd").cast("decimal(18,6)"))
    return checks.check_total(mart, "share_ytd")


@query
def check_count(spark, sf_dir):
    return checks.check_count(channel_details(spark, sf_dir))


# --- windows ---


@query
def partition_total(spark, sf_dir):
    return totals.partition_total(sum_by_region(spark, sf_dir), ["regions", "period"], "share_pct", "total_pct")


@query
def share_of_total(spark, sf_dir):
    share = measures.percent_of(F.col("share_pct"), F.col("total_pct"))
    return partition_total(spark, sf_dir).select(
        "regions", "network", "period", measures.fixed_point(share).alias("share")
    )


@query
def normalise_100(spark, sf_dir):
    rows = facts(spark, sf_dir, ("network", "year_of_week", "week_no", "share_pct"))
    weekly = sum_by(rows, ["network", _period()], "share_pct")
    return totals.normalise_100(_pivot(weekly, ["network"], AS_OF), ["l4w", "ytd"])


def _by_network(spark, sf_dir, *keys):
    rows = facts(spark, sf_dir, (*keys, "share_pct"))
    return sum_by(rows, keys, "share_pct")


@query
def rank_global(spark, sf_dir):
    return ranks.rank_many(_by_network(spark, sf_dir, "network", "channel", "targets"), "share_pct")


@query
def rank_all_rows(spark, sf_dir):
    """Every line item in one ranking: a single group that holds all rows."""
    return ranks.rank_many(facts(spark, sf_dir, (*LINE, "l_extendedprice")), "l_extendedprice")


@query
def rank_rows(spark, sf_dir):
    """Every line item ranked within its genre: groups of a sixth of all rows, with many ties."""
    rows = facts(spark, sf_dir, (*LINE, "genre", "share_pct"))
    return ranks.rank_many(rows, "share_pct", ["genre"])


@query
def rank_bounded(spark, sf_dir):
    kept = dimensions.keep_groups(_by_network(spark, sf_dir, "regions"), "regions", ("ASIA", "EUROPE", "AFRICA"))
    return ranks.rank_few(kept, "share_pct")


@query
def rank_partitioned(spark, sf_dir):
    rows = _by_network(spark, sf_dir, "network", "channel", "genre", "regions")
    rows = rows.withColumn("bucket", names.bucket_code(F.col("channel"), RULES.buckets))
    return ranks.rank_many(rows, "share_pct", ["bucket", "regions"])


# --- checks ---


@query
def preview(spark, sf_dir):
    rows = facts(spark, sf_dir, (*LINE, "channel", "share_pct"))
    return checks.preview(rows, 20, [F.desc("share_pct"), *LINE])


@query
def master_duplicates(spark, sf_dir):
    """Part names repeat, so as a master key they would fan out."""
    return checks.duplicate_keys(table(spark, sf_dir, "part"), F.upper("p_name"))


@query
def disagreeing_weeks(spark, sf_dir):
    rows = facts(spark, sf_dir, {**dict(zip(LINE, LINE)), "week": "week_padded", "week_no": "order_week"})
    return checks.disagreeing_weeks(rows)


@query
def audit_stamp(spark, sf_dir):
    """One run stamps every row with the same time."""
    details = marts.channel_details(facts(spark, sf_dir, FACT_COLUMNS), AS_OF, RULES)
    return details.agg(
        F.count("update_date").alias("stamped"),
        (F.min("update_date") == F.max("update_date")).alias("same"),
    )


# --- pipelines ---


@query
def clean_channel_facts(spark, sf_dir):
    feed, master = facts(spark, sf_dir, CHANNEL_FEED), channel_master(spark, sf_dir, lower=True)
    return cleaning.clean_channel_facts(feed, master, AS_OF)


@query
def clean_channel_facts_options(spark, sf_dir):
    feed, master = facts(spark, sf_dir, {**CHANNEL_FEED, "shr%": "spotty%"}), channel_master(spark, sf_dir)
    settings = CleanSettings(
        numbers="lenient", python_numbers=True, ignore_case=True, normalise_key=True, unique_master=True
    )
    return cleaning.clean_channel_facts(feed, master, AS_OF, settings)


@query
def clean_genre_facts(spark, sf_dir):
    feed, master = facts(spark, sf_dir, GENRE_FEED), channel_master(spark, sf_dir)
    return cleaning.clean_genre_facts(feed, master)


@query
def clean_genre_facts_options(spark, sf_dir):
    feed, master = facts(spark, sf_dir, GENRE_FEED), channel_master(spark, sf_dir, lower=True)
    settings = CleanSettings(drop_zero=True, slice_genre=True, normalise_key=True)
    return cleaning.clean_genre_facts(feed, master, settings, AS_OF)


NETWORK_COLUMNS = ("network", "network1", "regions", "targets", "year_of_week", "week_no", "share_pct")
GENRE_COLUMNS = ("network", "network1", "regions", "year_of_week", "week_no", "share_pct")
DETAIL_COLUMNS = (
    "network", "channel", "genre_fta_pay", "regions", "targets", "year_of_week", "week_no", "grp",
)


def network_mart(asof=AS_OF, settings=MartSettings(), named=False) -> Query:
    return _mart(marts.network_share, NETWORK_COLUMNS, asof, settings, named)


def genre_mart(asof=AS_OF, settings=MartSettings(), named=False, rules=None) -> Query:
    return _mart(marts.genre_share, GENRE_COLUMNS, asof, settings, named, rules)


def details_mart(asof=AS_OF, settings=MartSettings(), named=False) -> Query:
    mart = _mart(marts.channel_details, DETAIL_COLUMNS, asof, settings, named)
    return lambda spark, sf_dir: mart(spark, sf_dir).drop("update_date")


def _mart(build, columns, asof, settings, named, rules=None) -> Query:
    """``named`` uses the default rules, over facts whose keys are mapped to names those rules know."""
    source = {column: NAMED_FACTS[column] if named else column for column in columns}
    rules = rules or (DEFAULT_RULES if named else RULES)
    return lambda spark, sf_dir: build(facts(spark, sf_dir, source), asof, rules, settings)


def _changed(build, columns, name, when, value) -> Query:
    """A mart over facts with another value of one measure in some rows."""

    def mart(spark, sf_dir):
        rows = facts(spark, sf_dir, columns)
        return build(rows.withColumn(name, F.when(F.expr(when), F.lit(value)).otherwise(F.col(name))), AS_OF, RULES)

    return mart


def _from_sums(sums, build, columns, weeks_first) -> Query:
    """A mart over sums kept by week, one week of which is first written wrong and then replaced."""

    def mart(spark, sf_dir):
        kept = sums(facts(spark, sf_dir, columns), RULES)
        base = new_folder(spark, "sums")
        wrong = F.when((F.col("year_of_week") == AS_OF.year) & (F.col("week_no") == AS_OF.week), F.col(weeks_first) * 2)
        sinks.write_periods(kept.withColumn(weeks_first, F.coalesce(wrong, weeks_first)), base)
        one_week = kept.where((F.col("year_of_week") == AS_OF.year) & (F.col("week_no") == AS_OF.week))
        sinks.write_periods(one_week, base)
        return build(open_table(spark, base, kept.schema), AS_OF, RULES)

    return mart


QUERIES["network_share_from_sums"] = _from_sums(marts.network_sums, marts.network_share_from_sums, NETWORK_COLUMNS, "share_pct")
QUERIES["genre_share_from_sums"] = _from_sums(marts.genre_sums, marts.genre_share_from_sums, GENRE_COLUMNS, "share_pct")


@query
def channel_details_from_sums(spark, sf_dir):
    mart = _from_sums(marts.detail_sums, marts.channel_details_from_sums, DETAIL_COLUMNS, "grp")
    return mart(spark, sf_dir).drop("update_date")


# Fixed inputs of the keys below: which rows are changed.
NAN_ROWS = "regions = 'ASIA' and week_no = 39"
ZERO_ROWS = "regions = 'EUROPE' and week_no = 40"
NULL_ROWS = "targets = 'BUILDING' and week_no <> 40 or regions = 'ASIA'"

QUERIES["genre_share_nan"] = _changed(marts.genre_share, GENRE_COLUMNS, "share_pct", NAN_ROWS, float("nan"))
QUERIES["genre_share_zero_total"] = _changed(marts.genre_share, GENRE_COLUMNS, "share_pct", ZERO_ROWS, 0.0)


@query
def channel_details_nulls(spark, sf_dir):
    mart = _changed(marts.channel_details, DETAIL_COLUMNS, "grp", NULL_ROWS, None)
    return mart(spark, sf_dir).drop("update_date")


@query
def check_schema(spark, sf_dir):
    """A mart that has its declared columns passes unchanged."""
    return checks.check_schema(network_share(spark, sf_dir), schemas.NETWORK_SHARE)


network_share = network_mart()
genre_share = genre_mart()
channel_details = details_mart()

MARTS = {"network_share": network_mart, "genre_share": genre_mart, "channel_details": details_mart}
# name suffix -> arguments of the mart builders
VARIANTS = {
    "": {},
    "_1998w05": {"asof": AsOf(1998, 5)},  # year to date is open above
    "_1998w52": {"asof": AsOf(1998, 52)},
    "_1999w00": {"asof": AsOf(1999, 0)},  # what a run in week 1 asks for
    "_1999w01": {"asof": AsOf(1999, 1)},  # same index as 1998-W53
    "_1999w03": {"asof": AsOf(1999, 3)},
    "_1999w03_iso": {"asof": AsOf(1999, 3), "settings": MartSettings(calendar="iso")},
    "_closed_ytd": {"settings": MartSettings(ytd_upper="asof")},
    "_pruned": {"asof": AsOf(2000, 20), "settings": MartSettings(prune_history=True)},
    "_named": {"named": True},
    "_named_1999w01": {"asof": AsOf(1999, 1), "named": True},
}
for _mart_name, _builder in MARTS.items():
    for _suffix, _arguments in VARIANTS.items():
        QUERIES[_mart_name + _suffix] = _builder(**_arguments)
QUERIES["genre_share_open"] = genre_mart(rules=OPEN_RULES)


@query
def weekly_run(spark, sf_dir):
    """Both jobs for one week: raw feeds and master in, clean facts, and the three marts as written."""
    base = new_folder(spark, "weekly")
    facts(spark, sf_dir, {**CHANNEL_FEED, "rat%": "shr%"}).write.parquet(f"{base}/channel-feed")
    facts(spark, sf_dir, {**GENRE_FEED, "shr%": "shr%"}).write.parquet(f"{base}/genre-feed")
    channel_master(spark, sf_dir).write.parquet(f"{base}/master")
    jobs.clean(
        spark,
        AS_OF,
        channel_feed=f"{base}/channel-feed",
        genre_feed=f"{base}/genre-feed",
        master=f"{base}/master",
        output=base,
    )
    jobs.build_marts(
        spark,
        AS_OF,
        channel_facts=f"{base}/{jobs.CHANNEL_FACTS}",
        genre_facts=f"{base}/{jobs.GENRE_FACTS}",
        output=base,
        rules=RULES,
    )

    def written(name, schema, mart, label, measures, *places):
        columns = [F.lit(mart).alias("mart"), label.alias("name")]
        columns += [place.alias(name) for place, name in zip(places or (F.lit(None),) * 2, ("market", "demography"))]
        columns += ["rank", *[F.col(m).alias(n) for m, n in zip(measures, ("current", "trailing", "year"))]]
        return open_table(spark, f"{base}/{name}", schema).select(*columns)

    shares = ("mkt_share_cw", "share_l4w", "share_ytd")
    name = F.concat_ws("/", "network", "channel", "genre")
    return (
        written(jobs.NETWORK_SHARE, schemas.NETWORK_SHARE, "network", F.col("network"), shares)
        .unionByName(written(jobs.GENRE_SHARE, schemas.GENRE_SHARE, "genre", F.col("network"), shares))
        .unionByName(
            written(
                jobs.CHANNEL_DETAILS, schemas.CHANNEL_DETAILS, "details", name, ("grp", "grp_l4w", "grp_ytd"),
                F.col("market"), F.col("demography"),
            )
        )
    )
