"""The same questions in SQL, for DuckDB over the same tables. Written against the meaning, not the Spark code."""

from __future__ import annotations

from parity.queries import AS_OF, EVENTS_AS_OF, MARTS, NAN_ROWS, NULL_ROWS, VARIANTS, ZERO_ROWS
from parity.stand_in import CHANNEL_NAMES, NETWORK_NAMES, OPEN_RULES, RULES
from sharemill import DEFAULT_RULES, AsOf, MartSettings, RollUp, Rules


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_text(value) for value in values)


# Every column of the stand-in, in one wide view of the line items.
WIDE = f"""
select l_orderkey, l_linenumber, l_extendedprice, l_discount, l_tax, l_quantity as grp, l_quantity as share_pct,
  isoyear(l_shipdate) as year_of_week, weekofyear(l_shipdate) as week_no,
  format('{{:,.2f}}', l_extendedprice) as "rat%", format('{{:,.2f}}', l_quantity) as "shr%",
  format('{{:,.2f}}', l_tax) as "tax%",
  case when l_returnflag = 'R' then 'n/a' else format('{{:,.2f}}', l_extendedprice) end as "spotty%",
  cast(isoyear(l_shipdate) as varchar) as year_text, cast(weekofyear(l_shipdate) as varchar) as week_text,
  lpad(cast(weekofyear(l_shipdate) as varchar), 2, '0') as week_padded,
  cast(weekofyear(o_orderdate) as varchar) as order_week,
  p_brand as channel, p_type as genre, p_type as genre_fta_pay,
  case when p_size < 5 then p_brand || '(na)' when p_size between 5 and 9 then p_brand || '(NA)' else p_brand end
    as marked_channel,
  case when p_size < 25 then lower(list_extract([{_list(CHANNEL_NAMES)}], p_partkey % {len(CHANNEL_NAMES)} + 1))
    else ' ' || list_extract([{_list(CHANNEL_NAMES)}], p_partkey % {len(CHANNEL_NAMES)} + 1) || '  ' end
    as named_channel,
  case when p_type = 'PROMO' then 'Sports' else p_type end as named_genre_fta_pay,
  cr.r_name as regions, c_mktsegment as targets,
  case when cr.r_name = 'ASIA' then 'India' else cr.r_name end as named_regions,
  case when c_mktsegment = 'BUILDING' then 'Universe' else c_mktsegment end as named_targets,
  sn.n_name as network, sr.r_name as network1, '  ' || sn.n_name || ' ' as padded_network,
  list_extract([{_list(NETWORK_NAMES)}], s_nationkey + 1) as named_network,
  case when sr.r_name = 'EUROPE' then 'Star' else sr.r_name end as named_network1
from lineitem
join part on l_partkey = p_partkey
join supplier on l_suppkey = s_suppkey
join nation sn on s_nationkey = sn.n_nationkey
join region sr on sn.n_regionkey = sr.r_regionkey
join orders on l_orderkey = o_orderkey
join customer on o_custkey = c_custkey
join nation cn on c_nationkey = cn.n_nationkey
join region cr on cn.n_regionkey = cr.r_regionkey
"""

MASTER = """
select p_brand as channel, n_name as network, r_name as network1, min(p_type) as genre,
  max(p_type) as genre_fta_pay, r_name as genre_lang, min(p_type) as genre_consl, max(p_type) as genre_movie_others,
  max(p_name) as language
from part
join nation on n_nationkey = cast(regexp_extract(p_brand, '([0-9]+)$', 1) as integer) - 1
join region on n_regionkey = r_regionkey
group by p_brand, n_name, r_name
"""

ATTRIBUTES = "network, network1, genre, genre_fta_pay, genre_lang, genre_consl, genre_movie_others, language"
M_ATTRIBUTES = ", ".join("m." + name for name in ATTRIBUTES.split(", "))


def wide(select: str, rest: str = "") -> str:
    return f"with wide as ({WIDE}) select {select} from wide {rest}"


def _case(column: str, labels) -> str:
    whens = " ".join(f"when upper({column}) like {_text(pattern)} then {_text(label)}" for pattern, label in labels)
    return f"(case {whens} else {column} end)"


def _owner(rules: Rules, network: str = "network", network1: str = "network1") -> str:
    return f"(case when {network1} = {_text(rules.parent)} then {network1} else {network} end)"


def _roll_up(rule: RollUp, channel: str = "channel", genre: str = "genre_fta_pay") -> str:
    whens = " ".join(f"when upper({channel}) in ({_list(names)}) then {_text(label)}" for label, names in rule.labels)
    return (
        f"(case when upper({genre}) = {_text(rule.genre)} then (case {whens} else {_text(rule.otherwise)} end) "
        f"else {channel} end)"
    )


def _bucket(rules: Rules, channel: str = "channel") -> str:
    whens = " ".join(f"when upper({channel}) in ({_list(names)}) then {code}" for code, names in rules.buckets.items())
    return f"cast(case {whens} end as integer)"


def _index(calendar: str = "compat", year: str = "year_of_week", week: str = "week_no") -> str:
    if calendar == "compat":
        return f"cast(52 * {year} + {week} as integer)"
    # Monday of the week that holds 4 January, plus whole weeks
    monday = f"date_trunc('week', make_date({year}, 1, 4)) + to_days(cast(7 * ({week} - 1) as integer))"
    return f"cast(date_diff('day', date '1970-01-05', cast({monday} as date)) // 7 as integer)"


def _bounds(asof: AsOf, settings: MartSettings) -> dict[str, str]:
    def at(year: int, week: int) -> str:
        return _index(settings.calendar, str(year), str(week))

    now = at(asof.year, asof.week)
    year_start = at(asof.year, settings.ytd_week)
    upper = f" and period <= {now}" if settings.ytd_upper == "asof" else ""
    return {
        "current": f"period = {now}",
        "trailing": f"period between {now} - {settings.trailing} and {now} - 1",
        "year": f"period >= {year_start}{upper}",
    }


def _averages(asof: AsOf, settings: MartSettings, measures: dict[str, tuple[str, str]]) -> str:
    """Exact decimal averages; DuckDB's own avg of a decimal is a double."""
    bounds = _bounds(asof, settings)
    return ", ".join(
        f"cast(avg(case when {bounds[window]} then cast({value} as decimal(18,7)) end) as decimal(22,11)) as {name}"
        for name, (window, value) in measures.items()
    )


def _needed(asof: AsOf, settings: MartSettings) -> str:
    if not settings.prune_history:
        return "true"
    bounds = _bounds(asof, settings)
    return " or ".join(f"({test})" for test in bounds.values())


def _cut(value: str) -> str:
    return f"(cast(floor(cast({value} as decimal(38,11)) * 1000000) as double) / 1000000)"


def _pivot(source: str, keys: str, asof: AsOf = AS_OF, settings: MartSettings = MartSettings()) -> str:
    share = "share_pct"
    averages = _averages(
        asof, settings, {"cw": ("current", share), "l4w": ("trailing", share), "ytd": ("year", share)}
    )
    return f"select {keys}, {averages} from ({source}) w group by {keys}"


def _facts(named: bool, columns: str) -> str:
    """The fact columns with either vocabulary, names trimmed as the marts do."""
    prefix = "named_" if named else ""
    sources = {
        "network": f"trim({prefix}network, ' ')",
        "network1": f"{prefix}network1",
        "channel": f"trim({prefix}channel, ' ')",
        "genre_fta_pay": f"{prefix}genre_fta_pay",
        "regions": f"trim({prefix}regions, ' ')",
        "targets": f"trim({prefix}targets, ' ')",
    }
    chosen = ", ".join(f"{sources.get(name, name)} as {name}" for name in columns.split(", "))
    return f"select {chosen} from ({WIDE}) wide"


def network_share(
    asof: AsOf = AS_OF, settings: MartSettings = MartSettings(), named: bool = False, source: str | None = None
) -> str:
    """``source`` is SQL giving the clean facts; without it they come from the test tables."""
    rules = DEFAULT_RULES if named else RULES
    columns = "network, network1, regions, targets, year_of_week, week_no, share_pct"
    measures = {
        "cw": ("current", "share_pct"), "l4w": ("trailing", "share_pct"), "ytd": ("year", "share_pct"),
    }
    universe = " and ".join(f"{column} = {_text(value)}" for column, value in rules.universe.items())
    return f"""
with facts as ({source or _facts(named, columns)}),
by_network as (
  select {_owner(rules)} as network, week_no, year_of_week, {_index(settings.calendar)} as period,
    sum(share_pct) as share_pct
  from facts where {universe} group by all),
by_label as (
  select {_case("network", rules.network_labels)} as network, period, sum(share_pct) as share_pct
  from by_network where {_needed(asof, settings)} group by 1, 2),
pivoted as (select network, {_averages(asof, settings, measures)} from by_label group by network),
kept as (select * from pivoted where upper(network) in ({_list(rules.kept_labels)}))
select network, cast({asof.week} as integer) as week_no, cast(rank() over (order by cw desc nulls last) as integer) as rank,
  {_cut("cw")} as mkt_share_cw, {_cut("coalesce(l4w, 0)")} as share_l4w, {_cut("ytd")} as share_ytd
from kept"""


def genre_share(
    asof: AsOf = AS_OF,
    settings: MartSettings = MartSettings(),
    named: bool = False,
    rules: Rules | None = None,
    source: str | None = None,
) -> str:
    rules = rules or (DEFAULT_RULES if named else RULES)
    columns = "network, network1, regions, year_of_week, week_no, share_pct"
    measures = {
        "cw": ("current", "share_pct * 100 / nullif(total_pct, 0)"),
        "l4w": ("trailing", "share_pct"),
        "ytd": ("year", "share_pct"),
    }
    prefixes = " or ".join(f"upper(network) like {_text(prefix + '%')}" for prefix in rules.kept_prefixes)
    return f"""
with facts as ({source or _facts(named, columns)}),
by_region as (
  select regions, {_owner(rules)} as network, {_index(settings.calendar)} as period, sum(share_pct) as share_pct
  from facts group by all),
with_total as (
  select *, sum(share_pct) over (partition by regions, period) as total_pct
  from by_region where {_needed(asof, settings)}),
complete as (
  select * from with_total
  where regions is not null and network is not null and period is not null and share_pct is not null
    and total_pct is not null and not isnan(share_pct) and not isnan(total_pct)),
pivoted as (
  select {_case("network", rules.genre_labels)} as network, {_averages(asof, settings, measures)}
  from complete group by 1),
normalised as (
  select network, cw, cast(l4w * 100 / nullif(sum(l4w) over (), 0) as decimal(18,7)) as l4w,
    cast(ytd * 100 / nullif(sum(ytd) over (), 0) as decimal(18,7)) as ytd
  from pivoted)
select network, cast(rank() over (order by cw desc nulls last) as integer) as rank,
  {_cut("cw")} as mkt_share_cw, {_cut("l4w")} as share_l4w, {_cut("ytd")} as share_ytd
from normalised where {prefixes}"""


def channel_details(
    asof: AsOf = AS_OF, settings: MartSettings = MartSettings(), named: bool = False, source: str | None = None
) -> str:
    rules = DEFAULT_RULES if named else RULES
    columns = "network, channel, genre_fta_pay, regions, targets, year_of_week, week_no, grp"
    bounds = _bounds(asof, settings)
    return f"""
with facts as ({source or _facts(named, columns)}),
weekly as (
  select network, {_roll_up(rules.roll_up)} as channel, genre_fta_pay as genre, regions as market,
    targets as demography, {_index(settings.calendar)} as period, sum(grp) as grp
  from facts where upper(channel) in ({_list(rules.members)}) group by all),
pivoted as (
  select network, channel, genre, market, demography,
    avg(case when {bounds["current"]} then grp end) as grp,
    avg(case when {bounds["trailing"]} then grp end) as grp_l4w,
    avg(case when {bounds["year"]} then grp end) as grp_ytd
  from weekly where {_needed(asof, settings)} group by all),
ranked as (
  select *, rank() over (partition by {_bucket(rules)}, market, demography order by grp desc nulls last) as rank
  from pivoted)
select network, channel, genre, market, demography, cast(rank as integer) as rank,
  cast({asof.week} as integer) as week_no,
  {_cut("cast(coalesce(grp_ytd, 0) as decimal(18,7))")} as grp_ytd,
  {_cut("cast(coalesce(grp, 0) as decimal(18,7))")} as grp,
  {_cut("cast(coalesce(grp_l4w, 0) as decimal(18,7))")} as grp_l4w
from ranked"""


def _number(column: str) -> str:
    return f"cast(replace({column}, ',', '') as double)"


def _number_or_null(column: str) -> str:
    return f"try_cast(replace({column}, ',', '') as double)"


NAMED_CHANNEL = "trim(named_channel, ' ') as channel, named_genre_fta_pay as genre_fta_pay"
NAMED_LABEL = _roll_up(DEFAULT_RULES.roll_up, "trim(named_channel, ' ')", "named_genre_fta_pay")
UNIVERSE = "where targets = 'BUILDING' and regions = 'ASIA'"
OWNER = _owner(RULES)
ONE_WEEK = f"where year_of_week = {AS_OF.year} and week_no = {AS_OF.week}"

BY_NETWORK = wide(
    f"{OWNER} as network, week_no, year_of_week, sum(share_pct) as share_pct", f"{UNIVERSE} group by 1, 2, 3"
)


def _by_group(calendar: str = "compat") -> str:
    return (
        f"select {_case('network', RULES.network_labels)} as network, {_index(calendar)} as period, "
        f"sum(share_pct) as share_pct from ({BY_NETWORK}) a group by 1, 2"
    )


BY_REGION = wide(
    f"regions, {OWNER} as network, {_index()} as period, sum(share_pct) as share_pct", "group by 1, 2, 3"
)
WITH_TOTAL = f"select *, sum(share_pct) over (partition by regions, period) as total_pct from ({BY_REGION}) r"
EXACT = "cast(l_extendedprice / 7 as decimal(18,7))"
ENRICHED = f"""
with wide as ({WIDE}), master as ({MASTER})
select l_orderkey, l_linenumber, marked_channel as channel, share_pct, {M_ATTRIBUTES}
from wide left join master m on marked_channel = m.channel"""


def _clean_channel(share: str, master_condition: str, kept: str, grp: str = '"rat%"') -> str:
    return f"""
with wide as ({WIDE}), master as ({MASTER})
select marked_channel as channel, cast(week_padded as bigint) as week_no, targets, regions,
  {_number(grp)} as grp, {share} as share_pct, cast(year_text as bigint) as year_of_week, {M_ATTRIBUTES}
from wide left join master m on {master_condition}
where year_text = '{AS_OF.year}' and week_text = '{AS_OF.week}' and {kept}"""


def _clean_genre(kept: str, master_condition: str, share: str = '"tax%"') -> str:
    return f"""
with wide as ({WIDE}), master as ({MASTER})
select marked_channel as channel, week_text as week_no, regions, {_number(share)} as share_pct,
  cast(year_text as bigint) as year_of_week, {M_ATTRIBUTES}
from wide left join master m on {master_condition}
where {kept}"""


def _weekly_run() -> str:
    kept = "not (marked_channel like '%(na)%')"
    share = '"shr%"'
    channels = _clean_channel(_number(share), "upper(marked_channel) = upper(m.channel)", kept, grp=share)
    genres = _clean_genre(kept, "marked_channel = m.channel", share)
    genres = f"select * replace (cast(week_no as bigint) as week_no) from ({genres}) g"
    measures = "mkt_share_cw as current, share_l4w as trailing, share_ytd as year"
    return f"""
select 'network' as mart, network as name, null as market, null as demography, rank, {measures}
from ({network_share(source=channels)}) n
union all
select 'genre', network, null, null, rank, {measures} from ({genre_share(source=genres)}) g
union all
select 'details', network || '/' || channel || '/' || genre, market, demography, rank, grp, grp_l4w, grp_ytd
from ({channel_details(source=channels)}) d"""


ORACLE: dict[str, str] = {
    "scan_facts": wide(
        "l_orderkey, l_linenumber, channel, network, network1, genre, genre_fta_pay, regions, targets, year_of_week, "
        "week_no, grp, share_pct"
    ),
    "period_slice": wide(
        "l_orderkey, l_linenumber, marked_channel as channel, year_text as year_of_week, week_text as week_no",
        f"where year_text = '{AS_OF.year}' and week_text = '{AS_OF.week}'",
    ),
    "partition_sink": wide(
        'cast(year_of_week as integer) as "P_YEAR_OF_WEEK", cast(week_no as integer) as "P_WEEK_NO", channel, '
        f"count(*) as n, sum(case when year_of_week = {AS_OF.year} and week_no = {AS_OF.week} then 2 else 1 end "
        "* share_pct) as share_pct",
        "group by 1, 2, 3",
    ),
    "period_sink": wide(
        "l_orderkey, l_linenumber, channel, share_pct, year_of_week, week_no, "
        f'cast({AS_OF.year} as integer) as "P_YEAR_OF_WEEK", cast({AS_OF.week} as integer) as "P_WEEK_NO"',
        ONE_WEEK,
    ),
    "snapshot_sink": (
        f'select *, cast(0 as integer) as "P_YEAR_OF_WEEK", cast(0 as integer) as "P_WEEK_NO" from ({network_share()}) s'
    ),
    "clean_numeric": wide(
        f"""l_orderkey, l_linenumber, {_number('"rat%"')} as grp, {_number('"shr%"')} as share_pct"""
    ),
    "clean_numeric_lenient": wide(f"""l_orderkey, l_linenumber, {_number_or_null('"spotty%"')} as share_pct"""),
    "clean_numeric_guarded": wide(
        f"""l_orderkey, l_linenumber, cast(null as double) as guarded, {_number_or_null('"spotty%"')} as share_pct"""
    ),
    "rejected_rows": wide(
        'l_orderkey, l_linenumber, marked_channel as channel, "rat%", "spotty%"',
        f"""where ({_number_or_null('"rat%"')} is null or {_number_or_null('"spotty%"')} is null)
          and not (marked_channel like '%(na)%')""",
    ),
    "cast_period": wide(
        "l_orderkey, l_linenumber, cast(year_text as bigint) as year_of_week, cast(week_padded as bigint) as week_no"
    ),
    "project_rename": wide(
        "l_orderkey as order_id, l_linenumber as line, channel as channel_temp, week_no as week, regions as market"
    ),
    "drop_columns": wide("l_orderkey, l_linenumber, channel"),
    "trim_dims": wide(
        "l_orderkey, l_linenumber, trim(padded_network, ' ') as padded_network, trim(named_channel, ' ') as named_channel"
    ),
    "parent_override": wide(f"l_orderkey, l_linenumber, network, network1, {OWNER} as owner"),
    "classify_prefix": wide(
        "l_orderkey, l_linenumber, named_network as network, "
        f"{_case('named_network', DEFAULT_RULES.network_labels)} as label"
    ),
    "classify_prefix_wide": wide(
        "l_orderkey, l_linenumber, named_network as network, "
        f"{_case('named_network', DEFAULT_RULES.genre_labels)} as label"
    ),
    "rollup_members": wide(f"l_orderkey, l_linenumber, {NAMED_CHANNEL}, {NAMED_LABEL} as label"),
    "bucket_lookup": wide(
        f"l_orderkey, l_linenumber, {NAMED_CHANNEL}, {_bucket(DEFAULT_RULES, NAMED_LABEL)} as group_ch"
    ),
    "period_index": wide(f"l_orderkey, l_linenumber, year_of_week, week_no, {_index()} as period"),
    "period_index_iso": wide(f"l_orderkey, l_linenumber, year_of_week, week_no, {_index('iso')} as period"),
    "fixed_point": wide("l_orderkey, l_linenumber, cast(l_extendedprice * l_discount as decimal(18,7)) as fixed"),
    "truncate6": wide(f"l_orderkey, l_linenumber, {_cut(EXACT)} as up, {_cut('-' + EXACT)} as down"),
    "filter_eq": wide("l_orderkey, l_linenumber, targets, regions", UNIVERSE),
    "filter_eq_trimmed": wide("l_orderkey, l_linenumber, padded_network", "where trim(padded_network, ' ') = 'NATION_1'"),
    "exclude_like": wide("l_orderkey, l_linenumber, marked_channel", "where not (marked_channel like '%(na)%')"),
    "exclude_like_any_case": wide(
        "l_orderkey, l_linenumber, marked_channel", "where not (lower(marked_channel) like '%(na)%')"
    ),
    "exclude_zero": wide("l_orderkey, l_linenumber, l_tax as share_pct"),
    "exclude_zero_number": wide("l_orderkey, l_linenumber, l_tax as share_pct", "where l_tax <> 0"),
    "whitelist_semi": wide(
        f"l_orderkey, l_linenumber, {NAMED_CHANNEL}",
        f"where upper(trim(named_channel, ' ')) in ({_list(DEFAULT_RULES.members)})",
    ),
    "whitelist_table": wide(
        "l_orderkey, l_linenumber, channel",
        "where channel in (select p_brand from part where p_type = 'PROMO' and p_size < 3)",
    ),
    "drop_any_null": f"select * from ({ENRICHED}) e where network is not null",
    "enrich_exact": ENRICHED,
    "enrich_ci": ENRICHED.replace("marked_channel = m.channel", "upper(marked_channel) = upper(m.channel)"),
    "enrich_normalised": f"""
with wide as ({WIDE}), master as ({MASTER})
select l_orderkey, l_linenumber, ' ' || upper(wide.channel) || '  ' as channel, {M_ATTRIBUTES}
from wide left join master m on wide.channel = m.channel""",
    "sum_by_network": BY_NETWORK,
    "resum_by_group": _by_group(),
    "sum_by_region": BY_REGION,
    "sum_by_channel": wide(
        f"network, {_roll_up(RULES.roll_up)} as channel, genre_fta_pay, regions, targets, {_index()} as period, "
        "sum(grp) as grp",
        f"where upper(channel) in ({_list(RULES.members)}) group by 1, 2, 3, 4, 5, 6",
    ),
    "period_pivot": _pivot(_by_group(), "network"),
    "period_pivot_closed_ytd": _pivot(_by_group(), "network", settings=MartSettings(ytd_upper="asof")),
    "period_pivot_iso": _pivot(_by_group("iso"), "network", AsOf(1999, 3), MartSettings(calendar="iso")),
    "period_pivot_no_ytd": _pivot(
        f"select event_type, {_index('compat', 'isoyear(ts)', 'weekofyear(ts)')} as period, "
        "sum(cast(value as decimal(18,2))) as share_pct from events group by 1, 2",
        "event_type",
        EVENTS_AS_OF,
    ),
    "null_to_zero": f"select network, coalesce(cw, 0) as cw, l4w from ({_pivot(_by_group(), 'network')}) p",
    "check_total": f"select cast(sum(cast(share_ytd as decimal(18,6))) as decimal(28,6)) as sum_share_ytd from ({genre_share()}) g",
    "check_count": f"select count(*) as rows from ({channel_details()}) d",
    "partition_total": WITH_TOTAL,
    "share_of_total": (
        "select regions, network, period, cast(share_pct * 100 / nullif(total_pct, 0) as decimal(18,7)) as share "
        f"from ({WITH_TOTAL}) t"
    ),
    "normalise_100": (
        "select network, cw, cast(l4w * 100 / nullif(sum(l4w) over (), 0) as decimal(18,7)) as l4w, "
        "cast(ytd * 100 / nullif(sum(ytd) over (), 0) as decimal(18,7)) as ytd from ("
        + _pivot(wide(f"network, {_index()} as period, sum(share_pct) as share_pct", "group by 1, 2"), "network")
        + ") p"
    ),
    "rank_global": (
        "select *, cast(rank() over (order by share_pct desc nulls last) as integer) as rank from ("
        + wide("network, channel, targets, sum(share_pct) as share_pct", "group by 1, 2, 3")
        + ") s"
    ),
    "rank_rows": wide(
        "l_orderkey, l_linenumber, genre, share_pct, "
        "cast(rank() over (partition by genre order by share_pct desc nulls last) as integer) as rank"
    ),
    "rank_all_rows": wide(
        "l_orderkey, l_linenumber, l_extendedprice, "
        "cast(rank() over (order by l_extendedprice desc nulls last) as integer) as rank"
    ),
    "rank_bounded": (
        "select *, cast(rank() over (order by share_pct desc nulls last) as integer) as rank from ("
        + wide("regions, sum(share_pct) as share_pct", "where regions in ('ASIA', 'EUROPE', 'AFRICA') group by 1")
        + ") s"
    ),
    "rank_partitioned": (
        "select *, cast(rank() over (partition by bucket, regions order by share_pct desc nulls last) as integer) "
        "as rank from ("
        + wide(
            f"network, channel, genre, regions, sum(share_pct) as share_pct, {_bucket(RULES)} as bucket",
            "group by 1, 2, 3, 4",
        )
        + ") s"
    ),
    "preview": wide(
        "l_orderkey, l_linenumber, channel, share_pct", "order by share_pct desc, l_orderkey, l_linenumber limit 20"
    ),
    "master_duplicates": "select upper(p_name) as key, count(*) as n from part group by 1 having count(*) > 1",
    "disagreeing_weeks": wide(
        "l_orderkey, l_linenumber, week_padded as week, order_week as week_no",
        "where cast(week_padded as bigint) <> cast(order_week as bigint)",
    ),
    "audit_stamp": f"select count(*) as stamped, true as same from ({channel_details()}) d",
    "clean_channel_facts": _clean_channel(
        _number('"shr%"'), "upper(marked_channel) = upper(m.channel)", "not (marked_channel like '%(na)%')"
    ),
    "clean_channel_facts_options": _clean_channel(
        _number_or_null('"spotty%"'),
        "upper(marked_channel) = upper(m.channel)",
        "not (lower(marked_channel) like '%(na)%')",
    ),
    "clean_genre_facts": _clean_genre("not (marked_channel like '%(na)%')", "marked_channel = m.channel"),
    "clean_genre_facts_options": _clean_genre(
        f"not (marked_channel like '%(na)%') and l_tax <> 0 and year_text = '{AS_OF.year}' "
        f"and week_text = '{AS_OF.week}'",
        "upper(marked_channel) = upper(m.channel)",
    ),
}

ORACLE["keep_groups"] = (
    f"select * from ({ORACLE['classify_prefix']}) c where upper(label) in ({_list(DEFAULT_RULES.kept_labels)})"
)
ORACLE["keep_prefixes"] = f"select * from ({ORACLE['classify_prefix_wide']}) c where " + " or ".join(
    f"upper(label) like {_text(prefix + '%')}" for prefix in DEFAULT_RULES.kept_prefixes
)

_MART_SQL = {"network_share": network_share, "genre_share": genre_share, "channel_details": channel_details}
for _mart in MARTS:
    for _suffix, _arguments in VARIANTS.items():
        ORACLE[_mart + _suffix] = _MART_SQL[_mart](**_arguments)
ORACLE["weekly_run"] = _weekly_run()


def _changed(columns: str, name: str, when: str, value: str) -> str:
    return f"select * replace (case when {when} then {value} else {name} end as {name}) from ({_facts(False, columns)}) f"


_GENRE = "network, network1, regions, year_of_week, week_no, share_pct"
_DETAILS = "network, channel, genre_fta_pay, regions, targets, year_of_week, week_no, grp"
ORACLE["genre_share_nan"] = genre_share(source=_changed(_GENRE, "share_pct", NAN_ROWS, "cast('nan' as double)"))
ORACLE["genre_share_zero_total"] = genre_share(source=_changed(_GENRE, "share_pct", ZERO_ROWS, "0"))
ORACLE["channel_details_nulls"] = channel_details(source=_changed(_DETAILS, "grp", NULL_ROWS, "null"))
ORACLE["check_schema"] = network_share()
ORACLE["network_share_from_sums"] = network_share()
ORACLE["genre_share_from_sums"] = genre_share()
ORACLE["channel_details_from_sums"] = channel_details()
ORACLE["clean_numeric_underscores"] = wide("""l_orderkey, l_linenumber, cast(replace("rat%", ',', '') as double) as grp""")
ORACLE["enrich_fan_out"] = ORACLE["enrich_ci"].replace(
    f"({MASTER})", f"(from ({MASTER}) union all select * replace (lower(channel) as channel, 'again' as network) from ({MASTER}))"
)
ORACLE["genre_share_open"] = genre_share(rules=OPEN_RULES)

ORACLE["classify_table"] = """
with rules as (
  select s_suppkey as position, s_name as label,
    case s_suppkey % 4
      when 1 then 'CUSTOMER#0%' || lpad(cast(s_suppkey % 997 % 100 as varchar), 2, '0')
      when 2 then 'CUST_MER#000000' || lpad(cast(s_suppkey % 997 as varchar), 3, '0')
      else 'CUSTOMER#' || lpad(cast(s_suppkey % 997 as varchar), 8, '0') || '%' end as pattern
  from supplier
), labels as (
  select c_custkey, any_value(c_name) as c_name, min_by(label, position) as label
  from customer left join rules on upper(c_name) like pattern group by c_custkey
)
select o_orderkey, coalesce(label, c_name) as label from orders join labels on o_custkey = c_custkey
"""

ORACLE["bucket_table"] = """
with members as (select upper(p_name) as name, min(p_size) as bucket from part where p_size > 3 group by 1)
select l_orderkey, l_linenumber, bucket from lineitem join part on l_partkey = p_partkey left join members on upper(p_name) = name
"""

ORACLE["as_of_weeks"] = """
select distinct cast(o_orderdate as date) as day, cast(isoyear(o_orderdate) as integer) as asof_year,
  cast(weekofyear(o_orderdate) - 1 as integer) as asof_week, cast(isoyear(o_orderdate - interval 7 day) as integer) as previous_year,
  cast(weekofyear(o_orderdate - interval 7 day) as integer) as previous_week
from orders
"""
