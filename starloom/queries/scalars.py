"""Scalar functions on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arith, keys, scores, standard, text, times, urls
from ..operators.generate import date_spine, series
from .courses import sql_duration, sql_duration_band, sql_language, sql_level, sql_price_band, sql_price_model
from .registry import query, r, table


def scalar(
    name: str, source: str, key: list[str], columns: dict[str, tuple[Callable[[], Column], str]],
    prepare: dict[str, str] | None = None,
) -> None:
    """Register a projection: key columns and computed ones, each with its SQL.

    ``prepare`` derives input columns by expressions that read the same in both engines.
    """
    derived = ", ".join(["*", *[f"{e} as {c}" for c, e in (prepare or {}).items()]])
    computed = ", ".join(f"{sql} as {c}" for c, (_, sql) in columns.items())

    @query(name, f"select {', '.join(key)}, {computed} from (select {derived} from {source}) as t")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = table(spark, sf_dir, source)
        if prepare:
            df = df.selectExpr("*", *[f"{e} as {c}" for c, e in prepare.items()])
        return df.select(*key, *[build().alias(c) for c, (build, _) in columns.items()])


scalar(
    "sc_1_standardize_language", "documents", ["doc_id"],
    {
        "language": (lambda: standard.standardize_language("lang"), sql_language("lang")),
        "by_locale": (lambda: standard.standardize_language("locale"), sql_language("locale")),
    },
    {"locale": "case doc_id % 5 when 0 then upper(lang) || '-' || upper(lang) when 1 then ' ' || lang "
               "when 2 then source when 3 then null else 'Farsi' end"},
)

scalar(
    "sc_2_parse_duration", "events", ["event_id"],
    {
        "hours": (lambda: times.parse_duration("duration"), sql_duration("duration")),
        "leading": (lambda: times.parse_duration("duration", leading_only=True), sql_duration("duration", True)),
    },
    {"duration": "case event_type when 'view' then cast(value as string) || ' minutes' when 'click' then "
                 "'about ' || cast(value as string) || ' Hours' when 'error' then '5 hours 30 minutes' "
                 "when 'signup' then cast(value as string) when 'purchase' then cast(event_id as string) || ' weeks' end"},
)

scalar(
    "sc_3_standardize_level", "part", ["p_partkey"],
    {"level": (
        lambda: standard.standardize_level("raw"),
        sql_level("raw"),
    )},
    {"raw": "case p_size % 7 when 0 then ' Beginner level ' when 1 then 'Expert' when 2 then 'MIXED' "
            "when 3 then 'intermediate level' when 4 then null when 5 then p_type else 'introductory' end"},
)

scalar(
    "sc_4_standardize_price_model", "orders", ["o_orderkey"],
    {"price_model": (
        lambda: standard.standardize_price_model("raw"),
        sql_price_model("raw"),
    )},
    {"raw": "case o_orderpriority when '1-URGENT' then 'Subscription' when '2-HIGH' then 'MONTHLY_subscription' "
            "when '3-MEDIUM' then 'One Time' when '4-NOT SPECIFIED' then ' one time' end"},
)

_PRICE = "case when o_orderkey % 40 = 0 then null when o_orderkey % 40 = 1 then 0.0e0 " \
         "when o_orderkey % 40 = 2 then -5.0e0 else o_totalprice / 80 end"
scalar(
    "sc_5_price_band", "orders", ["o_orderkey"],
    {"price_category": (
        lambda: standard.price_band("price"),
        sql_price_band("price"),
    )},
    {"price": _PRICE},
)

scalar(
    "sc_6_duration_band", "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"],
    {"duration_category": (
        lambda: standard.duration_band("hours"),
        sql_duration_band("hours"),
    )},
    {"hours": "case when l_linenumber = 7 then null else l_quantity + l_linenumber end"},
)

_RATED = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
_MEASURES = {
    "rating": "case when l_linenumber = 7 then null else cast((l_partkey + l_suppkey) % 62 as double) / 10 - 0.5e0 end",
    "enrolled": "case when l_linenumber = 2 then null when l_linenumber = 3 then 0 else cast(l_orderkey % 5000 as int) end",
    "reviews": "case when l_linenumber = 4 then null else cast(l_quantity as int) end",
    "hours": "case when l_linenumber = 5 then null when l_linenumber = 6 then 0.0e0 else l_quantity end",
    "cost": "case when l_suppkey % 31 = 0 then null when l_suppkey % 31 = 1 then 0.0e0 "
            "when l_suppkey % 31 = 2 then -l_extendedprice else l_extendedprice end",
    "model": "case l_returnflag when 'A' then 'One Time' when 'N' then 'Subscription' else l_linestatus end",
}


def _measure(name: str, columns: dict[str, tuple[Callable[[], Column], str]]) -> None:
    scalar(name, "lineitem", _RATED, columns, _MEASURES)


_measure("sc_7_clamp_to_null", {
    "kept": (lambda: standard.clamp_to_null("rating", 0, 5), "case when rating >= 0 and rating <= 5 then rating end"),
})
_measure("sc_8_popularity_score", {
    "popularity_score": (lambda: scores.popularity_score("rating", "enrolled"), r("rating * ln(enrolled + 1)")),
    "with_zero": (
        lambda: scores.popularity_score("rating", "enrolled", True), r("rating * ln(coalesce(enrolled, 0) + 1)")
    ),
})
_measure("sc_9_engagement_rate", {
    "engagement_rate_pct": (
        lambda: scores.engagement_rate_pct("reviews", "enrolled"),
        "case when enrolled is null or enrolled = 0 then null when reviews is null then 0 else "
        + r("cast(reviews as double) / enrolled * 100") + " end",
    ),
    "without_reviews": (
        lambda: scores.engagement_rate_pct("reviews", "enrolled", False),
        r("cast(reviews as double) / nullif(enrolled, 0) * 100"),
    ),
})
_measure("sc_10_weighted_rating", {
    "weighted_rating": (
        lambda: scores.weighted_rating("rating", "reviews"), r("rating * ln(coalesce(reviews, 0) + 1)")
    ),
})
_measure("sc_11_cost_per_hour", {
    "cost_per_hour": (lambda: scores.cost_per_hour("cost", "hours"), r("cost / nullif(hours, 0)")),
})
_measure("sc_12_estimated_total_cost", {
    "total_cost": (
        lambda: scores.estimated_total_cost("cost", "hours", "model"),
        "case when cost is null or hours is null then null when lower(model) = 'one time' then cost "
        f"when lower(model) in ('subscription', 'monthly_subscription') then {r('cost * ceil(hours / 40.0)')} else cost end",
    ),
    "without_hours": (
        lambda: scores.estimated_total_cost("cost", "hours", "model", needs_hours=False),
        "case when lower(model) = 'one time' then cost "
        f"when lower(model) in ('subscription', 'monthly_subscription') then {r('cost * ceil(hours / 40.0)')} else cost end",
    ),
})
_measure("sc_13_value_score", {
    "value_score": (
        lambda: scores.value_score("rating", "enrolled", "cost"),
        f"case when cost > 0 then {r('rating * ln(enrolled + 1) / cost')} end",
    ),
    "any_sign": (
        lambda: scores.value_score("rating", "enrolled", "cost", positive_cost_only=False),
        r("rating * ln(enrolled + 1) / nullif(cost, 0)"),
    ),
})
_measure("sc_14_quality_tier", {
    "quality_tier": (
        lambda: standard.quality_tier("rating", "enrolled", "reviews"),
        "case when rating is null then 'Unrated' when rating >= 4.5 and enrolled >= 1000 and reviews >= 1.0 then 'Premium' "
        "when rating >= 4.0 and enrolled >= 500 then 'High' when rating >= 3.0 then 'Medium' else 'Low' end",
    ),
})

scalar(
    "sc_15_rewrite_delimiter", "part", ["p_partkey"],
    {"skills": (lambda: text.rewrite_delimiter("raw"), "replace(trim(raw), ' | ', ', ')")},
    {"raw": "' ' || p_brand || ' | ' || p_type || '|' || p_name || ' | '"},
)

_MDY = "cast(month(o_orderdate) as string) || '/' || cast(day(o_orderdate) as string) || '/' || cast(year(o_orderdate) as string)"
scalar(
    "sc_16_parse_dates", "orders", ["o_orderkey"],
    {
        "from_feed": (lambda: times.parse_feed_date("mdy"), "try_strptime(mdy, '%m/%d/%Y')::date"),
        "from_iso": (lambda: times.parse_iso_date("iso"), "try_cast(iso as date)"),
    },
    {
        "mdy": f"case when o_orderkey % 9 = 0 then '13/45/2020' when o_orderkey % 9 = 1 then null else {_MDY} end",
        "iso": "case when o_orderkey % 9 = 0 then 'soon' when o_orderkey % 9 = 1 then null "
               "else cast(o_orderdate as string) end",
    },
)

scalar(
    "sc_17_date_parts", "orders", ["o_orderkey"],
    {
        "day": (lambda: F.dayofmonth("o_orderdate"), "cast(day(o_orderdate) as integer)"),
        "month": (lambda: F.month("o_orderdate"), "cast(month(o_orderdate) as integer)"),
        "quarter": (lambda: F.quarter("o_orderdate"), "cast(quarter(o_orderdate) as integer)"),
        "year": (lambda: F.year("o_orderdate"), "cast(year(o_orderdate) as integer)"),
        "date_id": (lambda: keys.date_key("o_orderdate"), "cast(strftime(o_orderdate, '%Y%m%d') as integer)"),
    },
)

_GAPPY = {
    "a": "case when l_linenumber = 1 then null else l_linenumber end",
    "b": "case when l_quantity > 40 then null else cast(l_quantity as int) end",
    "c": "case when l_returnflag = 'A' then null else cast(l_suppkey as int) end",
}
scalar(
    "sc_18_safe_add_subtract", "lineitem", _RATED,
    {
        "added": (lambda: arith.safe_add(["a", "b", "c"]), "coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0)"),
        "subtracted": (
            lambda: arith.safe_subtract(["a", "b", "c"]), "coalesce(a, 0) - coalesce(b, 0) - coalesce(c, 0)"
        ),
    },
    _GAPPY,
)
scalar(
    "sc_19_safe_divide", "lineitem", _RATED,
    {"ratio": (
        lambda: arith.safe_divide("l_extendedprice", F.col("l_discount")), "l_extendedprice / nullif(l_discount, 0)"
    )},
)
scalar(
    "sc_20_width_bucket", "orders", ["o_orderkey"],
    {"bucket": (
        lambda: arith.width_bucket("o_totalprice", 50000, 400000, 7),
        "cast(case when o_totalprice < 50000 then 0 when o_totalprice >= 400000 then 8 "
        "else floor((o_totalprice - 50000) / (400000 - 50000) * 7) + 1 end as bigint)",
    )},
)

_POINTS = {
    "lat1": "c_acctbal / 200", "lon1": "cast(c_nationkey as double) * 7 - 90",
    "lat2": "cast(c_custkey % 90 as double)", "lon2": "c_acctbal / 100",
}


def _sql_haversine(factor: str) -> str:
    chord = (
        "pow(sin(radians((lat2 - lat1) / 2)), 2) + cos(radians(lat1)) * cos(radians(lat2)) "
        "* pow(sin(radians((lon2 - lon1) / 2)), 2)"
    )
    return r(f"2 * 3961 * asin(sqrt({chord})) * {factor}", 6)


scalar(
    "sc_21_haversine_distance", "customer", ["c_custkey"],
    {
        "miles": (lambda: F.round(arith.haversine_distance("lat1", "lon1", "lat2", "lon2"), 6), _sql_haversine("1")),
        "km": (
            lambda: F.round(arith.haversine_distance("lat1", "lon1", "lat2", "lon2", "km"), 6),
            _sql_haversine("1.60934"),
        ),
    },
    _POINTS,
)

_TOKEN = "_dbt_utils_surrogate_key_null_"
scalar(
    "sc_22_surrogate_key", "lineitem", _RATED,
    {
        "key": (
            lambda: keys.surrogate_key(["a", "l_returnflag", "b"]),
            f"md5(coalesce(cast(a as varchar), '{_TOKEN}') || '-' || coalesce(l_returnflag, '{_TOKEN}') || '-' "
            f"|| coalesce(cast(b as varchar), '{_TOKEN}'))",
        ),
        "key_empty": (
            lambda: keys.surrogate_key(["a", "b"], nulls_as_empty=True),
            "md5(coalesce(cast(a as varchar), '') || '-' || coalesce(cast(b as varchar), ''))",
        ),
    },
    _GAPPY,
)

_URL = {"u": "case page_id % 4 when 0 then replace(url, 'https://', '') when 1 then replace(url, 'http://', 'android-app://') "
             "when 2 then replace(url, '/', '') else url end"}
_BARE = "replace(replace(u, 'http://', ''), 'https://', '')"
scalar(
    "sc_23_url_host", "pages", ["page_id"],
    {
        "host": (lambda: urls.url_host("url"),
                 "split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''), '/', 1), '?', 1)"),
        "host_of_variant": (lambda: urls.url_host("u"),
                 "split_part(split_part(replace(replace(replace(u, 'android-app://', ''), 'http://', ''), 'https://', ''), '/', 1), '?', 1)"),
    },
    _URL,
)
scalar(
    "sc_24_url_path", "pages", ["page_id"],
    {"path": (
        lambda: urls.url_path("u"),
        f"split_part(right({_BARE}, length({_BARE}) - greatest(coalesce(nullif(position('/' in {_BARE}), 0), "
        f"position('?' in {_BARE}) - 1), 0)), '?', 1)",
    )},
    _URL,
)
scalar(
    "sc_25_url_parameter", "pages", ["page_id"],
    {
        "page": (lambda: urls.url_parameter("url", "page"), "nullif(split_part(split_part(url, 'page=', 2), '&', 1), '')"),
        "source": (
            lambda: urls.url_parameter("url", "source"), "nullif(split_part(split_part(url, 'source=', 2), '&', 1), '')"
        ),
    },
)
scalar(
    "sc_26_upper_column", "orders", ["o_orderkey"],
    {"status": (lambda: F.upper("mixed"), "upper(mixed)")},
    {"mixed": "lower(o_orderpriority)"},
)
scalar(
    "sc_27_first_non_blank", "events", ["event_id"],
    {"picked": (
        lambda: text.first_non_blank("p", "q", "event_type"),
        "coalesce(case when trim(p) <> '' then p end, case when trim(q) <> '' then q end, event_type)",
    )},
    {
        "p": "case when event_id % 3 = 0 then '  ' when event_id % 3 = 1 then null else props end",
        "q": "case when event_id % 2 = 0 then '' else cast(user_id as string) end",
    },
)
scalar(
    "sc_28_free_or_paid", "orders", ["o_orderkey"],
    {"price_model": (
        lambda: F.when(text.is_free_text("price"), "Free").otherwise("One Time"),
        "case when lower(trim(price)) in ('free', '0', '') then 'Free' else 'One Time' end",
    )},
    {"price": "case o_orderkey % 5 when 0 then ' FREE ' when 1 then '0' when 2 then '' when 3 then null "
              "else cast(o_orderkey as string) end"},
)


# --- generators sized by the tables -------------------------------------------------------------

@query(
    "gen_1_series",
    "select cast(i as bigint) as generated_number from (select unnest(range(1, (select max(o_orderkey) from orders) + 2)) as i) as t",
)
def number_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    return series(spark, last + 1)


_SPINE = """
select cast(d as timestamp) as date_{part} from (
    select unnest(generate_series(date_trunc('day', (select min(ts) from events)),
                                  date_trunc('day', (select max(ts) from events)) - interval 1 {part}, interval 1 {part})) as d
) as t
"""


def _register_spine(part: str) -> None:
    @query(f"gen_2_date_spine_{part}", _SPINE.format(part=part))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        first, last = table(spark, sf_dir, "events").agg(
            F.min("ts").cast("date"), F.max("ts").cast("date")
        ).first()
        return date_spine(spark, part, f"date'{first}'", f"date'{last}'")


for _part in ("day", "hour", "minute"):
    _register_spine(_part)


@query(
    "gen_2_date_spine_month",
    """
    select cast(d as timestamp) as date_month from (
        select unnest(generate_series((select min(o_orderdate) from orders), (select max(o_orderdate) from orders), interval 1 month)) as d
    ) as t where d < date_trunc('month', (select max(o_orderdate) from orders))
    """,
)
def month_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = table(spark, sf_dir, "orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    return date_spine(spark, "month", f"timestamp_ntz'{first}'", f"timestamp_ntz'{last}'")
