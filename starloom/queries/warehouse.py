"""History, star schema, reports and dashboard queries on the derived courses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.core import exact_sum
from ..operators.joins import lookup_join
from ..operators.shape import deduplicate
from ..operators.staging_area import stage
from ..plans import build, checks, dashboard, history, semantic, star
from ..plans.rules import DEFAULT, LOCAL, Rules
from ..plans.staging import COURSERA, FEEDS, UDACITY, UDEMY
from .courses import TIES, completed, raw_feed, sql_staged, standardized, with_courses
from .registry import REGISTRY, avg, big, mean, query, r, table

# --- flagship: order star, revenue share of the customer segments ------------------------------


@query(
    "flagship_segment_share",
    """
    with dim as (
        select row_number() over (order by c_mktsegment) as segment_id, c_mktsegment as segment_name
        from (select distinct c_mktsegment from customer where c_mktsegment is not null) as t
        union all select -1, 'Unknown'
    ), fact as (
        select coalesce(d.segment_id, -1) as segment_id, o.o_totalprice
        from orders o left join customer c on o.o_custkey = c.c_custkey left join dim d on c.c_mktsegment = d.segment_name
    ), totals as (
        select segment_id, count(*) as orders, cast(sum(cast(cast(o_totalprice as varchar) as decimal(38,12))) as double) as revenue
        from fact group by 1
    )
    select segment_name, orders, revenue, """
    + r("revenue * 100.0e0 / nullif(sum(revenue) over (), 0)", 1)
    + " as pct_of_revenue from totals join dim using (segment_id) order by revenue desc, segment_name limit 5",
)
def segment_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    dim = star.keyed_dimension(customer, "c_mktsegment", "segment_id", "segment_name", "Unknown")
    per_customer = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), exact_sum("o_totalprice").alias("total")
    )
    keyed = per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").join(
        dim, F.col("c_mktsegment") == F.col("segment_name"), "left"
    )
    totals = keyed.groupBy(F.coalesce("segment_id", F.lit(-1)).alias("segment_id")).agg(
        F.sum("n").alias("orders"), exact_sum("total").alias("revenue")
    )
    shared = semantic.share_of_total(totals, "revenue", "pct_of_revenue")
    return (
        shared.join(dim, "segment_id").select("segment_name", "orders", "revenue", "pct_of_revenue")
        .orderBy(F.desc("revenue"), "segment_name").limit(5)
    )


# --- history -------------------------------------------------------------------------------------

FIRST, SECOND = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
_GONE = "(platform = 'Udacity' and level = 'Advanced')"
_NEW_TITLE = "case when level = 'Beginner' then title || ' (2nd edition)' else title end"


def course_history(courses: DataFrame) -> DataFrame:
    """Two snapshots: some courses appear in the second, some change, some vanish."""
    first = history.first_snapshot(courses.filter("domain_name is not null"), FIRST)
    second = courses.withColumn("title", F.expr(_NEW_TITLE)).filter(f"not {_GONE}")
    return history.merge_snapshot(first, second, SECOND)


_HISTORY_SQL = f""", s1 as (select * from courses where domain_name is not null),
s2 as (select * replace ({_NEW_TITLE} as title) from courses where not {_GONE}),
history as (
    select s1.*, timestamp '{FIRST}' as valid_from,
           case when s2.course_id is not null and s2.title is distinct from s1.title then timestamp '{SECOND}' end as valid_to
    from s1 left join s2 on s1.course_id = s2.course_id and s1.platform = s2.platform
    union all by name
    select s2.*, timestamp '{SECOND}' as valid_from, cast(null as timestamp) as valid_to
    from s2 left join s1 on s1.course_id = s2.course_id and s1.platform = s2.platform
    where s1.course_id is null or s2.title is distinct from s1.title
)"""


@query("scd_1_course_snapshot", with_courses("select * from history", extra=_HISTORY_SQL))
def course_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return course_history(stage(standardized(spark, sf_dir), "courses"))


@query(
    "scd_1_weekly_event_snapshots",
    """
    with weekly as (
        select user_id, event_type, value, cast(week + interval 7 day as timestamp) as as_of from (
            select *, date_trunc('week', ts) as week,
                   row_number() over (partition by user_id, date_trunc('week', ts) order by ts desc, event_id desc) as rn
            from events
        ) as t where rn = 1
    ), changed as (
        select *, lag(event_type) over (partition by user_id order by as_of) as before from weekly
    )
    select user_id, event_type, value, as_of as valid_from, lead(as_of) over (partition by user_id order by as_of) as valid_to
    from changed where event_type is distinct from before
    """,
)
def weekly_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    week = F.date_trunc("week", "ts").cast("timestamp_ntz")
    events = table(spark, sf_dir, "events").withColumn("week", week)
    latest = deduplicate(events, ["user_id", "week"], [F.desc("ts"), F.desc("event_id")])
    observed = latest.select("user_id", "event_type", "value", F.expr("week + interval 7 days").alias("as_of"))
    return history.versions_of_changes(observed, ["user_id"], "as_of", ["event_type"]).drop("as_of")


# --- dimensions ---------------------------------------------------------------------------------

_UNKNOWN = star.UNKNOWN_NAMES


def _dim_sql(which: str, rules: Rules) -> str:
    column, key, name = star.DIMENSIONS[which]
    unknown = _UNKNOWN[which]
    if rules.unknown_member:
        return (
            f"select row_number() over (order by {column}) as {key}, {column} as {name} from "
            f"(select distinct {column} from courses where {column} is not null and {column} <> '{unknown}') as t "
            f"union all select -1, '{unknown}'"
        )
    if which in ("instructor", "offering_type"):
        return (
            f"select case when {name} = '{unknown}' then -1 else row_number() over (order by {name}) end as {key}, {name} "
            f"from (select distinct coalesce({column}, '{unknown}') as {name} from courses) as t"
        )
    return (
        f"select row_number() over (order by {column} nulls last) as {key}, {column} as {name} "
        f"from (select distinct {column} from courses) as t"
    )


def _register_dim(number: str, which: str, rules: Rules, suffix: str = "") -> None:
    @query(f"{number}_{which}{suffix}", with_courses(_dim_sql(which, rules), rules))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return star.build_dimension(standardized(spark, sf_dir, rules), which, rules)


for _which in ("platform", "level", "language", "domain"):
    _register_dim("dim_1", _which, LOCAL)
for _which in ("instructor", "offering_type"):
    _register_dim("dim_2", _which, LOCAL)
for _which in star.DIMENSIONS:
    _register_dim("dim_3", _which, DEFAULT)

_DATE_SQL = """select cast(strftime(last_updated, '%Y%m%d') as integer) as date_id, last_updated as full_date,
    cast(day(last_updated) as integer) as day, cast(month(last_updated) as integer) as month,
    cast(quarter(last_updated) as integer) as quarter, cast(year(last_updated) as integer) as year
    from (select distinct last_updated from courses where last_updated is not null) as t
    union all select -1, null, null, null, null, null"""


@query("dim_4_date", with_courses(_DATE_SQL))
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.date_dimension(standardized(spark, sf_dir))


@query(
    "dim_4_ship_date",
    _DATE_SQL.replace("last_updated is not null", "true").replace(
        "(select distinct last_updated from courses where true)",
        "(select distinct cast(l_shipdate as date) as last_updated from lineitem)",
    ),
)
def dim_ship_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.date_dimension(table(spark, sf_dir, "lineitem"), "l_shipdate")


_OFFERING_SQL = """select row_number() over (order by course_id, valid_from, platform) as offering_sk,
    course_id as offering_id, platform, title, description, skills, course_url, valid_from as effective_from,
    valid_to as effective_to, valid_to is null as is_current from history"""


@query("dim_5_offering", with_courses(_OFFERING_SQL, extra=_HISTORY_SQL))
def dim_offering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.offering_dimension(course_history(stage(standardized(spark, sf_dir), "courses")))


# --- fact ---------------------------------------------------------------------------------------

_METRICS = ", ".join(f"courses.{m}" for m in [*star.FACT_METRICS, "price_category", "duration_category"])


def _fact_sql(rules: Rules) -> str:
    dims = "".join(f", dim_{w} as ({_dim_sql(w, rules)})" for w in star.DIMENSIONS)
    every = rules.unknown_key

    joins, keys = [], []
    for which, (column, key, name) in star.DIMENSIONS.items():
        named = which in ("instructor", "offering_type")
        value = f"coalesce(courses.{column}, '{_UNKNOWN[which]}')" if named else f"courses.{column}"
        joins.append(f"left join dim_{which} on {value} = dim_{which}.{name}")
        keys.append(f"coalesce(dim_{which}.{key}, -1) as {key}" if every or named else f"dim_{which}.{key}")
    offering = "coalesce(offering_sk, -1) as offering_sk" if every else "offering_sk"
    return with_courses(
        f"""
        select {offering}, {', '.join(keys)}, coalesce(dim_date.date_id, -1) as date_id, {_METRICS}
        from courses {' '.join(joins)}
        left join dim_date on courses.last_updated = dim_date.full_date
        left join (select * from dim_offering where is_current) as current_offering
               on courses.course_id = current_offering.offering_id and courses.platform = current_offering.platform
        """,
        rules,
        _HISTORY_SQL + dims + f", dim_date as ({_DATE_SQL}), dim_offering as ({_OFFERING_SQL})",
    )


def whole_star(spark: SparkSession, sf_dir: str, rules: Rules = DEFAULT) -> dict[str, DataFrame]:
    courses = stage(standardized(spark, sf_dir, rules), "courses")
    return star.build_star(courses, stage(course_history(courses), "history"), rules)


@query("dim_6_fact_offerings", _fact_sql(DEFAULT))
def fact_offerings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whole_star(spark, sf_dir)["fact_offerings"]


@query("jn_1_fact_with_null_keys", _fact_sql(LOCAL))
def fact_with_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whole_star(spark, sf_dir, LOCAL)["fact_offerings"]


@query(
    "jn_1_order_star",
    """
    with dim_nation as (select row_number() over (order by n_name) as nation_id, n_name from nation union all select -1, 'Unknown'),
         dim_supplier as (select row_number() over (order by s_name) as supplier_id, s_name, s_nationkey, case when s_acctbal >= 1000 then s_suppkey else -s_suppkey end as s_suppkey from supplier)
    select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_extendedprice, coalesce(ds.supplier_id, -1) as supplier_id,
           coalesce(dn.nation_id, -1) as nation_id
    from lineitem l left join dim_supplier ds on l.l_suppkey = ds.s_suppkey
    left join nation n on ds.s_nationkey = n.n_nationkey left join dim_nation dn on n.n_name = dn.n_name
    """,
)
def order_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    dim_nation = star.keyed_dimension(nation, "n_name", "nation_id", "n_name", "Unknown")
    # Suppliers in the red are listed under another key: their lines find no partner.
    supplier = table(spark, sf_dir, "supplier").withColumn("s_suppkey", F.expr("case when s_acctbal >= 1000 then s_suppkey else -s_suppkey end"))
    dim_supplier = star.keyed_dimension(supplier, "s_name", "supplier_id", "s_name")
    # Snowflaked keys are resolved on the dimension, so the fact is joined once.
    keys = (
        supplier.join(dim_supplier, "s_name")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").join(dim_nation, "n_name", "left")
        .select(F.col("s_suppkey").alias("l_suppkey"), "supplier_id", "nation_id")
    )
    keys = stage(keys, "dim-supplier")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_suppkey")
    joined = lookup_join(lines, keys, ["l_suppkey"], keys.count())
    unknown = F.lit(-1).cast("bigint")
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        F.coalesce("supplier_id", unknown).alias("supplier_id"), F.coalesce("nation_id", unknown).alias("nation_id"),
    )


@query(
    "jn_4_current_version",
    with_courses(
        "select s.course_id, s.platform, h.title, h.valid_from from courses s left join history h "
        "on s.course_id = h.course_id and s.platform = h.platform and h.valid_to is null",
        extra=_HISTORY_SQL,
    ),
)
def current_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    courses = stage(standardized(spark, sf_dir), "courses")
    current = course_history(courses).filter("valid_to is null").select("course_id", "platform", "title", "valid_from")
    return courses.select("course_id", "platform").join(current, ["course_id", "platform"], "left")


# --- reports ---------------------------------------------------------------------------------------

_TOTAL_ENROLLED = f"{big('enrolled_students')} as total_enrolled"


def _pct(condition: str) -> str:
    return r(f"count(case when {condition} then 1 end) * 100.0e0 / nullif(count(*), 0)", 1)


@query(
    "agg_1_platform_performance",
    with_courses(f"""
    select platform, count(*) as total_courses, {avg('rating')} as avg_rating, {r('median(rating)')} as median_rating,
           {_TOTAL_ENROLLED}, {avg('enrolled_students', 0)} as avg_enrolled_per_course, {avg('price')} as avg_price,
           {r('median(price)')} as median_price, {avg('duration_hours', 1)} as avg_duration_hours,
           {avg('review_count', 0)} as avg_reviews, {avg('engagement_rate_pct')} as avg_engagement_pct,
           {avg('value_score')} as avg_value_score, {avg('weighted_rating')} as avg_weighted_rating,
           {avg('cost_per_hour')} as avg_cost_per_hour,
           count(case when price = 0 or price is null then 1 end) as free_courses,
           count(case when rating >= 4.5 then 1 end) as high_rated_courses, {_pct('rating >= 4.5')} as pct_high_rated
    from courses group by platform"""),
)
def platform_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantic.platform_performance(stage(standardized(spark, sf_dir), "courses"))


@query(
    "agg_2_domain_trends",
    with_courses(
        f"""
    select a.*, l.level as most_common_level, p.price_category as most_common_price_category from (
        select domain_name, count(*) as total_courses, count(distinct platform) as platforms_offering,
               {avg('rating')} as avg_rating, {_TOTAL_ENROLLED}, {avg('price')} as avg_price,
               {avg('duration_hours', 1)} as avg_duration_hours, {avg('engagement_rate_pct')} as avg_engagement_pct,
               {avg('value_score')} as avg_value_score,
               count(case when rating >= 4.0 then 1 end) as courses_rated_4_plus, {_pct('rating >= 4.0')} as pct_rated_4_plus
        from courses group by domain_name
    ) as a
    left join levels l on a.domain_name is not distinct from l.domain_name and l.rn = 1
    left join prices p on a.domain_name is not distinct from p.domain_name and p.rn = 1
    order by total_enrolled desc nulls last, a.domain_name nulls last""",
        extra="""
    , levels as (select domain_name, level, row_number() over (partition by domain_name order by count(*) desc, level) as rn
                 from courses group by domain_name, level)
    , prices as (select domain_name, price_category, row_number() over (partition by domain_name order by count(*) desc, price_category) as rn
                 from courses group by domain_name, price_category)""",
    ),
)
def domain_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantic.domain_trends(stage(standardized(spark, sf_dir), "courses"))


@query(
    "agg_3_instructor_rankings",
    with_courses(f"""
    select *, row_number() over (order by composite_score desc nulls last, instructor) as overall_rank,
           ntile(10) over (order by composite_score desc nulls last, instructor) as decile
    from (
        select instructor, count(*) as course_count, count(distinct platform) as platforms_count,
               string_agg(distinct platform, ', ' order by platform) as platforms,
               string_agg(distinct domain_name, ', ' order by domain_name) as domains,
               {avg('rating')} as avg_rating, {big('enrolled_students')} as total_students,
               {avg('enrolled_students', 0)} as avg_students_per_course, {big('review_count')} as total_reviews,
               {avg('engagement_rate_pct')} as avg_engagement_pct, {avg('value_score')} as avg_value_score,
               {avg('weighted_rating')} as avg_weighted_rating,
               {r(f"coalesce({mean('rating')}, 0) * 0.4e0 + ln(coalesce({big('enrolled_students')}, 0) + 1) * 0.3e0 + coalesce({mean('engagement_rate_pct')}, 0) * 0.3e0")}
                   as composite_score
        from courses where instructor is not null and trim(instructor) <> ''
        group by instructor having count(*) >= 2
    ) as stats"""),
)
def instructor_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantic.instructor_rankings(stage(standardized(spark, sf_dir), "courses"))


@query(
    "agg_4_pricing_analysis",
    with_courses(f"""
    select *, {r('course_count * 100.0e0 / nullif(sum(course_count) over (), 0)', 1)} as pct_of_total from (
        select price_category, count(*) as course_count, {avg('rating')} as avg_rating, {avg('price')} as avg_price,
               {r('min(price)')} as min_price, {r('max(price)')} as max_price, {_TOTAL_ENROLLED},
               {avg('enrolled_students', 0)} as avg_enrolled, {avg('duration_hours', 1)} as avg_duration_hours,
               {avg('cost_per_hour')} as avg_cost_per_hour, {avg('value_score')} as avg_value_score,
               {avg('engagement_rate_pct')} as avg_engagement_pct,
               count(case when price_model = 'Subscription' then 1 end) as subscription_count,
               count(case when price_model = 'One Time' then 1 end) as one_time_count
        from courses group by price_category
    ) as bands"""),
)
def pricing_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantic.pricing_analysis(standardized(spark, sf_dir))


def _tier_sql() -> str:
    columns = ["rating", "enrolled_students", "engagement_rate_pct"]
    cases = " ".join(
        f"when {' and '.join(f'{c} >= {b}' for c, b in zip(columns, least) if b is not None)} then '{name}'"
        for name, *least in fixed.QUALITY_TIERS
    )
    return f"case when rating is null then '{fixed.UNRATED_TIER}' {cases} else '{fixed.LOWEST_TIER}' end"


@query(
    "agg_5_quality_tiers",
    with_courses(f"""
    select *, {r('course_count * 100.0e0 / nullif(sum(course_count) over (partition by platform), 0)', 1)} as pct_of_platform from (
        select quality_tier, platform, domain_name, count(*) as course_count, {avg('rating')} as avg_rating,
               {avg('price')} as avg_price, {_TOTAL_ENROLLED}, {avg('engagement_rate_pct')} as avg_engagement_pct,
               {avg('value_score')} as avg_value_score, {avg('duration_hours', 1)} as avg_duration_hours,
               {avg('cost_per_hour')} as avg_cost_per_hour
        from (select *, {_tier_sql()} as quality_tier from courses) as tiered
        group by quality_tier, platform, domain_name
    ) as summary"""),
)
def quality_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantic.quality_tiers(standardized(spark, sf_dir))


# --- dashboard -------------------------------------------------------------------------------------

def _part_star(spark: SparkSession, sf_dir: str, *which: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The fact with some dimensions only."""
    courses = stage(standardized(spark, sf_dir), "courses")
    dims = {w: stage(star.build_dimension(courses, w), f"dim-{w}") for w in which}
    return star.build_fact(courses, dims), dims


@query(
    "agg_14_cards",
    with_courses(
        f"select {_TOTAL_ENROLLED}, {avg('rating', 4)} as avg_rating, {avg('weighted_rating', 4)} as weighted_rating, "
        f"{avg('cost_per_hour', 4)} as cost_per_hour from courses"
    ),
)
def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.cards(standardized(spark, sf_dir))


@query(
    "agg_15_enrolled_by_platform",
    with_courses(
        f"select platform as platform_name, {big('enrolled_students')} as enrolled_students from courses group by 1 order by 2 desc, 1"
    ),
)
def enrolled_by_platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dims = _part_star(spark, sf_dir, "platform")
    return dashboard.enrolled_by(fact, dims["platform"], "platform_id", "platform_name")


@query(
    "agg_15_enrolled_by_offering_type",
    with_courses(
        f"select offering_type, {big('enrolled_students')} as enrolled_students from courses group by 1 order by 2 desc, 1"
    ),
)
def enrolled_by_offering_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dims = _part_star(spark, sf_dir, "offering_type")
    return dashboard.enrolled_by(fact, dims["offering_type"], "offering_type_id", "offering_type")


@query(
    "agg_15_popularity_by_domain",
    with_courses(
        f"select coalesce(domain_name, 'Unknown') as domain_name, {avg('popularity_score', 4)} as popularity_score "
        "from courses group by 1 order by 2 desc, 1"
    ),
)
def popularity_by_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dims = _part_star(spark, sf_dir, "domain")
    return dashboard.popularity_by(fact, dims["domain"], "domain_id", "domain_name")


@query(
    "flt_4_slicer",
    with_courses(
        "select price, rating, enrolled_students, price_category, duration_category from courses "
        "where platform in ('Coursera', 'Udemy') and level in ('Beginner', 'All Levels') "
        "and domain_name in ('ECONOMY', 'SMALL', 'LARGE') and price_category in ('Cheap', 'Medium') "
        "and duration_category in ('Short', 'Long')"
    ),
)
def slicer(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dims = _part_star(spark, sf_dir, "platform", "level", "domain")
    chosen = {
        "platform_name": ["Coursera", "Udemy"], "level_name": ["Beginner", "All Levels"],
        "domain_name": ["ECONOMY", "SMALL", "LARGE"], "price_category": ["Cheap", "Medium"],
        "duration_category": ["Short", "Long"],
    }
    by_attribute = {
        "platform_name": (dims["platform"], "platform_id"), "level_name": (dims["level"], "level_id"),
        "domain_name": (dims["domain"], "domain_id"),
    }
    rows = dashboard.slicer(fact, by_attribute, chosen)
    return rows.select("price", "rating", "enrolled_students", "price_category", "duration_category")


_TOP_SQL = "(select title from courses group by 1 order by sum(enrolled_students) desc nulls last, title limit 3)"


@query("srt_3_top_n_filter", with_courses(f"select * from courses where title in {_TOP_SQL}"))
def top_n_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    courses = stage(standardized(spark, sf_dir), "courses")
    return dashboard.top_n_filter(courses, "title", F.sum("enrolled_students"))


@query(
    "srt_4_top_n_table",
    with_courses(
        f"select title, platform, rating, price, duration_hours, weighted_rating from courses where title in {_TOP_SQL} order by platform, title"
    ),
)
def top_n_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    courses = stage(standardized(spark, sf_dir), "courses")
    columns = ["title", "platform", "rating", "price", "duration_hours", "weighted_rating"]
    return dashboard.top_n_table(courses, columns, ["platform", "title"], F.sum("enrolled_students"))


# --- the whole build and its declared tests -----------------------------------------------------------

_REPORT_QUERIES = {
    "platform_performance": "agg_1_platform_performance", "domain_trends": "agg_2_domain_trends",
    "instructor_rankings": "agg_3_instructor_rankings", "pricing_analysis": "agg_4_pricing_analysis",
    "quality_tiers": "agg_5_quality_tiers",
}


def _test_sql(table: str, declared: checks.TableChecks) -> list[str]:
    """One SELECT per test: name, failing rows, severity."""
    found = [(f"{c} is not null", f"{c} is null", "error") for c in declared.not_null]
    found += [(f"{c} is accepted", f"{c} not in ({', '.join(repr(x) for x in v)})", "error") for c, v in (declared.accepted or {}).items()]
    found += [(f"{c} is in range", " or ".join(f"{c} {sign} {x}" for sign, x in (("<", low), (">", high)) if x is not None), severity)
              for c, low, high, severity in declared.ranges]
    parts = [f"select '{table}: {name}' as test, count(*) as failures, '{severity}' as severity from {table} where {failing}"
             for name, failing, severity in found]
    for key in declared.keys:
        where = f"where {key[0]} is not null" if len(key) == 1 else ""
        parts.append(f"select '{table}: {', '.join(key)} is unique', count(*), 'error' from "
                     f"(select {', '.join(key)} from {table} {where} group by all having count(*) > 1) as t")
    for column, (parent, field) in (declared.relationships or {}).items():
        parts.append(f"select '{table}: {column} is in {parent}', count(*), 'error' from {table} "
                     f"where {column} is not null and {column} not in (select {field} from {parent} where {field} is not null)")
    return parts


def _checks_sql() -> str:
    names = {"stg_coursera": COURSERA, "stg_udacity": UDACITY, "stg_udemy": UDEMY}
    tables = {name: sql_staged(feed) for name, feed in names.items()}
    tables |= {"combined": with_courses("select * from combined"), "courses": with_courses("select * from courses")}
    tables |= {f"dim_{w}": with_courses(_dim_sql(w, DEFAULT)) for w in star.DIMENSIONS}
    tables |= {"dim_date": with_courses(_DATE_SQL), "dim_offering": with_courses(_OFFERING_SQL, extra=_HISTORY_SQL)}
    tables |= {"fact_offerings": _fact_sql(DEFAULT)} | {t: REGISTRY[q].sql for t, q in _REPORT_QUERIES.items()}
    tests = [t for name, declared in checks.WAREHOUSE_CHECKS.items() for t in _test_sql(name, declared)]
    ctes = ", ".join(f"{name} as materialized ({sql})" for name, sql in tables.items())
    return (f"with {ctes} select test, failures, case when failures = 0 then 'pass' else severity end as status "
            f"from ({' union all '.join(tests)}) as t")


@query("dq_warehouse_checks", _checks_sql())
def warehouse_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = {name: raw_feed(spark, sf_dir, feed) for name, feed in FEEDS.items()}
    complete = {name: completed(spark, sf_dir, feed) for name, feed in FEEDS.items()}
    return build.build_warehouse(raw, SECOND, tiebreak=[F.asc(c) for c in TIES], complete=complete)["checks"]
