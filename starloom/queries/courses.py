"""Course feeds derived from the given tables, and the staging queries on them.

Every ``lineitem`` row becomes a raw feed row of the part sold, taught by its supplier; the
return flag says which of the three feeds it belongs to. The column expressions are the
same text in Spark and in the SQL twins; everything after them is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.shape import deduplicate
from ..plans.rules import CLOUD, DEFAULT, LOCAL, Rules
from ..plans.staging import FEEDS, UDEMY, Complete, Feed, align_feed, combine_feeds, stage_feed, stage_feeds
from ..plans.standardize import standardize_courses
from ..functions import fixed
from .registry import query, r, table

FLAG = {"Coursera": "A", "Udacity": "N", "Udemy": "R"}

_DAY = {
    "Udacity": "cast(year(l_shipdate) as string) || '-' || lpad(cast(month(l_shipdate) as string), 2, '0') "
               "|| '-' || lpad(cast(day(l_shipdate) as string), 2, '0')",
    "other": "cast(month(l_shipdate) as string) || '/' || cast(day(l_shipdate) as string) || '/' "
             "|| cast(year(l_shipdate) as string)",
}
_ID = {
    "Coursera": "case when l_partkey % 211 = 7 then null else cast(l_partkey as string) end",
    "Udacity": "'ud' || cast(l_partkey as string)",
    "Udemy": "case when l_partkey % 50 = 3 then 'draft' || cast(l_partkey as string) "
             "when l_partkey % 50 = 4 then cast(l_partkey as string) || '.0' else cast(l_partkey as string) end",
}
# Raw values by canonical name, before any standardization.
RAW = {
    "title": "'  ' || p_name || ' ' || cast(l_partkey as string) || ' '",
    "course_url": "'https://www.example.org/course/' || cast(l_partkey as string) || '?ref=' || l_linestatus",
    "language": "case l_linenumber when 1 then 'en-US' when 2 then 'ES' when 3 then 'Farsi' when 4 then ' en ' "
                "when 5 then 'xx' when 6 then null else 'nb-NO' end",
    "description": "' ' || p_type || ' course about ' || p_name",
    "skills": "p_brand || ' | ' || p_type || ' | ' || p_name || ' '",
    "level": "case p_size % 8 when 0 then ' Beginner Level' when 1 then 'EXPERT' when 2 then 'mixed' when 3 then null "
             "when 4 then 'Intermediate' when 5 then 'guru' when 6 then 'Introductory ' else 'all' end",
    "instructor": "case when l_suppkey % 17 = 0 then null when l_suppkey % 29 = 1 then '  ' "
                  "else ' ' || s_name || ' ' end",
    "domain_name": "case when p_size % 10 = 0 then null else p_type end",
    "duration_raw": "case cast(l_quantity as int) % 9 when 0 then cast(cast(l_quantity as int) as string) || ' hours' "
                    "when 1 then cast(cast(l_quantity as int) as string) || ' Minutes' when 2 then '5 hours 30 minutes' "
                    "when 3 then 'Approx. 5 hours' when 4 then cast(cast(l_quantity as int) as string) "
                    "when 5 then '3 weeks' when 6 then ' ' when 7 then cast(cast(l_quantity as int) as string) || '.5 hr' "
                    "else 'Approx 60 hours' end",
    "review_count": "case when l_linenumber = 5 then null else cast(cast(l_quantity as int) * 3 as string) "
                    "|| case when l_linenumber = 4 then '.0' else '' end end",
    "rating": "case when l_suppkey % 13 = 0 then null else cast((l_partkey + l_suppkey) * 7 % 56 as double) / 10 end",
    "price": "case when l_linenumber = 3 then 0.0e0 when l_suppkey % 19 = 0 then null when l_suppkey % 23 = 0 then -1.0e0 "
             "else p_retailprice * l_linenumber * l_linenumber / 8 end",
    "price_model": "case p_size % 5 when 0 then 'subscription' when 1 then 'Monthly_Subscription' when 2 then 'one time' "
                   "when 3 then 'One Time' else 'free' end",
    "enrolled_students": "case when l_linenumber = 2 then null when l_linenumber = 6 then '0' "
                         "when l_linenumber = 3 then cast(l_orderkey % 2500 as string) || '.0' "
                         "when l_linenumber = 4 then cast(l_orderkey % 2500 as string) || '.4' else cast(l_orderkey % 2500 as string) end",
    "offering_type": "case p_size % 4 when 0 then null when 1 then 'Course' when 2 then 'Specialization' "
                     "else 'Guided Project' end",
}
TIES = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
# Canonical columns by which a row is picked; they come from the lines, all others are built for picked rows.
_PICKED = ["course_id", "last_updated"]


def _raw_values(platform: str) -> dict[str, str]:
    day = _DAY.get(platform, _DAY["other"])
    return {
        "course_id": _ID[platform],
        **RAW,
        "last_updated": f"case when l_linenumber = 7 then null else {day} end",
    }


def _known_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines whose part and supplier are listed."""
    part, supplier = table(spark, sf_dir, "part").select("p_partkey"), table(spark, sf_dir, "supplier").select("s_suppkey")
    lines = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    return lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")


def _described(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Lines with their part and supplier, of a key listed more than once the first by its values."""
    for name, key, line_key in (("part", "p_partkey", "l_partkey"), ("supplier", "s_suppkey", "l_suppkey")):
        listed = table(spark, sf_dir, name)
        once = deduplicate(listed, [key], [F.asc(c) for c in listed.columns if c != key])
        lines = lines.join(once, F.col(line_key) == F.col(key))
    return lines


# The columns of a line that the raw values need beside those that break ties.
_CARRIED = ["l_partkey", "l_linestatus"]


def raw_feed(spark: SparkSession, sf_dir: str, feed: Feed, whole: bool = False) -> DataFrame:
    """One raw feed, the feed's share of the lines or all: ids, dates and the columns that break ties.

    :func:`completed` adds the other columns to the rows that are kept.
    """
    lines = _known_lines(spark, sf_dir)
    rows = lines if whole else lines.filter(F.col("l_returnflag") == FLAG[feed.platform])
    values = _raw_values(feed.platform)
    return rows.selectExpr(*[f"{values[c]} as `{feed.columns[c][0]}`" for c in _PICKED], *_CARRIED, *TIES)


def completed(spark: SparkSession, sf_dir: str, feed: Feed) -> Complete:
    """Adds the columns looked up in part and supplier to rows of :func:`raw_feed`, under the feed's own names."""
    return lambda rows: _described(spark, sf_dir, rows).selectExpr(
        *[f"`{feed.columns[c][0]}`" for c in _PICKED], *[f"{e} as `{feed.columns[c][0]}`" for c, e in RAW.items()], *TIES)


def staged(spark: SparkSession, sf_dir: str, feed: Feed, rules: Rules = DEFAULT, whole: bool = False) -> DataFrame:
    raw = raw_feed(spark, sf_dir, feed, whole)
    return stage_feed(raw, feed, rules, [F.asc(c) for c in TIES], completed(spark, sf_dir, feed))


def raw_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows of all feeds under the canonical names, derived in one pass over the lines: what picking them needs."""
    each = {f.platform: _raw_values(f.platform) for f in FEEDS.values()}

    def value(column: str) -> str:
        return "case l_returnflag " + " ".join(f"when '{FLAG[p]}' then {values[column]}" for p, values in each.items()) + " end"

    named = "case l_returnflag " + " ".join(f"when '{flag}' then '{p}'" for p, flag in FLAG.items()) + " end as platform"
    return _known_lines(spark, sf_dir).selectExpr(named, *[f"{value(c)} as {c}" for c in _PICKED], *_CARRIED, *TIES)


def combined(spark: SparkSession, sf_dir: str, rules: Rules = DEFAULT) -> DataFrame:
    def complete(rows: DataFrame) -> DataFrame:
        return _described(spark, sf_dir, rows).selectExpr("platform", *_PICKED, *[f"{e} as {c}" for c, e in RAW.items()])

    return stage_feeds(raw_feeds(spark, sf_dir), "platform", rules, [F.asc(c) for c in TIES], complete=complete)


def standardized(spark: SparkSession, sf_dir: str, rules: Rules = DEFAULT) -> DataFrame:
    return standardize_courses(combined(spark, sf_dir, rules), rules)


# --- the same in SQL -------------------------------------------------------------------------

def sql_language(c: str) -> str:
    cases = " ".join(
        f"when lower({c}) in ({', '.join(repr(x) for x in codes)}) then '{name}'"
        for name, codes in fixed.LANGUAGES.items()
    )
    return f"case when {c} is null then null {cases} else 'Other / Unknown' end"


def sql_level(c: str) -> str:
    cases = " ".join(
        f"when lower(trim({c})) in ({', '.join(repr(w) for w in words)}) then '{name}'" for name, words in fixed.LEVELS.items()
    )
    return f"case {cases} else 'Unknown' end"


def sql_price_model(c: str) -> str:
    subscriptions = ", ".join(repr(m) for m in fixed.SUBSCRIPTION_MODELS)
    return (
        f"case when lower({c}) in ({subscriptions}) then 'Subscription' "
        f"when lower({c}) = '{fixed.ONE_TIME_MODEL}' then 'One Time' else 'Unknown' end"
    )


def _sql_bands(c: str, first: str, bands: list[tuple[int, str]], top: str) -> str:
    cases = " ".join(f"when {c} < {upper} then '{name}'" for upper, name in bands)
    return f"case when {c} is null then 'Unknown' {first} {cases} else '{top}' end"


def sql_price_band(c: str) -> str:
    return _sql_bands(c, f"when {c} = 0 then 'Free'", fixed.PRICE_BANDS, fixed.PRICE_BAND_TOP)


def sql_duration_band(c: str) -> str:
    return _sql_bands(c, "", fixed.DURATION_BANDS, fixed.DURATION_BAND_TOP)


def sql_duration(c: str, leading_only: bool = False) -> str:
    t = f"lower(trim({c}))"
    if leading_only:
        digits = f"regexp_extract({c}, '^[0-9.]+')"
        number = f"(case when {digits} = '' then 0.0e0 else try_cast({digits} as double) end)"
        plain = f"try_cast(trim({c}) as double)"
    else:
        number = f"try_cast(regexp_extract(trim({c}), '[0-9.]+') as double)"
        plain = f"case when regexp_matches(trim({c}), '^[0-9.]+$') then try_cast(trim({c}) as double) end"
    return (
        f"case when {c} is null or trim({c}) = '' then null when {t} like '%min%' then {r(number + ' / 60.0')} "
        f"when {t} like '%hour%' or {t} like '%hr%' then {number} else {plain} end"
    )


def sql_staged(feed: Feed, rules: Rules = DEFAULT, whole: bool = False) -> str:
    values = _raw_values(feed.platform)
    columns = ", ".join(f"{e} as {c}" for c, e in values.items())
    dated = "try_cast(last_updated as date)" if feed.iso_dates else "try_strptime(last_updated, '%m/%d/%Y')::date"
    keep = "true"
    if feed.numeric_ids_only:
        keep = "try_cast(course_id as integer) is not null"
    if feed.id_required and rules.drop_null_ids:
        keep = "course_id is not null"
    skills = "replace(trim(skills), ' | ', ', ')" if feed.skill_delimiter else "trim(skills)"
    return f"""
    select course_id, trim(title) as title, course_url, '{feed.platform}' as platform,
           {sql_language('language')} as language, trim(description) as description, {skills} as skills,
           level, trim(instructor) as instructor, domain_name, offering_type, {dated} as last_updated,
           duration_raw, {sql_duration('duration_raw', rules.leading_number_only)} as duration_hours,
           cast(review_count as integer) as review_count, rating, price, price_model,
           cast(enrolled_students as integer) as enrolled_students
    from (
        select *, row_number() over (partition by course_id order by {dated} desc nulls last, {', '.join(TIES)}) as rn
        from (select {columns}, {', '.join(TIES)}
              from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
              where {whole} or l_returnflag = '{FLAG[feed.platform]}') as raw
        where {keep}
    ) as numbered where rn = 1"""


def sql_combined(rules: Rules = DEFAULT) -> str:
    return " union all by name ".join(f"({sql_staged(f, rules)})" for f in FEEDS.values())


def sql_standardized(rules: Rules = DEFAULT) -> str:
    """A SELECT with every standardized column."""
    enrolled = "coalesce(enrolled_students, 0)" if rules.null_enrolled_is_zero else "enrolled_students"
    reviews = "coalesce(review_count, 0)" if rules.null_reviews_is_zero else "review_count"
    engagement = f"cast({reviews} as double) / nullif(enrolled_students, 0) * 100"
    cost = (
        "case when lower(price_model) = 'one time' then price "
        "when lower(price_model) in ('subscription', 'monthly_subscription') "
        f"then {r('price * ceil(duration_hours / 40.0)')} else price end"
    )
    if rules.cost_needs_hours:
        cost = f"case when duration_hours is null then null else {cost} end"
    cost_ok = "estimated_total_cost > 0" if rules.positive_cost_only else "estimated_total_cost <> 0"
    kept = "case when rating < 0 or rating > 5 then null else rating end" if rules.clamp_rating else "rating"
    return f"""
    select *, case when {cost_ok} then {r(f'(rating * ln({enrolled} + 1)) / nullif(estimated_total_cost, 0)')} end as value_score
    from (
        select course_id, platform, title, course_url, description, skills, instructor, language, domain_name,
               {sql_level('level')} as level,
               {kept} as rating, review_count, enrolled_students, price,
               {sql_price_model('price_model')} as price_model,
               duration_hours, duration_raw,
               {sql_price_band('price')} as price_category,
               {sql_duration_band('duration_hours')} as duration_category,
               {r(f'rating * ln({enrolled} + 1)')} as popularity_score,
               {r(engagement)} as engagement_rate_pct,
               {r('rating * ln(coalesce(review_count, 0) + 1)')} as weighted_rating,
               {r('price / nullif(duration_hours, 0)')} as cost_per_hour,
               coalesce(offering_type, 'Unknown') as offering_type,
               {cost} as estimated_total_cost, last_updated
        from combined
    ) as enriched"""


def with_courses(select: str, rules: Rules = DEFAULT, extra: str = "") -> str:
    """SQL over ``combined`` and ``courses`` (the standardized rows)."""
    return (
        f"with combined as ({sql_combined(rules)}), courses as ({sql_standardized(rules)}){extra} {select}"
    )


# --- queries -----------------------------------------------------------------------------------

def _register_feed(key: str, feed: Feed) -> None:
    @query(f"prj_1_stage_{key}", sql_staged(feed, DEFAULT, whole=True))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return staged(spark, sf_dir, feed, whole=True)


for _key, _feed in FEEDS.items():
    _register_feed(_key, _feed)


@query("set_1_combine_feeds", with_courses("select * from combined"))
def combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combine_feeds(*[staged(spark, sf_dir, f) for f in FEEDS.values()])


def _register_rules(name: str, rules: Rules) -> None:
    @query(f"sc_standardize_courses_{name}", with_courses("select * from courses", rules))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return standardized(spark, sf_dir, rules)


for _name, _rules in {"default": DEFAULT, "local": LOCAL, "cloud": CLOUD}.items():
    _register_rules(_name, _rules)


@query(
    "prj_2_platform_literal",
    "select 'Udemy' as platform, p_partkey, trim(p_name) as title from part",
)
def platform_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(F.lit(UDEMY.platform).alias("platform"), "p_partkey", F.trim("p_name").alias("title"))


_SCRAPED = {
    "course_id": "cast(o_custkey as string)",
    "Course_Title": "o_orderstatus",
    "Price": "case o_orderstatus when 'F' then ' Free ' when 'O' then '0' else cast(o_orderkey as string) end",
    "No_of_Students_enrolled": "o_orderkey",
    "Unnamed: 0": "o_custkey",
}


@query(
    "prj_3_align_schema",
    f"""
    select course_id, "Course_Title", "Price", students as "No_of_Students", 'Course' as "offering_Type", '' as rate,
           case when lower(trim("Price")) in ('free', '0', '') then 'Free' else 'One Time' end as "price model"
    from (
        select {_SCRAPED['course_id']} as course_id, {_SCRAPED['Course_Title']} as "Course_Title",
               {_SCRAPED['Price']} as "Price", o_orderkey as students,
               row_number() over (partition by o_custkey order by o_orderkey desc) as rn
        from orders
    ) as scraped where rn = 1
    """,
)
def align(spark: SparkSession, sf_dir: str) -> DataFrame:
    scraped = table(spark, sf_dir, "orders").select(
        *[F.expr(e).alias(n) for n, e in _SCRAPED.items()]
    )
    return align_feed(scraped, UDEMY, F.col("No_of_Students_enrolled"))


@query(
    "win_1_latest_row_per_key",
    """
    select o_orderkey, o_custkey, o_orderdate, o_totalprice from (
        select *, row_number() over (partition by o_custkey order by o_orderdate desc nulls last, o_orderkey) as rn
        from orders
    ) as t where rn = 1
    """,
)
def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return deduplicate(orders, ["o_custkey"], [F.desc_nulls_last("o_orderdate"), F.asc("o_orderkey")])


