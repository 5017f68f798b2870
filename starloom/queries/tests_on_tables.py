"""Data-quality tests on whole tables; most are set up so that rows fail."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.quality import Check
from ..operators.staging_area import stage
from .courses import standardized, with_courses
from .registry import query, table

# --- row conditions --------------------------------------------------------------------------


@query(
    "dq_1_accepted_range",
    "select o_orderkey, price from (select o_orderkey, case when o_orderkey % 10 = 0 then null else o_totalprice end as price "
    "from orders) as t where not price >= 20000 or not price <= 450000",
)
def accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice")).alias("price")
    return quality.accepted_range(table(spark, sf_dir, "orders").select("o_orderkey", price), "price", 20000, 450000)


@query("dq_1_accepted_range_exclusive", "select * from nation where not n_nationkey > 0 or not n_nationkey < n_regionkey + 20")
def accepted_range_exclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted_range(table(spark, sf_dir, "nation"), "n_nationkey", 0, "n_regionkey + 20", inclusive=False)


@query("dq_1_accepted_range_passing", "select * from lineitem where not l_discount >= 0 or not l_discount <= 1")
def accepted_range_passing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted_range(table(spark, sf_dir, "lineitem"), "l_discount", 0, 1)


@query(
    "dq_2_at_least_one",
    "select o_custkey, count(v) as filler_column from (select o_custkey, case when o_orderstatus = 'F' then o_orderkey end as v "
    "from orders) as t group by 1 having count(v) = 0",
)
def at_least_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).alias("v"))
    return quality.at_least_one(rows, "v", ["o_custkey"])


@query("dq_2_at_least_one_in_table", "select count(v) as filler_column from (select null::bigint as v from orders) as t having count(v) = 0")
def at_least_one_in_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.at_least_one(table(spark, sf_dir, "orders").select(F.lit(None).cast("bigint").alias("v")), "v")


@query(
    "dq_3_cardinality_equality",
    """
    with a as (select c_nationkey as key, count(*) as num_rows from customer group by 1),
         b as (select c_custkey % 25 as key, count(*) as num_rows from customer group by 1)
    select * from (select cast(key as bigint) as key, num_rows from a except select * from b) as x
    union all select * from (select * from b except select cast(key as bigint), num_rows from a) as y
    """,
)
def cardinality_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    a = customer.select(F.col("c_nationkey").cast("bigint").alias("key"))
    b = customer.select((F.col("c_custkey") % 25).alias("field"))
    return quality.cardinality_equality(a, "key", b, "field")


# --- two tables ---------------------------------------------------------------------------------

@query(
    "dq_4_equal_rowcount",
    "select (select count(*) from orders) as count_a, (select count(*) from customer) as count_b, "
    "abs((select count(*) from orders) - (select count(*) from customer)) as diff_count",
)
def equal_rowcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.equal_rowcount(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))


@query(
    "dq_4_equal_rowcount_by_group",
    "select a.k as k_a, b.k as k_b, count_a, count_b, abs(count_a - count_b) as diff_count from "
    "(select p_size as k, count(*) as count_a from part group by 1) as a full join "
    "(select s_nationkey as k, count(*) as count_b from supplier group by 1) as b on a.k = b.k",
)
def equal_rowcount_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and nations overlap in part, so both sides have groups of their own."""
    a = table(spark, sf_dir, "part").select(F.col("p_size").alias("k"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))
    return quality.equal_rowcount(a, b, ["k"])


@query(
    "dq_5_equality",
    """
    with a as (select c_custkey, c_nationkey, case when c_custkey % 100 = 5 then null else c_mktsegment end as segment from customer),
         b as (select case when c_acctbal > 500 then c_custkey else -c_custkey end as c_custkey, c_nationkey,
                      case when c_custkey % 150 = 5 then null else c_mktsegment end as segment from customer)
    select 'a_minus_b' as which_diff, * from (select * from a except select * from b) as x
    union all select 'b_minus_a', * from (select * from b except select * from a) as y
    """,
)
def equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")

    def side(n: int) -> DataFrame:
        segment = F.when(F.col("c_custkey") % n != 5, F.col("c_mktsegment")).alias("segment")
        return customer.select("c_custkey", "c_nationkey", segment, F.lit(n).alias("n"), "c_acctbal")

    other = side(150).withColumn("c_custkey", F.expr("case when c_acctbal > 500 then c_custkey else -c_custkey end"))
    return quality.equality(side(100), other, exclude_columns=["N", "c_acctbal"])


@query(
    "dq_5_equality_with_precision",
    """
    with a as (select p_partkey, cast(round(cast(p_retailprice as decimal(38,10)), 1) as decimal(38,1)) as price from part),
         b as (select p_partkey, cast(round(cast(p_retailprice + case when p_partkey % 7 = 0 then 0.36e0 else 0.04e0 end as decimal(38,10)), 1) as decimal(38,1)) as price from part)
    select which_diff, p_partkey, cast(price as double) as price from (
    select 'a_minus_b' as which_diff, * from (select * from a except select * from b) as x
    union all select 'b_minus_a', * from (select * from b except select * from a) as y) as u
    """,
)
def equality_with_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("price"))
    b = a.withColumn("price", F.expr("price + case when p_partkey % 7 = 0 then 0.36e0 else 0.04e0 end"))
    rounded = quality.equality(a, b, precision=1)
    return rounded.select("which_diff", F.col("p_partkey").cast("bigint").alias("p_partkey"), F.col("price").cast("double").alias("price"))


@query("dq_6_expression_is_true", "select l_orderkey, l_linenumber, l_partkey, l_quantity, l_tax from lineitem where not (l_tax < l_quantity / 100)")
def expression_is_true(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_tax")
    return quality.expression_is_true(rows, "< l_quantity / 100", "l_tax")


@query(
    "dq_7_fewer_rows_than",
    "select x.a as count_our_model, x.b as count_comparison_model, case when a > b then a - b when a = b then 1 else 0 end as row_count_delta "
    "from (select (select count(*) from lineitem) as a, (select count(*) from orders) as b) as x",
)
def fewer_rows_than(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.fewer_rows_than(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


@query(
    "dq_7_fewer_rows_than_by_group",
    "select a.k as k_a, b.k as k_b, x as count_our_model, y as count_comparison_model, "
    "cast(case when x > y then x - y when x = y then 1 else 0 end as bigint) as row_count_delta from "
    "(select s_nationkey as k, count(*) as x from supplier group by 1) as a full join "
    "(select p_size as k, count(*) as y from part group by 1) as b on a.k = b.k",
)
def fewer_rows_than_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))
    b = table(spark, sf_dir, "part").select(F.col("p_size").alias("k"))
    return quality.fewer_rows_than(a, b, ["k"])


# --- ranges and sequences --------------------------------------------------------------------------

_RANGES = {
    "customer_id": "user_id",
    "valid_from": "event_id",
    "valid_to": "case when event_id % 50 = 0 then null when event_id % 11 = 0 then event_id else event_id + event_id % 400 end",
}


def _ranges_sql(operator: str, length: str, by: str | None) -> str:
    over = f"partition by {by} " if by else ""
    selected = f"{by} as partition_by_col, " if by else ""
    rows = ", ".join(f"{e} as {c}" for c, e in _RANGES.items())
    return f"""
    select * from (
        select {selected}valid_from as lower_bound, valid_to as upper_bound,
               lead(valid_from) over ({over}order by valid_from, valid_to) as next_lower_bound,
               row_number() over ({over}order by valid_from desc, valid_to desc) = 1 as is_last_record
        from (select {rows} from events) as e
    ) as w where not (coalesce(lower_bound {length} upper_bound, false)
                      and coalesce(upper_bound {operator} next_lower_bound, is_last_record, false))"""


def _ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*[F.expr(e).alias(c) for c, e in _RANGES.items()])


def _register_ranges(gaps: str, operator: str, zero_length: bool, by: str | None) -> None:
    name = f"dq_8_ranges_gaps_{gaps}{'_by_customer' if by else ''}"

    @query(name, _ranges_sql(operator, "<=" if zero_length else "<", by))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return quality.mutually_exclusive_ranges(
            _ranges(spark, sf_dir), "valid_from", "valid_to", by, gaps, zero_length
        )


_register_ranges("not_allowed", "=", False, "customer_id")
_register_ranges("allowed", "<=", True, "customer_id")
_register_ranges("required", "<", False, None)


@query(
    "dq_15_sequential_values",
    "select * from (select o_orderstatus, o_orderkey, lag(o_orderkey) over (partition by o_orderstatus order by o_orderkey) as previous_o_orderkey "
    "from orders) as t where not (o_orderkey = previous_o_orderkey + 1)",
)
def sequential_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.sequential_values(table(spark, sf_dir, "orders"), "o_orderkey", group_by=["o_orderstatus"])


@query(
    "dq_15_sequential_hours",
    "select * from (select hour, lag(hour) over (order by hour) as previous_hour from "
    "(select distinct date_trunc('hour', case when event_type = 'error' then ts else date_trunc('day', ts) end) as hour from events) as h) as t "
    "where not (hour = previous_hour + interval 1 hour)",
)
def sequential_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Other events count at the start of their day.
    moment = F.when(F.col("event_type") == "error", F.col("ts")).otherwise(F.date_trunc("day", "ts"))
    hours = table(spark, sf_dir, "events").select(F.date_trunc("hour", moment).cast("timestamp_ntz").alias("hour")).distinct()
    return quality.sequential_values(hours, "hour", 1, "hour")


# --- values ---------------------------------------------------------------------------------------------

@query("dq_9_not_accepted_values", "select distinct o_orderpriority as value_field from orders where o_orderpriority in ('5-LOW', '1-URGENT', 'none')")
def not_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_accepted_values(table(spark, sf_dir, "orders"), "o_orderpriority", ["5-LOW", "1-URGENT", "none"])


@query(
    "dq_10_not_constant",
    "select o_custkey, count(distinct o_orderstatus) as filler_column from orders group by 1 having count(distinct o_orderstatus) = 1",
)
def not_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_constant(table(spark, sf_dir, "orders"), "o_orderstatus", ["o_custkey"])


@query(
    "dq_11_not_empty_string",
    "select * from (select trim(case when event_id % 6 = 0 then '   ' when event_id % 6 = 1 then '' when event_id % 6 = 2 then null else props end) as p "
    "from events) as t where p = ''",
)
def not_empty_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.expr("case when event_id % 6 = 0 then '   ' when event_id % 6 = 1 then '' when event_id % 6 = 2 then null else props end")
    return quality.not_empty_string(table(spark, sf_dir, "events").select(p.alias("p")), "p")


@query(
    "dq_12_not_null_proportion",
    "select o_orderpriority, cast(count(v) as double) / count(*) as not_null_proportion from (select o_orderpriority, "
    "case when o_orderstatus = 'P' then null else o_orderkey end as v from orders) as t group by 1 "
    "having cast(count(v) as double) / count(*) < 0.6666e0 or cast(count(v) as double) / count(*) > 0.67e0",
)
def not_null_proportion(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("v")
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", v)
    return quality.not_null_proportion(rows, "v", 0.6666, 0.67, ["o_orderpriority"])


_NOW = "timestamp_ntz'2024-01-31 00:00:00'"


@query(
    "dq_13_recency",
    "select user_id, max(t) as most_recent, timestamp '2024-01-31 00:00:00' - interval 5 hour as threshold from (select user_id, "
    "case when user_id % 20 = 0 then null else ts end as t from events) as e group by 1 "
    "having max(t) is null or max(t) < timestamp '2024-01-31 00:00:00' - interval 5 hour",
)
def recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", F.when(F.col("user_id") % 20 != 0, F.col("ts")).alias("t"))
    return quality.recency(rows, "t", "hour", 5, _NOW, group_by=["user_id"])


@query(
    "dq_13_recency_by_day",
    "select event_type, cast(max(ts) as date) as most_recent, date '2024-02-29' as threshold from events group by 1 "
    "having cast(max(ts) as date) < date '2024-02-29'",
)
def recency_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.recency(
        table(spark, sf_dir, "events"), "ts", "day", 1, "timestamp_ntz'2024-03-01 05:00:00'", ignore_time=True, group_by=["event_type"]
    )


@query(
    "dq_14_relationships_where",
    "select o_custkey as id, null::bigint as right_id from orders where o_custkey is not null and o_orderstatus = 'F' "
    "and o_custkey not in (select c_custkey from customer where c_mktsegment <> 'MACHINERY')",
)
def relationships_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.relationships_where(
        table(spark, sf_dir, "orders"), "o_custkey", table(spark, sf_dir, "customer"), "c_custkey",
        "o_orderstatus = 'F'", "c_mktsegment <> 'MACHINERY'",
    )


@query(
    "dq_16_unique_combination",
    "select l_orderkey, l_linenumber from lineitem group by 1, 2 having count(*) > 1",
)
def unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique_combination(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_17_unique",
    "select o_custkey as unique_field, count(*) as n_records from orders where o_custkey is not null group by 1 having count(*) > 1",
)
def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique(table(spark, sf_dir, "orders"), "o_custkey")


@query(
    "dq_17_not_null",
    "select * from (select doc_id, case when lang = 'fr' then null else lang end as lang from documents) as t where lang is null",
)
def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang = F.when(F.col("lang") != "fr", F.col("lang")).alias("lang")
    return quality.not_null(table(spark, sf_dir, "documents").select("doc_id", lang), "lang")


@query(
    "dq_18_accepted_values",
    "select event_type as value_field, count(*) as n_records from events where event_type not in ('click', 'view') group by 1",
)
def accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted_values(table(spark, sf_dir, "events"), "event_type", ["click", "view"])


@query(
    "dq_19_relationships",
    "select doc_id as from_field from documents where doc_id not in (select doc_id from labels)",
)
def relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.relationships(table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels"), "doc_id")


@query(
    "dq_20_assert_equal",
    "select * from (select doc_id, n_chars, cast(length(text) as bigint) + case when doc_id % 9 = 0 then 1 else 0 end as expected "
    "from documents) as t where n_chars <> expected",
)
def assert_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = (F.length("text") + F.when(F.col("doc_id") % 9 == 0, 1).otherwise(0)).cast("bigint").alias("expected")
    return quality.assert_equal(table(spark, sf_dir, "documents").select("doc_id", "n_chars", expected), "n_chars", "expected")


@query(
    "dq_21_columns_match_set",
    "select column_name, case when column_name = 'o_comment' then 'missing' else 'unexpected' end as problem from ("
    "select 'o_comment' as column_name union all select column_name from (describe orders) where column_name not in "
    "('o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate')) as t",
)
def columns_match_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.columns_match_set(
        spark.read.parquet(f"{sf_dir}/orders.parquet"),  # the file's own columns
        ["O_ORDERKEY", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_comment"],
    )


@query(
    "dq_22_check_results",
    """
    select 'status' as test, (select count(distinct o_orderstatus) from orders where o_orderstatus not in ('F', 'O')) as failures, 'error' as status
    union all select 'cheap', (select count(*) from orders where not (o_totalprice >= 20000)), 'warn'
    union all select 'tolerated', (select count(*) from orders where not (o_totalprice <= 499000)), case when
        (select count(*) from orders where not (o_totalprice <= 499000)) > 0 then 'warn' else 'pass' end
    union all select 'urgent only', (select count(*) from orders where o_orderpriority = '1-URGENT' and o_totalprice < 0), 'pass'
    union all select 'more rows', abs((select count(*) from orders) - (select count(*) from customer)), 'error'
    """,
)
def check_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return quality.run_checks(orders, [
        Check("status", lambda d: quality.accepted_values(d, "o_orderstatus", ["F", "O"])),
        Check("cheap", lambda d: quality.accepted_range(d, "o_totalprice", 20000), severity="warn"),
        Check("tolerated", lambda d: quality.accepted_range(d, "o_totalprice", None, 499000), error_if="> 1000000000"),
        Check("urgent only", lambda d: quality.accepted_range(d, "o_totalprice", 0), where="o_orderpriority = '1-URGENT'"),
        Check("more rows", lambda d: quality.equal_rowcount(d, customer), fail_calc="sum(coalesce(diff_count, 0))"),
    ])


# --- the declared tests of the warehouse -------------------------------------------------------------------

@query(
    "dq_course_checks",
    with_courses(
        """
        select 'course_id is not null' as test, count(*) as failures, case when count(*) = 0 then 'pass' else 'error' end as status from courses where course_id is null
        union all select 'platform is accepted', count(distinct platform), 'pass' from courses where platform not in ('Coursera', 'Udacity', 'Udemy')
        union all select 'level is accepted', count(distinct level), 'pass' from courses where level not in ('Beginner', 'Intermediate', 'Advanced', 'All Levels', 'Unknown')
        union all select 'price_category is accepted', count(*), 'pass' from courses where price_category not in ('Free', 'Cheap', 'Medium', 'Expensive', 'Premium', 'Unknown')
        union all select 'duration_category is accepted', count(*), 'pass' from courses where duration_category not in ('Short', 'Medium', 'Long', 'Extensive', 'Unknown')
        union all select 'rating in range', count(*), 'pass' from courses where not rating >= 0 or not rating <= 5
        union all select 'price in range', count(*), case when count(*) = 0 then 'pass' else 'warn' end from courses where not price >= 0
        union all select 'course_id and platform are unique', count(*), 'pass' from (select course_id, platform from courses group by 1, 2 having count(*) > 1) as t
        """
    ),
)
def course_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    courses = stage(standardized(spark, sf_dir), "courses")
    return quality.run_checks(courses, COURSE_CHECKS)


COURSE_CHECKS = [
    Check("course_id is not null", lambda d: quality.not_null(d, "course_id")),
    Check("platform is accepted", lambda d: quality.accepted_values(d, "platform", ["Coursera", "Udacity", "Udemy"])),
    Check("level is accepted", lambda d: quality.accepted_values(
        d, "level", ["Beginner", "Intermediate", "Advanced", "All Levels", "Unknown"])),
    Check("price_category is accepted", lambda d: quality.accepted_values(
        d, "price_category", ["Free", "Cheap", "Medium", "Expensive", "Premium", "Unknown"])),
    Check("duration_category is accepted", lambda d: quality.accepted_values(
        d, "duration_category", ["Short", "Medium", "Long", "Extensive", "Unknown"])),
    Check("rating in range", lambda d: quality.accepted_range(d, "rating", 0, 5), severity="warn"),
    Check("price in range", lambda d: quality.accepted_range(d, "price", 0), severity="warn"),
    Check("course_id and platform are unique", lambda d: quality.unique_combination(d, ["course_id", "platform"])),
]
