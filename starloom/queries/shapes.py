"""Projection, joins, aggregates, windows and set operations on whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.core import exact_avg, rows_frame
from ..functions.keys import date_key
from ..functions.standard import rank_in
from ..operators import aggregate, joins, numbering, shape
from ..operators.quality import symmetric_difference
from ..plans import dashboard
from ..plans.semantic import share_of_group, share_of_total
from ..plans.star import add_member
from ..sources.catalog import relations_by_prefix, union_by_pattern
from .registry import avg, query, r, table


# --- projection ---------------------------------------------------------------------------

@query(
    "prj_4_star",
    "select n_nationkey as from_n_nationkey_x, n_name as nation from nation",
)
def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return nation.select(*shape.star(
        nation, exclude=["N_REGIONKEY"], prefix="from_", suffix="_x", rename={"n_name": "nation"}
    ))


@query(
    "prj_4_star_after_join",
    "select n.n_nationkey, n.n_name, r.r_name from nation n join region r on n.n_regionkey = r.r_regionkey",
)
def star_after_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nation.alias("n").join(region.alias("r"), F.col("n.n_regionkey") == F.col("r.r_regionkey"))
    return joined.select(
        *shape.star(nation, exclude=["n_regionkey"], alias="n"), *shape.star(region, exclude=["r_regionkey"], alias="r")
    )


@query(
    "prj_5_nullcheck",
    "select event_id, nullif(a, '') as a, nullif(event_type, '') as event_type, user_id from ("
    "select event_id, case when event_id % 3 = 0 then '' else event_type end as a, event_type, user_id from events) as t",
)
def nullcheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    blanked = F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("event_type")).alias("a")
    return shape.nullcheck(events.select("event_id", blanked, "event_type", "user_id"))


@query(
    "prj_6_group_by_first",
    "select l_returnflag, l_linestatus, count(*) as n, " + avg("l_quantity") + " as avg_qty from lineitem group by 1, 2",
)
def group_by_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return aggregate.group_by_first(rows, 2).agg(
        F.count(F.lit(1)).alias("n"), F.round(exact_avg("l_quantity"), 2).alias("avg_qty")
    )


# --- filters --------------------------------------------------------------------------------

@query(
    "flt_1_numeric_id",
    "select doc_id, raw from (select doc_id, case when doc_id % 3 = 0 then source when doc_id % 7 = 1 then null "
    "else cast(doc_id as string) end as raw from documents) as t where try_cast(raw as integer) is not null",
)
def numeric_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.expr("case when doc_id % 3 = 0 then source when doc_id % 7 = 1 then null else cast(doc_id as string) end")
    rows = table(spark, sf_dir, "documents").select("doc_id", raw.alias("raw"))
    return rows.filter(F.col("raw").try_cast("int").isNotNull())


@query(
    "flt_2_not_blank",
    "select event_id, who from (select event_id, case when event_id % 4 = 0 then '   ' when event_id % 4 = 1 then null "
    "else event_type end as who from events) as t where who is not null and trim(who) <> ''",
)
def not_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    who = F.expr("case when event_id % 4 = 0 then '   ' when event_id % 4 = 1 then null else event_type end")
    return table(spark, sf_dir, "events").select("event_id", who.alias("who")).filter(F.trim("who") != "")


@query(
    "flt_3_not_null_key",
    "select l.doc_id, d.document from labels l left join (select case when lang = 'en' then doc_id end as document from documents) d "
    "on l.doc_id = d.document where d.document is not null",
)
def not_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    english = table(spark, sf_dir, "documents").select(F.when(F.col("lang") == "en", F.col("doc_id")).alias("document"))
    labels = table(spark, sf_dir, "labels").select("doc_id")
    return labels.join(english, labels.doc_id == english.document, "left").filter(F.col("document").isNotNull())


# --- joins ------------------------------------------------------------------------------------

@query(
    "jn_2_coalesced_key",
    "select o_orderkey, coalesce(s_name, 'none') as s_name from (select o_orderkey, case when o_custkey % 5 = 0 then null "
    "else 'Supplier#' || lpad(cast(o_custkey % 150 as string), 9, '0') end as who from orders) as o "
    "left join (select coalesce(s_name, 'Supplier#000000000') as s_name from supplier) as s "
    "on coalesce(o.who, 'Supplier#000000000') = s.s_name",
)
def coalesced_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    default = "Supplier#000000000"
    who = F.expr("case when o_custkey % 5 = 0 then null else 'Supplier#' || lpad(cast(o_custkey % 150 as string), 9, '0') end")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(who, F.lit(default)).alias("__key"))
    supplier = table(spark, sf_dir, "supplier").select(
        F.coalesce("s_name", F.lit(default)).alias("__key"), F.col("s_name")
    )
    joined = joins.salted_join(orders, supplier, ["__key"], "left")
    return joined.select("o_orderkey", F.coalesce("s_name", F.lit("none")).alias("s_name"))


@query(
    "jn_3_date_key",
    "select o.o_orderkey, d.full_date from (select *, cast(strftime(o_orderdate, '%Y%m%d') as integer) as k from orders) as o "
    "left join (select distinct case when l_returnflag = 'R' then cast(strftime(l_shipdate, '%Y%m%d') as integer) end as k, "
    "cast(l_shipdate as date) as full_date from lineitem) as d on o.k = d.k",
)
def date_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = table(spark, sf_dir, "lineitem")
    days = shipped.select(F.when(F.col("l_returnflag") == "R", date_key("l_shipdate")).alias("__k"), F.col("l_shipdate").cast("date").alias("full_date")).distinct()
    orders = table(spark, sf_dir, "orders").select("o_orderkey", date_key("o_orderdate").alias("__k"))
    return orders.join(days, "__k", "left").select("o_orderkey", "full_date")


@query(
    "jn_5_star_count_top",
    "select n_name, count(*) as orders from orders join customer on o_custkey = c_custkey "
    "join nation on c_nationkey = n_nationkey group by 1 order by 2 desc, 1 limit 10",
)
def star_count_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_customer = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("__n"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    per_nation = (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey").agg(F.sum("__n").alias("orders"))
    )
    return (
        per_nation.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name").agg(F.sum("orders").alias("orders"))
        .orderBy(F.desc("orders"), "n_name").limit(10)
    )


@query(
    "jn_6_match_rate",
    "select count(*) as total, count(d.doc_id) as matched from conversations c left join labels d on c.conv_id = d.doc_id",
)
def match_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.match_rate(
        table(spark, sf_dir, "conversations"), table(spark, sf_dir, "labels"), {"conv_id": "doc_id"}, "doc_id"
    )


@query(
    "jn_7_orphans",
    "select o_orderkey, o_custkey from orders where o_custkey not in "
    "(select case when c_nationkey = 3 then -c_custkey else c_custkey end from customer)",
)
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    known = table(spark, sf_dir, "customer").selectExpr("case when c_nationkey = 3 then -c_custkey else c_custkey end as c_custkey")
    return joins.orphans(orders, "o_custkey", known, "c_custkey")


@query(
    "jn_8_full_join_of_counts",
    "select a.k as key_a, b.k as key_b, a.n as count_a, b.n as count_b from "
    "(select p_size as k, count(*) as n from part group by 1) as a full join "
    "(select s_nationkey as k, count(*) as n from supplier group by 1) as b on a.k = b.k",
)
def full_join_of_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    left = part.groupBy(F.col("p_size").alias("key_a")).agg(F.count(F.lit(1)).alias("count_a"))
    right = supplier.groupBy(F.col("s_nationkey").alias("key_b")).agg(F.count(F.lit(1)).alias("count_b"))
    return left.join(right, F.col("key_a") == F.col("key_b"), "full")


@query(
    "jn_10_only_new",
    "select doc_id, lang from documents where doc_id not in (select doc_id from labels)",
)
def only_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return joins.only_new(documents, table(spark, sf_dir, "labels"), ["doc_id"])


@query(
    "jn_11_names_for_ids",
    """
    with single as (
        select o_orderkey, unnest([o_custkey % 25, o_orderkey % 40, o_custkey % 7]) as id, unnest([0, 1, 2]) as place from orders
    )
    select o.o_orderkey, coalesce(t.names, '') as names from orders o left join (
        select o_orderkey, string_agg(n_name, ', ' order by place) as names
        from single join nation on id = n_nationkey group by 1
    ) as t on o.o_orderkey = t.o_orderkey
    """,
)
def names_for_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.expr("array(o_custkey % 25, o_orderkey % 40, o_custkey % 7)")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", ids.alias("ids"))
    nation = table(spark, sf_dir, "nation")
    return joins.names_for_ids(orders, "o_orderkey", "ids", nation, "n_nationkey", "n_name", "names")


@query(
    "jn_12_patch",
    """
    select d.doc_id, case when l.doc_id is null then d.lang else l.lang end as lang,
           case when l.doc_id is null then d.n_chars else l.n_chars end as n_chars, d.source
    from documents d left join (
        select doc_id, case when toxic = 1 then null else 'patched' end as lang, cast(quality as bigint) as n_chars from labels
    ) as l on d.doc_id = l.doc_id
    """,
)
def patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixes = table(spark, sf_dir, "labels").select(
        "doc_id", F.expr("case when toxic = 1 then null else 'patched' end").alias("lang"),
        F.col("quality").cast("bigint").alias("n_chars"),
    )
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", "source")
    return joins.patch(documents, fixes, ["doc_id"], ["lang", "n_chars"])


@query(
    "jn_13_zip_rows",
    """
    select a.c_custkey, a.c_name, b.s_suppkey, b.s_name from
    (select *, row_number() over (order by c_name) as rn from customer) as a full join
    (select *, row_number() over (order by s_acctbal desc, s_suppkey) as rn from supplier) as b on a.rn = b.rn
    """,
)
def zip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    zipped = joins.zip_rows(customer, supplier, ["c_name"], [F.desc("s_acctbal"), F.asc("s_suppkey")])
    return zipped.select("c_custkey", "c_name", "s_suppkey", "s_name")


# --- aggregates and reshaping ----------------------------------------------------------------------

_HOLES = "case when {c} % 5 = 0 then null else {c} end"


@query(
    "agg_6_null_profile",
    "select count(*) as total_rows, " + ", ".join(
        f"count(case when {c} is null then 1 end) as null_{c}" for c in ("a", "b", "o_orderstatus")
    ) + f" from (select *, {_HOLES.format(c='o_custkey')} as a, {_HOLES.format(c='o_orderkey')} as b from orders) as t",
)
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.expr(_HOLES.format(c="o_custkey")).alias("a"), F.expr(_HOLES.format(c="o_orderkey")).alias("b"), "o_orderstatus"
    )
    return aggregate.null_profile(orders, ["a", "b", "o_orderstatus"])


@query("agg_7_distinct", "select distinct p_brand, p_type from part")
def distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_brand", "p_type").distinct()


@query(
    "agg_8_pivot",
    "select o_orderpriority, " + ", ".join(
        f"cast(sum(case when o_orderstatus = '{v}' then 1 else 0 end) as bigint) as \"n_{v}\", "
        f"cast(sum(case when o_orderstatus = '{v}' then o_totalprice * 100 else 0 end) as bigint) as \"{v}_cents\""
        for v in ("F", "O", "P")
    ) + " from orders group by 1",
)
def pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    values = shape.column_value_list(orders, "o_orderstatus", order_by=[F.asc("value")])
    cents = (F.col("o_totalprice") * 100).cast("decimal(20,0)")
    counted = shape.pivot("o_orderstatus", values, prefix="n_")
    valued = shape.pivot("o_orderstatus", values, suffix="_cents", then_value=cents)
    result = orders.groupBy("o_orderpriority").agg(*counted, *valued)
    return result.select("o_orderpriority", *[F.col(c).cast("bigint") for c in result.columns[1:]])


@query(
    "agg_8_pivot_by_value_table",
    """
    with listed as (select l_suppkey as value, row_number() over (order by count(*) desc, l_suppkey) as place
                    from lineitem where l_returnflag = 'R' group by 1),
    counted as (select l_linestatus, l_suppkey as value, cast(sum(l_quantity) as bigint) as n from lineitem group by 1, 2)
    select l_linestatus, count(*) as n_values, cast(sum(n) as bigint) as total,
           string_agg(cast(value as varchar) || '=' || cast(n as varchar), ',' order by place) as cells
    from counted join listed using (value) group by 1
    """,
)
def pivot_by_value_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    values = shape.column_values(lines, "l_suppkey", where="l_returnflag = 'R'")
    wide = shape.pivot_map(lines, ["l_linestatus"], "l_suppkey", values, then_value=F.col("l_quantity").cast("decimal(20,0)"))
    pairs = F.transform(F.map_entries("cells"), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"].cast("bigint").cast("string")))
    total = F.aggregate(F.map_values("cells"), F.lit(0).cast("bigint"), lambda s, n: s + n.cast("bigint"))
    return wide.select("l_linestatus", F.size("cells").cast("bigint").alias("n_values"), total.alias("total"), F.array_join(pairs, ",").alias("cells"))


@query(
    "agg_9_unpivot",
    "select c_custkey, field, value from (select c_custkey, 'c_name' as field, c_name as value from customer union all "
    "select c_custkey, 'c_nationkey', cast(c_nationkey as varchar) from customer union all "
    "select c_custkey, 'c_mktsegment', case when c_custkey % 3 = 0 then null else c_mktsegment end from customer union all "
    "select c_custkey, 'rich', cast(c_acctbal > 5000 as varchar) from customer) as t",
)
def unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
        (F.col("c_acctbal") > 5000).alias("rich"), "c_acctbal",
    )
    return shape.unpivot(customer, exclude=["c_custkey"], remove=["C_ACCTBAL"], field_name="field")


@query(
    "agg_10_column_values",
    "select l_suppkey as value from lineitem where l_returnflag = 'R' group by 1 order by count(*) desc, 1 limit 50",
)
def column_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.column_values(table(spark, sf_dir, "lineitem"), "l_suppkey", max_records=50, where="l_returnflag = 'R'")


@query(
    "agg_11_single_value",
    "select o_orderpriority, count(*) as n from orders where o_totalprice > (select avg(c) from "
    "(select sum(cast(o_totalprice as decimal(24,6))) / count(*) as c from orders) as t) group by 1",
)
def single_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    mean = shape.single_value(orders.agg(exact_avg("o_totalprice")), 0.0)
    return orders.filter(F.col("o_totalprice") > mean).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query(
    "agg_11_results_as_dict",
    "select o_orderstatus, n from (select o_orderstatus, count(*) as n from orders group by 1) as t",
)
def results_as_dict(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = shape.results_as_dict(
        table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    )
    return rows_frame(spark, list(zip(*counts.values())), "o_orderstatus string, n bigint")


@query(
    "agg_12_deduplicate",
    "select user_id, event_type, ts, value, event_id from (select *, row_number() over (partition by user_id, event_type "
    "order by value desc, event_id) as rn from events) as t where rn = 1",
)
def deduplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "value", "event_id")
    return shape.deduplicate(events, ["user_id", "event_type"], [F.desc("value"), F.asc("event_id")])


@query(
    "agg_13_keep_last",
    "select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by event_id desc) as rn "
    "from events) as t where rn = 1",
)
def keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return shape.keep_last(events, ["user_id"], F.col("event_id"))


@query(
    "agg_13_keep_first_by_slug",
    "select page_id, slug, url from (select *, row_number() over (partition by coalesce(slug, url) order by page_id) as rn from "
    "(select page_id, url, case when page_id % 4 = 0 then null else split_part(url, '/', 4) end as slug from pages) as p) as t "
    "where rn = 1",
)
def keep_first_by_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    slug = F.when(F.col("page_id") % 4 != 0, F.split_part("url", F.lit("/"), F.lit(4))).alias("slug")
    pages = table(spark, sf_dir, "pages").select("page_id", slug, "url")
    return shape.dedupe_by_slug(pages, "slug", "url", F.col("page_id"))


# --- windows -------------------------------------------------------------------------------------

@query(
    "win_2_global_row_number",
    "select o_orderkey, o_orderdate, row_number() over (order by o_orderdate, o_orderkey) as rn from orders",
)
def global_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return numbering.number_rows(orders, ["o_orderdate", "o_orderkey"], "rn")


@query(
    "win_3_rank_and_decile",
    "select c_custkey, c_acctbal, row_number() over (order by c_acctbal desc, c_custkey) as overall_rank, "
    "ntile(10) over (order by c_acctbal desc, c_custkey) as decile from customer",
)
def rank_and_decile(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    ranked = numbering.number_rows(customer, [F.desc("c_acctbal"), F.asc("c_custkey")], "overall_rank", "n")
    return ranked.withColumn("decile", numbering.ntile("overall_rank", "n", 10)).drop("n")


@query(
    "win_4_share_of_group",
    "select o_orderpriority, o_orderstatus, n, "
    + r("n * 100.0e0 / nullif(sum(n) over (partition by o_orderpriority), 0)", 1)
    + " as pct from (select o_orderpriority, o_orderstatus, count(*) as n from orders group by 1, 2) as t",
)
def group_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return share_of_group(counted, "n", "o_orderpriority", "pct")


@query(
    "win_5_share_of_total",
    "select o_orderpriority, n, " + r("n * 100.0e0 / nullif(sum(n) over (), 0)", 1)
    + " as pct from (select o_orderpriority, count(*) as n from orders group by 1) as t",
)
def total_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return share_of_total(counted, "n", "pct")


@query(
    "win_6_previous_value",
    "select user_id, event_id, value, lag(event_id) over (partition by user_id order by event_id) as previous_id, "
    "lag(value) over (partition by user_id order by event_id) as previous_value from events",
)
def previous_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return numbering.with_neighbours(
        events, ["user_id"], ["event_id"], previous={"previous_id": "event_id", "previous_value": "value"}
    )


@query(
    "win_7_next_value",
    "select event_type, event_id, lead(event_id) over (partition by event_type order by event_id) as next_id, "
    "row_number() over (partition by event_type order by event_id desc) = 1 as is_last_record from events",
)
def next_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", "event_id")
    walked = numbering.with_neighbours(events, ["event_type"], ["event_id"], following={"next_id": "event_id"})
    return walked.withColumn("is_last_record", F.col("next_id").isNull())


# --- sort, limit ----------------------------------------------------------------------------------

@query(
    "srt_1_business_order",
    "select p_type, count(*) as n from part group by 1 order by case p_type when 'SMALL' then 1 when 'MEDIUM' then 2 "
    "when 'LARGE' then 3 else 4 end, p_type",
)
def business_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(rank_in("p_type", ["SMALL", "MEDIUM", "LARGE"]), "p_type")


@query(
    "srt_2_top_rows",
    "select o_orderkey, o_totalprice from orders where o_totalprice is not null order by o_totalprice desc, o_orderkey limit 10",
)
def top_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.top_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", ["o_orderkey"])


# --- set operations ----------------------------------------------------------------------------------

@query(
    "set_2_union_relations",
    """
    select 'customer' as source, c_custkey as id, c_name as name, cast(c_nationkey as varchar) as nation,
           c_acctbal as balance, c_mktsegment as segment, null::bigint as parts from customer where c_acctbal > 1000
    union all
    select 'supplier', s_suppkey, s_name, cast(s_nationkey as varchar), s_acctbal, null, s_suppkey % 9 from supplier where s_acctbal > 1000
    """,
)
def union_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.union_relations(
        _parties(spark, sf_dir), column_override={"nation": "string"}, exclude=["Internal"], source_column="source",
        where="balance > 1000",
    )


def _parties(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    customer = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as id", "c_name as name", "c_nationkey as nation", "c_acctbal as balance", "c_mktsegment as segment",
        "1 as internal",
    )
    supplier = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as id", "s_name as name", "s_nationkey as nation", "s_acctbal as balance", "s_suppkey % 9 as parts",
    )
    return {"customer": customer, "supplier": supplier}


@query(
    "src_9_union_by_pattern",
    """
    select 'customer' as origin, c_custkey as id, c_name as name, null::bigint as parts from customer
    union all select 'supplier', s_suppkey, s_name, s_suppkey % 9 from supplier
    """,
)
def union_by_name_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = f"party{uuid.uuid4().hex[:8]}"
    for name, df in _parties(spark, sf_dir).items():
        df.createOrReplaceTempView(f"{mark}_{name}")
        df.createOrReplaceTempView(f"{mark}_{name}_old")
    union = union_by_pattern(spark, "%", f"{mark}%", "%OLD", source_column="origin", include=["ID", "name", "parts"])
    assert len(relations_by_prefix(spark, "%", mark, "%_old")) == 2
    for name in relations_by_prefix(spark, "%", mark):  # the union has read their plans
        spark.catalog.dropTempView(name)
    return union.withColumn("origin", F.regexp_replace("origin", f"^{mark}_", ""))


@query(
    "set_3_unknown_member",
    "select cast(r_regionkey as bigint) as region_id, r_name as region_name from region union all select -1, 'Unknown'",
)
def unknown_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("bigint").alias("region_id"), F.col("r_name").alias("region_name")
    )
    return add_member(region, region_id=-1, region_name="Unknown")


@query(
    "set_4_symmetric_except",
    "select 'a_minus_b' as which_diff, * from (select c_nationkey as nation, c_custkey % 10 as k from customer except "
    "select s_nationkey, s_suppkey % 10 from supplier) as x union all select 'b_minus_a', * from "
    "(select s_nationkey, s_suppkey % 10 from supplier except select c_nationkey, c_custkey % 10 from customer) as y",
)
def symmetric_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").selectExpr("c_nationkey as nation", "c_custkey % 10 as k")
    b = table(spark, sf_dir, "supplier").selectExpr("s_nationkey as nation", "s_suppkey % 10 as k")
    return symmetric_difference(a, b)


# --- exact medians, modes and lists at scale ------------------------------------------------------------

@query(
    "agg_1_exact_median",
    "select l_returnflag, median(l_extendedprice) as median_price, median(l_quantity) as median_qty from lineitem group by 1",
)
def exact_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.medians(
        table(spark, sf_dir, "lineitem"), ["l_returnflag"], {"median_price": "l_extendedprice", "median_qty": "l_quantity"}
    )


@query(
    "agg_2_mode",
    """
    with a as (select l_suppkey, l_returnflag as v, count(*) as n from lineitem group by 1, 2),
         b as (select l_suppkey, l_linestatus as v, count(*) as n from lineitem group by 1, 2)
    select a.l_suppkey, a.v as common_flag, b.v as common_status
    from (select *, row_number() over (partition by l_suppkey order by n desc, v) as rn from a) as a
    join (select *, row_number() over (partition by l_suppkey order by n desc, v) as rn from b) as b
    on a.l_suppkey = b.l_suppkey and a.rn = 1 and b.rn = 1
    """,
)
def mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.modes(
        table(spark, sf_dir, "lineitem"), ["l_suppkey"], {"common_flag": "l_returnflag", "common_status": "l_linestatus"}
    )


@query(
    "agg_3_distinct_text",
    "select o_custkey, string_agg(distinct o_orderpriority, ', ' order by o_orderpriority) as priorities, "
    "string_agg(distinct o_orderstatus, ', ' order by o_orderstatus) as statuses from orders group by 1",
)
def distinct_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.distinct_text(
        table(spark, sf_dir, "orders"), ["o_custkey"], {"priorities": "o_orderpriority", "statuses": "o_orderstatus"}
    )

