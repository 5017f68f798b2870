"""Sources and sinks: whole tables written to the staging folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.staging_area import staging_root
from ..sources import catalog, files, toll
from .registry import query, table


def _scratch(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/starloom/files/{label}-{uuid.uuid4().hex}"


@query(
    "src_1_course_csv",
    "select cast(doc_id as varchar) as course_id, text as \"Description\", lang as \"Language\", "
    "'say \"' || source || '\", twice' as \"Course_Title\" from documents",
)
def course_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.concat(F.lit('say "'), "source", F.lit('", twice')).alias("Course_Title")
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("course_id"), F.col("text").alias("Description"),
        F.col("lang").alias("Language"), title,
    )
    path = _scratch(spark, "course-csv")
    files.write_csv(rows, path)
    return files.read_course_csv(spark, path, rows.columns)


@query(
    "src_2_json_records",
    "select conv_id, turn, role, text, case when turn % 2 = 0 then null else role end as maybe from conversations",
)
def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    maybe = F.when(F.col("turn") % 2 != 0, F.col("role")).alias("maybe")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", maybe)
    path = _scratch(spark, "json")
    files.write_json_records(rows, path)
    return files.read_json_records(spark, path, rows.schema, lines=True)


_LINE = {
    "Rowid": "cast(o_orderkey as string)",
    "Timestamp": "cast(o_orderdate as string)",
    "VehicleNumber": "'V' || cast(o_custkey as string)",
    "VehicleType": "o_orderpriority",
    "TollPlazaID": "cast(o_custkey % 97 as string)",
    "TollPlazaCode": "'PC' || o_orderstatus",
    "PaymentCode": "o_orderstatus || 'X'",
}


def _lines(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*[f"{_LINE[c]} as {c}" for c in columns])


def _line_sql(columns: list[str]) -> str:
    return "select " + ", ".join(f'{_LINE[c]} as "{c}"' for c in columns) + " from orders"


@query("src_3_csv_columns", _line_sql(list(_LINE)[:4]))
def csv_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "vehicles")
    files.write_csv(_lines(spark, sf_dir, list(_LINE)[:4]), path)
    return files.read_vehicles(spark, path)


@query("src_4_tsv_columns", _line_sql(list(_LINE)[4:]))
def tsv_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "plazas")
    _lines(spark, sf_dir, list(_LINE)).write.option("header", True).option("sep", "\t").csv(path)
    return files.read_toll_plazas(spark, path)


_FIXED = "lpad(cast(o_orderkey % 100000 as string), 5, '0') || ' ' || rpad(o_orderpriority, 10, ' ') || 'tail'"


@query(
    "src_5_fixed_width",
    "select lpad(cast(o_orderkey % 100000 as varchar), 5, '0') as row_number, substr(rpad(o_orderpriority, 10, ' '), 1, 10) as payment_type from orders",
)
def fixed_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "payments")
    table(spark, sf_dir, "orders").selectExpr(f"{_FIXED} as value").write.text(path)
    return files.read_payments(spark, path)


@query(
    "src_6_csv_append",
    "select cast(o_orderkey as varchar) as o_orderkey, o_orderstatus from orders",
)
def csv_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string"), "o_orderstatus")
    path = _scratch(spark, "append")
    files.write_csv(orders.filter("o_orderstatus = 'F'"), path)
    files.write_csv(orders.filter("o_orderstatus <> 'F'"), path, mode="append")
    return files.read_columns(spark, path, orders.columns, [1, 2])


@query(
    "src_7_materialize",
    "select r_name, count(*) as nations from nation join region on n_regionkey = r_regionkey group by 1",
)
def materialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = uuid.uuid4().hex[:8]
    view = catalog.materialize(table(spark, sf_dir, "nation"), f"nation_view_{mark}")
    saved = catalog.materialize(
        table(spark, sf_dir, "region"), f"region_table_{mark}", as_table=True, path=_scratch(spark, "table")
    )
    counted = (
        view.join(saved, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name").agg(F.count(F.lit(1)).alias("nations"))
    )
    # The result has read the plan and the files of both: the names can go.
    spark.catalog.dropTempView(f"nation_view_{mark}")
    spark.sql(f"drop table region_table_{mark}")
    return counted


@query(
    "src_8_failed_ids",
    "select distinct cast(user_id as varchar) as course_id from events where event_type = 'error'",
)
def failed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.expr(
        "cast(ts as string) || case when event_type = 'error' then ' ERROR All retries failed: https://x.org/api-2.0/courses/' "
        "|| cast(user_id as string) || '/ gave up' else ' INFO done https://x.org/api-2.0/courses/' || cast(event_id as string) || '/' end"
    )
    path = _scratch(spark, "log")
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    return files.read_failed_ids(spark, path)


@query(
    "sc_26_toll_job",
    """
    select "Rowid", "Timestamp", "VehicleNumber", upper("VehicleType") as "VehicleType", "TollPlazaID", "TollPlazaCode", "PaymentCode",
           row_number, payment_type from (
        select """ + ", ".join(f'{e} as "{c}"' for c, e in _LINE.items()) + """,
               lpad(cast(o_orderkey % 100000 as varchar), 5, '0') as row_number,
               substr(rpad(o_orderpriority, 10, ' '), 1, 10) as payment_type from orders
    ) as t
    """,
)
def toll_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three files are cut from one table, so that equal lines belong together."""
    plazas, vehicles, payments = (_scratch(spark, n) for n in ("plazas", "vehicles", "payments"))
    # One file each: the line order of the files is that of the table.
    whole = _lines(spark, sf_dir, list(_LINE))
    whole.select(*list(_LINE)[:4]).write.option("header", True).csv(vehicles)
    whole.write.option("header", True).option("sep", "\t").csv(plazas)
    table(spark, sf_dir, "orders").selectExpr(f"{_FIXED} as value").write.text(payments)
    rows = toll.consolidate(
        files.read_vehicles(spark, vehicles), files.read_toll_plazas(spark, plazas), files.read_payments(spark, payments)
    )
    return toll.upper_column(rows, "VehicleType")
