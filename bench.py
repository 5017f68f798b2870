"""Time the headline queries and their SQL twins; print one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES blank-separated query names, or "all" (default: the headline set)
"""

from __future__ import annotations

import glob
import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from starloom.queries import REGISTRY

HEADLINE = [
    "flagship_segment_share", "set_1_combine_feeds", "sc_standardize_courses_default", "win_1_latest_row_per_key",
    "win_2_global_row_number", "win_3_rank_and_decile", "win_6_previous_value", "jn_1_order_star", "jn_5_star_count_top",
    "jn_7_orphans", "agg_8_pivot", "agg_12_deduplicate", "agg_1_platform_performance", "agg_4_pricing_analysis",
    "agg_5_quality_tiers", "dim_6_fact_offerings", "scd_1_course_snapshot", "set_4_symmetric_except",
    "dq_4_equal_rowcount_by_group", "dq_8_ranges_gaps_allowed_by_customer", "dq_16_unique_combination", "dq_22_check_results",
    "sc_13_value_score", "sc_22_surrogate_key", "ext_1_html_to_text", "ext_2_keyword_tags", "ext_14_json_find",
]
REPEATS = 2


def session(cpus: int) -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="starloom-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("starloom-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def best(run) -> float:
    times = []
    for _ in range(REPEATS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def baseline(sf_dir: str, cpus: int, names: list[str]) -> dict[str, float]:
    """The SQL twins on the same files, results fetched."""
    try:
        import duckdb
    except ImportError:
        return {}
    database = duckdb.connect(config={"threads": cpus})
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        database.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return {n: best(lambda: database.execute(REGISTRY[n].sql).to_arrow_table()) for n in names if REGISTRY[n].sql}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = os.environ.get("BENCH_QUERIES", "").split()
    names = sorted(REGISTRY) if chosen == ["all"] else chosen or HEADLINE
    spark = session(cpus)
    times = {
        n: best(lambda: REGISTRY[n].run(spark, sf_dir).write.format("noop").mode("overwrite").save()) for n in names
    }
    version = spark.version
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "cpus": cpus,
        "spark": version,
        "shuffle_partitions": cpus,
        "baseline": baseline(sf_dir, cpus, names),
    }))


if __name__ == "__main__":
    main()
