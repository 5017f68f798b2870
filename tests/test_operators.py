"""Operators on small tables: hand-worked results, brute force, and hot keys."""

import random
import re
from collections import Counter
from datetime import datetime, timedelta
from statistics import median

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.functions import fixed, text
from starloom.operators import aggregate, generate, joins, numbering, shape, tagging
from starloom.operators.staging_area import stage, staging_root


# --- numbering ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def skewed(spark):
    """20,000 rows of which a third share one key, with many exact copies."""
    ids = spark.range(20_000, numPartitions=7)
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50)
    return ids.select(key.alias("k"), (F.col("id") * 7919 % 101).alias("v"), F.col("id"))


def test_number_rows_equals_the_plain_window(skewed):
    got = numbering.number_rows(skewed, ["k", "v", "id"], "rn", "n")
    plain = skewed.withColumn("rn", F.row_number().over(Window.orderBy("k", "v", "id")))
    assert rows(got.drop("n")) == rows(plain)
    assert got.select("n").distinct().collect()[0][0] == 20_000


def test_number_rows_spreads_equal_rows(spark):
    same = spark.range(8000, numPartitions=8).select(F.lit(1).alias("x"))
    setting = "spark.sql.adaptive.coalescePartitions.enabled"  # would merge slices this small
    spark.conf.set(setting, "false")
    try:
        slices = numbering.ordered_slices(same, ["x"])
        sizes = [r[1] for r in slices.groupBy("__slice").count().collect()]
    finally:
        spark.conf.unset(setting)
    assert len(sizes) > 1 and max(sizes) <= 4000
    assert sorted(r[0] for r in numbering.number_rows(same, ["x"], "rn").select("rn").collect()) == list(range(1, 8001))


def test_nulls_are_numbered_last(frame):
    df = frame([(3,), (None,), (1,)], "x int")
    assert rows(numbering.number_rows(df, ["x"], "rn")) == [(1, 1), (3, 2), (None, 3)]


@pytest.mark.parametrize("n", [1, 3, 9, 10, 11, 25, 99])
def test_ntile(spark, n):
    df = spark.range(1, n + 1).toDF("rn").withColumn("n", F.lit(n))
    got = df.select("rn", numbering.ntile("rn", "n", 10).alias("t"))
    plain = df.select("rn", F.ntile(10).over(Window.orderBy("rn")).cast("long").alias("t"))
    assert rows(got) == rows(plain)


def test_neighbours_equal_the_plain_window(skewed):
    got = numbering.with_neighbours(skewed, ["k"], ["v", "id"], previous={"pv": "v", "pid": "id"}, following={"nid": "id"})
    w = Window.partitionBy("k").orderBy("v", "id")
    plain = skewed.select("*", F.lag("v").over(w).alias("pv"), F.lag("id").over(w).alias("pid"), F.lead("id").over(w).alias("nid"))
    assert rows(got) == rows(plain)


def test_neighbours_across_the_whole_table(skewed):
    got = numbering.with_neighbours(skewed.select("id"), [], ["id"], previous={"p": "id"})
    assert got.filter("id > 0 and (p is null or p <> id - 1)").count() == 0


def test_running_count(skewed):
    hist = skewed.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    got = numbering.running_count(hist, ["k", "v"], "n", "upto")
    plain = hist.withColumn("upto", F.sum("n").over(Window.orderBy("k", "v")))
    assert rows(got) == rows(plain)


def test_staged_tables_live_in_the_given_folder(spark, frame):
    staged = stage(frame([(1,)], "x int"), "probe")
    assert spark.conf.get("spark.checkpoint.dir") == staging_root(spark)
    assert staged.inputFiles()[0].replace("file://", "").startswith(staging_root(spark))


# --- aggregates ---------------------------------------------------------------------------

def test_pivot_by_a_table_of_values(frame):
    data = [("a", "x", 2), ("a", "x", 3), ("a", "y", None), ("b", "z", 4), (None, "x", 1), ("c", None, 9), ("c", "other", 9)]
    df = frame(data, "k string, `my value` string, n int")
    values = frame([("z",), ("x",), ("x",), (None,), ("unseen",), ("y",)], "value string").coalesce(1)
    got = {r.k: list(r.cells.items()) for r in shape.pivot_map(df, ["k"], "my value", values, then_value=F.col("n")).collect()}
    assert got == {"a": [("x", 5), ("y", None)], "b": [("z", 4)], None: [("x", 1)], "c": []}
    every = {r.k: r.cells for r in shape.pivot_map(df, ["k"], "my value", agg="count").collect()}
    assert every == {"a": {"x": 2, "y": 1}, "b": {"z": 1}, None: {"x": 1}, "c": {"other": 1}}
    assert shape.pivot_map(df.limit(0), ["k"], "my value").collect() == []


def test_pivot_by_many_values(spark):
    """100,000 values, of which every third is asked for, in descending order; none of them passes through the driver."""
    df = spark.range(300_000).select((F.col("id") % 2).alias("k"), (F.col("id") % 100_000).alias("v"))
    values = spark.range(0, 100_000, 3).select((F.lit(99_999) - F.col("id")).alias("value")).orderBy(F.desc("value"))
    wide = shape.pivot_map(df, ["k"], "v", values)
    keys = F.map_keys("cells")
    got = wide.select("k", F.size(keys).alias("n"), F.element_at(keys, 1).alias("first"), F.element_at(keys, -1).alias("last"),
                      F.aggregate(F.map_values("cells"), F.lit(0).cast("long"), lambda s, x: s + x).alias("total")).collect()
    want = [v for v in range(99_999, -1, -3)]
    by_parity = {k: [v for v in want if v % 2 == k] for k in (0, 1)}
    assert sorted(tuple(r) for r in got) == [(k, len(v), v[0], v[-1], 3 * len(v)) for k, v in by_parity.items()]


def test_lists_for_the_driver_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(shape, "MOST_LISTED", 50)
    many = spark.range(51)
    for listed in (lambda: shape.column_value_list(many, "id"), lambda: shape.results_as_dict(many)):
        with pytest.raises(ValueError, match="max_records"):
            listed()
    assert len(shape.results_as_dict(many, 51)["id"]) == len(shape.column_value_list(many, "id", max_records=51)) == 51


@pytest.mark.parametrize("most", [40, 7])
def test_medians_of_large_groups_are_narrowed_down(frame, monkeypatch, most):
    """Half of all rows in one group, nearly equal, heavily tied and infinite values, odd and even counts; few values may be sorted."""
    monkeypatch.setattr(aggregate, "MOST_VALUES", most)
    rng = random.Random(4)
    data = [("hot", rng.gauss(0, 1), rng.randrange(3)) for _ in range(3000)] + [(None, rng.choice([1.0, 2.0, float("inf"), -1e300]), None) for _ in range(701)]
    data += [("even", float(i), 5) for i in range(500)] + [("two", 1.0, 1), ("two", 4.0, None)] + [("none", None, None)] * 3
    data += [("steep", 2.0 ** i, i) for i in range(-400, 400)] + [("steep", 1.0, 0)] * 900
    rng.shuffle(data)
    groups = {}
    for k, x, y in data:
        groups.setdefault(k, ([], []))
        for values, v in zip(groups[k], (x, y)):
            values += [] if v is None else [float(v)]
    want = [(k, *(median(v) if v else None for v in both)) for k, both in groups.items()]
    got = rows(aggregate.medians(frame(data, "k string, x double, y int").repartition(5), ["k"], {"mx": "x", "my": "y"}))
    assert got == sorted(want, key=repr)
    every = [x for _, x, _ in data if x is not None]
    assert rows(aggregate.medians(frame(data, "k string, x double, y int"), [], {"mx": "x"})) == [(median(every),)]


def test_medians_and_modes_by_brute_force(skewed):
    got = {r["k"]: r for r in aggregate.medians(skewed, ["k"], {"mv": "v", "mid": "id"}).collect()}
    modes = {r["k"]: r["m"] for r in aggregate.modes(skewed, ["k"], {"m": "v"}).collect()}
    groups = {}
    for r in skewed.collect():
        groups.setdefault(r["k"], []).append(r)
    assert set(got) == set(groups)
    for k, members in groups.items():
        assert got[k]["mv"] == median(r["v"] for r in members)
        assert got[k]["mid"] == median(r["id"] for r in members)
        counts = Counter(r["v"] for r in members)
        top = max(counts.values())
        assert modes[k] == min(v for v, n in counts.items() if n == top)


def test_median_ignores_nulls_and_keeps_null_groups(frame):
    df = frame([(None, 1.0), (None, 4.0), ("a", None), ("a", 2.0), ("b", 3.0)], "g string, x double")
    assert rows(aggregate.medians(df, ["g"], {"m": "x"})) == [("a", 2.0), ("b", 3.0), (None, 2.5)]


def test_distinct_text(frame):
    df = frame([("a", "y", None), ("a", "x", "q"), ("a", "y", "q"), ("b", None, None)], "g string, v string, w string")
    assert rows(aggregate.distinct_text(df, ["g"], {"vs": "v", "ws": "w"})) == [("a", "x, y", "q"), ("b", None, None)]


def test_null_profile(frame):
    df = frame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert rows(aggregate.null_profile(df, ["a", "b"])) == [(3, 1, 2)]


def test_group_by_first(frame):
    df = frame([("a", 1, 5), ("a", 1, 6), ("b", 1, 7)], "x string, y int, z int")
    assert rows(aggregate.group_by_first(df, 2).agg(F.sum("z"))) == [("a", 1, 11), ("b", 1, 7)]


# --- shape ---------------------------------------------------------------------------------------

def test_star(frame):
    df = frame([(1, 2, 3)], "field_1 int, field_2 int, field_3 int")
    assert df.select(*shape.star(df, exclude=["FIELD_3"])).columns == ["field_1", "field_2"]
    assert df.select(*shape.star(df, prefix="p_", suffix="_s")).columns == ["p_field_1_s", "p_field_2_s", "p_field_3_s"]
    assert df.select(*shape.star(df, rename={"field_1": "z"})).columns == ["z", "field_2", "field_3"]


def test_nullcheck(frame):
    df = frame([("", "a", 1), ("b", "", 2)], "x string, y string, z int")
    assert rows(shape.nullcheck(df)) == [("b", None, 2), (None, "a", 1)]


def test_align_schema(frame):
    df = frame([("0", "x", 5)], "`Unnamed: 0` string, Price string, `Duration` int")
    got = shape.align_schema(df, {"Price": "Price_Model"}, {"rate": "", "Duration": 9})
    assert got.columns == ["Price_Model", "Duration", "rate"] and rows(got) == [("x", 5, "")]


def test_pivot(frame):
    df = frame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    values = shape.column_value_list(df, "color", order_by=[F.asc("value")])
    assert values == ["blue", "blue's", "red"]
    got = df.groupBy("size").agg(*shape.pivot("color", ["red", "blue", "blue's"], quote_identifiers=False))
    assert got.columns == ["size", "red", "blue", "blues"]
    assert rows(got) == [("M", 1, 0, 0), ("S", 1, 1, 1)]
    got = df.groupBy("size").agg(*shape.pivot("color", ["red"], agg="max", prefix="has ", then_value=F.lit(9)))
    assert got.columns == ["size", "has red"] and rows(got) == [("M", 9), ("S", 9)]


def test_unpivot(frame):
    df = frame([(1, "a", True, 5), (2, "b", None, 6)], "id int, name string, ok boolean, n int")
    got = shape.unpivot(df, exclude=["id"], remove=["N"], field_name="prop", value_name="val")
    assert rows(got) == [(1, "name", "a"), (1, "ok", "true"), (2, "name", "b"), (2, "ok", None)]


def test_union_relations(frame):
    t1 = frame([(1, "drew", 3), (2, "bob", 4)], "id int, name string, favorite_number int")
    t2 = frame([(3, "green", 9)], "id int, favorite_color string, favorite_number int")
    got = shape.union_relations({"t1": t1, "t2": t2}, source_column="src")
    assert got.columns == ["src", "id", "name", "favorite_number", "favorite_color"]
    assert rows(got) == [("t1", 1, "drew", 3, None), ("t1", 2, "bob", 4, None), ("t2", 3, None, 9, "green")]
    assert shape.union_relations({"t1": t1, "t2": t2}, include=["ID"], source_column=None).columns == ["id"]
    assert shape.union_relations({"t1": t1, "t2": t2}, exclude=["NAME", "favorite_color"], source_column=None).columns == [
        "id", "favorite_number"
    ]
    assert shape.union_relations({"t": t1}, column_override={"id": "string"}).schema["id"].dataType.simpleString() == "string"
    assert shape.union_relations({"t1": t1, "t2": t2}, where="id > 1").count() == 2
    with pytest.raises(ValueError):
        shape.union_relations({"t1": t1}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        shape.union_relations({"t1": t1}, include=["nope"])


def test_column_values(frame):
    df = frame([("a", "left"), ("b", "right"), ("b", "left"), ("c", "left")], "field string, condition string")
    assert shape.column_value_list(df, "field") == ["b", "a", "c"]
    assert shape.column_value_list(df, "field", max_records=1) == ["b"]
    assert shape.column_value_list(df, "field", where="condition = 'right'") == ["b"]
    assert shape.column_value_list(df, "field", default=["y"], where="condition = 'up'") == ["y"]
    assert shape.column_value_list(None, "field", default=["y", "z"]) == ["y", "z"]
    with pytest.raises(ValueError):
        shape.column_value_list(None, "field")


def test_single_results(frame):
    df = frame([(1, "a"), (2, "b")], "x int, y string")
    assert shape.single_value(df.orderBy("x")) == 1
    assert shape.single_value(df.filter("x > 9"), "none") == "none"
    assert shape.results_as_dict(df.orderBy("x")) == {"x": (1, 2), "y": ("a", "b")}


def test_long_lists_of_values(spark):
    many = spark.range(12_000)
    assert len(shape.column_value_list(many, "id")) == 12_000
    assert len(shape.column_value_list(many, "id", max_records=5)) == 5
    assert len(shape.results_as_dict(many)["id"]) == 12_000 and len(shape.results_as_dict(many, 3)["id"]) == 3


def test_column_values_by_an_aggregate(frame):
    df = frame([("a", 1), ("b", 9), ("a", 2), (None, 5)], "v string, x int")
    got = shape.column_values(df, "v", [F.desc("top")], aggregates={"top": F.max("x")}).collect()
    assert [r[0] for r in got] == ["b", None, "a"]


def test_groups_without_values_stay(frame):
    df = frame([("a", 1.0, "x"), ("b", None, None), ("b", None, None), ("c", 2.0, "")], "g string, x double, t string")
    assert rows(aggregate.medians(df, ["g"], {"m": "x"})) == [("a", 1.0), ("b", None), ("c", 2.0)]
    assert rows(aggregate.modes(df, ["g"], {"m": "t"})) == [("a", "x"), ("b", None), ("c", "")]
    assert rows(aggregate.distinct_text(df, ["g"], {"m": "t"})) == [("a", "x"), ("b", None), ("c", "")]


def test_a_clustered_hot_key_is_spread(spark):
    left = spark.range(30_000).select(F.lit(1).alias("k"), F.col("id").alias("x")).repartition(8, "k")
    salts = left.select(F.pmod(F.xxhash64(*joins.spreading(left, ["k"]), F.spark_partition_id()), F.lit(joins.SALTS)).alias("s"))
    assert salts.distinct().count() == joins.SALTS
    right = spark.range(3).select(F.col("id").cast("int").alias("k"), F.lit("y").alias("y"))
    got = joins.lookup_join(left, right, ["k"], 1, joins.BROADCAST_BYTES + 1)
    assert got.filter("y = 'y'").count() == 30_000


def test_neighbours_of_hot_and_ordinary_groups(frame, monkeypatch):
    monkeypatch.setattr(numbering, "HOT_ROWS", 5)
    data = [(g, i, i * 10) for g, n in (("a", 9), ("b", 3), (None, 7), ("c", 1)) for i in range(n)]
    got = numbering.with_neighbours(frame(data, "g string, i int, v int"), ["g"], ["i"], {"p": "v"}, {"n": "v"})
    size = {"a": 9, "b": 3, None: 7, "c": 1}
    assert rows(got) == sorted([(g, i, v, v - 10 if i else None, v + 10 if i < size[g] - 1 else None) for g, i, v in data], key=repr)


def test_neighbours_of_ordinary_groups_take_one_shuffle(frame):
    df = frame([("a", 1), ("a", 2)], "g string, i int")
    plan = numbering.with_neighbours(df, ["g"], ["i"], {"p": "i"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_spine_of_many_seconds(spark):
    late = spark.range(2**32, 2**32 + 1).selectExpr(generate._stepped("SECOND", "timestamp_ntz'1950-01-01'")).first()[0]
    assert late == datetime(1950, 1, 1) + timedelta(seconds=2**32)
    day = generate.date_spine(spark, "hour", "'2024-02-28 22:00:00'", "'2024-03-01 02:00:00'")
    assert day.count() == 28 and day.agg(F.max("date_hour")).first()[0].isoformat() == "2024-03-01T01:00:00"


def test_slugify():
    assert shape.slugify("!Hell0 world-hi") == "hell0_world_hi"
    assert shape.slugify("0 Begins with digit") == "_0_begins_with_digit"
    assert shape.slugify("") == ""


def test_deduplicate_keeps_rows_with_nulls(frame):
    df = frame([(1, "play", 1), (1, "play", 2), (2, None, 1), (None, "x", 1)], "user_id int, event string, version int")
    got = shape.deduplicate(df, ["user_id"], [F.desc("version")])
    assert rows(got) == [(1, "play", 2), (2, None, 1), (None, "x", 1)]


def test_deduplicate_limits_before_the_shuffle(skewed):
    plan = shape.deduplicate(skewed, ["k"], [F.asc("id")])._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("row_number(), 1, Partial")
    assert plan.index("Exchange hashpartitioning") < partial


def test_keep_first_and_last(frame):
    df = frame([(1, "a"), (2, "a"), (3, None), (4, None)], "n int, slug string")
    assert rows(shape.keep_first(df, ["slug"], F.col("n"))) == [(1, "a"), (3, None)]
    assert rows(shape.keep_last(df, ["slug"], F.col("n"))) == [(2, "a"), (4, None)]
    both = df.withColumn("record", F.concat(F.lit("r"), "n"))
    assert rows(shape.dedupe_by_slug(both, "slug", "record", F.col("n")).select("n")) == [(1,), (3,), (4,)]


# --- joins ------------------------------------------------------------------------------------------

@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_the_plain_join(spark, skewed, how):
    left = skewed.withColumn("k", F.when(F.col("id") % 11 != 0, F.col("k")))
    right = spark.range(0, 40, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    assert rows(joins.salted_join(left, right, ["k"], how)) == rows(left.join(right, "k", how))


def test_salted_join_refuses_full_joins(skewed):
    with pytest.raises(ValueError):
        joins.salted_join(skewed, skewed, ["k"], "full")


def test_hot_keys(skewed):
    assert rows(joins.hot_keys(skewed, ["k"], 10)) == [(0,)]


def test_large_lookups_are_salted(skewed, frame):
    right = frame([(0, "a"), (1, "b")], "k bigint, name string")
    small = joins.lookup_join(skewed, right, ["k"], 2)
    large = joins.lookup_join(skewed, right, ["k"], joins.BROADCAST_ROWS + 1)
    assert "__salt" in large._jdf.queryExecution().analyzed().toString()
    assert rows(small) == rows(large.select(small.columns))


def test_patch_and_only_new(frame):
    df = frame([(1, "a", 5), (2, "b", 6)], "id int, x string, y int")
    fixes = frame([(2, None, 9), (3, "z", 1)], "id int, x string, y int")
    assert rows(joins.patch(df, fixes, ["id"], ["x", "y"])) == [(1, "a", 5), (2, None, 9)]
    assert rows(joins.only_new(df, fixes, ["id"])) == [(1, "a", 5)]


def test_match_rate_multiplies_like_a_join(frame):
    left = frame([("a",), ("a",), ("b",), (None,)], "k string")
    right = frame([("a", 1), ("a", 2), ("c", 3), (None, 4)], "j string, sk int")
    assert rows(joins.match_rate(left, right, {"k": "j"}, "sk")) == [(6, 4)]


def test_names_for_ids(frame):
    df = frame([(1, ["3", "9", "1"]), (2, ["9"]), (3, None)], "course int, ids array<string>")
    names = frame([("1", "Ann"), ("3", "Bo")], "id string, name string")
    assert rows(joins.names_for_ids(df, "course", "ids", names, "id", "name", "people")) == [(1, "Bo, Ann"), (2, ""), (3, "")]


def test_zip_rows_pads_the_shorter_side(frame):
    a, b = frame([("x",), ("y",), ("z",)], "l string"), frame([(2,), (1,)], "r int")
    assert rows(joins.zip_rows(a, b, ["l"], ["r"])) == [(1, "x", 1), (2, "y", 2), (3, "z", None)]


# --- generators --------------------------------------------------------------------------------------

def test_series(spark):
    assert [r[0] for r in generate.series(spark, 10).orderBy(F.col("generated_number")).collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        generate.series(spark, 0)


def test_date_spine(spark):
    days = [r[0] for r in generate.date_spine(spark, "day", "date'2018-01-01'", "date'2018-01-10'").orderBy("date_day").collect()]
    assert days == [datetime(2018, 1, d) for d in range(1, 10)]
    months = generate.date_spine(spark, "month", "date'2023-11-15'", "date'2024-02-01'")
    assert [r[0] for r in months.orderBy("date_month").collect()] == [datetime(2023, 11, 15), datetime(2023, 12, 15), datetime(2024, 1, 15)]
    with pytest.raises(ValueError):
        generate.date_spine(spark, "fortnight", "date'2018-01-01'", "date'2018-01-10'")


def test_random_shapes_keep_every_row(spark):
    rng = random.Random(11)
    for _ in range(3):
        n = rng.randrange(1, 400)
        data = [(rng.choice([0, 0, 0, 1, None]), rng.randrange(5)) for _ in range(n)]
        df = spark.createDataFrame(data, "k int, v int")
        assert numbering.number_rows(df, ["k", "v"], "rn").count() == n
        assert numbering.with_neighbours(df, ["k"], ["v"], previous={"p": "v"}).count() == n


# --- tags of a vocabulary table -------------------------------------------------------------

def test_tags_of_a_table_are_those_of_the_fixed_list(frame):
    rng = random.Random(31)
    glue = [" ", ", ", "-", "", "é", "_", "/", ".", "\n", "+", "#"]
    texts = ["".join(w for s in rng.choices(fixed.SKILLS, k=8) for w in (s if rng.random() < 0.5 else s.upper(), rng.choice(glue)))
             for _ in range(300)] + ["C++ and C#", "C++11 C#7", "react native", "Power  BI", "r", "", "nothing here", None]
    df = frame([(i, t, "mine") for i, t in enumerate(texts)], "id int, body string, tags string")
    listed = frame([(i, k) for i, k in enumerate(fixed.SKILLS)] + [(900, fixed.SKILLS[0].upper()), (901, None), (902, "++x"), (903, "")],
                   "place int, `a skill` string")
    got = dict(tagging.vocabulary_tags(df, ["id"], "body", listed, "a skill", "place").collect())
    want = dict(df.select("id", text.keyword_tags("body")).collect())
    assert got == {i: t or [] for i, t in want.items()}
    assert dict(tagging.vocabulary_tags(df, ["id"], "body", listed.limit(0), "a skill").collect()) == {i: [] for i in got}


@pytest.mark.parametrize("most", [200_000, 10])
def test_tags_of_a_hundred_thousand_skills(spark, frame, monkeypatch, most):
    """Broadcast or shuffled, against a plain search for every run of words."""
    monkeypatch.setattr(tagging, "BROADCAST_ROWS", most)
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4))) for _ in range(3000)]
    skills = {" ".join(rng.choices(words, k=rng.choice([1, 2, 2, 3]))) + rng.choice(["", "", "", "+", "#"]) for _ in range(110_000)}
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(150)] + ["".join(rng.choice([s, s + "x ", s + " "]) for s in rng.sample(sorted(skills), 9))
                                                                                    for _ in range(100)]
    got = dict(tagging.vocabulary_tags(frame(list(enumerate(texts)), "id int, body string"), ["id"], "body",
                                       spark.createDataFrame([(s,) for s in sorted(skills)], "keyword string")).collect())
    for i, body in enumerate(texts):
        runs = re.findall(r"\w+|\W+", body)
        found = {"".join(runs[a:a + n]) for a in range(len(runs)) for n in range(1, 7)
                 if re.match(r"\w", runs[a]) and a + n <= len(runs) and (n % 2 or a + n < len(runs))}
        assert got[i] == sorted(found & skills)
