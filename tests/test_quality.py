"""Data-quality tests: a passing and a failing table for each."""

import random
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators import quality
from starloom.operators.quality import Check


def empty(df):
    return df.count() == 0


def test_accepted_range(frame):
    df = frame([(-1,), (11,), (None,)], "id int")
    assert empty(quality.accepted_range(df, "id", -1, 11))
    assert rows(quality.accepted_range(df, "id", -1, 11, inclusive=False)) == [(-1,), (11,)]
    assert rows(quality.accepted_range(df, "id", min_value=0)) == [(-1,)]
    assert rows(quality.accepted_range(df, "id", max_value="5 + 5")) == [(11,)]
    assert empty(quality.accepted_range(df, "id"))


def test_at_least_one(frame):
    df = frame([("a", 1), ("b", None)], "field string, value int")
    assert empty(quality.at_least_one(df, "value"))
    assert rows(quality.at_least_one(df, "value", ["field"])) == [("b", 0)]
    assert rows(quality.at_least_one(df.filter("field = 'b'"), "value")) == [(0,)]


def test_cardinality_equality(frame):
    a = frame([(1,), (2,), (3,)], "same int")
    b = frame([(1, 2), (2, 3), (3, 1)], "same int, other int")
    assert empty(quality.cardinality_equality(a, "same", b, "other"))
    assert rows(quality.cardinality_equality(a, "same", frame([(1,), (1,), (2,), (3,)], "x int"), "x")) == [(1, 1), (1, 2)]


def test_equality(frame):
    a = frame([(1, 1, 3), (1, 2, 1), (2, 3, 3), (2, 3, 3)], "a int, b int, c int")
    b = frame([(1, 1, 2), (1, 2, 2), (2, 3, 2)], "a int, b int, c int")
    assert empty(quality.equality(a, b, compare_columns=["a", "b"]))
    assert empty(quality.equality(a, b, exclude_columns=["C"]))
    failing = quality.equality(a, b)
    assert rows(failing) == [
        ("a_minus_b", 1, 1, 3), ("a_minus_b", 1, 2, 1), ("a_minus_b", 2, 3, 3),
        ("b_minus_a", 1, 1, 2), ("b_minus_a", 1, 2, 2), ("b_minus_a", 2, 3, 2),
    ]
    assert rows(quality.equality_metric(failing)) == [(6,)]
    assert rows(quality.equality_metric(quality.equality(a, b.limit(0)))) == [(6,)]
    with pytest.raises(ValueError):
        quality.equality(a, b, ["a"], ["b"])
    with pytest.raises(ValueError):
        quality.equality(a, b.drop("c"))


def test_equality_treats_nulls_as_equal(frame):
    a = frame([(None, 1)], "x string, y int")
    assert empty(quality.equality(a, a))


def test_equality_with_precision(frame):
    a = frame([("x", 62.3888186)], "id string, n double")
    b = frame([("x", 62.3888187)], "id string, n double")
    assert empty(quality.equality(a, b, precision=4))
    assert not empty(quality.equality(a, b, precision=8))


def test_rowcounts(frame):
    three, four = frame([(1, 1), (1, 2), (1, 3)], "a int, f int"), frame([(1, 1), (1, 2), (1, 3), (1, 4)], "a int, f int")
    assert rows(quality.equal_rowcount(three, three)) == [(3, 3, 0)]
    assert rows(quality.equal_rowcount(three, four)) == [(3, 4, 1)]
    assert rows(quality.fewer_rows_than(three, four)) == [(3, 4, 0)]
    assert rows(quality.fewer_rows_than(four, three)) == [(4, 3, 1)]
    assert rows(quality.fewer_rows_than(three, three)) == [(3, 3, 1)]


def test_rowcounts_by_group(frame):
    a, b = frame([("x",), ("x",), ("y",), (None,)], "g string"), frame([("x",), ("z",), (None,)], "g string")
    lenient = rows(quality.equal_rowcount(a, b, ["g"]))
    assert lenient == sorted(
        [("x", "x", 2, 1, 1), ("y", None, 1, None, None), (None, "z", None, 1, None), (None, None, 1, None, None),
         (None, None, None, 1, None)], key=repr)
    strict = quality.equal_rowcount(a, b, ["g"], strict_groups=True)
    assert strict.agg(F.sum("diff_count")).first()[0] == 5


def test_row_conditions(frame):
    df = frame([(0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 9.0)], "a double, b double")
    assert empty(quality.expression_is_true(df, "a + b = 1"))
    assert rows(quality.expression_is_true(df, "+ b < 1", "a")) == [(0.0, 1.0), (0.5, 0.5), (1.0, 0.0)]
    assert rows(quality.expression_is_true(df, "> 0", "a")) == [(0.0, 1.0)]
    assert rows(quality.not_null(df, "a")) == [(None, 9.0)]
    assert rows(quality.assert_equal(df, "a", "b")) == [(0.0, 1.0), (1.0, 0.0)]


def test_empty_strings(frame):
    df = frame([("",), ("   ",), ("x",), (None,)], "t string")
    assert quality.not_empty_string(df, "t").count() == 2
    assert quality.not_empty_string(df, "t", trim_whitespace=False).count() == 1


def test_values(frame):
    df = frame([("Rome",), ("Rome",), ("Oslo",), (None,)], "city string")
    assert empty(quality.not_accepted_values(df, "city", ["Paris"]))
    assert rows(quality.not_accepted_values(df, "city", ["Rome"])) == [("Rome",)]
    assert empty(quality.accepted_values(df, "city", ["Rome", "Oslo"]))
    assert rows(quality.accepted_values(df, "city", ["Oslo"])) == [("Rome", 2)]
    assert rows(quality.unique(df, "city")) == [("Rome", 2)]
    assert empty(quality.unique(frame([(None,), (None,), (1,)], "x int"), "x"))


def test_not_constant(frame):
    df = frame([(1, 1), (1, 1), (1, 2)], "a int, f int")
    assert empty(quality.not_constant(df, "f"))
    assert rows(quality.not_constant(df, "a")) == [(1,)]
    assert rows(quality.not_constant(df, "a", ["f"])) == [(1, 1), (2, 1)]
    assert empty(quality.not_constant(frame([(None,)], "x int"), "x"))


def test_not_null_proportion(frame):
    half = frame([(i if i < 5 else None, "g") for i in range(10)], "v int, g string")
    assert empty(quality.not_null_proportion(half, "v", 0.5, 0.5))
    assert rows(quality.not_null_proportion(half, "v", 0.9)) == [(0.5,)]
    assert rows(quality.not_null_proportion(half, "v", 0.0, 0.4, ["g"])) == [("g", 0.5)]


def test_recency(frame):
    now = "timestamp_ntz'2024-01-02 00:00:00'"
    df = frame([("a", datetime(2024, 1, 1, 1)), ("b", datetime(2023, 12, 30)), ("c", None)], "g string, t timestamp_ntz")
    assert empty(quality.recency(df, "t", "day", 1, now))
    late = quality.recency(df, "t", "day", 1, now, group_by=["g"])
    assert [r[0] for r in late.orderBy("g").collect()] == ["b", "c"]
    assert [r[0] for r in quality.recency(df, "t", "day", 3, now, True, ["g"]).collect()] == ["c"]


def test_relationships(frame):
    child, parent = frame([(1,), (2,), (4,), (4,), (None,)], "id int"), frame([(1,), (2,), (3,), (None,)], "id int")
    assert rows(quality.relationships(child, "id", parent, "id")) == [(4,), (4,)]
    assert empty(quality.relationships_where(child, "id", parent, "id", from_condition="id <> 4"))
    assert rows(quality.relationships_where(child, "id", parent, "id", to_condition="id <> 2")) == [(2, None), (4, None), (4, None)]


def test_sequences(frame):
    even = frame([(1, 2), (1, 4), (1, 6), (2, 8), (2, 10)], "g int, s int")
    assert empty(quality.sequential_values(even, "s", 2))
    assert rows(quality.sequential_values(even, "s", 3, group_by=["g"])) == [(1, 4, 2), (1, 6, 4), (2, 10, 8)]
    hours = frame([(datetime(2021, 1, 1, h),) for h in (0, 1, 2, 4)], "t timestamp_ntz")
    assert rows(quality.sequential_values(hours, "t", 1, "hour")) == [(datetime(2021, 1, 1, 4), datetime(2021, 1, 1, 2))]


def test_ranges(frame):
    tight = frame([(0, 1), (1, 2), (2, 4)], "lo int, hi int")
    assert empty(quality.mutually_exclusive_ranges(tight, "lo", "hi", gaps="not_allowed"))
    assert empty(quality.mutually_exclusive_ranges(tight, "lo", "hi", gaps="allowed"))
    assert quality.mutually_exclusive_ranges(tight, "lo", "hi", gaps="required").count() == 2
    wide = frame([(1, 1, 5), (1, 7, 9), (2, 3, 6), (2, 7, None), (2, 9, 9)], "k int, lo int, hi int")
    failing = quality.mutually_exclusive_ranges(wide, "lo", "hi", "k", gaps="required")
    assert [tuple(r)[1] for r in failing.orderBy("lower_bound").collect()] == [7, 9]
    assert quality.mutually_exclusive_ranges(wide, "lo", "hi", "k", gaps="allowed", zero_length=True).count() == 1
    with pytest.raises(ValueError):
        quality.mutually_exclusive_ranges(tight, "lo", "hi", gaps="maybe")


@pytest.mark.parametrize("gaps, operator", [("not_allowed", "="), ("allowed", "<="), ("required", "<")])
def test_ranges_by_brute_force(spark, gaps, operator):
    rng = random.Random(gaps)
    data = [(rng.randrange(3), rng.choice([None, *range(30)]), rng.choice([None, *range(30)])) for _ in range(150)]
    df = spark.createDataFrame(data, "k int, lo int, hi int")
    up = Window.partitionBy("k").orderBy(F.asc_nulls_last("lo"), F.asc_nulls_last("hi"))
    down = Window.partitionBy("k").orderBy(F.desc_nulls_last("lo"), F.desc_nulls_last("hi"))
    plain = (
        df.withColumn("nx", F.lead("lo").over(up)).withColumn("last", F.row_number().over(down) == 1)
        .filter(f"not (coalesce(lo < hi, false) and coalesce(hi {operator} nx, last, false))")
    )
    got = quality.mutually_exclusive_ranges(df, "lo", "hi", "k", gaps)
    # Rows that agree on both bounds may swap their following row; compare what decides.
    assert rows(got.select("partition_by_col", "lower_bound", "upper_bound")) == rows(plain.select("k", "lo", "hi"))


def test_unique_combination(frame):
    df = frame([("jan", "a", 1), ("jan", "b", 2), ("feb", "a", 1)], "month string, product string, revenue int")
    assert empty(quality.unique_combination(df, ["month", "product"]))
    assert rows(quality.unique_combination(df, ["product", "revenue"])) == [("a", 1)]


def test_columns(frame):
    df = frame([(1, 2)], "a int, B int")
    assert empty(quality.columns_match_set(df, ["A", "b"]))
    assert rows(quality.columns_match_set(df, ["a", "c"])) == [("b", "unexpected"), ("c", "missing")]


def test_check_status(frame):
    df = frame([(1,), (2,), (2,), (None,)], "x int")
    twice = lambda d: quality.unique(d, "x")
    got = quality.run_checks(df, [
        Check("plain", twice),
        Check("warned", twice, severity="warn"),
        Check("filtered", twice, where="x = 1"),
        Check("tolerated", twice, error_if="> 1"),
        Check("wanted", twice, error_if="< 1", warn_if="< 1"),
        Check("wanted, none", twice, where="x = 1", error_if="< 1"),
        Check("summed", twice, fail_calc="sum(n_records)"),
    ])
    assert [tuple(r) for r in got.collect()] == [
        ("plain", 1, "error"), ("warned", 1, "warn"), ("filtered", 0, "pass"), ("tolerated", 1, "warn"),
        ("wanted", 1, "pass"), ("wanted, none", 0, "error"), ("summed", 2, "error"),
    ]


def plain_difference(a, b):
    return sorted([("a_minus_b", *r) for r in set(a) - set(b)] + [("b_minus_a", *r) for r in set(b) - set(a)], key=repr)


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_differences_by_fingerprints(frame, monkeypatch, buckets):
    monkeypatch.setattr(quality, "BUCKETS", buckets)
    rng = random.Random(3)
    some = lambda n: [(rng.choice([None, 1, 2, 3]), rng.choice([None, "", "x", "y"]), rng.choice([0.0, 1.5, None])) for _ in range(n)]
    schema = "i int, `t x` string, d double"
    for a, b in ((some(300), some(300)), (some(5), some(0)), (some(40), some(40)), ([(1, None, 0.0), (None, "x", 0.0)], [(None, "x", 0.0), (1, None, 0.0)] * 3)):
        assert rows(quality.symmetric_difference(frame(a, schema), frame(b, schema))) == plain_difference(a, b)
    both = [(None, 1, None), (1, None, None)], [(1, None, None), (None, None, 1)]
    assert rows(quality.symmetric_difference(*[frame(x, "a int, b int, c int") for x in both])) == plain_difference(*both)


def test_equal_tables_move_a_row_per_bucket(spark):
    """Row order, partitioning and copies of the same table do not matter; a single row that differs is found in its bucket alone."""
    a = spark.range(50_000).select("id", F.concat(F.lit("v"), F.col("id") % 97).alias("v"))
    b = a.orderBy(F.desc("id")).repartition(5)
    assert quality.differing_buckets(a, b).isEmpty() and quality.equality(a, b).isEmpty()
    other = b.withColumn("v", F.when(F.col("id") == 777, "w").otherwise(F.col("v")))
    assert quality.differing_buckets(a, other).count() in (1, 2)
    assert rows(quality.equality(a, other)) == [("a_minus_b", 777, "v1"), ("b_minus_a", 777, "w")]
    plan = quality.equality(a, b)._jdf.queryExecution().executedPlan().toString()
    assert "__bucket" in plan and plan.count("BroadcastExchange") >= 1
