"""Small helpers shared by the column functions."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ColumnOrName = Column | str

# What a Unicode-aware "\s" matches, spelled out so that the JVM agrees.
WHITESPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# The same characters one by one, for trimming.
_BLANKS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_text(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Separators that occur in no vocabulary.
_ENTRY, _PAIR = "\x01", "\x02"


def lookup(key: Column, table: Mapping[str, str]) -> Column:
    """Value of ``key`` in a small constant table, NULL where it is not listed.

    The table travels as one literal, which the optimizer folds to a map once per query.
    """
    entries = _ENTRY.join(f"{k}{_PAIR}{v}" for k, v in table.items())
    return F.try_element_at(F.str_to_map(F.lit(entries), F.lit(_ENTRY), F.lit(_PAIR)), key)


def let(value: Column, build: Callable[[Column], Column]) -> Column:
    """``build(value)`` with ``value`` evaluated once per row however often it is used."""
    return F.try_element_at(F.transform(F.array(value), build), F.lit(1))


def text_array(values: Sequence[str]) -> Column:
    """A constant array of texts."""
    return F.expr(f"array({', '.join(sql_text(v) for v in values)})")


def rows_frame(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A few constant rows as a DataFrame, without a Python worker.

    ``schema`` lists ``name type`` pairs of JSON-representable types.
    """
    names = [field.split()[0] for field in schema.split(",")]
    text = json.dumps([dict(zip(names, row)) for row in rows])
    fields = ", ".join(f"{field.split()[0]}: {field.split()[1]}" for field in schema.split(","))
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{fields}>>")))


def whole_number(c: ColumnOrName, kind: str = "int") -> Column:
    """A whole number from text that may carry a decimal point (``12.0``), rounded half away from zero; else NULL."""
    text = F.btrim(col(c).cast("string"))
    decimal = F.coalesce(text.try_cast("decimal(38,18)"), text.try_cast("double").try_cast("decimal(38,18)"))
    return F.coalesce(text.try_cast(kind), F.round(decimal, 0).try_cast(kind))


def strip(c: ColumnOrName) -> Column:
    """Trim every kind of whitespace, not only blanks."""
    return F.btrim(col(c), F.lit(_BLANKS))


def blank_to_null(c: ColumnOrName) -> Column:
    """``''`` becomes NULL."""
    return F.nullif(col(c), F.lit(""))


# Accumulators of an exact sum. Values below _MOST of up to six decimals count in millionths, in two longs, the lower one of _LOW_BITS; others
# of up to 18 decimals as such; what is left by binary digits to longs of _BIN bits each, from 2**_FIRST on. Nothing overflows below 10**9 rows.
_MILLION, _LOW_BITS, _MOST = 1e6, 26, 2.0 ** 33
_BIN, _FIRST, _BINS = 24, -96, 8
_SMALLEST, _LARGEST = 2.0 ** (_FIRST + 53), 2.0 ** (_FIRST + _BIN * _BINS - 4)  # of a value that loses no digit in the bins


def _from_bins(bins: Column) -> Column:
    """(whole, rest) of a number of 0 or more given by its bins, lowest first: digits from 2**0 on as decimal, those below as double."""
    unit = F.lit(float(1 << _BIN))

    def step(state: Column, total: Column, place: Column) -> Column:
        with_carry = total + state["carry"]
        digit = F.pmod(with_carry, F.lit(1 << _BIN))
        return F.struct(
            F.shiftright(with_carry, _BIN).alias("carry"),
            (state["rest"] + F.when(place < 0, digit * F.pow(F.lit(2.0), place)).otherwise(0.0)).alias("rest"),
            (state["whole"] + F.when(place >= 0, digit * state["scale"]).otherwise(0)).cast("decimal(38,0)").alias("whole"),
            F.when(place >= 0, state["scale"] * unit.cast("decimal(9,0)")).otherwise(state["scale"]).cast("decimal(38,0)").alias("scale"))

    zero, one = F.lit(0).cast("decimal(38,0)"), F.lit(1).cast("decimal(38,0)")
    start = F.struct(F.lit(0).cast("long").alias("carry"), F.lit(0.0).alias("rest"), zero.alias("whole"), one.alias("scale"))
    places = F.array(*[F.lit(_FIRST + _BIN * k) for k in range(_BINS)])
    pairs = F.arrays_zip(bins.alias("total"), places.alias("place"))
    return F.aggregate(pairs, start, lambda s, p: step(s, p["total"], p["place"]), lambda s: F.struct(
        (s["whole"] + s["carry"] * s["scale"]).cast("decimal(38,0)").alias("whole"), s["rest"].alias("rest")))


def _bins_total(bins: Column) -> Column:
    """Signed (whole, rest) of bins of either sign."""
    top = F.aggregate(bins, F.lit(0).cast("long"), lambda carry, total: F.shiftright(total + carry, _BIN))
    sign = F.when(top < 0, -1).otherwise(1)

    def signed(number: Column) -> Column:
        return F.struct((number["whole"] * sign).cast("decimal(38,0)").alias("whole"), (number["rest"] * sign).alias("rest"))

    return let(_from_bins(F.transform(bins, lambda b: b * sign)), signed)


def exact_sum(c: ColumnOrName) -> Column:
    """Sum as double that does not depend on the order in which partitions arrive.

    Whole numbers are added only: values below 2**33 by their decimal digits, up to 18 behind the point (most have six or fewer, and count in
    longs), all others between 2**-43 and 2**92 by their binary digits, so a retried or differently partitioned run gives the same
    result. If a group holds a value outside that range (NaN, an infinity, 10**28), the plain sum of doubles is returned.
    """
    value = col(c).cast("double")
    size = F.abs(value)
    millionths = F.rint(value * _MILLION)
    short = (size < _MOST) & (millionths / _MILLION == value)
    digits = F.when(~short & (size < _MOST), value).try_cast("decimal(38,18)")
    middle = F.coalesce(digits.cast("double") == value, F.lit(False))
    long = ~short & ~middle & (size >= _SMALLEST) & (size < _LARGEST)
    whole = millionths.cast("long")
    none = F.lit(0).cast("long")
    high = F.sum(F.when(short, F.shiftright(whole, _LOW_BITS)))
    low = F.sum(F.when(short, whole.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))))

    def nearest(k: int) -> Column:
        """The value to the nearest multiple of a bin's unit, in that unit."""
        return F.rint(value * F.lit(2.0 ** -(_FIRST + _BIN * k)))

    def bin_sum(k: int) -> Column:
        digit = nearest(k) if k == _BINS - 1 else nearest(k) - nearest(k + 1) * F.lit(float(1 << _BIN))
        return F.coalesce(F.sum(F.when(long, digit.cast("long"))), F.lit(0).cast("long"))

    # the widest kind of value: 0 decimal digits only, 1 binary ones too, 2 others; NULL without values
    widest = F.max(F.when(short | middle, 0).when(long, 1).when(value.isNotNull(), 2))
    parts = F.struct(
        F.coalesce(high, none).alias("high"), F.coalesce(low, none).alias("low"),
        F.coalesce(F.sum(F.when(middle, digits)), F.lit(0).cast("decimal(38,18)")).alias("middle"),
        F.array(*[bin_sum(k) for k in range(_BINS)]).alias("bins"), widest.alias("widest"), F.sum(value).alias("plain"))

    def total(p: Column) -> Column:
        in_millionths = (p["high"].cast("decimal(20,0)") * F.lit(1 << _LOW_BITS).cast("decimal(9,0)") + p["low"]).cast("decimal(32,0)")
        decimal = (in_millionths * F.lit("0.000001").cast("decimal(6,6)")).cast("decimal(38,18)") + p["middle"]

        def with_bins(b: Column) -> Column:
            exact = [(decimal + b["whole"].try_cast("decimal(38,18)")).cast("double"),
                     (decimal.cast("decimal(37,12)") + b["whole"].try_cast("decimal(25,0)")).cast("double")]  # beyond 10**20
            rough = b["whole"].cast("double") + (decimal.cast("double") + b["rest"])
            return F.when(b["rest"] == 0, F.coalesce(*exact, rough)).otherwise(rough)

        return F.when(p["widest"] == 0, decimal.cast("double")).when(p["widest"] == 1, let(_bins_total(p["bins"]), with_bins)).otherwise(p["plain"])

    return let(parts, total)


def exact_avg(c: ColumnOrName) -> Column:
    """Average over non-NULL values with a reproducible sum; divided once, as double."""
    return exact_sum(c) / F.nullif(F.count(col(c)), F.lit(0))
