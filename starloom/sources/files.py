"""File sources and sinks of the course and toll jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_schema(columns: Sequence[str]) -> T.StructType:
    """All columns as text: dirty feeds are cast, and judged, later."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# --- delimited text ---------------------------------------------------------------------

CSV_OPTIONS = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}


def read_course_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Course CSV with a header, a byte order mark and quoted text over several lines; columns by their header names.

    All files of one read share a header. Columns of the file that are not asked for are not returned, one that is asked
    for and absent is an error. Quoted line breaks keep a file in one task: write large feeds as several files.
    """
    found = header_names(spark, path)
    absent = [c for c in columns if c not in found]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    reader = spark.read.schema(text_schema(found)).options(**CSV_OPTIONS, enforceSchema=False)
    return reader.csv(path).select(*[F.col(f"`{c}`") for c in columns])


def header_names(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file, from its header line alone."""
    return [c.removeprefix("\ufeff") for c in spark.read.options(**CSV_OPTIONS, inferSchema=False).csv(path).columns]


def read_columns(spark: SparkSession, path: str, columns: Sequence[str], keep: Sequence[int], sep: str = ",") -> DataFrame:
    """Delimited text with a header, only the columns at the given places (1-based)."""
    df = spark.read.schema(text_schema(columns)).option("header", True).option("sep", sep).csv(path)
    return df.select(*[F.col(f"`{columns[i - 1]}`") for i in keep])


def read_vehicles(spark: SparkSession, path: str) -> DataFrame:
    """Toll vehicle CSV: its first four columns."""
    columns = ["Rowid", "Timestamp", "VehicleNumber", "VehicleType"]
    return read_columns(spark, path, columns, [1, 2, 3, 4])


def read_toll_plazas(spark: SparkSession, path: str) -> DataFrame:
    """Toll plaza TSV: columns five to seven."""
    columns = [
        "Rowid", "Timestamp", "VehicleNumber", "VehicleType", "TollPlazaID", "TollPlazaCode", "PaymentCode",
    ]
    return read_columns(spark, path, columns, [5, 6, 7], sep="\t")


def read_payments(spark: SparkSession, path: str) -> DataFrame:
    """Toll payment text of fixed width: characters 1-5 and 7-16."""
    return spark.read.text(path).select(
        F.substring("value", 1, 5).alias("row_number"), F.substring("value", 7, 10).alias("payment_type")
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header in every part file; ``append`` adds part files."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, got {mode!r}")
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


# --- JSON and logs --------------------------------------------------------------------------

def read_json_records(spark: SparkSession, path: str, schema: T.StructType | str, lines: bool = False) -> DataFrame:
    """JSON files holding one array of objects each, or one object per line.

    A file with an array is read by one task; use lines for large ones.
    """
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def write_json_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line, NULL fields kept."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


# Fixed value: how the log reports a failed request.
FAILED_REQUEST = r"All retries failed: .*api-2.0/courses/(\d+)/"


def failed_ids(lines: DataFrame, column: str = "value", pattern: str = FAILED_REQUEST) -> DataFrame:
    """Distinct ids of the requests a log reports as failed."""
    found = lines.select(F.regexp_extract(column, pattern, 1).alias("course_id"))
    return found.filter("course_id <> ''").distinct()


def read_failed_ids(spark: SparkSession, path: str) -> DataFrame:
    return failed_ids(spark.read.text(path))
