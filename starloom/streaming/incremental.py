"""New feed files as micro-batches: seen ids are skipped, the history is merged.

The stream's own checkpoint remembers which files were read, and the batch number makes
a repeated micro-batch write the same folders again, so a restart neither loses nor
doubles rows. What a batch reads and writes follows from the keys it holds, not from all that came before: ids and open versions lie in
buckets of their key's hash, and only buckets that the batch touches are opened.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.joins import only_new
from ..operators.shape import keep_last
from ..operators.staging_area import staging_root
from ..plans.history import KEY, TRACKED, changed_versions, first_snapshot, one_row_per_key
from ..sources.files import CSV_OPTIONS

BUCKETS = 256
# The filter of seen ids: so many bitmaps of 32,768 bits per bucket, 16 MB in all; fuller ones only open buckets in vain.
MAPS, MAP_BITS = 16, 1 << 15


def new_files(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """CSV feed files of a folder as a stream, each read once.

    The header of every file is held against the schema, in order: a file with other columns stops the stream instead of being
    read into the wrong ones.
    """
    return spark.readStream.schema(schema).options(**CSV_OPTIONS, enforceSchema=False).csv(folder)


def _run(stream: DataFrame, name: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    checkpoint = f"{staging_root(stream.sparkSession)}/streams/{name}"
    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _place(key: Sequence[str]) -> Column:
    """A number below BUCKETS * MAPS * MAP_BITS from a key; NULLs count by their place."""
    parts = [x for c in key for x in (F.col(f"`{c}`").cast("string"), F.isnull(F.col(f"`{c}`")))]
    return F.pmod(F.xxhash64(*parts), F.lit(BUCKETS * MAPS * MAP_BITS))


def _bucket(key: Sequence[str]) -> Column:
    return F.floor(_place(key) / (MAPS * MAP_BITS)).cast("int")


def _touched(keyed: DataFrame, bucket: str) -> list[int]:
    """The buckets that rows fall into, BUCKETS numbers at most."""
    return sorted(r[0] for r in keyed.select(bucket).distinct().collect())


# --- seen ids --------------------------------------------------------------------------------

def append_unseen(stream: DataFrame, base: str, key: str, ingest_order: str, name: str) -> StreamingQuery:
    """Append the rows whose key no earlier batch held; within a batch the last one wins.

    Rows go to ``batch=n``. The ids of a batch go to ``_seen/ids/bucket=b/batch=n`` and the filter of all ids up to it, a bitmap of fixed
    size, to ``_seen/filter/batch=n``. An id whose bit is not set is new; the buckets of the others are read, and
    those buckets only, to compare the ids themselves.
    """
    schema = stream.schema

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()  # read for the filter and for the rows; rebuilt from the files if lost
        known = _hit(batch, _filter(spark, base, number), key)
        hits = _touched(known, "__bucket")
        seen = _seen_ids(spark, base, hits, number, schema[key])
        fresh = keep_last(only_new(batch, seen, [key]), [key], F.col(ingest_order))
        fresh.write.mode("overwrite").parquet(f"{base}/batch={number}")
        batch.unpersist()
        _remember(spark.read.schema(schema).parquet(f"{base}/batch={number}"), base, key, number)

    return _run(stream, name, each)


def _filter(spark: SparkSession, base: str, number: int) -> DataFrame:
    """(__map, __bits): the bitmaps of all ids before a batch."""
    if number == 0:
        return spark.createDataFrame([], "__map long, __bits binary")
    return spark.read.schema("__map long, __bits binary").parquet(f"{base}/_seen/filter/batch={number - 1}")


def _hit(batch: DataFrame, bits: DataFrame, key: str) -> DataFrame:
    """(__bucket) of the rows whose bit is set."""
    place = batch.select(_place([key]).alias("__place"), _bucket([key]).alias("__bucket")).withColumn("__map", F.floor(F.col("__place") / MAP_BITS))
    bit = F.col("__place") % MAP_BITS
    byte = F.conv(F.hex(F.substring("__bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    set_ = byte.bitwiseAND(F.expr(f"shiftleft(1L, cast(__place % {MAP_BITS} % 8 as int))")) != 0
    return place.join(bits, "__map").filter(set_).select("__bucket")


def _seen_ids(spark: SparkSession, base: str, buckets: Sequence[int], number: int, field: T.StructField) -> DataFrame:
    """The ids that earlier batches have in some buckets."""
    stored = T.StructType([field, T.StructField("bucket", T.IntegerType()), T.StructField("batch", T.LongType())])
    if not buckets:
        return spark.createDataFrame([], T.StructType([field]))
    root = f"{base}/_seen/ids"
    folders = [f"{root}/bucket={b}" for b in buckets]  # a set bit was set by an id of its bucket
    read = spark.read.schema(stored).option("basePath", root).parquet(*folders)
    return read.filter(F.col("batch") < number).select(field.name)


def _remember(fresh: DataFrame, base: str, key: str, number: int) -> None:
    """Add the ids of a batch to the buckets, and their bits to the filter."""
    spark = fresh.sparkSession
    ids = fresh.select(key, _bucket([key]).alias("bucket"), F.lit(number).cast("long").alias("batch")).repartition("bucket")
    ids.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(f"{base}/_seen/ids")
    place = fresh.select(_place([key]).alias("__place"))
    new = place.groupBy(F.floor(F.col("__place") / MAP_BITS).alias("__map")).agg(F.bitmap_construct_agg(F.col("__place") % MAP_BITS).alias("__bits"))
    both = _filter(spark, base, number).unionByName(new).groupBy("__map").agg(F.bitmap_or_agg("__bits").alias("__bits"))
    both.write.mode("overwrite").parquet(f"{base}/_seen/filter/batch={number}")


# --- history ---------------------------------------------------------------------------------

def merge_history(
    stream: DataFrame, base: str, as_of: Callable[[int], str], name: str,
    key: Sequence[str] = KEY, tracked: Sequence[str] = TRACKED,
) -> StreamingQuery:
    """Merge every batch, one row per key, into a history of two parts.

    Open versions lie in buckets of their key. Batch ``n`` reads the buckets that its keys fall into and writes them anew to
    ``open/batch=n/bucket=b``; the versions it closes go to ``closed/batch=n``, written once and never again. ``buckets/batch=n``
    says which batch has the latest open versions of every bucket. What batch ``n - 1`` has superseded is deleted when batch ``n``
    is done: :func:`read_history` reads the state after the last two batches.
    """
    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        latest = _latest(spark, base, number - 1)
        placed = batch.withColumn("__bucket", _bucket(key)).persist()  # read for the buckets and for the rows; rebuilt if lost
        touched = _touched(placed, "__bucket")
        batch = placed.drop("__bucket")
        folders = [_folder(base, latest[b], b) for b in touched if b in latest]
        if folders:
            after = changed_versions(spark.read.schema(_versions(batch.schema)).parquet(*folders), batch, as_of(number), key, tracked)
        else:
            after = first_snapshot(one_row_per_key(batch, key), as_of(number))
        after = after.withColumn("bucket", _bucket(key)).repartition("bucket").persist()
        open_versions = after.filter("valid_to is null").select(*[c for c in after.columns if c != "bucket"], "bucket")
        open_versions.write.mode("overwrite").partitionBy("bucket").parquet(f"{base}/open/batch={number}")
        after.filter("valid_to is not null").drop("bucket").write.mode("overwrite").parquet(f"{base}/closed/batch={number}")
        after.unpersist()
        placed.unpersist()
        now = latest | dict.fromkeys(touched, number)
        rows = spark.createDataFrame(sorted(now.items()), "bucket int, batch long")  # BUCKETS rows at most
        rows.coalesce(1).write.mode("overwrite").parquet(f"{base}/buckets/batch={number}")
        _delete(spark, [_folder(base, old, b) for b, old in _latest(spark, base, number - 2).items() if latest.get(b) != old])

    return _run(stream, name, each)


def _folder(base: str, batch: int, bucket: int) -> str:
    return f"{base}/open/batch={batch}/bucket={bucket}"


def _versions(schema: T.StructType) -> T.StructType:
    ends = [T.StructField(c, T.TimestampNTZType()) for c in ("valid_from", "valid_to")]
    return T.StructType([*schema.fields, *ends])


def _latest(spark: SparkSession, base: str, number: int) -> dict[int, int]:
    """The batch that has the latest open versions of each bucket after a batch; none before the first."""
    if number < 0:
        return {}
    return {r.bucket: r.batch for r in spark.read.schema("bucket int, batch long").parquet(f"{base}/buckets/batch={number}").collect()}


def _delete(spark: SparkSession, folders: Sequence[str]) -> None:
    for folder in folders:  # BUCKETS at most
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_history(spark: SparkSession, base: str, number: int) -> DataFrame:
    """The history after batch ``number``, the last or the one before: its open versions and all closed up to then."""
    closed = spark.read.parquet(*[f"{base}/closed/batch={n}" for n in range(number + 1)])
    folders = [_folder(base, batch, bucket) for bucket, batch in _latest(spark, base, number).items()]
    if not folders:
        return closed
    return spark.read.schema(closed.schema).parquet(*folders).unionByName(closed)
