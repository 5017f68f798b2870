"""Written intermediate tables: the only way this package cuts lineage.

A staged table is a parquet folder under the checkpoint folder of the cluster, so it
outlives any executor and is read back with column pruning.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: the session's checkpoint folder, else its warehouse.

    Both are shared by all executors of a cluster. A warehouse on the machines' own disks, as it is where nothing is set, is refused
    unless the session runs on one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (root or _shared(spark.conf.get("spark.sql.warehouse.dir"), spark.conf.get("spark.master", "local"))).rstrip("/")


def _shared(root: str, master: str) -> str:
    if not master.startswith("local") and (root.startswith("file:") or ":" not in root):
        raise ValueError(f"staged tables need a folder that all executors share: set spark.checkpoint.dir ({root} is each machine's own)")
    return root


def staged_path(spark: SparkSession, label: str) -> str:
    """A new folder for one staged table."""
    return f"{staging_root(spark)}/starloom/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back."""
    path = staged_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete every table this application has staged; call it when its results are written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{staging_root(spark)}/starloom/{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
