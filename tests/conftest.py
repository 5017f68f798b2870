import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Build a small DataFrame from rows and a DDL schema."""
    def build(rows, schema):
        return spark.createDataFrame([tuple(r) if isinstance(r, (list, tuple)) else (r,) for r in rows], schema)

    return build


@pytest.fixture(scope="session")
def values(frame):
    """Evaluate a column function over single values."""
    def evaluate(function, inputs, kind="string"):
        df = frame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
        return [r[0] for r in df.select("i", function("x").alias("y")).orderBy("i").select("y").collect()]

    return evaluate


def rows(df):
    """Rows of a result as a sorted list of plain tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
