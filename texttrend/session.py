"""Session settings and tables kept between steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Runtime settings every job relies on; the rest is left to the cluster.
_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin UTC and adaptive execution (with skew-join splitting) on a session."""
    for key, value in _RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("texttrend")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Recording a call site for every column expression slows plan building.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {"spark.sql.shuffle.partitions": "8", **conf}.items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Unset is accepted in local mode only, where driver and executors share one
    disk; a cluster must name storage all executors can reach.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="texttrend-"))
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession) -> str:
    """A folder of its own below the shared one, not created yet."""
    return f"{shared_folder(spark).rstrip('/')}/texttrend/{uuid.uuid4().hex}"


def store(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and read it back, cutting its lineage.

    Used for what several later steps read: the table survives lost executors,
    is pruned and filtered at the scan, and carries a real size for the planner.
    """
    spark = df.sparkSession
    path = path or new_path(spark)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """Rows of the driver program as a table whose size the planner knows.

    Going through Arrow makes it a local relation; plain lists would become an
    RDD scan of unknown size, which is never broadcast.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [()] * len(arrow)
    arrays = [pa.array(values, type=field.type) for values, field in zip(columns, arrow)]
    return spark.createDataFrame(pa.table(arrays, schema=arrow), schema)


def is_small(df: DataFrame, rows: int = 200_000) -> bool:
    """Whether ``df`` has at most ``rows`` rows; counts no further than that."""
    return df.limit(rows + 1).count() <= rows
