"""Session helpers: a local session for tests and the shared folder for written tables."""

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_session(cores="*", partitions=8, name="larkspur"):
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        # Noting the call site of every column costs more than planning the query.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark):
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without one gets a temporary folder; a cluster without one is an error,
    because a folder of one machine is lost with that machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="larkspur-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def new_path(spark, name):
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/larkspur/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df):
    """Reliable checkpoint, below the shared folder."""
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def small_table(spark, rows, schema):
    """A table of a few rows held in the plan, so that Spark knows its size and can broadcast it."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)
    columns = list(zip(*rows)) or [()] * len(kind)
    arrays = [pa.array(list(c), f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), kind)
