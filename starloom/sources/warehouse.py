"""Where the star is written and read."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it then gets one folder under /tmp.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_folders[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{label}-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A small table typed in by hand."""
    return spark.createDataFrame(list(rows), schema)


def write_table(df: DataFrame, folder: str, name: str, schema: T.StructType) -> DataFrame:
    """Overwrite ``folder/name`` and give it back as read from there."""
    path = f"{folder}/{name}"
    conform(df, schema).write.mode("overwrite").parquet(path)
    return read_table(df.sparkSession, folder, name, schema)


def read_table(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/{name}")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from there.

    Cuts the lineage, lets several uses share one computation, and gives the planner a
    true size. Unlike a cached table it outlives its executors.
    """
    folder = new_folder(df.sparkSession, label)
    return write_table(df, folder, label, df.schema)
