"""Tables that a plan writes for itself, in the folder the cluster shares."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_DIR = "file:///tmp/checkpoints/foliospark"
_made: dict[str, SparkSession] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local one only where none is set and all tasks run in the driver's process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = LOCAL_DIR
    return found.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new name below the shared folder; what is there goes when the driver's process ends."""
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _made[path] = spark
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """``df`` written and read again: its lineage ends here, and a lost executor loses nothing.

    A table goes by ``release`` once all that reads it is written, or else when
    the driver's process ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(*tables: DataFrame) -> None:
    """Deletes tables of ``materialize`` that no plan reads any more."""
    for table in tables:
        if (spark := _made.pop(table._scratch, None)) is not None:
            _delete(spark, table._scratch)


@atexit.register
def _clean() -> None:
    for name, spark in _made.items():
        try:
            _delete(spark, name)
        except Exception:  # the JVM has ended before: nothing more to do
            return
