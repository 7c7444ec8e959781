"""Session helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app_name: str = "starloom", cores: str = "*", shuffle_partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks. Clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: the cluster's shared ``spark.checkpoint.dir``.

    Only a local session without one gets a folder of its own, which goes when the process ends.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="starloom-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    The rows and the partition numbers they carry then stay as they are whatever executors are
    lost, later steps read only the columns they need, and Spark knows the size of the table. It
    also ends the hash partitioning of ``df``: a join whose side is still partitioned from a window
    or aggregate skips that side's shuffle, and with it the splitting of hot keys.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
