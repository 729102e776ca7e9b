"""A local session for tests and benchmarks (on a cluster the caller brings its own), and the shared folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | None = None, memory: str = "8g") -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("loamline")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@lru_cache(maxsize=1)
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="loamline-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder for what is written between steps: the session's ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder, removed when Python ends. On a
    cluster no machine's own folder will do, so there the setting is asked for.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _own_folder()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage through the shared folder."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Removes a folder that Spark wrote, in whatever store it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
