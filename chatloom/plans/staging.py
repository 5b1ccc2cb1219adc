"""Cut long lineages by writing a table to the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_local_dirs: dict[str, str] = {}


def stage_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    # A setting of the core can't be changed in a running session.
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="chatloom-")
    return _local_dirs[app]


def _own_dir(spark: SparkSession) -> str:
    """Folder of this application's staged tables."""
    return f"{stage_dir(spark)}/chatloom/{spark.sparkContext.applicationId}"


def stage_path(spark: SparkSession, label: str) -> str:
    return f"{_own_dir(spark)}/{label}-{uuid.uuid4().hex}"


def remove_staged(spark: SparkSession) -> bool:
    """Delete all tables this application has staged; whether there were any.

    Call it when a job's results are written: DataFrames that read staged tables can't be
    used afterwards. Tables of other applications in the same folder stay.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    The result has a short lineage, survives lost executors, and carries real
    sizes, so the planner's broadcast decisions rest on checked numbers.
    """
    return stage_with_path(df, label)[0]


def stage_with_path(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Like ``stage``, with the folder of the table, for ``discard``."""
    spark = df.sparkSession
    path = stage_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete one staged table. Nothing that is still to run may read it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stage_counted(df: DataFrame, label: str, condition: Column) -> tuple[DataFrame, int]:
    """Like ``stage``, and count the rows that meet ``condition`` while writing."""
    seen = Observation()
    staged = stage(df.observe(seen, F.count_if(condition).alias("rows")), label)
    return staged, seen.get["rows"]


def together(*builds: Callable[[], DataFrame]) -> list[DataFrame]:
    """Run independent builds at the same time, so that their jobs share the cluster."""
    with ThreadPoolExecutor(max_workers=len(builds)) as pool:
        return [job.result() for job in [pool.submit(build) for build in builds]]
