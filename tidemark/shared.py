"""The shared folder: where stages are written that several consumers read, and that other executors must see."""

from __future__ import annotations

import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a folder of this machine will do for a local session (tests, a laptop) only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master.startswith("local") and not master.startswith("local-cluster"):
        return f"{tempfile.gettempdir()}/tidemark"
    raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")


def importable(spark: SparkSession) -> None:
    """Python workers that start from now on import this package from where the driver has it."""
    sc, root = spark.sparkContext, str(Path(__file__).resolve().parents[1])
    here = sc.environment.get("PYTHONPATH", "")
    if root not in here.split(os.pathsep):
        sc.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, here) if x)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under this session's part of the shared folder."""
    return f"{folder(spark)}/tidemark-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """What is executed inside removes its shuffle files when it ends. Otherwise they stay until the driver happens to collect
    its garbage, and a query of several steps needs disk for the shuffles of all of them at once."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def written(df: DataFrame, name: str = "stage", compression: str | None = None) -> DataFrame:
    """df written to the shared folder and read again: computed once, its lineage cut, a lost executor's rows still there."""
    path = scratch(df.sparkSession, name)
    with swept(df.sparkSession):
        (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Removes what this session has written; its results that aren't collected or saved elsewhere go too."""
    _delete(spark, f"{folder(spark)}/tidemark-{spark.sparkContext.applicationId}")


def sweep(spark: SparkSession, days: float = 7.0) -> int:
    """Removes what sessions have left that wrote nothing for so many days; how many these were. Their own folder is touched
    whenever a session writes a stage."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder(spark))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    old, own = time.time() * 1000 - days * 86_400_000, f"tidemark-{spark.sparkContext.applicationId}"
    gone = [s for s in (fs.listStatus(root) if fs.exists(root) else []) if s.getPath().getName().startswith("tidemark-") and s.getPath().getName() != own and s.getModificationTime() < old]
    for s in gone:
        fs.delete(s.getPath(), True)
    return len(gone)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
