"""Cut lineage by writing a table into the cluster's shared folder.

A written table survives the loss of any executor, carries exact file sizes into the
optimizer and answers ``count()`` from its footers.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")

SETTING = "spark.checkpoint.dir"
#: Of written tables.
CODEC = "zstd"
#: Masters whose only executor is the driver itself.
_ONE_PROCESS = re.compile(r"local(\[[^,\]]*(,[^,\]]*)?\])?")


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` or the context names.

    Only where neither is set and the driver is the one executor, as in a test, is a folder made
    and named for the rest of the application.
    """
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not _ONE_PROCESS.fullmatch(spark.sparkContext.master):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyhouse-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/tallyhouse/{name}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Run ``df`` once, write it, and return a reader of the written table."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_once(tasks: Sequence[Callable[[], Result]]) -> list[Result]:
    """Results of independent tasks whose jobs share the cluster; the first error is raised when all have ended."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max(1, len(tasks))) as pool:
        return [f.result() for f in [pool.submit(inherit(t)) for t in tasks]]
