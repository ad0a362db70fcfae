"""Helpers of the operators: staged tables, folds, text columns, Arrow batches.

Staged tables live below ``spark.checkpoint.dir``, which every executor reaches, so a lost
executor costs recomputed tasks and never a lost table.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SETTING = "spark.checkpoint.dir"
#: Separators of words: a space and the control characters from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; only a single-process session without one gets its own."""
    configured = spark.conf.get(SETTING, None)
    if configured:
        return configured.rstrip("/")
    own = spark.sparkContext.getCheckpointDir()
    if own:
        return own.rstrip("/")
    if not re.fullmatch(r"local(\[[^,\]]*(,[^,\]]*)?\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyhouse-llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Run ``df`` once into the shared folder and read it from there; removed when the application ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application; the driver's import path may not be theirs."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    held = os.path.join(tempfile.mkdtemp(prefix="tallyhouse-code-"), "tallyhouse_code.zip")
    with zipfile.ZipFile(held, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(held)
    _shipped.add(app)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts


def column(df: DataFrame, name: str, kind: str) -> Column:
    """A column by its exact name, so that odd names of extra columns never clash."""
    return df[f"`{name}`"].cast(kind)


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` does not have, compared without case."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def runs(texts: pa.Array, limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text each; a longer text is a range of its own."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        before = ends[lo] - sizes[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield lo, hi
        lo = hi


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts behind one another, and where each begins (one more entry for the end); null is empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        texts, kind = texts.cast(pa.string()), np.int32
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]
