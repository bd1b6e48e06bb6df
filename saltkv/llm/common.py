"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saltkv.session import scratch_path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this library to the executors' Python, once a session, unless their
    search path (``PYTHONPATH``) has it already."""
    root = Path(__file__).resolve().parents[2]
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    zipped = shutil.make_archive(f"{tempfile.mkdtemp()}/saltkv-package", "zip", root, "saltkv")
    spark.sparkContext.addPyFile(zipped)  # the driver serves it; no executor reads that folder
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under private names, so that extra
    input columns can neither clash nor be carried along by accident."""
    return df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("string").alias("__text"))


def hash_sample(df: DataFrame, by: str, n: int, order: list[str]) -> DataFrame:
    """The ``n`` rows of ``df`` with the smallest hash of column ``by``.  The
    limit is found on hashes alone, so that tasks send few whole rows."""
    h = F.xxhash64(by)
    last = df.select(h.alias("h")).orderBy("h").limit(n).agg(F.max("h")).first()[0]
    return df.where(h <= F.lit(last)).orderBy(h, *order).limit(n)


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage
    ends at files that every executor can read again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_KEPT: dict[str, dict] = {}


def kept(owner: str) -> dict:
    """What a Python worker keeps from one task of ``owner`` to its next: Spark reuses workers, for tasks of any operator."""
    return _KEPT.setdefault(owner, {})


def let_go(owner: str | None = None) -> None:
    """Drop what other operators keep, and give free memory back to the system."""
    import pyarrow as pa

    others = [own for name, own in _KEPT.items() if own and name != owner]
    for own in others:
        own.clear()
    if others:
        gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc's
        trim(0)


def lean(run, owner: str | None = None):
    """``run``, a function of Arrow batches, in a worker that holds nothing of other operators and nothing of this one's
    batches when it ends."""

    def lean_run(batches):
        let_go(owner)
        try:
            yield from run(batches)
        finally:
            let_go(owner)

    return lean_run


class KnownWords(dict):
    """A cache that notes the keys it was asked for and lacks."""

    def __init__(self):
        self.lacks: dict[str, None] = {}

    def __missing__(self, key):
        self.lacks[key] = None


def open_fs(uri: str):
    """``(pyarrow file system, path)`` of a shared location (file:, hdfs:, s3:...)."""
    from pyarrow import fs

    if not re.match(r"[a-zA-Z][a-zA-Z0-9+.-]+:", uri):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
