"""Materialising intermediate results on storage every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# A hinted broadcast side must be provably no longer than this.
BROADCAST_ROWS = 1_000_000


_scope: ContextVar[str] = ContextVar("waterline_scope", default="common")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; only a local session may fall back to a temporary one."""
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_SETTING, None) or context.getConf().get(CHECKPOINT_SETTING)
    if named or context.getCheckpointDir():
        return named or context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="waterline-"))
    return context.getCheckpointDir()


def scratch_area(spark: SparkSession, scope: str | None = None) -> str:
    """This application's own part of the shared folder, or that of one scope in it."""
    own = f"{shared_dir(spark).rstrip('/')}/waterline-{spark.sparkContext.applicationId}"
    return own if scope is None else f"{own}/{scope}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the current scope of this application."""
    return f"{scratch_area(spark, _scope.get())}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(name: str) -> Iterator[None]:
    """What is materialised inside goes to a scope of its own, which ``drop_stages`` can drop by name."""
    token = _scope.set(name)
    try:
        yield
    finally:
        _scope.reset(token)


def drop_stages(spark: SparkSession, scope: str | None = None) -> None:
    """Delete this application's materialised stages, or those of one scope.

    Frames that still read them fail from then on, so call it when their results are written.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_area(spark, scope))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder now and go on from the files, with its lineage cut.

    A Parquet table rather than an RDD checkpoint: later reads of a few columns stay few columns.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast when the caller's bound on the row count allows it, else leave it to AQE."""
    return F.broadcast(df) if max_rows <= BROADCAST_ROWS else df
