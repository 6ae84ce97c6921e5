"""Session checks and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def require_utc(spark: SparkSession) -> None:
    """Dates are cut from instants in the session zone, so the zone is fixed."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00", "GMT"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, found {zone}")


def _join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one machine, may fall
    back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="tsmedallion-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch folder; nothing is created yet."""
    return _join(scratch_root(spark), "tsmedallion", f"{name}-{uuid.uuid4().hex}")


# Tables written by ``materialise`` inside the innermost scope of this thread.
_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Drop, at the end, the tables that ``materialise`` wrote inside.

    For a run that has written its results. Without a scope the tables stay, as
    a DataFrame returned to the caller may still read them.
    """
    written: list[str] = []
    token = _scope.set(written)
    try:
        yield
    finally:
        _scope.reset(token)
        for name in written:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage like a checkpoint, but stays columnar, so later reads
    prune columns, and survives the loss of any executor. With ``partition_by``
    each value of these columns has a folder of its own, which a filter prunes.
    """
    path = scratch_path(df.sparkSession, name)
    written = _scope.get()
    if written is not None:
        written.append(path)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
