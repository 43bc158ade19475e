"""Session defaults, shared scratch space and materialisation of derived tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "featloom", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Session with adaptive execution and skew handling on.

    On a cluster ``master`` and the partition count are left to the deployment;
    adaptive execution coalesces small shuffles and splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is made, but only in local
    mode: on a cluster a machine-local folder would be lost with its executor.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="featloom-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


@contextmanager
def owned_stages(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``materialize`` wrote inside the block when it ends; for plans that leave their results elsewhere."""
    paths: list[str] = []
    token = _owned.set(paths)
    try:
        yield
    finally:
        _owned.reset(token)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for path in paths:
            target = hadoop(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet to the shared folder and reading it back.

    The written table survives the loss of executors, and its file sizes give
    Catalyst real statistics for the joins that follow: a small one is broadcast
    by the session's own threshold, any other is joined by shuffle.
    """
    path = scratch_path(df.sparkSession, name)
    if (paths := _owned.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
