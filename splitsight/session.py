"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "splitsight", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; callers size shuffles themselves."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, also set as checkpoint folder.

    A temporary folder is used only when the setting is missing and driver and executors are one
    process; on a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    root = configured or current
    if root is None:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder when the master is {master}")
        root = tempfile.mkdtemp(prefix="splitsight-")
    if current is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


_made: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for a table that has to be written once."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what was stored below the shared folder inside it.

    Results have to be written or collected before the end. Without it, such tables stay.
    """
    before = len(_made)
    try:
        yield
    finally:
        for path in _made[before:]:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        del _made[before:]


def stored(df: DataFrame, label: str = "stored") -> DataFrame:
    """The rows written once as a table below the shared folder and read back.

    For results that are read several times: cuts the lineage, survives the loss of executors, and
    later reads prune columns and know the size.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
