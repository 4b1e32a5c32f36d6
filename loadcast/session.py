"""Session defaults, the shared staging folder and staged tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_OWNED: ContextVar[str | None] = ContextVar("owned_staging", default=None)


def build_session(app_name: str = "loadcast", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    Cluster settings given through ``spark-submit`` win over these defaults for
    anything not named here; ``master`` is only for local runs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with the machine.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder all executors share")
    folder = tempfile.mkdtemp(prefix="loadcast-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


@contextmanager
def owned_staging(spark: SparkSession) -> Iterator[str]:
    """Stage into a folder of this block's own and delete it at the end of the block.

    For callers that write their results inside the block: nothing staged outlives it.
    """
    folder = os.path.join(staging_dir(spark), "loadcast", f"run-{uuid.uuid4().hex}")
    token = _OWNED.set(folder)
    try:
        yield folder
    finally:
        _OWNED.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written table survives the loss of any executor, ends the lineage, and
    stays columnar, so later readers prune columns and push filters. With
    ``partition_by`` a filter on those columns skips whole folders.
    """
    folder = _OWNED.get() or os.path.join(staging_dir(df.sparkSession), "loadcast")
    path = os.path.join(folder, f"{label}-{uuid.uuid4().hex}")
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
