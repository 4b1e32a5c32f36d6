"""A claim that at most one application can hold, as a file in a shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def claim_once(spark: SparkSession, folder: str, what: str) -> str:
    """Take ``folder`` for this application, or raise ``ValueError`` if it was taken before.

    Each applicant writes a file of its own and then lists the folder. It holds the claim only if
    it sees no other file; else it takes its own back. Of two at the same time at most one gets
    it, on any file system whose listings show finished writes: no atomic rename is asked for.
    A claim stays when its owner fails.
    """
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = spark._jvm.org.apache.hadoop.fs.Path
    parent = path(folder)
    files = parent.getFileSystem(conf)
    files.mkdirs(parent)
    own = path(parent, f"claim-{uuid.uuid4().hex}")
    files.create(own, False).close()
    if [s.getPath().getName() for s in files.listStatus(parent)] != [own.getName()]:
        files.delete(own, False)
        raise ValueError(f"{what} already used: {folder}")
    return own.toString()
