"""CSV files of one folder whose headers differ, each read by its own header.

Spark takes the header of one file for all files of a read and binds columns by position, so a
file with another column order would give wrong numbers without an error.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

from ..schema import require_columns

READERS = 32


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a text file, compressed or not; None if it has none."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    text = jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
    lines = jvm.java.io.BufferedReader(text)
    try:
        return lines.readLine()
    finally:
        lines.close()


def header_groups(spark: SparkSession, files: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each header, as column names in order. Files without a line are left out.

    One line of each file is read, by several threads of the driver.
    """
    with ThreadPool(max(1, min(READERS, len(files)))) as pool:
        lines = pool.map(lambda f: first_line(spark, f), files)
    out: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines, strict=True):
        if line is not None:
            names = tuple(n.strip() for n in next(csv.reader([line.removeprefix("﻿")]), []))
            out.setdefault(names, []).append(file)
    return dict(sorted(out.items()))


def read_csv(spark: SparkSession, path: str, required: Sequence[str] = ()) -> DataFrame:
    """Every CSV file under ``path`` as text columns, matched by the names in its own header.

    Files of one header are one read; with several headers the reads are united by name. Every
    file needs the required columns, a further one that a file lacks is null in its rows.
    """

    def reader() -> DataFrameReader:
        return spark.read.option("header", True).option("mode", "FAILFAST")

    whole = reader().csv(path)
    uri = spark._jvm.java.net.URI
    files = [spark._jvm.org.apache.hadoop.fs.Path(uri(f)).toString() for f in whole.inputFiles()]
    groups = header_groups(spark, files) if len(files) > 1 else {}
    if len(groups) < 2:
        require_columns(whole, required)
        return whole

    def read(members: list[str]) -> DataFrame:
        # Names in folders (day=...) stay columns.
        base = reader() if any(c in path for c in "*?[{") else reader().option("basePath", path)
        table = base.csv(members)
        require_columns(table, required, f"required columns in {len(members)} files such as {members[0]}")
        return table

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(read, groups.values()))
