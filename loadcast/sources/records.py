"""Run records: one row each, stored as JSON."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import existing


def save_record(record: DataFrame, path: str) -> str:
    """Write a record frame (one row per run, or per series)."""
    record.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def load_record(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read a record back; give the schema to get maps and nested rows as they were.

    Takes one record per line, and a record (or a list of them) spread over lines with
    indentation. A record that cannot be parsed and a file without one raise an error.
    """
    lines = existing(lambda: spark.read.text(path), "Required artifact", path)
    text = F.trim("value")
    whole = F.startswith(text, F.lit("{")) & F.endswith(text, F.lit("}"))
    spread = not lines.where((text != "") & ~whole).isEmpty()
    reader = spark.read.option("multiLine", spread).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    record = reader.json(path)
    try:
        found = record.take(1)
    except (PySparkException, Py4JJavaError) as error:
        raise ValueError(f"Malformed record at: {path}") from error
    if not found:
        raise ValueError(f"No record at: {path}")
    return record


def optional_table(spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet") -> DataFrame:
    """The table, or an empty one of the same shape when it was never written."""
    reader = spark.read.schema(schema).format(format)
    if format == "csv":
        reader = reader.option("header", True)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def require_paths(spark: SparkSession, paths: Sequence[str]) -> None:
    """Fail with every missing path named."""
    missing = []
    for path in paths:
        try:
            spark.read.format("binaryFile").load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(path)
    if missing:
        raise FileNotFoundError(f"Required artifacts are missing: {missing}")
