"""Series and prediction tables, as CSV or parquet."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.errors import error_columns, nan_to_null
from ..operators.filters import with_errors
from ..operators.ordering import drop_duplicate_times
from ..schema import DAY, DEFAULT_COLUMNS, SeriesColumns, require_columns
from .headers import read_csv

# Texts a CSV reader takes as a missing number.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def existing(read: Callable[[], DataFrame], what: str, path: str) -> DataFrame:
    """Run a reader, turning Spark's path error into ``FileNotFoundError``."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"{what} not found at: {path}") from error
        raise


def parse_time(value: Column, kind: T.DataType, pattern: str | None = None) -> Column:
    """A zone-free timestamp; text that does not parse fails the job, never becomes NULL."""
    if isinstance(kind, T.TimestampNTZType):
        return value
    if not isinstance(kind, T.StringType):
        return value.cast("timestamp_ntz")
    parsed = F.to_timestamp_ntz(value, F.lit(pattern)) if pattern else F.to_timestamp_ntz(value)
    failure = F.raise_error(F.concat(F.lit("Unparseable timestamp: "), value)).cast("timestamp_ntz")
    return F.when(value.isNotNull() & parsed.isNull(), failure).otherwise(parsed)


def parse_number(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        value = F.when(~F.trim(value).isin(MISSING_TEXTS), F.trim(value))
    return nan_to_null(value.cast("double"))


def read_table(spark: SparkSession, path: str, format: str, what: str, required: Sequence[str] = ()) -> DataFrame:
    """A table with the required columns; CSV columns are text, matched by the header of each file."""
    if format == "csv":
        return existing(lambda: read_csv(spark, path, required), what, path)
    table = existing(lambda: spark.read.format(format).load(path), what, path)
    require_columns(table, required)
    return table


def load_series(
    spark: SparkSession,
    path: str,
    cols: SeriesColumns = DEFAULT_COLUMNS,
    format: str = "csv",
    pattern: str | None = None,
    series: str = "all",
    unique: bool = False,
) -> DataFrame:
    """A demand table: required columns checked, times parsed, one row per (series, time).

    A file without a series column becomes the single series named ``series``.
    Further columns pass through. ``unique=True`` skips the duplicate-removing
    shuffle for sources known to have none. Order is left to the operators that
    need it; sort at the sink if a sorted file is wanted.
    """
    raw = read_table(spark, path, format, "Dataset", [cols.time, cols.target])
    kinds = {f.name: f.dataType for f in raw.schema.fields}
    typed = raw.withColumns(
        {
            cols.series: F.col(cols.series) if cols.series in kinds else F.lit(series),
            cols.time: parse_time(F.col(cols.time), kinds[cols.time], pattern),
            cols.target: parse_number(F.col(cols.target), kinds[cols.target]),
        }
    )
    return typed if unique else drop_duplicate_times(typed, cols)


def load_predictions(
    spark: SparkSession,
    path: str,
    cols: SeriesColumns = DEFAULT_COLUMNS,
    format: str = "csv",
    pattern: str | None = None,
    series: str = "all",
) -> DataFrame:
    """A saved prediction table, typed, with its error columns complete, also where only some files have them."""
    raw = read_table(spark, path, format, "Final predictions artifact", [cols.time, cols.target, "prediction"])
    kinds = {f.name: f.dataType for f in raw.schema.fields}
    numbers = [n for n in (cols.target, "prediction", "residual", "absolute_error") if n in kinds]
    typed = raw.withColumns(
        {
            cols.series: F.col(cols.series) if cols.series in kinds else F.lit(series),
            cols.time: parse_time(F.col(cols.time), kinds[cols.time], pattern),
            **{n: parse_number(F.col(n), kinds[n]) for n in numbers},
        }
    )
    if "residual" in kinds:
        typed = typed.withColumn("residual", F.coalesce("residual", error_columns(cols.target)["residual"]))
    return with_errors(typed, cols)


def write_by_day(
    df: DataFrame, path: str, cols: SeriesColumns = DEFAULT_COLUMNS, ranges: int | None = None, mode: str = "overwrite"
) -> str:
    """Parquet in a folder for each day, sorted in each file, for tables that are read by date window.

    A window reads the folders of its days only. Rows are dealt by range of (day, series, time):
    a day with many rows is several files, and a file is of few days. ``ranges`` asks for a number
    of ranges other than the session's.
    """
    order = [DAY, *cols.key]
    dated = df.withColumn(DAY, F.to_date(cols.time))
    ranged = dated.repartitionByRange(ranges, *order) if ranges else dated.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.mode(mode).partitionBy(DAY).parquet(path)
    return path


def write_table(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    partition_by: Sequence[str] = (),
    order_by: Sequence[str | Column] = (),
    mode: str = "overwrite",
) -> str:
    """Write a directory of files, with a header for CSV; ``order_by`` sorts across the files."""
    if order_by:
        df = df.orderBy(*order_by)
    writer = df.write.mode(mode).format(format)
    if format == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path
