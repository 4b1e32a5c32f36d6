"""Demand tables derived from the test tables, as Spark plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.functions import floor_hour
from loadcast.operators.layout import Layout, measure
from loadcast.plans import prepare

NAIVE_MODELS = {
    "Seasonal Naive": "lag_168",
    "lag_24": "lag_24",
    "rolling_mean_24": "rolling_mean_24",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series: total event value per hour."""
    events = table(spark, sf_dir, "events")
    return events.groupBy(F.lit("all").alias("series_id"), floor_hour(F.col("ts")).alias("ts")).agg(
        F.round(F.sum("value"), 2).alias("y")
    )


def hourly_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series per event type."""
    events = table(spark, sf_dir, "events")
    return events.groupBy(F.col("event_type").alias("series_id"), floor_hour(F.col("ts")).alias("ts")).agg(
        F.round(F.sum("value"), 2).alias("y")
    )


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily quantity shipped per supplier: many series."""
    lineitem = table(spark, sf_dir, "lineitem")
    # Grouped by a number and a date, which hash and shuffle smaller than text and timestamp.
    daily = lineitem.groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("day")).agg(
        F.sum("l_quantity").alias("y")
    )
    return daily.select(
        F.col("l_suppkey").cast("string").alias("series_id"), F.col("day").cast("timestamp_ntz").alias("ts"), "y"
    )


def panel_layout(spark: SparkSession, sf_dir: str) -> Layout:
    """Measured on the raw rows of one column: an upper bound for the daily panel."""
    return measure(table(spark, sf_dir, "lineitem"), "l_suppkey")


def long_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one irregular series: a single key holds all rows."""
    return table(spark, sf_dir, "events").select(F.lit("all").alias("series_id"), "ts", F.col("value").alias("y"))


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(F.lit("all").alias("series_id"), F.col("o_orderdate").alias("ts")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("y")
    )


def panel_frame(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Layout]:
    layout = panel_layout(spark, sf_dir)
    return prepare(panel(spark, sf_dir), layout=layout), layout


def long_form(frame: DataFrame, models: dict[str, str] | None = None) -> DataFrame:
    """One row per model and frame row, by a narrow explode."""
    models = models or NAIVE_MODELS
    entries = [
        F.struct(F.lit(name).alias("model"), F.col(column).alias("prediction")) for name, column in models.items()
    ]
    kept = [c for c in ("series_id", "ts", "y", "split", "fold") if c in frame.columns]
    return frame.select(*kept, F.inline(F.array(*entries)))


def naive(frame: DataFrame) -> DataFrame:
    return frame.withColumn("prediction", F.col("lag_168"))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round floating columns, as the SQL side does: sums differ in the last bits."""
    return reduce(
        lambda d, f: d.withColumn(f.name, F.round(f.name, digits)) if f.dataType.typeName() == "double" else d,
        df.schema.fields,
        df,
    )
