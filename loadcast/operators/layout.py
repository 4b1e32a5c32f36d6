"""Measured size of a series table, and the plan choices that follow from it.

Two layouts exist. When every series is small, a series is the unit of
parallelism and one hash shuffle serves all per-series windows. When any series
is too long for one task, the time axis itself is cut into blocks. The choice is
made from a count, never guessed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_TASK_CONF = "spark.loadcast.rowsPerTask"
BLOCK_ROWS_CONF = "spark.loadcast.blockRows"
BROADCAST_ROWS_CONF = "spark.loadcast.broadcastRows"

DEFAULT_ROWS_PER_TASK = 2_000_000
DEFAULT_BLOCK_ROWS = 262_144
DEFAULT_BROADCAST_ROWS = 250_000
# Scheduling limit for one stage; beyond it partitions grow instead.
MAX_TASKS = 100_000


def setting(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(key, str(default)))


@dataclass(frozen=True)
class Layout:
    n_series: int
    n_rows: int
    max_rows: int
    rows_per_task: int = DEFAULT_ROWS_PER_TASK
    block_rows: int = DEFAULT_BLOCK_ROWS
    always_blocks: bool = False

    @property
    def blocked(self) -> bool:
        return self.always_blocks or self.max_rows > self.rows_per_task

    @property
    def block_bound(self) -> int | None:
        """Most (series, block) groups there can be; None when the size is unknown."""
        return self.n_series + math.ceil(self.n_rows / self.block_rows) if self.n_rows else None

    @property
    def tasks(self) -> int:
        """Partitions that keep a task near ``rows_per_task`` rows; 0 when the size is unknown."""
        return min(MAX_TASKS, math.ceil(self.n_rows / self.rows_per_task)) if self.rows_per_task else 0


def spread(df: DataFrame, keys: list[str], layout: Layout) -> DataFrame:
    """Shuffle by ``keys`` into enough partitions for the measured rows.

    While the session's partition count suffices, the shuffle is left to Spark,
    which then merges small partitions at run time.
    """
    if layout.tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(layout.tasks, *keys)


def measure(df: DataFrame, by: str | list[str], rows_per_task: int | None = None) -> Layout:
    """Count series and rows. One job over the key column only; one row comes back.

    Counting a source before it is aggregated gives upper bounds, which is
    enough: a plan chosen for a bound is right for anything below it.
    """
    keys = [by] if isinstance(by, str) else list(by)
    limit = rows_per_task or setting(df.sparkSession, ROWS_PER_TASK_CONF, DEFAULT_ROWS_PER_TASK)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    found = sizes.agg(
        F.count(F.lit(1)).alias("n_series"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.max("rows"), F.lit(0)).alias("max_rows"),
    ).first()
    blocks = setting(df.sparkSession, BLOCK_ROWS_CONF, DEFAULT_BLOCK_ROWS)
    return Layout(found["n_series"], found["n_rows"], found["max_rows"], limit, blocks)


def join_by_series(
    rows: DataFrame, table: DataFrame, on: str | list[str], table_rows: int | None, how: str = "inner"
) -> DataFrame:
    """Join a table of at most ``table_rows`` rows to the fact rows.

    Broadcast only while that bound is small. Past it, or without a bound, the join
    is left to adaptive execution, which splits the partitions of hot keys.
    """
    limit = setting(rows.sparkSession, BROADCAST_ROWS_CONF, DEFAULT_BROADCAST_ROWS)
    small = table_rows is not None and table_rows <= limit
    return rows.join(F.broadcast(table) if small else table, on, how)
