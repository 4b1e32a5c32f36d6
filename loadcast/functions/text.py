"""Text forms used in records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_timestamp(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")


def label(value: Column) -> Column:
    return F.upper(F.translate(value, "_", " "))
