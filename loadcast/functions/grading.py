"""Anomaly flag, direction and severity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score at which an anomaly becomes high, then critical.
HIGH_FROM = 1.5
CRITICAL_FROM = 2.0


def direction(residual: Column) -> Column:
    return F.when(residual > 0, "spike").when(residual < 0, "drop").otherwise("neutral")


def anomaly_flag(absolute_residual: Column, threshold: Column) -> Column:
    return absolute_residual > threshold


def severity_score(absolute_residual: Column, threshold: Column) -> Column:
    return absolute_residual / threshold


def severity(score: Column, is_anomaly: Column) -> Column:
    return (
        F.when(~is_anomaly, "normal")
        .when(score < HIGH_FROM, "moderate")
        .when(score < CRITICAL_FROM, "high")
        .when(is_anomaly, "critical")
    )
