"""Readers and writers for series, predictions, run records and models."""

from .claims import claim_once
from .models import load_model, save_model
from .records import load_record, optional_table, require_paths, save_record
from .tables import load_predictions, load_series, parse_time, write_by_day, write_table

__all__ = [
    "claim_once",
    "load_model",
    "load_predictions",
    "load_record",
    "load_series",
    "optional_table",
    "parse_time",
    "require_paths",
    "save_model",
    "save_record",
    "write_by_day",
    "write_table",
]
