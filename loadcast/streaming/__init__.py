"""Scoring new rows as they arrive, against a frozen threshold."""

from .scoring import score_stream

__all__ = ["score_stream"]
