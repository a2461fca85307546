"""Sinks: rolling text files with exactly-once commits."""

from .files import rolling_text_sink

__all__ = ["rolling_text_sink"]
