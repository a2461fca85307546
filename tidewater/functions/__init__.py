"""Column functions: record parsing, word splitting, tags, ordering, event time."""

from . import core, time

__all__ = ["core", "time"]
