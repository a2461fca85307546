"""Structured Streaming forms: stateful processors, stream operators, runners."""

from . import late, ops, processors, run, split

__all__ = ["late", "ops", "processors", "run", "split"]
