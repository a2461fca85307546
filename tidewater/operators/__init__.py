"""DataFrame -> DataFrame operators (batch forms)."""

from . import (accumulate, aggregates, joins, late, partition, rowops, scan, split, state,
               topn, windows)

__all__ = ["accumulate", "aggregates", "joins", "late", "partition", "rowops", "scan", "split",
           "state", "topn", "windows"]
