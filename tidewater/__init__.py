"""tidewater: keyed stream/batch operators as Spark DataFrame plans.

Subpackages: ``sources`` (tables, lines, records, generators), ``functions``
(column functions), ``operators`` (row ops, routing, keyed aggregates,
windows, joins, keyed state, top-N, late rows, side outputs), ``streaming``
(Structured Streaming forms), ``sinks`` and ``plans`` (the registered
queries and their SQL oracle).

Functions and classes of this package that run in Python workers are shipped
with the tasks (pickled by value), so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

cloudpickle.register_pickle_by_value(sys.modules[__name__])
