"""Side outputs: split one input into named, disjoint outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUTE = "_tw_route"


def route_column(branches: dict[str, Column], main: str = "main") -> Column:
    """Name of the first branch whose predicate is true; a null predicate
    counts as false, so rows with null fields go to ``main``."""
    expr = F.lit(main)
    for name, pred in reversed(list(branches.items())):
        expr = F.when(F.coalesce(pred, F.lit(False)), F.lit(name)).otherwise(expr)
    return expr


def split_by(df: DataFrame, branches: dict[str, Column], main: str = "main") -> dict[str, DataFrame]:
    """``{name: rows}`` for each branch plus ``main`` (rows no branch took).

    The outputs are disjoint and together hold every input row. Each output
    is a filter over the input; persist the input first if it is expensive
    and all outputs are written.
    """
    routed = df.withColumn(ROUTE, route_column(branches, main))
    names = [*branches, main]
    return {name: routed.filter(F.col(ROUTE) == F.lit(name)).drop(ROUTE) for name in names}
