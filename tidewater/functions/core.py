"""Column-level functions: record parsing, word splitting, tags, ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .time import epoch_micros

# The labels the two-input co-map puts in front of each value.
NUMBER_STREAM_TAG = "来源于数字流:"
LETTER_STREAM_TAG = "来源于字母流:"

# The sensor record layout "id,ts,vc" (comma separated).
SENSOR_SEPARATOR = ","
SENSOR_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("vc", T.IntegerType()),
])


def _c(expr: Column | str) -> Column:
    return F.col(expr) if isinstance(expr, str) else expr


# Fixed value: the accepted number syntax (optional sign, decimal digits,
# no surrounding spaces), as the record function's integer parse accepts.
INTEGER_PATTERN = r"^[+-]?[0-9]+$"


def parse_integer(text: Column, dtype: str, permissive: bool) -> Column:
    """Parse a whole-number field. Only ``[+-]digits`` is accepted (a plain
    cast would also take surrounding spaces). Strict mode fails the query on
    anything else or on overflow; permissive mode gives null."""
    well_formed = text.rlike(INTEGER_PATTERN)
    if permissive:
        return F.when(well_formed, text.try_cast(dtype))
    return F.when(text.isNull(), F.lit(None).cast(dtype)).when(
        well_formed, text.cast(dtype)).otherwise(
        F.raise_error(F.concat(F.lit("not a number: "), text)).cast(dtype))


def parse_sensor(line: Column | str, permissive: bool = False) -> Column:
    """``"id,ts,vc"`` -> struct(id string, ts bigint, vc int).

    Strict mode fails the query on a bad number or a missing field (as an
    exception in the record function would). In permissive mode bad fields
    become null; see :func:`is_bad_sensor`. Fields after the third are
    ignored.
    """
    parts = F.split(_c(line), SENSOR_SEPARATOR)
    if permissive:
        ts_text = F.try_element_at(parts, F.lit(2))
        vc_text = F.try_element_at(parts, F.lit(3))
    else:
        ts_text = F.element_at(parts, 2)
        vc_text = F.element_at(parts, 3)
    ts = parse_integer(ts_text, "bigint", permissive)
    vc = parse_integer(vc_text, "int", permissive)
    return F.struct(F.element_at(parts, 1).alias("id"), ts.alias("ts"), vc.alias("vc"))


def is_bad_sensor(parsed: Column | str) -> Column:
    p = _c(parsed)
    return p.isNull() | p.getField("ts").isNull() | p.getField("vc").isNull()


def split_pair(line: Column | str, sep: str = " ") -> Column:
    """``"k v"`` -> struct(k, v) on a single separator (first two fields)."""
    parts = F.split(_c(line), sep)
    return F.struct(F.element_at(parts, 1).alias("k"), F.element_at(parts, 2).alias("v"))


def split_words(text: Column | str, sep: str = " ") -> Column:
    """Split on one separator character with the record-function semantics
    of the reference: trailing empty tokens are dropped, leading and inner
    ones are kept, ``""`` gives one empty token and an all-separator string
    gives none."""
    t = _c(text)
    stripped = F.rtrim(t, F.lit(sep)) if sep != " " else F.rtrim(t)
    return (F.when(t == F.lit(""), F.array(F.lit("")))
            .when(stripped == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, _regex_literal(sep))))


def _regex_literal(sep: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch for ch in sep)


def tag(value: Column | str, label: str) -> Column:
    return F.concat(F.lit(label), _c(value).cast("string"))


def descending(df: DataFrame, col: str) -> Column:
    """A value that sorts in reverse order of ``col``, for any orderable scalar."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return -epoch_micros(df, col)
    if isinstance(dtype, T.IntegralType):
        return F.bitwise_not(col)                   # no overflow at the least value
    if isinstance(dtype, T.BooleanType):
        return ~F.col(col)
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        # byte by byte in reverse, and a text that goes on before its prefix
        raw = F.hex(F.col(col).cast("binary"))
        digits = F.transform(F.split(raw, "(?!$)"), lambda c: -F.conv(c, 16, 10).cast("int"))
        return F.when(F.col(col).isNotNull(), F.when(raw == "", F.array(F.lit(1)))
                      .otherwise(F.concat(digits, F.array(F.lit(1)))))
    return -F.col(col)


def order_struct(df: DataFrame, cols: Sequence[str], reverse: bool = False) -> Column:
    """Struct of the order columns; ``reverse`` flips every component."""
    if not reverse:
        return F.struct(*[F.col(c) for c in cols])
    return F.struct(*[descending(df, c).alias(c) for c in cols])
