"""Event time as epoch microseconds, independent of the session time zone.

``timestamp`` values are instants; ``timestamp_ntz`` values are wall-clock
readings, taken here as UTC (as the test tables and the SQL oracle do).
Casting NTZ to an instant goes through the session zone, which is exact only
when that zone is UTC; otherwise the instant is rebuilt from the wall-clock
fields in UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "Zulu", "UCT"}


def session_is_utc(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.session.timeZone", "UTC") in UTC_NAMES


def epoch_micros(df: DataFrame, col: str | Column, dtype: T.DataType | None = None) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    if dtype is None and isinstance(col, str):
        dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        if session_is_utc(df):
            return F.unix_micros(c.cast("timestamp"))
        secs = F.date_part(F.lit("SECOND"), c)
        inst = F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c),
                                F.minute(c), secs, F.lit("UTC"))
        return F.unix_micros(inst)
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("bigint") * F.lit(86_400_000_000)
    return F.unix_micros(c.cast("timestamp"))


def from_epoch_micros(df: DataFrame, us: Column, dtype: T.DataType) -> Column:
    """Inverse of :func:`epoch_micros` for a result column of type ``dtype``."""
    inst = F.timestamp_micros(us)
    if not isinstance(dtype, T.TimestampNTZType):
        return inst
    if session_is_utc(df):
        return inst.cast("timestamp_ntz")
    tz = df.sparkSession.conf.get("spark.sql.session.timeZone")
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), inst.cast("timestamp_ntz"))


def event_time_from(col: str | Column, unit: str = "seconds") -> Column:
    """Timestamp assigner: an epoch number in ``unit`` (seconds, millis,
    micros) as an event-time ``timestamp``."""
    c = F.col(col) if isinstance(col, str) else col
    if unit == "seconds":
        return F.timestamp_seconds(c)
    if unit == "millis":
        return F.timestamp_millis(c)
    if unit == "micros":
        return F.timestamp_micros(c)
    raise ValueError("unit must be seconds, millis or micros")
