"""Source-zone wall clocks to UTC and back, independent of the session zone.

``timestamp_ntz`` values are wall clocks, so ``convert_timezone`` applies.
``timestamp`` values carry the source wall clock as a UTC instant (what a JDBC
read in a UTC JVM yields), so ``to_utc_timestamp`` shifts them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_DAY = 86_400_000_000


def wall_to_utc(value: Column, dtype: T.DataType, zone: str) -> Column:
    """UTC timestamp of a source-local DATE or TIMESTAMP; other types unchanged."""
    if isinstance(dtype, T.DateType):
        value = value.cast("timestamp_ntz")
    elif isinstance(dtype, T.TimestampType):
        return F.to_utc_timestamp(value, zone)
    elif not isinstance(dtype, T.TimestampNTZType):
        return value
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), value)


def local_date(value: Column, dtype: T.DataType, zone: str) -> Column:
    """Source-local calendar date of a UTC timestamp; other types unchanged."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), value))
    if isinstance(dtype, T.TimestampType):
        micros = F.unix_micros(F.from_utc_timestamp(value, zone))
        whole_days = micros - F.pmod(micros, F.lit(MICROS_PER_DAY))
        return F.date_from_unix_date((whole_days / MICROS_PER_DAY).cast("int"))
    return value


def day_start(day: date, dtype: T.DataType, zone: str | None = None) -> Column:
    """Midnight of ``day`` as a literal comparable with a column of ``dtype``.

    With ``zone`` the column holds UTC timestamps and midnight is that zone's.
    Types without a time meaning get ISO text, which Spark coerces.
    """
    if isinstance(dtype, T.DateType):
        return F.lit(day)
    if isinstance(dtype, T.TimestampNTZType):
        midnight = F.lit(f"{day} 00:00:00").cast("timestamp_ntz")
    elif isinstance(dtype, T.TimestampType):
        midnight = F.lit(f"{day} 00:00:00Z").cast("timestamp")
    else:
        return F.lit(f"{day}T00:00:00.000")
    return wall_to_utc(midnight, dtype, zone) if zone else midnight
