"""Time rules: everything is TIMESTAMP_NTZ or DATE; never depend on the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from floe.functions.grid import col


def quarter_start(c) -> Column:
    """First day of the quarter as a DATE (zone-free)."""
    x = col(c)
    return F.make_date(F.year(x), F.quarter(x) * 3 - 2, F.lit(1))


def days_to_timestamp(days, epoch: str) -> Column:
    """fractional days since ``epoch`` -> TIMESTAMP_NTZ, microsecond exact."""
    secs = (col(days) * F.lit(86400.0)).cast("decimal(18,6)")
    return F.expr(f"timestamp_ntz'{epoch} 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), secs)


def nanos_to_timestamp(nanos) -> Column:
    """BIGINT nanoseconds since 1970 -> TIMESTAMP_NTZ (floor to microseconds).

    Exact: the division is done in decimal (a BIGINT near 1.5e18 is not exactly
    representable as a double).
    """
    micros = F.floor(col(nanos).cast("decimal(38,0)") / F.lit(1000)).cast("decimal(24,0)")
    secs = (micros / F.lit(1000000)).cast("decimal(24,6)")
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), secs)


def fmt_month(c) -> Column:
    """'yyyy-MM'."""
    return F.date_format(col(c), "yyyy-MM")


def fmt_day(c) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd")
