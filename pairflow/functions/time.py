"""Time expressions that never depend on the session time zone.

Event time is kept as TIMESTAMP_NTZ holding the UTC wall clock. Spark's
``date_trunc`` returns TIMESTAMP and goes through the session zone (a row in
a DST gap moves by an hour), so flooring is done with interval arithmetic,
which stays NTZ.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_minute(c) -> Column:
    """Floor an NTZ timestamp to its minute; NULL stays NULL."""
    x = col_of(c)
    return x - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                  F.extract(F.lit("SECOND"), x))


def epoch_ms_to_ts(c) -> Column:
    """Epoch milliseconds (number or numeric text) to NTZ (UTC wall clock)."""
    ms = col_of(c).try_cast("bigint")
    return F.timestamp_add("MILLISECOND", ms, F.expr(EPOCH_NTZ))


def parse_ts(c, fmt: str | None = None) -> Column:
    """Text to NTZ UTC wall clock; bad text gives NULL (ANSI-safe).

    Without ``fmt`` ISO-8601 is accepted with or without a zone suffix;
    ``Z`` and ``UTC`` mean UTC, an offset (``+HH:MM``, ``+HHMM``, ``+HH``) is
    folded into the wall clock, and any other zone name gives NULL rather
    than a wrong time. With ``fmt`` the text is parsed by that pattern,
    zone-free.
    """
    s = F.trim(col_of(c).cast("string"))
    if fmt:
        return F.try_to_timestamp(s, F.lit(fmt)).cast("timestamp_ntz")
    # date or date and time, then the zone: nothing, Z, UTC or an offset
    iso = (r"^(\d{4}-\d{1,2}-\d{1,2}(?:[T ]\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d+)?)?)?)"
           r" ?(?:Z|UTC|([+-])(\d{2})(?::?(\d{2}))?)?$")
    wall = F.regexp_extract(s, iso, 1).try_cast("timestamp_ntz")  # no match: NULL
    sign, hh, mm = (F.regexp_extract(s, iso, i) for i in (2, 3, 4))
    offset_min = (F.coalesce(hh.try_cast("int"), F.lit(0)) * 60
                  + F.coalesce(mm.try_cast("int"), F.lit(0))) * F.when(sign == "-", -1).otherwise(1)
    return F.timestamp_add("MINUTE", -offset_min, wall)


def minutes_between(later, earlier) -> Column:
    """Whole minutes from ``earlier`` to ``later`` (both NTZ), zone-free."""
    diff = col_of(later) - col_of(earlier)
    return (F.extract(F.lit("DAY"), diff).cast("bigint") * 1440
            + F.extract(F.lit("HOUR"), diff).cast("bigint") * 60
            + F.extract(F.lit("MINUTE"), diff).cast("bigint"))


def ts_to_epoch_ms(c) -> Column:
    """NTZ (UTC wall clock) to epoch milliseconds, zone-free."""
    diff = col_of(c) - F.expr(EPOCH_NTZ)
    return (F.extract(F.lit("DAY"), diff).cast("bigint") * 86_400_000
            + F.extract(F.lit("HOUR"), diff).cast("bigint") * 3_600_000
            + F.extract(F.lit("MINUTE"), diff).cast("bigint") * 60_000
            + (F.extract(F.lit("SECOND"), diff) * 1000).cast("bigint"))


def ts_to_epoch_us(c) -> Column:
    """NTZ (UTC wall clock) to epoch microseconds, zone-free."""
    diff = col_of(c) - F.expr(EPOCH_NTZ)
    return (F.extract(F.lit("DAY"), diff).cast("bigint") * 86_400_000_000
            + F.extract(F.lit("HOUR"), diff).cast("bigint") * 3_600_000_000
            + F.extract(F.lit("MINUTE"), diff).cast("bigint") * 60_000_000
            + (F.extract(F.lit("SECOND"), diff) * 1_000_000).cast("bigint"))


def iso_text(c, suffix: str = "Z") -> Column:
    """NTZ as ISO-8601 text ``YYYY-MM-DDTHH:MM:SS[.ffffff]<suffix>``."""
    return F.concat(F.regexp_replace(col_of(c).cast("string"), " ", "T"), F.lit(suffix))
