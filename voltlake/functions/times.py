"""Times whose text, day and parts do not depend on the session's time zone.

An instant is a ``timestamp``. Its UTC wall time is a ``timestamp_ntz``, whose parts and text are
the same in every session.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A time of day followed by an offset or a zone's name.
ZONED = r"\d:\d{2}.*(Z|UTC|GMT|[+-]\d{1,2}(:?\d{2})?|[A-Za-z]+/[A-Za-z_/]+)\s*$"


#: Microseconds of a day.
DAY_MICROS = 86_400_000_000


def utc_wall(time: Column) -> Column:
    """UTC wall time of an instant, by whole microseconds."""
    micro = F.expr("INTERVAL '0 00:00:00.000001' DAY TO SECOND")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.unix_micros(time) * micro


def utc_day(time: Column) -> Column:
    micros = F.unix_micros(time)
    # The difference is a multiple of the divisor, so the quotient is exact.
    return F.date_from_unix_date(((micros - F.pmod(micros, F.lit(DAY_MICROS))) / F.lit(DAY_MICROS)).cast("int"))


def utc_text(time: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSSSSS`` in UTC."""
    return wall_text(utc_wall(time))


def wall_text(wall: Column) -> Column:
    """The same of a wall time; casting to text drops trailing zeros of the fraction."""
    text = wall.cast("string")
    return F.concat(F.substring(text, 1, 19), F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0"))


def utc_instant(wall: Column) -> Column:
    """The instant of a UTC wall time, by whole microseconds."""
    minutes = F.unix_date(wall.cast("date")).cast("long") * 1440 + F.hour(wall) * 60 + F.minute(wall)
    seconds = F.extract(F.lit("SECOND"), wall)  # with six digits of the fraction
    return F.timestamp_micros(minutes * 60_000_000 + (seconds * 1_000_000).cast("long"))


def utc_time(text: Column) -> Column:
    """Text to an instant; text without a zone is UTC, text that is no time gives null."""
    wall = F.trim(text).try_cast("timestamp_ntz")
    plain = F.concat(wall.cast("string"), F.lit("Z")).try_cast("timestamp")  # parses the text once in a lambda, too
    return F.when(text.rlike(ZONED), F.trim(text).try_cast("timestamp")).otherwise(plain)
