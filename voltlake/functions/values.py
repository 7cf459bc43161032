"""Scalar expressions of the star schema and the utilization view."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltlake.constants import (
    CITY_POI_NAMES,
    BUFFER_METRES,
    DEFAULT_BUFFER_METRES,
    STATUS_NUMBERS,
)
from voltlake.functions.times import utc_text, utc_wall


def lookup(key: Column, values: dict, default: Column | None = None) -> Column:
    """Value of a small fixed mapping, ``default`` (or null) for anything else."""
    literal = F.create_map(*[F.lit(v) for v in chain.from_iterable(values.items())])
    found = F.try_element_at(literal, key)
    return found if default is None else F.coalesce(found, default)


def status_key(entity: Column, time: Column) -> Column:
    """Key of a status row: hash of the entity id and the query time as UTC text."""
    return F.md5(F.concat(entity, utc_text(time)).cast("binary"))


def status_number(status: Column) -> Column:
    return lookup(status, STATUS_NUMBERS)


def buffer_metres(
    category: Column,
    distances: dict[str, float] = BUFFER_METRES,
    default: float = DEFAULT_BUFFER_METRES,
) -> Column:
    metres = {name: float(m) for name, m in distances.items()}
    return lookup(category, metres, F.lit(float(default)))


def poi_city_name(city: Column, names: dict[str, str] = CITY_POI_NAMES) -> Column:
    return lookup(city, names, city)


def two_digit_share(part: Column, whole: Column) -> Column:
    """part / whole rounded to two digits, halves to even."""
    return F.rint(part / whole * F.lit(100.0)) / F.lit(100.0)


def calendar_fields(time: Column) -> list[Column]:
    """hour, day, ISO week, month, year and weekday (0 = Sunday), in UTC."""
    time = utc_wall(time)
    return [
        F.hour(time).alias("hour"),
        F.dayofmonth(time).alias("day"),
        F.weekofyear(time).alias("week"),
        F.month(time).alias("month"),
        F.year(time).alias("year"),
        (F.dayofweek(time) - F.lit(1)).alias("weekday"),
    ]
