"""Nested snapshots to rows.

Two forms of the same work. The document form keeps one row per file until the last step:
repeated parents are resolved inside the row, so flattening needs no shuffle. The table form
works on any DataFrame with a parent id and a column of child records.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.constants import MISSING
from voltlake.functions.nested import (
    RECORD,
    computed_once,
    field,
    fields,
    is_last_of_key,
    let,
    record_type,
    text_of,
)
from voltlake.functions.times import utc_time
from voltlake.sources.snapshots import read_document


def station_rows(documents: DataFrame, station_type: str = RECORD) -> DataFrame:
    """One row per station over all cities: path, city_key, timestamp, station. A city without a
    valid time has no rows; ``quarantine_parts`` lists it."""
    doc = read_document(F.col("content"), station_type)
    cities = documents.select("path", F.explode(doc).alias("city_key", "city_value"))
    time, stations = utc_time(F.col("city_value.timestamp")), F.col("city_value.data")
    return cities.select(
        "path",
        "city_key",
        time.alias("timestamp"),
        F.explode(F.when(time.isNotNull(), stations)).alias("station"),
    ).where(F.col("station").isNotNull())


def station_rows_ts(documents: DataFrame, point_type: str = RECORD) -> DataFrame:
    """One row per station with its city's own time: path, id, timestamp, evses."""
    return documents.select("path", F.inline(_listed_stations(point_type)))


def station_columns(
    documents: DataFrame, columns: list[str] | None = ["id", "timestamp", "evses"]
) -> DataFrame:
    """One row per station with path and the wanted ``columns``; None gives all keys that occur,
    found by one more pass, and the timestamp. An absent key is null."""
    rows = station_rows(documents)
    if columns is None:
        columns = [*(k for k in discover_keys(rows, "station") if k != "timestamp"), "timestamp"]
    keyed = {c: field(F.col("station"), c).alias(c) for c in columns if c != "timestamp"}
    return rows.select("path", *[keyed.get(c, F.col(c)) for c in columns])


# The steps below are one expression over one document: nothing is written between them, and
# no filter looks for unreadable documents, since it would parse each text a second time and
# such documents leave no rows anyway.


def _listed_stations(point_type: str) -> Column:
    """Stations of a document in file order: array of struct<id, timestamp, evses>."""
    station = f"struct<id:string,evses:array<{point_type}>>"

    def of_city(entry: Column) -> Column:
        return let(utc_time(entry["value"]["timestamp"]), lambda time: timed(entry, time))

    def timed(entry: Column, time: Column) -> Column:
        stations = F.filter(entry["value"]["data"], lambda s: s.isNotNull())
        return F.transform(
            F.coalesce(F.when(time.isNotNull(), stations), F.array().cast(f"array<{station}>")),
            lambda s: F.struct(
                s["id"].alias("id"), time.alias("timestamp"), s["evses"].alias("evses")
            ),
        )

    doc = read_document(F.col("content"), station)
    return F.flatten(F.transform(F.map_entries(doc), of_city))


def _keep_last(items: Column) -> Column:
    """Of array elements with equal ``id``, the last one. Arrays without repeats pass as they
    are after one hash-set look."""

    def filtered(array: Column, ids: Column) -> Column:
        zipped = F.arrays_zip(array.alias("item"), is_last_of_key(ids).alias("last"))
        return F.transform(F.filter(zipped, lambda z: z["last"]), lambda z: z["item"])

    def resolved(array: Column) -> Column:
        return let(
            F.transform(array, lambda x: x["id"]),
            lambda ids: F.when(F.size(F.array_distinct(ids)) == F.size(ids), array).otherwise(
                filtered(array, ids)
            ),
        )

    return let(items, resolved)


def _with_last_flag(items: Column) -> Column:
    """Array of struct<item, last>: is the element the last one with its ``id``?"""

    def flags(ids: Column) -> Column:
        plain = F.size(F.array_distinct(ids)) == F.size(ids)
        return F.when(plain, F.transform(ids, lambda _: F.lit(True))).otherwise(
            is_last_of_key(ids)
        )

    def zipped(array: Column) -> Column:
        last = let(F.transform(array, lambda x: x["id"]), flags)
        return F.arrays_zip(array.alias("item"), last.alias("last"))

    return let(items, zipped)


def _listed_points(point_type: str) -> Column:
    """Points of a document: array of struct<id, id_cs, timestamp, point>.

    Children hang on the last listing of a repeated station; a parent without children
    leaves nothing behind.
    """

    def of_station(station: Column) -> Column:
        return F.transform(
            F.filter(station["evses"], lambda p: p.isNotNull()),
            lambda p: F.struct(
                text_of(p["id"], MISSING).alias("id"),
                station["id"].alias("id_cs"),
                station["timestamp"].alias("timestamp"),
                p.alias("point"),
            ),
        )

    lists = F.transform(_keep_last(_listed_stations(point_type)), of_station)
    return F.flatten(F.filter(lists, lambda points: points.isNotNull()))


def _with_id(keys: list[str]) -> list[str]:
    return list(dict.fromkeys(["id", *keys]))


def point_rows(documents: DataFrame, keys: list[str]) -> DataFrame:
    """One row per charging point: path, id, id_cs, timestamp, point (a struct of variants with
    ``keys``)."""
    return documents.select("path", F.inline(_listed_points(record_type(_with_id(keys)))))


def connector_rows(documents: DataFrame, keys: list[str]) -> DataFrame:
    """One row per connector: path, id_cp, timestamp, connector (a struct of variants with
    ``keys``). Connectors hang on the last listing of a repeated point."""
    connectors = f"array<{record_type(_with_id(keys))}>"
    listed = _listed_points(record_type(["id"], connectors=connectors))
    points = documents.select("path", F.inline(_keep_last(listed)))
    return points.select(
        "path",
        F.col("id").alias("id_cp"),
        "timestamp",
        F.explode(computed_once(F.col("point.connectors"))).alias("connector"),
    ).where(F.col("connector").isNotNull())


def point_rows_with_connectors(
    documents: DataFrame, keys: list[str], connector_keys: list[str]
) -> DataFrame:
    """Points and their connectors from one parse: path, id, timestamp, point (a struct of
    variants with ``keys`` and the array ``connectors``), is_last (the point's last listing)."""
    connectors = f"array<{record_type(_with_id(connector_keys))}>"
    listed = _listed_points(record_type(_with_id(keys), connectors=connectors))
    rows = documents.select("path", F.inline(_with_last_flag(listed)))
    return rows.select(
        "path", "item.id", "item.timestamp", "item.point", F.col("last").alias("is_last")
    )


def keep_last_parent(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Table form of "the last duplicate wins": one row per key, the one with the largest
    ``order``. The aggregate is reduced before the shuffle, so a key that fills a third of the
    table still sends one row per task."""
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("last"))
    return last.select(*keys, "last.*")


def explode_children(
    df: DataFrame, *, index_col: str, index_new: str, col_records: str, carry: list[str] = ()
) -> DataFrame:
    """One row per child record under the parent id: index_new, *carry, record. Parents
    without children vanish. Columns in ``carry`` (the parent's time, say) ride along, which
    replaces a join back on the parent id."""
    return df.select(
        F.col(index_col).alias(index_new), *carry, F.explode(col_records).alias("record")
    ).where(F.col("record").isNotNull())


def discover_keys(df: DataFrame, record: str) -> list[str]:
    """All keys seen in a record column, sorted. Only key names reach the driver."""
    keys = df.select(F.explode(F.map_keys(record)).alias("key")).distinct().orderBy("key")
    return [row["key"] for row in keys.collect()]


#: Type of records with unknown keys whose values keep their kind.
VARIANTS = "map<string,variant>"


def discover_schema(df: DataFrame, records: str) -> DataFrame:
    """key, type and n_records of every key in a column of arrays of ``VARIANTS`` records.

    The type holds all values that the key has; ``n_records`` tells how many records have the key, also
    with a null. Types are merged where the records are and once more for each key.
    """
    each = df.select(F.explode(computed_once(F.col(records))).alias("record"))
    keyed = each.select(F.explode(computed_once(F.col("record"))).alias("key", "value"))
    return keyed.groupBy("key").agg(
        F.schema_of_variant_agg("value").alias("type"), F.count(F.lit(1)).alias("n_records")
    )


def spread_records(
    df: DataFrame,
    record: str,
    *,
    keys: list[str] | None = None,
    fill: str | None | Mapping[str, str | None] = MISSING,
    drop_record: bool = True,
    drop_status: bool = True,
    columns: list[str] | None = None,
) -> DataFrame:
    """Each key of a record column becomes a column.

    ``keys`` declares them; without it they are discovered with one more pass. ``fill`` is one
    default for absent keys or one per key. ``columns`` projects the result.
    """
    names = discover_keys(df, record) if keys is None else list(keys)
    spread = fields(F.col(record), names, fill)
    kept = [c for c in df.columns if not (drop_record and c == record)]
    result = df.select(*kept, *spread)
    if drop_status and "status" in names:
        result = result.drop("status")
    return result if columns is None else result.select(*columns)
