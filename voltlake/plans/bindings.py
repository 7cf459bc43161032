"""Domain rows derived from the given tables by plain projections and joins.

The given tables are TPC-H-like, so customers stand for charging points, suppliers for
stations, orders for connectors, events for status rows and parts for POIs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, cached_property
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.constants import CITY_POI_NAMES
from voltlake.functions.geo import xy
from voltlake.functions.times import utc_instant, wall_text
from voltlake.operators.poi import prepare_pois
from voltlake.operators.spatial import match_pois, write_shapes
from voltlake.plans.warehouse import (
    MAIN_SPECS,
    STAGING_SPECS,
    LazyTables,
    Tables,
    build_tables,
    load_warehouse,
)
from voltlake.runtime import scratch_path
from voltlake.sources.snapshots import scan_snapshots

# City codes of the fixture: those with another name on the POI side, and invented ones.
CITIES = [*CITY_POI_NAMES, *(f"stadt{n}" for n in range(1, 34))]

EVENTS_PER_SNAPSHOT = 1000
SNAPSHOTS_PER_FILE = 16
#: Snapshots whose texts one task puts together; they are some 32 MB.
SNAPSHOTS_PER_TASK = 32
SNAPSHOT_PATTERN = "*.txt"

STATUS_OF_EVENT = {
    "view": "AVAILABLE",
    "click": "RESERVED",
    "purchase": "CHARGING",
    "error": "OUTOFORDER",
    "signup": "UNKNOWN",
}


class Inputs:
    """The given tables and the domain tables derived from them. Plans made once are kept;
    no data is."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}
        self._folders: dict[str, str] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    # ---- small pieces ----------------------------------------------------------------

    def _n_suppliers(self) -> Column:
        return self.table("supplier").agg(F.count(F.lit(1))).scalar()

    def _spread(self, df: DataFrame) -> DataFrame:
        """Rows of a table that has fewer files than there are cores, dealt over all of them."""
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

    @staticmethod
    def _status(event_type: Column) -> Column:
        pairs = [F.lit(x) for pair in STATUS_OF_EVENT.items() for x in pair]
        return F.try_element_at(F.create_map(*pairs), event_type)

    @staticmethod
    def _longitude(key: Column) -> Column:
        return F.lit(6.0) + (key * 104729 % 1000003) * F.lit(9e-6)

    @staticmethod
    def _latitude(key: Column) -> Column:
        return F.lit(47.3) + (key * 7919 % 1000003) * F.lit(7.5e-6)

    # ---- flat domain tables ----------------------------------------------------------

    def raw_status_cp(self) -> DataFrame:
        e = self.table("events")
        return e.select(
            self._status(F.col("event_type")).alias("status_cp"),
            F.concat(F.lit("CP"), F.col("user_id")).alias("id_cp"),
            F.get_json_object("props", "$.k").alias("parkingsensor_status"),
            utc_instant(F.col("ts")).alias("ts"),
        )

    def raw_status_connectors(self) -> DataFrame:
        e = self.table("events")
        return e.select(
            self._status(F.col("event_type")).alias("status_connector"),
            F.concat(F.lit("C"), "user_id", F.lit("-"), F.col("event_id") % 2).alias(
                "id_connector"
            ),
            utc_instant(F.col("ts")).alias("ts"),
        )

    def _suppliers(self) -> DataFrame:
        return self.table("supplier").join(
            self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        )

    def raw_charging_stations(self) -> DataFrame:
        return self._suppliers().select(*self._station_columns(F.col))

    def _station_columns(self, given: Callable[[str], Column]) -> list[Column]:
        """A station's scalars from what is given of its supplier."""
        key = given("s_suppkey")
        postal = (F.lit(10000) + key * 37 % 90000).cast("string")
        return [
            key.cast("int").alias("id"),
            given("s_name").alias("name"),
            F.concat(F.lit("Street "), key).alias("address"),
            given("n_name").alias("city"),
            F.when(key % 2 == 0, F.concat(F.lit(" "), postal, F.lit(" ")))
            .otherwise(postal)
            .alias("postal_code"),
            F.lit("DE").alias("country"),
            given("s_acctbal").alias("distance_in_m"),
            F.when(key % 3 == 0, F.lit("")).otherwise(F.lit("Owner")).alias("owner"),
            (key % 2 == 0).alias("roaming"),
            self._latitude(key).alias("latitude"),
            self._longitude(key).alias("longitude"),
            F.concat(F.lit("Operator "), key % 7).alias("operator_name"),
            F.when(key % 2 == 0, F.lit("0800")).otherwise(F.lit("-")).alias("operator_hotline"),
            ((key % 4 == 0) | (key % 8 == 1)).alias("open_24_7"),
        ]

    def raw_charging_points(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            (key % self._n_suppliers()).cast("int").alias("id_cs"),
            F.lit("-").alias("charging_station_position"),
            (key % 2 == 0).alias("roaming"),
            F.concat(F.lit("ref "), key % 5).alias("physical_reference"),
            F.when(key % 4 == 0, F.lit("")).otherwise((key % 4).cast("string")).alias(
                "cp_parking_space_numbers"
            ),
            F.when(key % 2 == 0, F.lit("left")).otherwise(F.lit("right")).alias("cp_position"),
            F.lit("-").alias("cp_public_comment"),
            F.concat(F.lit("CP"), key).alias("id"),
            F.col("c_mktsegment").alias("vehicle_type"),
            (key % 3).cast("string").alias("floor_level"),
            key.cast("int").alias("uid"),
        )

    def raw_connectors(self) -> DataFrame:
        side = F.col("o_orderkey") % 2
        first = F.col("first_order")
        grouped = self.table("orders").groupBy("o_custkey", side.alias("side")).agg(
            F.min("o_orderkey").alias("first_order")
        )
        return grouped.select(
            F.concat(F.lit("CP"), "o_custkey").alias("id_cp"),
            F.when(F.col("side") == 0, F.lit("SOCKET")).otherwise(F.lit("CABLE")).alias("format"),
            F.when(first % 3 == 0, F.lit("DC")).otherwise(F.lit("AC_3_PHASE")).alias(
                "power_type"
            ),
            F.concat(F.lit("C"), "o_custkey", F.lit("-"), F.col("side")).alias("id"),
            (first % 9).cast("string").alias("tariff_id"),
            (first % 64).cast("int").alias("ampere"),
            (first % 395 + 3).cast("int").alias("max_power"),
            F.lit(230).alias("voltage"),
            F.lit("IEC_62196_T2").alias("standard"),
        )

    # ---- POIs ------------------------------------------------------------------------

    @cached_property
    def poi_features(self) -> DataFrame:
        """OSM-like features in degrees around the stations' positions."""
        p = F.col("p_partkey")
        parts = self._spread(self.table("part").select("p_partkey", "p_size"))
        base = parts.select("p_partkey", "p_size", (p % self._n_suppliers()).alias("near"))
        lon = self._longitude(F.col("near")) + (p * 29 % 37 - 18) * F.lit(4e-5)
        lat = self._latitude(F.col("near")) + (p * 13 % 41 - 20) * F.lit(3e-5)
        kind = p % 3
        names = F.array(F.lit("point"), F.lit("polygon"), F.lit("multipolygon"))
        elements = F.array(F.lit("node"), F.lit("way"), F.lit("relation"))
        size = F.col("p_size")
        shaped = base.select(
            "p_partkey", "near",
            names[kind.cast("int")].alias("geom_type"),
            elements[kind.cast("int")].alias("element_type"),
            p.alias("osmid"),
            F.when(size % 7 == 0, F.lit("supermarket"))
            .when(size % 7 == 1, F.lit("fuel"))
            .when(size % 7 == 2, F.lit("bench"))
            .alias("amenity"),
            F.when(size % 5 == 0, F.lit("mall")).when(size % 5 == 1, F.lit("bakery")).alias(
                "shop"
            ),
            lon.alias("lon"), lat.alias("lat"),
            ((p % 5 + 1) * F.lit(1e-4)).alias("a"),
            ((p % 4 + 1) * F.lit(1e-4)).alias("b"),
        )
        return shaped.withColumn("geometry", self._shape()).drop("a", "b")

    @staticmethod
    def _box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
        return F.array(xy(x0, y0), xy(x1, y0), xy(x1, y1), xy(x0, y1), xy(x0, y0))

    def _shape(self) -> Column:
        """Point; box with an off-centre hole; two boxes, the second one wider."""
        lon, lat, a, b = (F.col(c) for c in ("lon", "lat", "a", "b"))
        outer = self._box(lon - a, lat - b, lon + a, lat + b)
        hole = self._box(lon - a / 2, lat - b / 2, lon + a / 4, lat + b / 4)
        second = self._box(lon + a * 2, lat - b, lon + a * 5, lat + b / 2)
        return (
            F.when(F.col("geom_type") == "point", F.array(F.array(F.array(xy(lon, lat)))))
            .when(F.col("geom_type") == "polygon", F.array(F.array(outer, hole)))
            .otherwise(F.array(F.array(outer), F.array(second)))
        )

    @cached_property
    def planar_pois(self) -> DataFrame:
        """id_poi, poi_cat, geom_type and geometry in metres, plus the position in degrees."""
        return prepare_pois(self.poi_features)

    # ---- raw snapshots ---------------------------------------------------------------

    def snapshot_documents(self, listing: Column | None = None) -> DataFrame:
        """Snapshot texts as the poll would have written them: path, content.

        A snapshot covers a block of event ids. The id is a key, so a document holds a fixed
        number of events however the users or stations are skewed. ``listing`` splits a
        station into several listings in its city. Events are dealt by snapshot with what is known of
        their stations, and only then become text: no text is shuffled, and as many tasks
        as the events ask for keep each task's texts in memory.
        """
        key = F.col("user_id")
        event = F.col("event_id")
        status = self._status(F.col("event_type"))
        json_null = F.parse_json(F.lit("null"))
        # A variant field tells a key holding null (variant null) from an absent key (SQL null).
        sensor = F.when(F.col("event_type") == "error", json_null).when(
            F.col("event_type") != "signup", json_text(F.col("k"))
        )

        def connector(side: int, state: Column) -> Column:
            return F.struct(
                F.concat(F.lit("C"), key, F.lit(f"-{side}")).alias("id"),
                state.alias("status"),
                F.when(F.lit(side) == 0, F.lit("SOCKET")).otherwise(F.lit("CABLE")).alias(
                    "format"
                ),
                F.when(event % 3 != 0, (event % 64).cast("int")).alias("ampere"),
                (key % 395 + 3).cast("int").alias("max_power"),
                F.lit(230).alias("voltage"),
            )

        one = F.array(connector(0, status))
        two = F.array(connector(0, status), connector(1, F.lit("AVAILABLE")))
        point = F.struct(
            F.concat(F.lit("CP"), key).alias("id"),
            event.alias("uid"),
            status.alias("status"),
            sensor.alias("parkingsensor_status"),
            (event % 2 == 0).alias("roaming"),
            F.when(event % 2 == 0, F.lit("curb; north")).alias("charging_station_position"),
            F.when(key % 2 == 0, F.lit("left")).otherwise(F.lit("right")).alias("cp_position"),
            F.when(key % 3 == 0, json_null)
            .otherwise(json_text((key % 3).cast("string")))
            .alias("floor_level"),
            F.array(F.lit("RFID")).alias("capabilities"),
            F.when(event % 5 == 0, F.lit(None)).when(key % 2 == 0, two).otherwise(one).alias(
                "connectors"
            ),
        )
        events = self.table("events").select(
            F.floor(event / EVENTS_PER_SNAPSHOT).alias("snapshot_no"),
            (key % self._n_suppliers()).cast("int").alias("id_cs"),
            (F.lit(0) if listing is None else listing).alias("listing"),
            "ts", "event_id", "user_id", "event_type", F.get_json_object("props", "$.k").alias("k"),
        )
        dealt = events.join(self._station_facts(), "id_cs").repartition(self._text_tasks(), "snapshot_no")
        points = dealt.withColumn("point", F.struct(event.alias("n"), F.to_json(point).alias("json")))
        stations = points.groupBy("snapshot_no", "id_cs", "listing").agg(
            F.min("ts").alias("ts"), F.sort_array(F.collect_list("point")).alias("points"),
            F.first("facts").alias("facts"),
        )
        described = stations.select("*", F.explode("facts").alias("fact")).select(
            "snapshot_no", "id_cs", "listing", "ts", "points",
            *self._station_columns(lambda name: F.col("fact")[name]),
        ).withColumn("head", self._station_json())
        text = F.concat(
            F.regexp_replace("head", r"\}$", ""), F.lit(',"evses":['),
            F.array_join(F.transform("points", lambda p: p["json"]), ","), F.lit("]}"),
        )
        cities = described.groupBy("snapshot_no", "city").agg(
            F.min("ts").alias("ts"),
            F.sort_array(
                F.collect_list(F.struct("listing", "id_cs", text.alias("json")))
            ).alias("stations"),
        )
        city = F.concat(
            F.lit('"'), "city", F.lit('":{"timestamp":"'),
            wall_text(F.col("ts")), F.lit('","data":['),
            F.array_join(F.transform("stations", lambda s: s["json"]), ","), F.lit("]}"),
        )
        documents = cities.groupBy("snapshot_no").agg(
            F.sort_array(F.collect_list(F.struct("city", city.alias("json")))).alias("cities")
        )
        polled = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(
            mins=(F.col("snapshot_no") * 10).cast("int")
        )
        return documents.select(
            F.concat(
                F.translate(F.substring(polled.cast("string"), 1, 19), " -:", "_"),
                F.lit("_cp_data_cities"),
            ).alias("path"),
            F.concat(
                F.lit("{"), F.array_join(F.transform("cities", lambda c: c["json"]), ","),
                F.lit("}"),
            ).alias("content"),
        )

    def _text_tasks(self) -> int:
        """Tasks that put the snapshots' texts together: at least one a core."""
        n_events = self.table("events").count()
        return max(self.spark.sparkContext.defaultParallelism, -(-n_events // (EVENTS_PER_SNAPSHOT * SNAPSHOTS_PER_TASK)))

    def _station_facts(self) -> DataFrame:
        """For each station id, what its text is made of: one entry for each supplier with that id."""
        fact = F.struct("s_suppkey", "s_name", "s_acctbal", "n_name")
        return self._suppliers().groupBy(F.col("s_suppkey").cast("int").alias("id_cs")).agg(
            F.collect_list(fact).alias("facts")
        )

    @staticmethod
    def _station_json() -> Column:
        """The scalars of a station as JSON text."""
        key = F.col("id")
        # Any text but the empty one is true, zero and an absent key are false.
        always = (
            F.when(key % 8 == 1, F.parse_json(F.lit('"false"')))
            .when(key % 8 == 3, F.parse_json(F.lit("0")))
            .when(key % 8 != 5, F.parse_json(F.col("open_24_7").cast("string")))
        )
        head = F.struct(
            "id", "name", "address", "city", "postal_code", "country", "distance_in_m",
            F.when(key % 3 == 0, F.parse_json(F.lit("null")))
            .when(key % 3 == 1, F.parse_json(F.lit('"Owner"')))
            .alias("owner"),
            "roaming",
            F.struct("latitude", "longitude").alias("coordinates"),
            F.struct(
                F.col("operator_name").alias("name"),
                F.when(key % 2 == 0, F.lit("0800")).alias("hotline"),
            ).alias("operator"),
            F.struct(
                always.alias("twentyfourseven"),
                F.array().cast("array<string>").alias("regular_hours"),
            ).alias("opening_times"),
            F.lit('left; then "right"').alias("directions"),
        )
        return F.to_json(head)

    def snapshot_folder(self) -> str:
        """Folder with one file per snapshot, as the poll leaves them."""
        return self._written("files", self._write_files)

    def _write_files(self, path: str) -> None:
        documents = self.snapshot_documents().withColumnRenamed("path", "snapshot")
        documents.write.partitionBy("snapshot").text(path)

    def files(self) -> DataFrame:
        """The snapshot files, scanned."""
        return scan_snapshots(self.spark, self.snapshot_folder(), SNAPSHOT_PATTERN, recursive=True)

    def documents(self, split_listing: bool = False) -> DataFrame:
        """The same snapshots from a compacted table, many per file."""
        listing = F.col("event_id") % 2 if split_listing else None

        def write(path: str) -> None:
            self.snapshot_documents(listing).write.option(
                "maxRecordsPerFile", SNAPSHOTS_PER_FILE
            ).parquet(path)

        return self.spark.read.parquet(self._written(f"documents-{split_listing}", write))

    def _written(self, name: str, write: Callable[[str], None]) -> str:
        """Path of derived files, written once per session."""
        if name not in self._folders:
            path = scratch_path(self.spark, name)
            write(path)
            self._folders[name] = path
        return self._folders[name]

    # ---- star schema -----------------------------------------------------------------

    def warehouse_sources(self) -> LazyTables:
        one_at_a_time = Lock()

        @cache
        def prepared() -> DataFrame:
            wanted = self.planar_pois.where(F.col("poi_cat").isNotNull())
            path = scratch_path(self.spark, "pois")
            wanted.write.parquet(path)
            return self.spark.read.schema(wanted.schema).parquet(path)

        def pois() -> DataFrame:
            # Prepared once, as the job does for its POI files; the match and each load read them.
            with one_at_a_time:  # tables are loaded side by side
                return prepared()

        def mapping() -> DataFrame:
            stations = self.raw_charging_stations().withColumnRenamed("id", "id_cs")
            shapes = write_shapes(pois(), scratch_path(self.spark, "shapes"))
            pairs = match_pois(pois(), stations, shapes=shapes)
            # Matched once, as the job does for its mapping file; each load checks and then loads the pairs.
            path = scratch_path(self.spark, "pairs")
            pairs.write.parquet(path)
            return self.spark.read.schema(pairs.schema).parquet(path)

        return LazyTables(
            {
                "raw_staging_connectors": self.raw_connectors,
                "raw_staging_charging_points": self.raw_charging_points,
                "raw_staging_charging_stations": self.raw_charging_stations,
                "raw_staging_status_cp": self.raw_status_cp,
                "raw_staging_status_connectors": self.raw_status_connectors,
                "staging_poi": pois,
                "staging_mapping_poi_cs": mapping,
            }
        )

    @cached_property
    def warehouse(self) -> str:
        """Database holding the loaded star schema."""
        location = scratch_path(self.spark, "warehouse")
        database = "voltlake_" + location.rsplit("-", 1)[1]
        load_warehouse(
            self.spark, database, self.warehouse_sources(), STAGING_SPECS + MAIN_SPECS, location
        )
        return database

    @cached_property
    def star_schema(self) -> Tables:
        """All staging and main tables as lazy plans."""
        return build_tables(self.warehouse_sources(), STAGING_SPECS + MAIN_SPECS)


@cache
def inputs_of(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(spark, sf_dir)


def json_text(text: Column) -> Column:
    """Plain text without quotes or control characters as a variant."""
    return F.parse_json(F.concat(F.lit('"'), text, F.lit('"')))


def city_code(nation_key: Column) -> Column:
    """One of the fixed cities for each nation."""
    return F.element_at(
        F.array(*[F.lit(c) for c in CITIES]), (nation_key % len(CITIES) + 1).cast("int")
    )


