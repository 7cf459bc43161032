"""Column lists and types of the staging tables, the star schema and the snapshot records.

The names and types are fixed values: they must equal the published ones.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "geometry": T.ArrayType(
        T.ArrayType(
            T.ArrayType(
                T.StructType(
                    [T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]
                )
            )
        )
    ),
}


def table(*columns: str) -> T.StructType:
    """``table("id string!", "n int")``; ``!`` marks NOT NULL."""
    fields = []
    for column in columns:
        name, kind = column.rstrip("!").split(" ")
        fields.append(T.StructField(name, _TYPES[kind], nullable=not column.endswith("!")))
    return T.StructType(fields)


GEOMETRY = _TYPES["geometry"]

STAGING = {
    "staging_connectors": table(
        "id_cp string!", "format string", "power_type string", "id string", "tariff_id string",
        "ampere int", "max_power int", "voltage int", "standard string",
    ),
    "staging_charging_points": table(
        "id_cs int!", "charging_station_position string", "roaming boolean",
        "physical_reference string", "cp_parking_space_numbers string", "cp_position string",
        "cp_public_comment string", "id string", "vehicle_type string", "floor_level string",
        "uid int!",
    ),
    "staging_charging_stations": table(
        "id int", "name string", "address string", "city string", "postal_code string",
        "country string", "distance_in_m double", "owner string", "roaming boolean",
        "latitude double", "longitude double", "operator_name string",
        "operator_hotline string", "open_24_7 boolean",
    ),
    "staging_status_cp": table(
        "status_cp string!", "id_cp string!", "parkingsensor_status string", "ts timestamp!",
    ),
    "staging_status_connectors": table(
        "status_connector string!", "id_connector string!", "ts timestamp!",
    ),
}

MAIN = {
    "status_chargingpoints": table(
        "id_status_cp string!", "id_chargingpoint string!", "query_time timestamp!",
        "status_cp string", "status_parkingsensor string",
    ),
    "status_connectors": table(
        "id_status_connector string!", "id_connector string!", "query_time timestamp!",
        "status_connector string",
    ),
    "charging_station": table(
        "id_cs int", "name string", "address string", "city string", "postal_code string",
        "country string", "owner string", "roaming boolean", "latitude double",
        "longitude double", "operator_name string", "operator_hotline string",
        "open_24_7 boolean",
    ),
    "charging_point": table(
        "id_cp string!", "id_cs int!", "charging_station_position string", "roaming boolean",
        "physical_reference string", "cp_parking_space_numbers string", "cp_position string",
        "vehicle_type string", "floor_level string",
    ),
    "connector": table(
        "id_connector string!", "id_cp string!", "format string", "power_type string",
        "ampere int", "max_power int", "voltage int", "standard string",
    ),
    "time": table(
        "query_time timestamp!", "hour int", "day int", "week int", "month int", "year int",
        "weekday int",
    ),
    "mapping_poi_cs": table("id_poi string!", "id_cs int!"),
    "poi": table(
        "geom geometry", "longitude double!", "latitude double!", "id_poi string!",
        "poi_category string!",
    ),
}

PRIMARY_KEYS = {
    "status_chargingpoints": ["id_status_cp"],
    "status_connectors": ["id_status_connector"],
    "charging_station": ["id_cs"],
    "charging_point": ["id_cp"],
    "connector": ["id_connector"],
    "time": ["query_time"],
    "poi": ["id_poi"],
}

# (child table, child column, parent table, parent column)
REFERENCES = [
    ("status_chargingpoints", "id_chargingpoint", "charging_point", "id_cp"),
    ("status_chargingpoints", "query_time", "time", "query_time"),
    ("status_connectors", "id_connector", "connector", "id_connector"),
    ("status_connectors", "query_time", "time", "query_time"),
    ("charging_point", "id_cs", "charging_station", "id_cs"),
    ("connector", "id_cp", "charging_point", "id_cp"),
    ("mapping_poi_cs", "id_poi", "poi", "id_poi"),
    ("mapping_poi_cs", "id_cs", "charging_station", "id_cs"),
]

# Scalar keys read from the records of a snapshot.
STATION_KEYS = [
    "id", "name", "address", "city", "postal_code", "country", "distance_in_m", "owner",
    "roaming",
]
STATION_NESTED_KEYS = ["directions", "evses"]
POINT_KEYS = [
    "id", "uid", "charging_station_position", "roaming", "physical_reference",
    "cp_parking_space_numbers", "cp_position", "cp_public_comment", "vehicle_type",
    "floor_level",
]
POINT_NESTED_KEYS = ["capabilities", "connectors"]
CONNECTOR_KEYS = [
    "id", "format", "power_type", "tariff_id", "ampere", "max_power", "voltage", "standard",
]
