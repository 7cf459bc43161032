"""Fixed values. They must equal the published ones for results to agree."""

# Buffer distance in metres per POI category, and the one for all others.
BUFFER_METRES = {
    "supermarket": 40.0,
    "fast_food": 30.0,
    "highway_services": 30.0,
    "fuel": 30.0,
    "mall": 40.0,
    "doityourself": 40.0,
}
DEFAULT_BUFFER_METRES = 30.0

# Wanted tag values per tag column.
POI_TAGS = {
    "amenity": ["supermarket", "fast_food", "highway_services", "fuel"],
    "shop": ["mall", "doityourself"],
}

# City names that differ on the POI side.
CITY_POI_NAMES = {
    "koeln": "köln",
    "muenster": "Münster",
    "tuebingen": "Tübingen",
    "buehl": "Bühl",
    "goettingen": "Göttingen",
}

# Status text -> number; any other status has no number.
STATUS_NUMBERS = {"AVAILABLE": 0.0, "RESERVED": 0.5, "CHARGING": 1.0, "OUTOFORDER": -1.0}

# What a key gets when a record lacks it, the snapshot name, the archive name.
MISSING = "-"
SNAPSHOT_NAME = r"((\d{8}_\d{6})_cp_data_cities)"
ARCHIVE_PREFIX = "archive_cp_data_cities_"
