"""Raw snapshot files: one JSON object ``city -> {timestamp, data: [station]}`` per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.constants import SNAPSHOT_NAME
from voltlake.functions.nested import let
from voltlake.functions.times import utc_time


def document_type(station: str) -> str:
    """Type of a snapshot whose stations have the given type."""
    return f"map<string,struct<timestamp:string,data:array<{station}>>>"


def snapshot_name(path: Column) -> Column:
    return F.regexp_extract(path, SNAPSHOT_NAME, 1)


def snapshot_time(path: Column) -> Column:
    """Poll time (UTC) from the file name; null where the name has none."""
    polled = F.regexp_extract(path, SNAPSHOT_NAME, 2)
    pattern = r"(\d{4})(\d{2})(\d{2})_(\d{2})(\d{2})(\d{2})"
    return utc_time(F.regexp_replace(polled, pattern, "$1-$2-$3 $4:$5:$6"))


def name_order(path: Column) -> Column:
    """What files are ordered by: the snapshot's name, or else the file's; then the path."""
    snapshot = F.regexp_extract(path, f"(?s).*{SNAPSHOT_NAME}", 1)
    own = F.substring_index(path, "/", -1)
    name = F.when(snapshot == "", own).otherwise(snapshot)
    return F.struct(name.alias("name"), path.alias("path"))


def _options(pattern: str, recursive: bool) -> dict[str, str]:
    return {"pathGlobFilter": pattern, "recursiveFileLookup": str(recursive).lower()}


def scan_snapshots(
    spark: SparkSession, path: str | list[str], pattern: str = "*.json", recursive: bool = False
) -> DataFrame:
    """One row per file: path, content. Files of subfolders only if ``recursive``."""
    return (
        spark.read.format("text")
        .options(wholetext="true", **_options(pattern, recursive))
        .load(path)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))
    )


def stream_snapshots(
    spark: SparkSession,
    path: str,
    pattern: str = "*.json",
    files_per_trigger: int = 1000,
    recursive: bool = False,
) -> DataFrame:
    """The same rows as a stream of new files."""
    return (
        spark.readStream.format("text")
        .options(wholetext="true", **_options(pattern, recursive))
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))
    )


def list_snapshots(
    spark: SparkSession, path: str, pattern: str = "*.json", recursive: bool = False
) -> DataFrame:
    """The files' paths, without opening them: path, and file as ``scan_snapshots`` writes it."""
    return (
        spark.read.format("binaryFile")
        .options(**_options(pattern, recursive))
        .load(path)
        .select("path", F.col("_metadata.file_path").alias("file"))
    )


def newest_path(
    spark: SparkSession, path: str, pattern: str = "*.json", recursive: bool = False
) -> str:
    """Last file by name, whatever its folder."""
    files = list_snapshots(spark, path, pattern, recursive)
    newest = files.agg(F.max_by("path", name_order(F.col("path")))).first()[0]
    if newest is None:
        raise FileNotFoundError(f"no {pattern} below {path}")
    return newest


def latest_snapshot(
    spark: SparkSession, path: str, pattern: str = "*.json", recursive: bool = False
) -> DataFrame:
    """Only the last file by name; the scan opens no other."""
    return scan_snapshots(spark, newest_path(spark, path, pattern, recursive), pattern)


def latest_document(documents: DataFrame) -> DataFrame:
    """The same on rows already read, e.g. from the archive."""
    newest = documents.agg(F.max_by("path", name_order(F.col("path")))).scalar()
    return documents.where(F.col("path") == newest)


def read_document(content: Column, station: str) -> Column:
    """A snapshot's text as ``document_type(station)``, parsed once.

    The typed parser gives up a whole document for one odd city, and a city's stations for one odd
    station. Where that could have happened the text is read again without a type and
    converted part by part, so that only the odd parts are null.
    """
    kind = document_type(station)

    def repaired(doc: Column) -> Column:
        gaps = F.exists(F.map_values(doc), lambda c: c.isNull() | c["data"].isNull())
        whole = F.try_variant_get(F.try_parse_json(content), "$", kind)
        return F.when(F.coalesce(gaps, F.lit(True)), whole).otherwise(doc)

    return let(F.from_json(content, kind), repaired)


def quarantine_parts(documents: DataFrame) -> DataFrame:
    """What the readers leave out: path, city, station (position in the city), reason, content.

    Reasons: ``document`` is no JSON object; ``city`` is none; ``time`` of a city is missing or no
    time, which leaves out the city; ``stations`` of a city are no list; ``station`` is no
    object; ``points`` of a station are no list, which leaves out the points alone.
    """
    part = "struct<city:string,station:int,reason:string,content:string>"

    def of_city(entry: Column) -> Column:
        city = entry["value"]
        stations = F.try_variant_get(city, "$.data", "array<variant>")
        time = utc_time(F.try_variant_get(city, "$.timestamp", "string"))
        reason = (
            F.when(~is_object(city), F.lit("city"))
            .when(time.isNull(), F.lit("time"))
            .when(stations.isNull(), F.lit("stations"))
        )
        whole = F.struct(entry["key"], F.lit(None).cast("int"), reason, city.cast("string")).cast(part)

        def of_station(station: Column, i: Column) -> Column:
            points = F.try_variant_get(station, "$.evses", "variant")
            wrong = ~F.schema_of_variant(points).startswith("ARRAY") & (F.schema_of_variant(points) != "VOID")
            reason = F.when(~is_object(station), F.lit("station")).when(wrong, F.lit("points"))
            text = F.when(reason.isNotNull(), station.cast("string"))  # of odd stations alone
            return F.struct(entry["key"], i.cast("int"), reason, text).cast(part)

        listed = F.filter(F.transform(stations, of_station), lambda p: p["reason"].isNotNull())
        return F.when(reason.isNotNull(), F.array(whole)).otherwise(listed)

    cities = F.try_variant_get(F.try_parse_json("content"), "$", "map<string,variant>")
    whole = F.struct(
        F.lit(None).cast("string"), F.lit(None).cast("int"), F.lit("document"), F.col("content")
    ).cast(part)
    parts = let(
        cities,
        lambda c: F.when(c.isNull(), F.array(whole)).otherwise(
            F.flatten(F.transform(F.map_entries(c), of_city))
        ),
    )
    return documents.select("path", F.inline(parts))


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def split_payloads(documents: DataFrame) -> DataFrame:
    """Adds ``readable``: false for payloads that do not parse. Readers keep the readable rows;
    the others go to a quarantine table instead of stopping the job."""
    return documents.withColumn(
        "readable", F.from_json("content", "map<string,string>").isNotNull()
    )
