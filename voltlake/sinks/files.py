"""Writers: delimited files and the archive of raw snapshots."""

from __future__ import annotations

import datetime
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.constants import ARCHIVE_PREFIX, SNAPSHOT_NAME
from voltlake.functions.times import utc_day
from voltlake.runtime import list_paths
from voltlake.sources.delimited import escape_text
from voltlake.sources.snapshots import (
    list_snapshots,
    newest_path,
    scan_snapshots,
    snapshot_time,
)


def write_table(
    df: DataFrame, path: str, output_format: str = "csv", sep: str = ";", escaped: bool = False
) -> None:
    """Quoted delimited files with a header, or Parquet; any other format is rejected.

    With ``escaped`` texts hold no line break, so that a line is a row and many tasks share a file;
    ``read_delimited(escaped=True)`` gives the texts back.
    """
    if output_format == "csv":
        rows = escape_text(df) if escaped else df
        rows.write.mode("overwrite").options(
            sep=sep, header=True, quote='"', escape='"',
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
            timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSSXXX",
        ).csv(path)
    elif output_format == "parquet":
        df.write.mode("overwrite").parquet(path)
    else:
        raise NotImplementedError(f"output format {output_format!r}")


def archive_snapshots(
    spark: SparkSession,
    source: str,
    folder: str,
    pattern: str = "*.json",
    *,
    name: str | None = None,
    recursive: bool = False,
) -> str:
    """Raw snapshot files into a compacted table, partitioned by day; returns its path.

    Without a name the table is named after the newest snapshot and written whole. An archive that
    exists under the given name gains the days it lacks, and the last day it has is written anew,
    since it may have been cut short. Files that came late for days before it are added to what
    these days hold; other files are not opened. Names tell the days and what is archived,
    and the scan's own partitions, which pack many files, are written as they are: no text is
    shuffled.
    """
    newest = re.search(f".*{SNAPSHOT_NAME}", newest_path(spark, source, pattern, recursive))
    if newest is None:
        raise ValueError(f"the newest file below {source} carries no snapshot time")
    path = f"{folder}/{name or ARCHIVE_PREFIX + newest[2]}"
    day = utc_day(snapshot_time(F.col("path")))
    files = scan_snapshots(spark, source, pattern, recursive)
    last = _last_day(spark, path) if name else None
    if last is None:
        _write_days(files, path, "overwrite")
        return path
    listed = list_snapshots(spark, source, pattern, recursive)
    earlier = listed.where(day < F.lit(last))
    archived = read_archive(spark, path).where(F.col("snapshot_date") < F.lit(last)).select(F.col("path").alias("file"))
    late = earlier.join(archived, "file", "left_anti")
    newer = listed.where((day >= F.lit(last)) | day.isNull())
    for some, mode in ((late, "append"), (newer, "overwrite")):
        wanted = [r["path"] for r in some.collect()]  # names of new files, as for a directory listing
        if wanted:
            _write_days(scan_snapshots(spark, wanted, pattern), path, mode)
    return path


def _write_days(files: DataFrame, path: str, mode: str) -> None:
    """Files into an archive; ``overwrite`` replaces the days it has files of."""
    (
        files.withColumn("snapshot_date", utc_day(snapshot_time(F.col("path"))))
        .write.mode(mode)
        .option("compression", "zstd")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(path)
    )


def _last_day(spark: SparkSession, path: str) -> datetime.date | None:
    """Last day of an archive; None if there is no archive. Told by the folders' names; no file is opened."""
    found = list_paths(spark, f"{path}/snapshot_date=*")
    days = [d for p in found if (d := p.rsplit("=", 1)[1]) != "__HIVE_DEFAULT_PARTITION__"]
    return datetime.date.fromisoformat(max(days)) if days else None


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Archived snapshots: path, content, snapshot_date."""
    return spark.read.parquet(path)
