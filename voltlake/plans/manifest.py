"""What a database publishes: one manifest names the parts of all its tables.

A part is a written table that never changes. A load writes its parts first and then one manifest, which is
one file that appears as a whole. Whoever opens the manifest reads the same load of every table,
and a load that fails or dies leaves the manifest before it in force. With the parts it
names how far each intake folder has been consumed, so the facts and that mark move together.

Manifests are numbered. The last ``KEPT`` stay, so that readers under way find their parts; parts
that only older ones name are dropped.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.runtime import drop_scratch, list_paths

KEPT = 2
SCHEMA = "kind string, name string, position int, value string"
PART = re.compile(r"(?P<table>.+)__\d{20}_[0-9a-f]{6}")


@dataclass
class Manifest:
    number: int = 0
    # Parts of each table, in the order they were written.
    parts: dict[str, list[str]] = field(default_factory=dict)
    # Last consumed batch of each intake folder.
    marks: dict[str, int] = field(default_factory=dict)

    def rows(self) -> list[tuple[str, str, int, str]]:
        parts = [("part", t, i, p) for t, listed in self.parts.items() for i, p in enumerate(listed)]
        return parts + [("mark", folder, 0, str(batch)) for folder, batch in self.marks.items()]

    def successor(self, parts: dict[str, list[str]], marks: dict[str, int]) -> Manifest:
        """The next manifest: tables and marks that aren't named stay as they are."""
        return Manifest(self.number + 1, self.parts | parts, self.marks | marks)


def quoted(*names: str) -> str:
    """A name of several parts, whatever characters they have."""
    return ".".join(f"`{n.replace('`', '``')}`" for n in names)


def folder_of(spark: SparkSession, database: str) -> str:
    return spark.catalog.getDatabase(quoted(database)).locationUri.rstrip("/") + "/manifest"


def numbers(spark: SparkSession, database: str) -> list[int]:
    """Numbers of the complete manifests; one that is being written has no file yet."""
    found = list_paths(spark, f"{folder_of(spark, database)}/load=*/part-*.parquet")
    return sorted({int(re.search(r"/load=(\d+)/", path)[1]) for path in found})


def read_manifest(spark: SparkSession, database: str, number: int | None = None) -> Manifest:
    """The manifest in force, or the one of a number; an empty one before the first load."""
    if number is None:
        number = max(numbers(spark, database), default=0)
    if not number:
        return Manifest()
    found = spark.read.schema(SCHEMA).parquet(f"{folder_of(spark, database)}/load={number:020d}")
    parts: dict[str, list[str]] = {}
    marks: dict[str, int] = {}
    for row in sorted(found.collect(), key=lambda r: (r["name"], r["position"])):  # a row for each part
        if row["kind"] == "part":
            parts.setdefault(row["name"], []).append(row["value"])
        else:
            marks[row["name"]] = int(row["value"])
    return Manifest(number, parts, marks)


def publish(spark: SparkSession, database: str, manifest: Manifest) -> None:
    """Puts the manifest in force and drops what only expired ones name.

    Of two loads that started from the same manifest the second one fails here, and its parts are
    never named.
    """
    path = f"{folder_of(spark, database)}/load={manifest.number:020d}"
    rows = spark.createDataFrame(manifest.rows(), SCHEMA)
    rows.coalesce(1).write.mode("error").parquet(path)
    listed = numbers(spark, database)
    named = {p for n in listed[-KEPT:] for parts in read_manifest(spark, database, n).parts.values() for p in parts}
    for number in listed[:-KEPT]:
        for parts in read_manifest(spark, database, number).parts.values():
            for part in set(parts) - named:
                spark.sql(f"DROP TABLE IF EXISTS {quoted(database, part)}")
        drop_scratch(spark, f"{folder_of(spark, database)}/load={number:020d}")


def vacuum(spark: SparkSession, database: str) -> list[str]:
    """Drops the parts that no kept manifest names, such as those of loads that died.

    Not to be run beside a load, whose parts are not named yet.
    """
    listed = numbers(spark, database)
    named = {p for n in listed for parts in read_manifest(spark, database, n).parts.values() for p in parts}
    tables = {p["table"] for p in map(PART.fullmatch, named) if p}
    found = [t.name for t in spark.catalog.listTables(quoted(database)) if t.tableType != "VIEW"]
    lost = [n for n in found if n not in named and (m := PART.fullmatch(n)) and m["table"] in tables]
    for name in lost:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(database, name)}")
    return lost


def read_parts(spark: SparkSession, database: str, parts: list[str]) -> DataFrame:
    """The rows of all parts, with the columns of the newest; a part lacking one has null there."""
    frames = [spark.table(quoted(database, part)) for part in parts]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out.select(*[F.col(quoted(c)) for c in frames[-1].columns])
