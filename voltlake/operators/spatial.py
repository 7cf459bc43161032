"""Stations within a category's buffer distance of a POI.

A grid turns the distance join into an equi-join. Cells come in levels, each four times as
wide as the one before. A POI goes to the first level whose cells are at least as wide as its
buffered bounds, where it touches at most 2 x 2 cells; a station goes to its one cell on every
level in use. So a pair can meet in one cell only, and the candidates per POI follow its own size.

Candidates are found by bounds alone, which are a few numbers a POI. They are then held against the
POI's edges in their cell: those near it, and those that decide which side of the border a
spot in it is on. No copy and no salt of a POI carries edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.constants import BUFFER_METRES, DEFAULT_BUFFER_METRES
from voltlake.functions.geo import bounds, covers_point, near_segment, segments, to_utm32
from voltlake.functions.values import buffer_metres
from voltlake.operators.skew import PAIRS_PER_TASK, skew_join
from voltlake.sources.poi import AREA_KINDS

LEVELS = 6
CELL_KEYS = ["level", "cell_x", "cell_y"]
#: Metres that a cell is taken wider, for spots whose division by its width was rounded.
SLACK = 1e-3


def cell_sizes(distances: dict[str, float], default: float) -> list[float]:
    """Cell width per level; the first holds a buffered point."""
    base = 2.0 * max([default, *distances.values()])
    return [base * 4**k for k in range(LEVELS)]


def _size_of(level: Column, sizes: list[float]) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in sizes]), level + 1)


def _cell(value: Column, size: Column) -> Column:
    return F.floor(value / size)


def station_points(stations: DataFrame) -> DataFrame:
    """id_cs and the planar position of stations given in degrees; no position, no row."""
    placed = stations.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())
    planar = placed.select(
        "id_cs", to_utm32(F.col("longitude"), F.col("latitude")).alias("p")
    )
    return planar.select("id_cs", F.col("p.x").alias("sx"), F.col("p.y").alias("sy"))


def station_cells(points: DataFrame, sizes: list[float], levels: Column) -> DataFrame:
    """One row per station and level; ``levels`` is an array."""
    placed = points.withColumn("levels", levels).select(
        *points.columns, F.explode("levels").alias("level")
    )
    size = _size_of(F.col("level"), sizes)
    return placed.withColumns(
        {"cell_x": _cell(F.col("sx"), size), "cell_y": _cell(F.col("sy"), size)}
    )


def shape_cells(
    pois: DataFrame, distances: dict[str, float] = BUFFER_METRES, default: float = DEFAULT_BUFFER_METRES
) -> DataFrame:
    """One row for each POI and cell: its bounds and the edges that matter in that cell.

    ``edges`` are near it, ``sides`` lie to the right of some spots in it and not of others, and ``odd`` tells if
    those that every spot in it has to its right are odd in number. Written out, the table serves any number of matches, each of which reads the
    columns it needs.
    """
    sizes = cell_sizes(distances, default)
    shaped = pois.select(
        "id_poi",
        buffer_metres(F.col("poi_cat"), distances, default).alias("radius"),
        F.col("geom_type").isin(AREA_KINDS).alias("is_area"),
        # The geometry, which may be an expression itself, is evaluated once.
        F.inline(F.transform(F.array("geometry"), lambda g: F.struct(bounds(g).alias("box"), segments(g).alias("all_edges")))),
    )
    grown = shaped.select(
        "id_poi", "radius", "is_area", "all_edges", (F.size("all_edges") == 0).alias("is_point"),
        (F.col("box.x0") - F.col("radius")).alias("x0"),
        (F.col("box.y0") - F.col("radius")).alias("y0"),
        (F.col("box.x1") + F.col("radius")).alias("x1"),
        (F.col("box.y1") + F.col("radius")).alias("y1"),
    )
    extent = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    level = F.lit(len(sizes) - 1)
    for k in range(len(sizes) - 2, -1, -1):
        level = F.when(extent <= F.lit(sizes[k]), F.lit(k)).otherwise(level)
    size = _size_of(F.col("level"), sizes)

    def cells(low: str, high: str) -> Column:
        return F.explode(F.sequence(_cell(F.col(low), size), _cell(F.col(high), size)))

    placed = (
        grown.withColumn("level", level)
        .withColumn("cell_x", cells("x0", "x1"))
        .withColumn("cell_y", cells("y0", "y1"))
    )
    west, south = F.col("cell_x") * size - SLACK, F.col("cell_y") * size - SLACK
    east, north = west + size + 2 * SLACK, south + size + 2 * SLACK
    near, beside, beyond = _edge_tests(west, south, east, north, F.col("radius"))
    is_area = F.col("is_area")
    return placed.select(
        *[c for c in placed.columns if c != "all_edges"],
        F.filter("all_edges", near).alias("edges"),
        F.filter("all_edges", lambda e: is_area & beside(e)).alias("sides"),
        (F.size(F.filter("all_edges", beyond)) % 2 == 1).alias("odd"),
    )


def _edge_tests(west: Column, south: Column, east: Column, north: Column, radius: Column):
    """Of an edge and a cell: can a spot in the cell be within the radius of it; can it lie to the right
    of some spots and not of others; does it lie to the right of all of them?"""

    def low(e: Column, axis: str) -> Column:
        return F.least(e[f"a{axis}"], e[f"b{axis}"])

    def high(e: Column, axis: str) -> Column:
        return F.greatest(e[f"a{axis}"], e[f"b{axis}"])

    def near(e: Column) -> Column:
        across = (low(e, "x") <= east + radius) & (high(e, "x") >= west - radius)
        return across & (low(e, "y") <= north + radius) & (high(e, "y") >= south - radius)

    def beyond(e: Column) -> Column:
        return (low(e, "x") >= east) & (low(e, "y") <= south) & (high(e, "y") >= north)

    def beside(e: Column) -> Column:
        met = (high(e, "x") >= west) & (high(e, "y") > south) & (low(e, "y") < north)
        return met & ~beyond(e)

    return near, beside, beyond


def write_shapes(
    pois: DataFrame, path: str, distances: dict[str, float] = BUFFER_METRES, default: float = DEFAULT_BUFFER_METRES
) -> DataFrame:
    """``shape_cells`` kept as a table, which the geometries are read for once."""
    shapes = shape_cells(pois, distances, default)
    shapes.write.parquet(path)
    return pois.sparkSession.read.schema(shapes.schema).parquet(path)


def _in_reach() -> Column:
    """Is a station in a POI's grown bounds? For a point that and its distance is the exact test."""
    x, y, r = F.col("sx"), F.col("sy"), F.col("radius")
    in_box = x.between(F.col("x0"), F.col("x1")) & y.between(F.col("y0"), F.col("y1"))
    # A point's bounds are its position grown by the radius.
    dx = x - (F.col("x0") + F.col("x1")) / F.lit(2.0)
    dy = y - (F.col("y0") + F.col("y1")) / F.lit(2.0)
    # As a CASE the optimizer derives no "x0 is not null" from it, which it would push below
    # the projection and so compute every POI's bounds twice.
    return F.when(in_box, ~F.col("is_point") | (dx * dx + dy * dy <= r * r)).otherwise(F.lit(False))


def _within_buffer() -> Column:
    """Exact test of a candidate against the edges of its cell: distance, then containment."""
    x, y, edges = F.col("sx"), F.col("sy"), F.col("edges")
    inside = covers_point(F.col("sides"), x, y) != F.col("odd")
    return F.col("is_point") | near_segment(edges, x, y, F.col("radius")) | (F.col("is_area") & inside)


def match_pois(
    pois: DataFrame,
    stations: DataFrame,
    distances: dict[str, float] = BUFFER_METRES,
    default: float = DEFAULT_BUFFER_METRES,
    *,
    columns: list[str] | None = ["id_poi", "id_cs"],
    pairs_per_task: int = PAIRS_PER_TASK,
    shapes: DataFrame | None = None,
) -> DataFrame:
    """Pairs id_poi, id_cs, or the wanted ``columns`` of both sides; None gives all of them.

    ``pois``: id_poi, poi_cat, geom_type, geometry in metres. ``stations``: id_cs, longitude,
    latitude in degrees. A POI listed for two cities gives its pairs once. ``shapes`` is what
    ``write_shapes`` has kept of the same POIs and distances; without it all is one plan.
    """
    sizes = cell_sizes(distances, default)
    shapes = shape_cells(pois, distances, default) if shapes is None else shapes
    cells = shapes.drop("edges", "sides", "odd", "is_area")
    # Stations are copied only to levels that hold a POI; a subquery of at most LEVELS numbers.
    levels = cells.agg(F.collect_set("level")).scalar()
    found = skew_join(
        station_cells(station_points(stations), sizes, levels),
        cells,
        CELL_KEYS,
        _in_reach(),
        left_id="id_cs",
        right_id="id_poi",
        pairs_per_task=pairs_per_task,
    )
    # One row for each POI and cell on the right side, so a POI with many candidates is theirs alone to
    # be split.
    own = shapes.select("id_poi", *CELL_KEYS, "is_area", "edges", "sides", "odd")
    tested = (
        found.select("id_poi", "id_cs", "sx", "sy", "radius", "is_point", *CELL_KEYS)
        .join(own, ["id_poi", *CELL_KEYS])
        .where(_within_buffer())
    )
    pairs = tested.select("id_poi", "id_cs").dropDuplicates(["id_poi", "id_cs"])
    if columns is not None and set(columns) <= {"id_poi", "id_cs"}:
        return pairs.select(*columns)
    # A POI listed for two cities keeps one of its rows.
    described = pois.dropDuplicates(["id_poi"])
    clashing = [c for c in stations.columns if c in described.columns and c != "id_cs"]
    named = stations.withColumnsRenamed({c: f"{c}_cs" for c in clashing})
    full = pairs.join(described, "id_poi").join(named, "id_cs")
    return full if columns is None else full.select(*columns)
