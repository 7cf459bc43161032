"""Projection, interior points and the distance match against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from voltlake.constants import BUFFER_METRES
from voltlake.functions import geo
from voltlake.functions.values import buffer_metres, poi_city_name
from voltlake.operators import poi as pois
from voltlake.operators import spatial
from voltlake.operators.skew import key_pieces, skew_join
from voltlake.schemas import table

FEATURES = table("id_poi string", "poi_cat string", "geom_type string", "geometry geometry")
TAGGED = "element_type string, osmid bigint, amenity string, shop string"


def closed(*points):
    return [tuple(map(float, p)) for p in [*points, points[0]]]


def square(x, y, half):
    return closed((x - half, y - half), (x + half, y - half), (x + half, y + half), (x - half, y + half))


def features(spark, rows):
    return spark.createDataFrame(rows, FEATURES)


def inside(rings, x, y):
    crossings = 0
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            if (ay > y) != (by > y) and x < ax + (y - ay) / (by - ay) * (bx - ax):
                crossings += 1
    return crossings % 2 == 1


def distance(rings, x, y):
    best = math.inf
    for ring in rings:
        pairs = list(zip(ring, ring[1:])) or [(ring[0], ring[0])]
        for (ax, ay), (bx, by) in pairs:
            ux, uy = bx - ax, by - ay
            length2 = ux * ux + uy * uy
            t = max(0, min(1, ((x - ax) * ux + (y - ay) * uy) / length2)) if length2 else 0
            best = min(best, math.hypot(ax + t * ux - x, ay + t * uy - y))
    return best


# ---- projection --------------------------------------------------------------------------


def meridian_arc(lat):
    """Distance from the equator by numerical integration (Simpson), GRS80."""
    a, f = 6378137.0, 1 / 298.257222101
    e2 = f * (2 - f)
    n, top = 2000, math.radians(lat)
    g = lambda p: a * (1 - e2) / (1 - e2 * math.sin(p) ** 2) ** 1.5
    h = top / n
    return h / 3 * sum(
        (1 if i in (0, n) else 4 if i % 2 else 2) * g(i * h) for i in range(n + 1)
    )


def project(spark, points):
    df = spark.createDataFrame([tuple(map(float, p)) for p in points], "lon double, lat double")
    out = df.select(geo.to_utm32(F.col("lon"), F.col("lat")).alias("p")).collect()
    return [(r["p"]["x"], r["p"]["y"]) for r in out]


def test_central_meridian_is_the_scaled_arc(spark):
    lats = [0, 10, 47.3, 50, 55, 80]
    for lat, (x, y) in zip(lats, project(spark, [(9, lat) for lat in lats])):
        assert x == pytest.approx(500000, abs=1e-6)
        assert y == pytest.approx(0.9996 * meridian_arc(lat), abs=1e-4)


def test_projection_is_conformal(spark):
    """Small steps north and east map to equal lengths at a right angle, with the known scale."""
    a, f = 6378137.0, 1 / 298.257222101
    e2, d = f * (2 - f), 1e-5
    for lon, lat in [(6, 47.5), (9, 51), (13.4, 52.5), (14.9, 54)]:
        (x0, y0), (x1, y1), (x2, y2) = project(spark, [(lon, lat), (lon + d, lat), (lon, lat + d)])
        s = math.sin(math.radians(lat))
        east = math.radians(d) * a / math.sqrt(1 - e2 * s * s) * math.cos(math.radians(lat))
        north = math.radians(d) * a * (1 - e2) / (1 - e2 * s * s) ** 1.5
        k_east, k_north = math.hypot(x1 - x0, y1 - y0) / east, math.hypot(x2 - x0, y2 - y0) / north
        assert k_east == pytest.approx(k_north, abs=2e-6)
        assert ((x1 - x0) * (x2 - x0) + (y1 - y0) * (y2 - y0)) / (east * north) == pytest.approx(
            0, abs=2e-6
        )


def test_geometry_projection_equals_point_projection(spark):
    ring = closed((7.0, 50.0), (7.1, 50.0), (7.1, 50.1))
    df = features(spark, [("w", None, "polygon", [[ring]])])
    got = df.select(geo.geometry_to_utm32(F.col("geometry")).alias("g")).first()["g"][0][0]
    for vertex, (x, y) in zip(got, project(spark, ring)):
        assert (vertex["x"], vertex["y"]) == pytest.approx((x, y), abs=1e-6)


# ---- representative points ---------------------------------------------------------------


def star(rng, cx, cy, n, low, high):
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return closed(*[
        (cx + r * math.cos(t), cy + r * math.sin(t))
        for t, r in ((t, rng.uniform(low, high)) for t in angles)
    ])


def test_interior_points_lie_inside(spark):
    rng = random.Random(7)
    rows = []
    for i in range(120):
        outer = star(rng, 0, 0, rng.randint(8, 40), 40, 100)
        rings = [outer, square(0, 0, 8)] if i % 2 else [outer]
        rows.append((f"w{i}", None, "polygon", [rings]))
    for i in range(30):
        parts = [[star(rng, 300 * k, 50 * k, 9, 40, 100)] for k in range(3)]
        rows.append((f"m{i}", None, "multipolygon", parts))
    got = pois.with_position(features(spark, rows)).collect()
    shapes = {r[0]: [ring for part in r[3] for ring in part] for r in rows}
    assert all(inside(shapes[r["id_poi"]], r["longitude"], r["latitude"]) for r in got)
    assert len(got) == 150


def test_interior_point_takes_the_widest_span(spark):
    c_shape = closed((0, 0), (10, 0), (10, 2), (2, 2), (2, 8), (10, 8), (10, 10), (0, 10))
    holed = [square(0, 0, 10), closed((-5, -5), (0, -5), (0, 5), (-5, 5))]
    rows = [("c", None, "polygon", [[c_shape]]), ("h", None, "polygon", [holed])]
    got = {r["id_poi"]: r for r in pois.with_position(features(spark, rows)).collect()}
    assert (got["c"]["longitude"], got["c"]["latitude"]) == (1.0, 5.0)
    assert (got["h"]["longitude"], got["h"]["latitude"]) == (5.0, 0.0)


def test_points_and_lines(spark):
    rows = [
        ("p", None, "point", [[[(1.0, 2.0)]]]),
        ("l", None, "linestring", [[[(0.0, 0.0), (4.0, 0.0), (5.0, 0.0), (10.0, 0.0)]]]),
        ("s", None, "linestring", [[[(0.0, 0.0), (4.0, 0.0)]]]),
    ]
    got = {r["id_poi"]: (r["longitude"], r["latitude"])
           for r in pois.with_position(features(spark, rows)).collect()}
    assert got["p"] == (1.0, 2.0)
    assert got["l"] == (5.0, 0.0)
    assert got["s"] in [(0.0, 0.0), (4.0, 0.0)]


# ---- tags --------------------------------------------------------------------------------


def test_category(spark):
    rows = [
        ("node", 1, None, "mall"), ("node", 2, "fuel", "mall"), ("way", 3, "bench", "bakery"),
        ("way", 4, "mall", None), ("way", 5, "bench", "supermarket"), ("way", 6, None, None),
    ]
    df = pois.with_category(pois.with_poi_id(spark.createDataFrame(rows, TAGGED)))
    assert {r["id_poi"]: r["poi_cat"] for r in df.collect()} == {
        "node/1": "mall", "node/2": "fuel", "way/3": None, "way/4": "mall",
        "way/5": "supermarket", "way/6": None,
    }
    wanted = pois.tag_filter(spark.createDataFrame(rows, TAGGED))
    assert sorted(r["osmid"] for r in wanted.collect()) == [1, 2]


def test_source_without_a_tag_column(spark):
    df = spark.createDataFrame([("node", 1, "fuel"), ("node", 2, None)], "element_type string, osmid bigint, amenity string")
    got = pois.with_category(pois.with_poi_id(df)).collect()
    assert {r["osmid"]: r["poi_cat"] for r in got} == {1: "fuel", 2: None}


def test_lookups(spark):
    df = spark.createDataFrame([("mall",), ("fuel",), ("zoo",), (None,)], "c string")
    got = {r["c"]: r["m"] for r in df.select("c", buffer_metres(F.col("c")).alias("m")).collect()}
    assert got == {"mall": 40.0, "fuel": 30.0, "zoo": 30.0, None: 30.0}
    own = {r["c"]: r["m"] for r in df.select(
        "c", buffer_metres(F.col("c"), {"zoo": 99}, 5).alias("m")).collect()}
    assert own == {"mall": 5.0, "fuel": 5.0, "zoo": 99.0, None: 5.0}
    cities = spark.createDataFrame([("koeln",), ("hof",)], "c string")
    assert [r[0] for r in cities.select(poi_city_name(F.col("c"))).collect()] == ["köln", "hof"]


# ---- match -------------------------------------------------------------------------------


def planar_match(spark, monkeypatch, poi_rows, station_rows, **options):
    """Match with station positions given in metres."""
    monkeypatch.setattr(spatial, "to_utm32", lambda lon, lat: geo.xy(lon, lat))
    stations = spark.createDataFrame(
        [(i, float(x), float(y)) for i, x, y in station_rows],
        "id_cs int, longitude double, latitude double",
    )
    got = spatial.match_pois(features(spark, poi_rows), stations, **options).collect()
    return sorted((r["id_poi"], r["id_cs"]) for r in got)


def brute(poi_rows, station_rows, distances=BUFFER_METRES, default=30.0):
    pairs = set()
    for id_poi, cat, kind, geometry in poi_rows:
        rings = [ring for part in geometry for ring in part]
        r = distances.get(cat, default)
        for id_cs, x, y in station_rows:
            area = kind in ("polygon", "multipolygon")
            if distance(rings, x, y) <= r or (area and inside(rings, x, y)):
                pairs.add((id_poi, id_cs))
    return sorted(pairs)


def random_case(seed):
    rng = random.Random(seed)
    spots = [(i, rng.uniform(-3000, 3000), rng.uniform(-3000, 3000)) for i in range(700)]
    rows, cats = [], ["mall", "fuel", None, "zoo"]
    for i in range(150):
        x, y, cat = rng.uniform(-3000, 3000), rng.uniform(-3000, 3000), rng.choice(cats)
        kind = i % 4
        if kind == 0:
            rows.append((f"n{i}", cat, "point", [[[(x, y)]]]))
        elif kind == 1:
            size = rng.choice([20, 150, 900, 2500])
            ring = star(rng, x, y, 12, size / 2, size)
            rows.append((f"w{i}", cat, "polygon", [[ring, square(x, y, size / 5)]]))
        elif kind == 2:
            rows.append((f"r{i}", cat, "multipolygon", [[square(x, y, 40)], [square(x + 300, y, 90)]]))
        else:
            rows.append((f"l{i}", cat, "linestring", [[[(x, y), (x + 200, y + 50), (x + 300, y - 90)]]]))
    return rows, spots


def test_match_equals_brute_force(spark, monkeypatch):
    rows, spots = random_case(3)
    expected = brute(rows, spots)
    assert len(expected) > 300
    assert planar_match(spark, monkeypatch, rows, spots) == expected


def test_match_with_hot_cells_equals_brute_force(spark, monkeypatch):
    """A third of the stations and of the POIs on one spot, cut into many pieces."""
    rows, spots = random_case(5)
    spots += [(1000 + i, 10.0 + i % 3, 10.0) for i in range(350)]
    rows += [(f"h{i}", "mall", "point", [[[(12.0 + i % 60, 9.0)]]]) for i in range(75)]
    got = planar_match(spark, monkeypatch, rows, spots, pairs_per_task=50)
    assert got == brute(rows, spots)


def test_large_pois_carry_the_edges_of_a_cell(spark, monkeypatch, tmp_path):
    """Thousands of vertices on a cell's corner: each cell holds its own edges, and pairs are right on all sides."""
    rng = random.Random(8)
    rows = [
        ("big", "mall", "polygon", [[star(rng, 20_480, 20_480, 10_000, 4_000, 9_000), square(20_480, 20_480, 2_000)]]),
        ("ring", "fuel", "multipolygon", [[star(rng, -700, 300, 400, 500, 520)], [square(500, 300, 60)]]),
        ("path", "zoo", "linestring", [[[(i * 3.0, 90 * math.sin(i / 20)) for i in range(2_000)]]]),
    ]
    spots = [(i, rng.uniform(11_000, 30_000), rng.uniform(11_000, 30_000)) for i in range(500)]
    spots += [(1000 + i, rng.uniform(-1500, 6200), rng.uniform(-400, 1000)) for i in range(400)]
    kept = spatial.write_shapes(features(spark, rows), str(tmp_path / "shapes"))
    carried = kept.where("id_poi = 'big'").agg(F.sum(F.size("edges")), F.sum(F.size("sides")), F.count("*")).first()
    assert carried[2] == 4 and carried[0] < 1.1 * 10_004 and carried[1] < 2.2 * 10_004
    expected = brute(rows, spots)
    assert len(expected) > 200
    assert planar_match(spark, monkeypatch, rows, spots) == expected
    assert planar_match(spark, monkeypatch, rows, spots, shapes=kept) == expected


def test_match_edges(spark, monkeypatch):
    rows = [
        ("edge", "fuel", "point", [[[(0.0, 0.0)]]]),
        ("hole", "fuel", "polygon", [[square(1000, 0, 200), square(1000, 0, 100)]]),
        ("twice", "mall", "point", [[[(5000.0, 0.0)]]]),
        ("twice", "mall", "point", [[[(5000.0, 0.0)]]]),
    ]
    spots = [(1, 30, 0), (2, 30.001, 0), (3, 1000, 0), (4, 1080, 0), (5, 1150, 0), (6, 5000, 40)]
    got = planar_match(spark, monkeypatch, rows, spots)
    assert got == [("edge", 1), ("hole", 4), ("hole", 5), ("twice", 6)]


def test_no_pois_no_pairs(spark, monkeypatch):
    assert planar_match(spark, monkeypatch, [], [(1, 0, 0)]) == []
    assert planar_match(spark, monkeypatch, random_case(2)[0], []) == []


def test_stations_without_position_match_nothing(spark):
    stations = spark.createDataFrame(
        [(1, None, 50.0), (2, 9.0, None), (3, 9.0, 50.0)],
        "id_cs int, longitude double, latitude double",
    )
    point = project(spark, [(9.0, 50.0)])[0]
    rows = [("n", None, "point", [[[point]]])]
    got = spatial.match_pois(features(spark, rows), stations).collect()
    assert [(r["id_poi"], r["id_cs"]) for r in got] == [("n", 3)]


def test_match_plan_has_no_cross_join(spark):
    rows, spots = random_case(1)
    stations = spark.createDataFrame(
        [(i, 9.0, 50.0) for i, _, _ in spots], "id_cs int, longitude double, latitude double"
    )
    df = spatial.match_pois(features(spark, rows), stations)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_match_offers_other_columns(spark, monkeypatch):
    monkeypatch.setattr(spatial, "to_utm32", lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    rows = [("n", "mall", "point", [[[(1.0, 2.0)]]])]
    stations = spark.createDataFrame([(1, 2.0, 2.0, "x")], "id_cs int, longitude double, latitude double, poi_cat string")
    every = spatial.match_pois(features(spark, rows), stations, columns=None)
    assert {"id_poi", "id_cs", "poi_cat", "poi_cat_cs", "geom_type", "longitude"} <= set(every.columns)
    some = spatial.match_pois(features(spark, rows), stations, columns=["id_cs", "poi_cat"])
    assert [tuple(r) for r in some.collect()] == [(1, "mall")]


# ---- hot keys ----------------------------------------------------------------------------


def test_pieces_follow_pairs(spark):
    left = spark.range(1000).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("k"))
    right = spark.range(1000).select((F.col("id") % 500).alias("k"))
    right = right.unionByName(spark.range(98).select(F.lit(0).cast("long").alias("k")))
    pieces = [tuple(r) for r in key_pieces(left, right, ["k"], 1000).collect()]
    assert pieces == [(0, 13, 4)]  # 400 x 100 pairs in 40 pieces or more
    assert key_pieces(left, right, ["k"], 40_000).count() == 0
    assert key_pieces(left.where("false"), right, ["k"], 1).count() == 0


def test_skew_join_equals_plain_join(spark):
    left = spark.range(300).selectExpr("if(id < 100, 0, id % 40) k", "id l")
    right = spark.range(200).selectExpr("if(id < 70, 0, id % 50) k", "id r")
    expected = left.join(right, "k").where("(l + r) % 3 = 0")
    condition = (F.col("l") + F.col("r")) % 3 == 0
    for pairs in (1, 50, 10**6):
        got = skew_join(left, right, ["k"], condition, left_id="l", right_id="r", pairs_per_task=pairs)
        assert got.columns == ["k", "l", "r"]
        assert got.count() == expected.count()
        assert got.exceptAll(expected).count() == 0


def test_one_spot_is_spread_over_tasks(spark):
    """30,000 stations and 30,000 POIs on one spot make 9 * 10^8 pairs; nothing runs while
    the plan is built, and no combination of pieces has more than the wanted number."""
    one = spark.range(30_000)
    left, right = one.selectExpr("0 k", "id l"), one.selectExpr("0 k", "id r")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    n_left, n_right = key_pieces(left, right, ["k"], 5_000_000).first()[1:]
    assert n_left * n_right >= 180
    before = len(tracker.getJobIdsForGroup(None))
    skew_join(left, right, ["k"], F.lit(True), left_id="l", right_id="r")
    shape = "id_poi string, poi_cat string, geom_type string, geometry array<array<array<struct<x:double,y:double>>>>"
    spatial.match_pois(
        spark.createDataFrame([], shape),
        spark.createDataFrame([], "id_cs int, longitude double, latitude double"),
    )
    assert len(tracker.getJobIdsForGroup(None)) == before
    sizes = [0] * (n_left * n_right)
    for i, c in left.groupBy(F.pmod(F.xxhash64("l"), F.lit(n_left))).count().collect():
        assert c < 1.2 * 30_000 / n_left and len(sizes) > i
