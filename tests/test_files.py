"""Delimited files, archive, stream intake."""

import json

import pytest

from voltlake.operators import status
from voltlake.schemas import MAIN, STAGING, table
from voltlake.sinks.files import archive_snapshots, read_archive, write_table
from voltlake.sources.delimited import escape_text, read_delimited, unescape_text
from voltlake.sources.poi import read_geojson
from voltlake.streaming.intake import take_in, taken_in


def test_separators_quotes_and_blanks_survive(spark, tmp_path):
    schema = table("id int", "text string")
    data = [(1, 'a;b "c"'), (2, " padded "), (3, ""), (4, None), (5, "ü"), (6, '"')]
    df = spark.createDataFrame(data, schema)
    write_table(df, str(tmp_path / "t"))
    back = read_delimited(spark, str(tmp_path / "t"), schema)
    assert sorted(tuple(r) for r in back.collect()) == [
        (i, "" if t is None else t) for i, t in data
    ]
    nulls = read_delimited(spark, str(tmp_path / "t"), schema, empty_as_null=True)
    assert {r["id"]: r["text"] for r in nulls.collect()}[3] is None


def test_columns_bind_by_name(spark, tmp_path):
    path = tmp_path / "status.csv"
    path.write_text("timestamp;status;id\n2021-10-01 10:00:00+00:00;AVAILABLE;p1\n")
    back = read_delimited(
        spark, str(path), STAGING["staging_status_connectors"],
        names={"id": "id_connector", "status": "status_connector", "timestamp": "ts"},
    ).first()
    assert (back["id_connector"], back["status_connector"], str(back["ts"])) == (
        "p1", "AVAILABLE", "2021-10-01 10:00:00",
    )


def test_many_files_one_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id_poi;id_cs\nnode/1;1\n")
    (tmp_path / "b.csv").write_text("id_poi;id_cs\nway/2;2\n")
    schema = MAIN["mapping_poi_cs"]
    assert read_delimited(spark, str(tmp_path), schema).count() == 2
    (tmp_path / "c.csv").write_text("id_cs;id_poi\n3;node/3\n")
    with pytest.raises(Exception):
        read_delimited(spark, str(tmp_path), schema).collect()


def test_missing_column_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id_poi\nnode/1\n")
    with pytest.raises(ValueError):
        read_delimited(spark, str(tmp_path), MAIN["mapping_poi_cs"])


def test_misfit_text_becomes_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id_poi;id_cs\nnode/1;-\nnode/2; 7 \n")
    got = read_delimited(spark, str(tmp_path), MAIN["mapping_poi_cs"]).collect()
    assert sorted((r["id_poi"], r["id_cs"]) for r in got) == [("node/1", None), ("node/2", 7)]


def test_unknown_output_format_is_rejected(spark, tmp_path):
    df = spark.range(1)
    write_table(df, str(tmp_path / "p"), "parquet")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1
    with pytest.raises(NotImplementedError):
        write_table(df, str(tmp_path / "x"), "xlsx")


def snapshot(folder, time, *points):
    doc = {
        "koeln": {
            "timestamp": f"{time[:4]}-{time[4:6]}-{time[6:8]} 10:00:00",
            "data": [{"id": 1, "evses": [{"id": p, "status": "AVAILABLE"} for p in points]}],
        }
    }
    (folder / f"{time}_cp_data_cities.json").write_text(json.dumps(doc))


def test_archive(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    snapshot(raw, "20211001_100000", "a", "b")
    snapshot(raw, "20211002_100000", "c")
    path = archive_snapshots(spark, str(raw), str(tmp_path))
    assert path.endswith("/archive_cp_data_cities_20211002_100000")
    back = read_archive(spark, path)
    assert sorted(str(r["snapshot_date"]) for r in back.collect()) == ["2021-10-01", "2021-10-02"]
    assert status.cp_status(back).count() == 3
    (raw / "zz.json").write_text("{}")
    with pytest.raises(ValueError):
        archive_snapshots(spark, str(raw), str(tmp_path))


def test_intake_takes_new_files_only(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    where = (str(raw), str(tmp_path / "out"), str(tmp_path / "progress"))
    snapshot(raw, "20211001_100000", "a", "b")
    (raw / "20211001_101000_cp_data_cities.json").write_text("<html>busy</html>")
    take_in(spark, *where)
    seen = lambda: taken_in(spark, where[1])[0]
    bad = lambda: spark.read.parquet(f"{where[1]}/quarantine")
    assert (seen().count(), bad().count()) == (2, 1)
    take_in(spark, *where)
    assert (seen().count(), bad().count()) == (2, 1)
    snapshot(raw, "20211001_102000", "c")
    take_in(spark, *where)
    assert sorted(r["id"] for r in seen().collect()) == ["a", "b", "c"]


def test_geojson_lines(spark, tmp_path):
    square = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    shapes = [
        ("Point", [1, 2], [[[(1, 2)]]]),
        ("Polygon", [square], [[[tuple(p) for p in square]]]),
        ("MultiPolygon", [[square], [square]], [[[tuple(p) for p in square]]] * 2),
        ("LineString", [[0, 0], [1, 1]], [[[(0, 0), (1, 1)]]]),
    ]
    lines = [
        json.dumps(
            {
                "type": "Feature", "properties": {"osmid": i, "shop": "mall"},
                "geometry": {"type": kind, "coordinates": coordinates},
            }
        )
        for i, (kind, coordinates, _) in enumerate(shapes)
    ]
    (tmp_path / "f.jsonl").write_text("\n".join(lines))
    got = {
        int(r["osmid"]): r
        for r in read_geojson(spark, str(tmp_path), ["osmid", "shop", "amenity"]).collect()
    }
    for i, (kind, _, expected) in enumerate(shapes):
        geometry = [[[(v["x"], v["y"]) for v in ring] for ring in part] for part in got[i]["geometry"]]
        assert geometry == expected
        assert (got[i]["geom_type"], got[i]["shop"], got[i]["amenity"]) == (
            kind.lower(), "mall", None,
        )


ODD_TEXTS = ["", "plain", "a\nb", "\r\n", "\\n", "\\", "\\\n\\b\r", "b\\\\", '"q";\n;"', " lead\t\n", "é\u2028\n"]


def test_escaped_text_comes_back(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD_TEXTS)] + [(99, None)], "n int, t string")
    escaped = escape_text(df)
    assert escaped.where("t rlike '[\\\\r\\\\n]'").count() == 0
    assert sorted(map(tuple, unescape_text(escaped).collect())) == sorted(map(tuple, df.collect()))


def test_one_file_with_free_text_is_read_by_many_tasks(spark, tmp_path):
    texts = [f"{i}\n{ODD_TEXTS[i % len(ODD_TEXTS)]}" + "x" * 200 for i in range(4000)]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string").coalesce(1)
    write_table(df, str(tmp_path / "t"), escaped=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        back = read_delimited(spark, str(tmp_path / "t"), table("n int", "t string"), escaped=True)
        assert len(list((tmp_path / "t").glob("part-*.csv"))) == 1 and back.rdd.getNumPartitions() > 4
        assert sorted(map(tuple, back.collect())) == list(enumerate(texts))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
