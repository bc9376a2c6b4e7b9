"""Layers from several sources: choices, errors and what is not there."""

import pytest
from pyspark.sql import functions as F

from groundshift.operators import parcelview
from groundshift.sources import layers


def test_the_first_field_that_fits_is_taken(spark):
    df = spark.createDataFrame([(1, 2)], "PNU int, jibun int")
    assert layers.first_field(df, ["code", "pnu", "JIBUN"]) == "PNU"
    assert layers.first_field(df, ["other"]) is None


def test_the_official_railway_replaces_the_other_one(spark):
    schema = "id int, railway string, service string, points array<int>"
    osm = spark.createDataFrame([(1, "rail", None, [1, 2]), (2, "rail", "yard", [1, 2]), (3, "tram", None, [1, 2]), (4, "rail", None, [1]), (5, None, None, [1, 2])], schema)
    official = spark.createDataFrame([(9, None, None, [1, 2]), (8, None, None, [])], schema)
    ids = lambda d: sorted(r.id for r in d.collect())
    assert ids(layers.railway(osm, None, ["rail"])) == [1]
    assert ids(layers.railway(osm, official, ["rail"])) == [9]
    assert ids(layers.railway(osm, official.where("id = 0"), ["rail", "tram"])) == [1, 3]


def test_areas_that_are_not_there_are_errors(spark):
    f = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "c"), (None, None)], "code string, name string")
    assert layers.named_areas(f, "name", ["a", "c"]).count() == 2
    with pytest.raises(ValueError, match="x, y"):
        layers.named_areas(f, "name", ["a", "y", "x"])
    assert layers.coded_area(f, "code", "1", "name", "a").count() == 1
    for code, name in (("1", "b"), ("2", "b"), ("3", "a")):
        with pytest.raises(ValueError, match="expected one"):
            layers.coded_area(f, "code", code, "name", name)


def test_no_file_of_candidates_gives_none(spark, tmp_path):
    assert layers.imagery_candidates(spark, f"{tmp_path}/none.csv") is None
    (tmp_path / "some.csv").write_text("offer,acquired,cloud,resolution\na,2024-02-30,x,0.5\nb,2024-02-29,7,\n")
    got = [tuple(map(str, r)) for r in layers.imagery_candidates(spark, f"{tmp_path}/some.csv").orderBy("offer").collect()]
    assert got == [("a", "None", "None", "0.5"), ("b", "2024-02-29", "7.0", "None")]


def test_exchange_keeps_one_row_a_parcel(spark):
    p = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 9.0), ("a", 3, 9.0), (None, 4, 1.0), ("b", 5, None)], "pnu string, id int, area double")
    assert sorted(map(tuple, layers.exchange(p, "pnu", ["id", "area"], [-F.coalesce("area", F.lit(0.0)), F.col("id")]).collect())) == [("a", 2, 9.0), ("b", 5, None)]


def test_answers_name_the_first_rows_in_order(spark):
    v = spark.createDataFrame([(i, f"p{i}", float(i % 4)) for i in range(8)], "id int, name string, area double")
    top = lambda rows: parcelview.answer("q", rows, {"area": True, "id": False}, F.col("name"), 3).first()
    assert tuple(top(v)) == ("q", 8, "p3, p7, p2")
    assert tuple(top(v.where("id > 99"))) == ("q", 0, "")
