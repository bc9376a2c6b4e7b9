"""Nested features as rows of corners: polygons of GeoJSON, and rings put together from open ways by their end points."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from groundshift.operators.components import dropped, written

FEATURE = "type string, id string, properties map<string,string>, geometry struct<type:string,coordinates:string>"


def read_geojson(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(feature, properties, geometry) of the features of collections: whole files, which are not split, or files of a feature a line, which are."""
    if lines:
        return parsed(spark.read.text(path).withColumnRenamed("value", "feature_text"), "feature_text")
    f = spark.read.option("multiLine", True).schema(f"features array<struct<{', '.join(x.strip().replace(' ', ':', 1) for x in FEATURE.split(', '))}>>").json(path)
    return f.select(F.explode("features").alias("f")).select(F.col("f.id").alias("feature"), F.col("f.properties").alias("properties"), F.col("f.geometry").alias("geometry"))


def parsed(texts: DataFrame, column: str) -> DataFrame:
    """(feature, properties, geometry) of texts that hold a feature each; what is no feature is left out."""
    f = texts.select(F.from_json(column, FEATURE).alias("f")).where("f.type = 'Feature'")
    return f.select(F.col("f.id").alias("feature"), F.col("f.properties").alias("properties"), F.col("f.geometry").alias("geometry"))


def corners(features: DataFrame) -> DataFrame:
    """(feature, part, ring, i, x, y) of the polygons and multi-polygons of features; the point that closes a ring is not repeated, other geometries have none."""
    kind, text = F.col("geometry.type"), F.col("geometry.coordinates")
    one = F.from_json(text, "array<array<array<double>>>")
    parts = F.when(kind == "Polygon", F.array(one)).when(kind == "MultiPolygon", F.from_json(text, "array<array<array<array<double>>>>"))
    p = features.select("feature", F.posexplode(parts).alias("part", "rings")).select("feature", "part", F.posexplode("rings").alias("ring", "points"))
    closed = (F.size("points") > 1) & (F.element_at("points", 1) == F.element_at("points", -1))
    p = p.withColumn("points", F.when(closed, F.slice("points", F.lit(1), F.size("points") - 1)).otherwise(F.col("points")))
    p = p.select("feature", "part", "ring", F.posexplode("points").alias("i", "p"))
    return p.select("feature", "part", "ring", "i", F.get("p", F.lit(0)).alias("x"), F.get("p", F.lit(1)).alias("y"))


def tagged(features: DataFrame, wanted: dict[str, list[str]], tags: str = "properties") -> DataFrame:
    """Features of which some tag has one of its wanted values; none is a valid result."""
    hit = F.lit(False)
    for k, values in wanted.items():
        hit = hit | F.coalesce(F.col(tags)[k].isin(values), F.lit(False))
    return features.where(hit)


def _joined(state: DataFrame, columns: list[str]) -> DataFrame:
    """state with columns of the row that next points to, as c_."""
    other = state.select(F.col("rel").alias("rel_"), F.col("half").alias("half_"), *(F.col(c).alias(f"{c}_") for c in columns))
    return state.join(other, (F.col("rel") == F.col("rel_")) & (F.col("next") == F.col("half_")), "left")


def assembled(ways: DataFrame) -> DataFrame:
    """(rel, ring, i, x, y) from ways (rel, way, points array<struct<x, y>>): closed ways are rings, open ones are chained by their end points, in either direction. Chains that do not close make no ring.
    ring is the least way of the ring, and the ring runs as that way does.

    Every way is two halves, one for each direction; the next half of a half is the other way at its end. Rings are cycles of halves, told and put into order by pointer jumping, in as many
    rounds as the logarithm of the most ways of a relation.
    """
    n = F.size("points")
    w = written(ways.where(n >= 2).withColumns({"a": F.element_at("points", 1), "b": F.element_at("points", -1)}))
    closed = w.where("a = b").select("rel", F.col("way").alias("ring"), F.posexplode(F.slice("points", F.lit(1), n - 1)).alias("i", "p"))
    half = lambda d: F.struct(F.col("way").alias("way"), F.lit(d).alias("d"))
    open_ = w.where("a <> b")
    halves = written(open_.select("rel", half(0).alias("half"), "a", "b").union(open_.select("rel", half(1).alias("half"), F.col("b").alias("a"), F.col("a").alias("b"))))
    nexts = halves.select("rel", F.col("half").alias("to"), F.col("a").alias("b"))
    met = halves.join(nexts, ["rel", "b"]).where("to.way <> half.way").groupBy("rel", "half").agg(F.min("to").alias("next"), F.count(F.lit(1)).alias("n"))
    state = written(halves.select("rel", "half").join(met.where("n = 1").select("rel", "half", "next"), ["rel", "half"], "left").withColumns({"low": F.col("half"), "open": F.col("next").isNull()}))
    most = halves.groupBy("rel").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    follow = state.select("rel", "half", "next")
    for _ in range(max(1, math.ceil(math.log2(most)) + 1)):
        j = _joined(state, ["low", "open", "next"])
        state = written(j.select("rel", "half", F.least("low", F.coalesce("low_", "low")).alias("low"), (F.col("open") | F.coalesce("open_", F.lit(False))).alias("open"), F.coalesce("next_", "next").alias("next")))
    ring = state.where("not open and low.d = 0").select("rel", "half", "low")
    # the half before the least one ends the list; ranks count the halves to the end
    order = ring.join(follow, ["rel", "half"]).select("rel", "half", "low", F.when(F.col("next") != F.col("low"), F.col("next")).alias("next")).withColumn("rank", F.col("next").isNotNull().cast("bigint"))
    order = written(order)
    while order.where("next is not null").limit(1).count():
        j = _joined(order, ["rank", "next"])
        new = written(j.select("rel", "half", "low", F.col("next_").alias("next"), (F.col("rank") + F.coalesce("rank_", F.lit(0))).alias("rank")))
        dropped(order)
        order = new
    p = order.select("rel", F.col("low.way").alias("ring"), F.col("half.way").alias("way"), F.col("half.d").alias("d"), "rank").join(open_.select("rel", "way", "points"), ["rel", "way"])
    along = F.when(F.col("d") == 1, F.reverse("points")).otherwise(F.col("points"))
    p = p.select("rel", "ring", "rank", F.posexplode(F.slice(along, F.lit(1), F.size("points") - 1)).alias("j", "p"))
    p = p.withColumn("i", F.row_number().over(Window.partitionBy("rel", "ring").orderBy(F.desc("rank"), "j")) - 1).select("rel", "ring", "i", "p")
    return closed.union(p).select("rel", "ring", "i", F.col("p.x").alias("x"), F.col("p.y").alias("y"))


def feature_text(key: Column, properties: Column, rings: Column) -> Column:
    """A polygon as the text of a GeoJSON feature; rings are arrays of arrays of two numbers."""
    geometry = F.struct(F.lit("Polygon").alias("type"), rings.alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), key.cast("string").alias("id"), properties.alias("properties"), geometry.alias("geometry")))
