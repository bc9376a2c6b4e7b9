"""Layers from several files and offices: parts put together, areas of interest by attribute, a railway from the better source, exports and lists of candidates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundshift.functions import keys


def first_field(df: DataFrame, candidates: list[str]) -> str | None:
    """The column that the first of these names fits, whatever its case; None if none does."""
    have = {c.lower(): c for c in df.columns}
    return next((have[c.lower()] for c in candidates if c.lower() in have), None)


def together(parts: list[DataFrame]) -> DataFrame:
    """Parts of a layer one after the other; a column that a part lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def railway(osm: DataFrame, official: DataFrame | None, include: list[str]) -> DataFrame:
    """Lines (railway, points, ...): those of the official source instead of the others if it has any, else the listed kinds that are no service tracks. Lines without two points go."""
    full = lambda d: d.where(F.size("points") >= 2)
    if official is not None and official.limit(1).count():
        return full(official)
    return full(osm.where(F.col("railway").isin(include) & F.col("service").isNull()))


def named_areas(features: DataFrame, name: str, names: list[str]) -> DataFrame:
    """Features with these names; a name that no feature has is an error that lists it."""
    found = {r[0] for r in features.where(F.col(name).isin(names)).select(name).distinct().collect()}  # at most as many as names
    if missing := sorted(set(names) - found):
        raise ValueError(f"no feature is named {', '.join(missing)}")
    return features.where(F.col(name).isin(names))


def coded_area(features: DataFrame, code: str, value: str, name: str, expected: str) -> DataFrame:
    """The one feature with this code; none, several or another name than expected are errors."""
    found = features.where(F.col(code) == value)
    rows = found.select(name).limit(2).collect()
    if len(rows) != 1 or rows[0][0] != expected:
        raise ValueError(f"{code} {value}: expected one feature named {expected}, found {[r[0] for r in rows]}")
    return found


def permits(items: DataFrame, parcels: DataFrame, pnu: str = "pnu") -> DataFrame:
    """Permit items (district, dong, kind, main, sub, ...) with their parcel number, of the legal dongs in which the parcels lie."""
    text = lambda c: F.col(c).cast("string")
    codes = parcels.select(F.substring(pnu, 1, 10).alias("__dong")).where("length(__dong) = 10").distinct()
    return items.withColumn("__dong", F.concat(text("district"), text("dong"))).join(codes, "__dong", "left_semi").withColumn("pnu", keys.parcel_number(text("district"), text("dong"), text("kind"), text("main"), text("sub"))).drop("__dong")


def exchange(parcels: DataFrame, pnu: str, columns: list[str], order: list[Column]) -> DataFrame:
    """One row for each parcel number with these columns: the first in order. Rows without a number go."""
    rank = F.struct(*order)
    return parcels.where(F.col(pnu).isNotNull()).groupBy(pnu).agg(F.min_by(F.struct(*columns), rank).alias("s")).select(pnu, "s.*")


CANDIDATE = T.StructType([T.StructField(c, T.StringType()) for c in ("offer", "acquired", "cloud", "resolution")])


def imagery_candidates(spark: SparkSession, path: str) -> DataFrame | None:
    """Offers of images from a CSV file with a header (offer, acquired, cloud, resolution); None if there is no file. What is no date or number is NULL."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return None
    c = spark.read.schema(CANDIDATE).option("header", True).csv(path)
    number = lambda n: F.expr(f"try_cast({n} as double)").alias(n)
    return c.select("offer", F.expr("cast(try_to_timestamp(acquired, 'yyyy-MM-dd') as date)").alias("acquired"), number("cloud"), number("resolution"))
