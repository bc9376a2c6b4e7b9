"""Map algebra over the pixel table: one row in, one row out. NULL is an observation that is not there; it is never zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def norm_diff(a: Column, b: Column, min_den: float = 1e-3) -> Column:
    """(a - b) / (a + b), NULL where the sum is below min_den."""
    return F.when(a + b >= min_den, (a - b) / (a + b))


def ndvi(red: Column, nir: Column) -> Column:
    """Vegetation index; NULL where a band is not positive or the result leaves [-1, 1]."""
    x = F.when((red > 0) & (nir > 0), norm_diff(nir, red))
    return F.when(x.between(-1, 1), x)


def bsi(red: Column, nir: Column, blue: Column, swir: Column) -> Column:
    """Bare-soil index."""
    return norm_diff(swir + red, nir + blue)


def mndwi(green: Column, swir: Column) -> Column:
    """Water index."""
    return norm_diff(green, swir)


def mean_of_present(*bands: Column) -> Column:
    """Mean of the bands that are there."""
    have = F.filter(F.array(*(b.cast("double") for b in bands)), lambda x: x.isNotNull())
    return F.when(F.size(have) > 0, F.aggregate(have, F.lit(0.0), lambda a, x: a + x) / F.size(have))


def grayscale(red: Column, green: Column, blue: Column) -> Column:
    return (red + green + blue) / 3


def reflectance(dn: Column, scale: float = 10000.0) -> Column:
    return F.when(dn > 0, dn / scale)


def boa_offset(baseline: Column) -> Column:
    """1000 from processing baseline 4.0 on, else 0; what is no number counts as older."""
    return F.when(F.coalesce(baseline.try_cast("double"), F.lit(0.0)) >= 4, 1000).otherwise(0)


def without_offset(dn: Column, offset: Column) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(65535), dn - offset))


def clear(scl: Column) -> Column:
    """Scene classes without cloud, shadow or snow."""
    return scl.isin(4, 5, 6, 7)


def decline(before: Column, after: Column, before_min: float = 0.5, after_max: float = 0.3, delta_max: float = -0.2) -> Column:
    """Vegetation at the first date and none at the second; false where either is not known."""
    return F.coalesce((before >= before_min) & (after <= after_max) & (after - before <= delta_max), F.lit(False))


def exposed(v: Column, b: Column, ndvi_max: float = 0.3, bsi_min: float = 0.0) -> Column:
    return F.coalesce((v <= ndvi_max) & (b >= bsi_min), F.lit(False))


def tier(score: Column, high: float, medium: float) -> Column:
    """HIGH, MEDIUM or LOW; NULL for NULL."""
    return F.when(score.isNull(), None).when(score >= high, "HIGH").when(score >= medium, "MEDIUM").otherwise("LOW")


def with_indices(pixels: DataFrame, min_obs: int = 2) -> DataFrame:
    """Pixels with ndvi, bsi, mndwi and gray; NULL where fewer than min_obs observations made the pixel."""
    ok = F.col("n") >= min_obs
    red, nir, blue, green, swir = (F.when(ok, F.col(c)) for c in ("red", "nir", "blue", "green", "swir"))
    return pixels.withColumns({"ndvi": ndvi(red, nir), "bsi": bsi(red, nir, blue, swir), "mndwi": mndwi(green, swir), "gray": grayscale(red, green, blue)})
