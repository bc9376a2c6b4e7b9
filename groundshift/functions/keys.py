"""Scalar functions over keys, dates and numbers kept as text. What cannot be read is NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date8(x: Column) -> Column:
    """YYYYMMDD to a date."""
    return F.when(F.length(x) == 8, F.try_to_date(x, "yyyyMMdd"))


def any_date(x: Column) -> Column:
    """The first of four formats that fits."""
    x = F.trim(x)
    return F.coalesce(
        F.when(x.rlike(r"^\d{8}$"), F.try_to_date(x, "yyyyMMdd")),
        F.when(x.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(x, "yyyy-MM-dd")),
        F.when(x.rlike(r"^\d{4}/\d{2}/\d{2}$"), F.try_to_date(x, "yyyy/MM/dd")),
        F.when(x.rlike(r"^\d{4}$"), F.try_to_date(F.concat(x, F.lit("0101")), "yyyyMMdd")),
    )


def number(x: Column) -> Column:
    """Text as a number; what is none, or empty, is NULL."""
    return F.trim(x).try_cast("double")


def zfill(x: Column, n: int) -> Column:
    """Zeros to the left; longer text stays whole."""
    return F.when(F.length(x) >= n, x).otherwise(F.lpad(x, n, "0"))


def parcel_number(district: Column, dong: Column, kind: Column, main: Column, sub: Column) -> Column:
    """The 19 characters of a parcel number."""
    return F.concat(district, dong, F.coalesce(kind, F.lit("0")), zfill(main, 4), zfill(sub, 4))


def without_kind(pnu: Column) -> Column:
    """The join key: a parcel number without its 11th character."""
    return F.concat(F.substring(pnu, 1, 10), F.substring(pnu, 12, 100))


def clean_pnu(pnu: Column) -> Column:
    return F.nullif(F.trim(pnu), F.lit(""))


def lot_of_pnu(pnu: Column) -> Column:
    """Lot text of a parcel number of 19 digits: mountain mark, main and sub number."""
    main, sub = F.substring(pnu, 12, 4).cast("int"), F.substring(pnu, 16, 4).cast("int")
    text = F.concat(F.when(F.substring(pnu, 11, 1) == "2", F.lit("산 ")).otherwise(F.lit("")), main.cast("string"), F.when(sub > 0, F.concat(F.lit("-"), sub.cast("string"))).otherwise(F.lit("")))
    return F.when(pnu.rlike(r"^\d{19}$"), text)


def lot_parts(text: Column) -> dict[str, Column]:
    """Mountain flag, main and sub number and land category of a lot text such as ``산 12-3 임``."""
    t = F.trim(text)
    at = r"^(산)?\s*(\d+)(?:-(\d+))?\s*([가-힣]*)$"
    part = lambda k: F.nullif(F.regexp_extract(t, at, k), F.lit(""))
    return {"mountain": part(1).isNotNull(), "main_no": part(2).cast("int"), "sub_no": F.coalesce(part(3).cast("int"), F.when(part(2).isNotNull(), F.lit(0))), "category": part(4)}


def building_number(text: Column) -> tuple[Column, Column]:
    """``307-16`` to main and sub number; blank is 0."""
    main = F.coalesce(F.nullif(F.trim(F.split_part(text, F.lit("-"), F.lit(1))), F.lit("")), F.lit("0"))
    sub = F.coalesce(F.nullif(F.trim(F.split_part(text, F.lit("-"), F.lit(2))), F.lit("")), F.lit("0"))
    return main, sub


def road_key(road: Column, main: Column, sub: Column) -> Column:
    return F.concat_ws("_", F.right(F.trim(road), F.lit(7)), zfill(main, 4), zfill(sub, 4))


def truthy(x: Column) -> Column:
    return F.coalesce(F.lower(F.trim(x.cast("string"))).isin("true", "1"), F.lit(False))
