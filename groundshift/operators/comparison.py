"""Two runs over the same parcels side by side, and how far they agree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The findings that count as robust when both runs make them, with their columns.
TARGETS = {"exposed_increase": ("composite_type", "EXPOSED_SURFACE_INCREASE"), "quarry_expansion": ("quarry_context", "POTENTIAL_QUARRY_EXPANSION")}


def compared(single: DataFrame, composite: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Parcels of both runs with the columns of each (_single, _comp), whether the types agree and which findings are robust. Parcels of one run alone are left out."""
    named = lambda df, tail: df.select(key, *(F.col(c).alias(f"{c}_{tail}") for c in columns))
    m = named(single, "single").join(named(composite, "comp"), key)
    robust = {f"robust_{n}": (F.col(f"{c}_single") == t) & (F.col(f"{c}_comp") == t) for n, (c, t) in TARGETS.items()}
    m = m.withColumns({"type_agree": F.col("composite_type_single") == F.col("composite_type_comp"), **robust})
    return m.withColumn("robust_any", F.col("robust_exposed_increase") | F.col("robust_quarry_expansion"))


def agreement(runs: DataFrame, area: str) -> DataFrame:
    """One row from compared: parcels, those that both runs can judge, the share of equal types among them, counts and overlap of each finding, correlation of the areas (over more than three; NULL where those of a run are all equal)."""
    ok = (F.col("composite_type_single") != "INSUFFICIENT_DATA") & (F.col("composite_type_comp") != "INSUFFICIENT_DATA")
    found = []
    for n, (c, t) in TARGETS.items():
        a, b = F.col(f"{c}_single") == t, F.col(f"{c}_comp") == t
        found += [F.count_if(a).alias(f"{n}_single"), F.count_if(b).alias(f"{n}_comp"), F.count_if(a & b).alias(f"{n}_both"), F.try_divide(F.count_if(a & b), F.count_if(a | b)).alias(f"{n}_jaccard")]
    pair = lambda x: F.when(ok, F.col(f"{area}_{x}"))
    return runs.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("n_evaluable"), F.try_divide(F.count_if(ok & F.col("type_agree")), F.count_if(ok)).alias("agreement"), *found,
        F.when(F.count_if(ok) > 3, F.try_divide(F.covar_pop(pair("single"), pair("comp")), F.stddev_pop(pair("single")) * F.stddev_pop(pair("comp")))).alias("exposed_r"), F.count_if("robust_any").alias("robust"),
    )
