"""Queries of the second sensor, lattices, audits of scenes and records of composites."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from groundshift.operators import scenes as sn
from groundshift.operators import sensors
from groundshift.plans.registry import query
from groundshift.sources.tables import ctes, table

# scenes as recorded (an id may be missing), and what the catalog of the second sensor holds: some are missing, shifted by a day, processed anew, or kept with their offset
_RECORDED = """sr AS (SELECT event_id AS event, CASE WHEN event_id % 13 <> 0 THEN event_id END AS scene_id, CAST(ts AS DATE) AS day, CASE WHEN event_id % 17 <> 0 THEN '04.00' END AS baseline, 1000 AS removed FROM events),
    it AS (SELECT event_id AS scene_id, CASE WHEN event_id % 7 = 0 THEN CAST(CAST(ts AS DATE) + 1 AS DATE) ELSE CAST(ts AS DATE) END AS day, CASE WHEN event_id % 11 = 0 THEN '02.14' ELSE '04.00' END AS baseline, CASE WHEN event_id % 19 = 0 THEN 0 ELSE 1000 END AS removed FROM events WHERE event_id % 5 <> 0),
    sw AS (SELECT *, CASE WHEN reason IS NULL THEN 'OK' ELSE 'UNAVAILABLE' END AS status FROM (SELECT event, sr.scene_id, CASE WHEN sr.scene_id IS NULL THEN 'NO_SCENE_ID' WHEN it.scene_id IS NULL THEN 'NOT_FOUND' WHEN sr.day <> it.day THEN 'DATE_MISMATCH' WHEN sr.baseline <> it.baseline THEN 'BASELINE_MISMATCH' WHEN sr.removed <> it.removed THEN 'OFFSET_MISMATCH' END AS reason FROM sr LEFT JOIN it ON it.scene_id = sr.scene_id))"""


def _second(spark, sf_dir):
    e, k, day = table(spark, sf_dir, "events"), F.col("event_id"), F.to_date("ts")
    recorded = e.select(k.alias("event"), F.when(k % 13 != 0, k).alias("scene_id"), day.alias("day"), F.when(k % 17 != 0, "04.00").alias("baseline"), F.lit(1000).alias("removed"))
    items = e.where("event_id % 5 <> 0").select(k.alias("scene_id"), F.when(k % 7 == 0, F.date_add(day, 1)).otherwise(day).alias("day"), F.when(k % 11 == 0, "02.14").otherwise("04.00").alias("baseline"), F.when(k % 19 == 0, 0).otherwise(1000).alias("removed"))
    return sensors.second_band(recorded, items, ["event"])


@query("S31_second_sensor", f"WITH {_RECORDED} SELECT event, scene_id, status, reason FROM sw")
def second_sensor(spark, sf_dir):
    return _second(spark, sf_dir)


# a year's scene is the first whose number ends like the year
_STACK = f"""{_RECORDED}, {ctes('pixels')}, ye AS (SELECT e.epoch, min(event) AS event FROM (SELECT DISTINCT epoch FROM pixels) e JOIN sr ON event % 10 = e.epoch % 10 GROUP BY e.epoch), av AS (SELECT epoch FROM ye JOIN sw USING (event) WHERE status = 'OK'),
    cm AS (SELECT epoch, CAST(floor(r / 2) AS INT) AS r, CAST(floor(c / 2) AS INT) AS c, {', '.join(f'CASE WHEN count(*) FILTER (n >= 2) >= 2 THEN avg({b}) FILTER (n >= 2) END AS {b}' for b in ('red', 'nir', 'blue', 'green', 'swir'))} FROM pixels GROUP BY 1, 2, 3),
    cs AS (SELECT epoch, r, c, CASE WHEN red + nir > 0 THEN (nir - red) / (nir + red) END AS ndvi, CASE WHEN av.epoch IS NOT NULL AND swir + red + nir + blue >= 1e-3 THEN (swir + red - nir - blue) / (swir + red + nir + blue) END AS bsi, CASE WHEN av.epoch IS NOT NULL AND green + swir >= 1e-3 THEN (green - swir) / (green + swir) END AS mndwi, av.epoch IS NOT NULL AS available FROM cm LEFT JOIN av USING (epoch))"""


@query("A06_coarse_stack", f"WITH {_STACK} SELECT epoch, r, c, round(ndvi, 6) AS ndvi, round(bsi, 6) AS bsi, round(mndwi, 6) AS mndwi, available FROM cs")
def coarse_stack(spark, sf_dir):
    """Indices of cells of 20 m; years whose scene the second sensor lacks have no soil and water index."""
    p, s = table(spark, sf_dir, "pixels"), _second(spark, sf_dir)
    scene = p.select("epoch").distinct().join(s.select("event", "status", (F.col("event") % 10).alias("last")), F.col("epoch") % 10 == F.col("last")).groupBy("epoch").agg(F.min_by("status", "event").alias("status"))
    g = sensors.coarse_stack(p, scene.where("status = 'OK'"), F.col("n") >= 2)
    return g.select("epoch", "r", "c", *(F.round(x, 6).alias(x) for x in ("ndvi", "bsi", "mndwi")), "available")


@query("J06_placed_lattice", f"WITH {ctes('pixels')}, p AS (SELECT epoch, r + 3 AS r, c - 5 AS c, red FROM pixels) SELECT epoch, CAST(floor(r / 2) AS INT) AS r2, CAST(floor(c / 2) AS INT) AS c2, count(*) AS cells, round(avg(red), 6) AS red FROM p GROUP BY 1, 2, 3")
def placed_lattice(spark, sf_dir):
    """Cells of 10 m whose lattice begins 50 m before and 30 m above that of 20 m cells."""
    p = sensors.placed(table(spark, sf_dir, "pixels").select("epoch", "r", "c", "red"), (-50.0, 30.0), (0.0, 0.0), 10.0)
    return p.groupBy("epoch", "r2", "c2").agg(F.count(F.lit(1)).alias("cells"), F.round(F.avg("red"), 6).alias("red"))


_HOUR = "CAST(extract('hour' FROM ts) AS INT)"


@query("A67_scene_audit", f"WITH {ctes('scenes')}, s AS (SELECT *, {_HOUR} AS grp, max(clear_fraction) OVER (PARTITION BY {_HOUR}) AS best FROM scenes WHERE clear_fraction >= 0.5e0), r AS (SELECT grp, scene_id, row_number() OVER (PARTITION BY grp ORDER BY abs(date_diff('day', CAST(ts AS DATE), DATE '2024-01-05')), clear_fraction DESC, scene_id) AS rank FROM s WHERE clear_fraction >= best - 0.1e0) SELECT {_HOUR} AS grp, a.scene_id, round(clear_fraction, 6) AS clear_fraction, r.scene_id IS NOT NULL AS selected FROM scenes a LEFT JOIN r ON r.scene_id = a.scene_id AND r.rank = 1")
def scene_audit(spark, sf_dir):
    """Every scene that was considered, and whether it was taken."""
    s = table(spark, sf_dir, "scenes")
    out = sensors.audited(s.withColumn("grp", F.hour("ts")), sn.choose(s, F.hour("ts"), datetime(2024, 1, 5)), "grp")
    return out.select("grp", "scene_id", F.round("clear_fraction", 6).alias("clear_fraction"), "selected")


_MADE = f"""{ctes('pixels')}, pv AS (SELECT CAST(year(l_shipdate) AS INT) AS year, max(CAST(l_shipdate AS DATE)) AS day, min(l_orderkey) AS scene_id, count(DISTINCT month(l_shipdate)) AS n_scenes FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1), vf AS (SELECT epoch AS year, count(*) FILTER (n >= 2) * 1e0 / count(*) AS valid_fraction FROM pixels GROUP BY 1)"""


@query("S32_composite_records", f"WITH {_MADE} SELECT year, day, 'median composite' AS provider, scene_id, concat('median of ', CAST(n_scenes AS VARCHAR), ' scenes') AS platform, 'mixed' AS baseline, round(valid_fraction, 6) AS clear_fraction FROM pv JOIN vf USING (year) WHERE n_scenes >= 2 AND valid_fraction >= 0.3e0")
def composite_records(spark, sf_dir):
    """A composite of a year is made from the scenes of its months; with fewer than two of them, or too few valid cells, it is not OK."""
    o = table(spark, sf_dir, "lineitem").where("l_shipdate is not null").groupBy(F.year("l_shipdate").alias("year")).agg(F.to_date(F.max("l_shipdate")).alias("day"), F.min("l_orderkey").alias("scene_id"), F.countDistinct(F.month("l_shipdate")).alias("n_scenes"))
    v = table(spark, sf_dir, "pixels").groupBy(F.col("epoch").alias("year")).agg((F.count_if(F.col("n") >= 2) / F.count(F.lit(1))).alias("valid_fraction"))
    p = o.join(v, "year").withColumn("status", F.when((F.col("n_scenes") >= 2) & (F.col("valid_fraction") >= 0.3), "OK").otherwise("INSUFFICIENT"))
    return sensors.composite_records(p).withColumn("clear_fraction", F.round("clear_fraction", 6))
