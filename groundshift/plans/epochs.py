"""Queries of sites through epochs and of incremental runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundshift.operators import components as cc
from groundshift.operators import evidence as ev
from groundshift.operators import incremental as inc
from groundshift.operators import sites as st
from groundshift.plans.clusters import _COMP, _labelled
from groundshift.plans.registry import query
from groundshift.plans.shapes import _edges, _r, _shapes, _sweep
from groundshift.sources.tables import ctes, epochs, table

_SITES = f"""{_COMP}, sc AS (SELECT k, comp, r, c FROM comp JOIN (SELECT k, comp FROM comp GROUP BY 1, 2 HAVING count(*) >= 2) USING (k, comp)),
    si AS (SELECT k, comp, k * 1000000000000 + comp AS id, avg(c * 10 + 5e0) AS x, avg(r * 10 + 5e0) AS y, count(*) AS n FROM sc GROUP BY k, comp)"""


def _sites(spark, sf_dir):
    """Cells of changes of two cells or more: (k, comp, id, r, c)."""
    cells = cc.written(_labelled(spark, sf_dir))
    large = cells.groupBy("k", "comp").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    return cc.written(cells.join(large.select("k", "comp"), ["k", "comp"], "left_semi").withColumn("id", F.col("k") * F.lit(1000000000000) + F.col("comp")))


@query("J26_same_sites", f"WITH RECURSIVE {_SITES}, o AS (SELECT a.id, list_sort(list_distinct(list(b.k))) AS l FROM si a JOIN si b ON a.k <> b.k AND pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= 900 GROUP BY a.id) SELECT si.id, si.k, coalesce(array_to_string(l, ','), '') AS others, coalesce(len(l), 0) + 1 AS n_epochs FROM si LEFT JOIN o USING (id)")
def same_sites(spark, sf_dir):
    s = _sites(spark, sf_dir).groupBy("k", "id").agg(F.avg(F.col("c") * 10 + 5.0).alias("x"), F.avg(F.col("r") * 10 + 5.0).alias("y"))
    return st.same_sites(s, 30.0).select("id", "k", F.array_join(F.col("others").cast("array<string>"), ",").alias("others"), "n_epochs")


@query("J27_persisting_sites", f"WITH RECURSIVE {_SITES}, m AS (SELECT s.k, s.comp, bool_or(b.r IS NOT NULL) AS met FROM sc s LEFT JOIN sc b ON b.k = s.k - 1 AND b.r = s.r AND b.c = s.c GROUP BY 1, 2) SELECT k, count(*) AS n, count(*) FILTER (met) AS persistent FROM m GROUP BY k")
def persisting_sites(spark, sf_dir):
    return st.persisting(_sites(spark, sf_dir))


_BLOCKS = f"""{_SITES}, {ctes('zone_points')}, {_edges('zone_points', 'zone_id')}, zc AS (SELECT k || '_' || r || '_' || c AS g, k AS zone, r, c FROM (SELECT k, r, unnest(range(CAST(floor(x0 / 10) AS INT), CAST(ceil(x1 / 10) AS INT))) AS c FROM (SELECT *, unnest(range(CAST(floor(y0 / 10) AS INT), CAST(ceil(y1 / 10) AS INT))) AS r FROM zone_b))),
    zp AS (SELECT g, 0 AS layer, s, xa, ya, xb, yb FROM zc JOIN zone_e ON k = zone UNION ALL SELECT g, 1, s, c * 10e0, (r + h) * 10e0, c * 10e0 + 10, (r + h) * 10e0 FROM zc, (VALUES (1, 1), (0, -1)) v(h, s)), {_sweep('zp', 'zo')},
    bc AS (SELECT zone, r, c, ab AS area FROM zc JOIN zo USING (g) WHERE ab > 1e-6), bw AS (SELECT zone, sum(area) AS whole FROM bc GROUP BY 1),
    fresh AS (SELECT a.id, NOT bool_or(b.id IS NOT NULL) AS new FROM si a LEFT JOIN si b ON b.k < a.k AND pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= 900 GROUP BY a.id),
    tc AS (SELECT zone, sc.k, si.id, sum(area) AS area, max(CAST(new AS INT)) AS new FROM bc JOIN sc USING (r, c) JOIN si ON si.k = sc.k AND si.comp = sc.comp JOIN fresh ON fresh.id = si.id GROUP BY 1, 2, 3),
    tb AS (SELECT zone, k, sum(area) AS area, count(*) AS n, CAST(sum(new) AS BIGINT) AS new FROM tc GROUP BY 1, 2), ek AS (SELECT count(*) AS n, max(k) AS last FROM ep WHERE k > 0),
    pg AS (SELECT bw.zone, ek.n AS epochs, count(tb.k) AS active, coalesce(sum(tb.area), 0e0) AS area, whole, arg_max((tb.k, tb.n, tb.new), tb.k) AS l, coalesce(bool_or(tb.k = ek.last), FALSE) AS now FROM bw JOIN ek ON TRUE LEFT JOIN tb ON tb.zone = bw.zone GROUP BY 1, 2, whole)"""


def _progress(spark, sf_dir):
    cells = _sites(spark, sf_dir)
    s = cells.groupBy("k", "id").agg(F.avg(F.col("c") * 10 + 5.0).alias("x"), F.avg(F.col("r") * 10 + 5.0).alias("y"))
    new = st.same_sites(s, 30.0).select("id", F.forall("others", lambda e: e > F.col("k")).alias("new"))
    z = _shapes(spark, sf_dir, "zone_points", "zone_id")
    t = st.touched(z.cover, cells.select("k", "id", "r", "c").join(new, "id"), "zone_id")
    blocks = z.cover.groupBy("zone_id").agg(F.sum("area").alias("whole"))
    return st.progress(blocks, t, list(range(1, len(epochs(spark, sf_dir)))), "zone_id")


@query("J16_A30_block_progress", f"WITH RECURSIVE {_BLOCKS} SELECT zone AS zone_id, CAST(epochs AS INT) AS epochs, active, round(active * 1e0 / epochs + 1e-9, 6) AS persistence, round(area + 1e-9, 4) AS area, round(area / whole + 1e-9, 6) AS ratio, l[1] AS last_active, coalesce(l[2], 0) AS last_n, coalesce(l[3], 0) AS last_new, now AS active_now FROM pg")
def block_progress(spark, sf_dir):
    p = _progress(spark, sf_dir)
    return p.withColumns({"persistence": _r("persistence", 6), "area": _r("area", 4), "ratio": _r("ratio", 6)})


_STAGE = "CASE WHEN round(area / whole, 6) < 0.03e0 THEN CASE WHEN coalesce(l[3], 0) = 0 THEN 'NOT_STARTED' ELSE 'STABLE' END WHEN NOT now THEN 'STABLE' WHEN round(area / whole, 6) >= 0.1e0 AND coalesce(l[3], 0) = 0 THEN 'SITE_WORK' WHEN coalesce(l[3], 0) > 0 AND active * 1e0 / epochs >= 0.5e0 THEN 'CONSTRUCTION' WHEN coalesce(l[3], 0) > 0 THEN 'NEARING_COMPLETION' ELSE 'SITE_WORK' END"


@query("P30_block_stage", f"WITH RECURSIVE {_BLOCKS} SELECT zone AS zone_id, {_STAGE} AS stage FROM pg")
def block_stage(spark, sf_dir):
    """Stages from the blocks' own progress."""
    p = _progress(spark, sf_dir)
    return p.select("zone_id", ev.development_stage(F.round("ratio", 6), F.col("last_new"), F.col("persistence"), F.col("active_now")).alias("stage"))


_BASE = 3
_STATUS = ("STRADDLES_BASELINE", "UNKNOWN", "POST_BASELINE_PERMITTED", "PRE_BASELINE")
_RISKS = "CASE {0} " + " ".join(f"WHEN '{k}' THEN {v}e0" for k, v in ev.RISK.items()) + " END"


@query("P51_refined_status", f"""WITH RECURSIVE {_BLOCKS}, h AS (SELECT zone, min(k) AS k FROM tb GROUP BY 1), b AS (SELECT bw.zone, CASE bw.zone % 4 WHEN 0 THEN 'STRADDLES_BASELINE' WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN 'POST_BASELINE_PERMITTED' ELSE 'PRE_BASELINE' END AS status, h.k FROM bw LEFT JOIN h ON h.zone = bw.zone),
    c AS (SELECT *, {_RISKS.format('status')} AS risk, k - 1 >= {_BASE} AS after, k <= {_BASE} AS before FROM b)
    SELECT zone AS zone_id, CASE WHEN after AND status IN ('STRADDLES_BASELINE', 'UNKNOWN') THEN 'POST_BASELINE_UNVERIFIED' WHEN after THEN status WHEN before THEN 'PRE_BASELINE' ELSE status END AS status, CASE WHEN after THEN greatest(risk, 1e0) WHEN before THEN 0e0 ELSE risk END AS risk, k AS change_epoch FROM c""")
def refined_status(spark, sf_dir):
    """The earliest interval in which a block changed brackets a verdict of two dates."""
    cells = _sites(spark, sf_dir)
    z = _shapes(spark, sf_dir, "zone_points", "zone_id")
    first = z.cover.join(cells.select("k", "r", "c"), ["r", "c"]).groupBy("zone_id").agg(F.min("k").alias("k"))
    status = F.element_at(F.array(*map(F.lit, _STATUS)), (F.col("zone_id") % 4 + 1).cast("int"))
    b = z.cover.select("zone_id").distinct().join(first, "zone_id", "left").withColumn("base", status)
    refined, risk = st.bracketed(F.col("base"), ev.risk(F.col("base")), F.col("k") - 1, F.col("k"), F.lit(_BASE))
    return b.select("zone_id", refined.alias("status"), risk.alias("risk"), F.col("k").alias("change_epoch"))


@query("S26_S27_incremental_run", f"""WITH {ctes('pixels')}, p AS (SELECT a.epoch AS t1, b.epoch AS t2, count(*) AS cells, count(*) FILTER (abs(b.red - a.red) > 500) AS changed, bool_or((a.epoch = 1995 AND a.n < 2) OR (b.epoch = 1995 AND b.n < 2)) AS more FROM pixels a JOIN pixels b ON b.epoch = a.epoch + 1 AND b.r = a.r AND b.c = a.c GROUP BY 1, 2)
    SELECT concat(CAST(t1 AS VARCHAR), '_', CAST(t2 AS VARCHAR)) AS pair, cells, changed, CASE WHEN more THEN 2 ELSE 1 END AS run FROM p""")
def incremental_run(spark, sf_dir):
    """A first run on pixels without the weak ones of one year, a second on all pixels: only pairs with that year are done again; a third finds nothing to do."""
    p = table(spark, sf_dir, "pixels").select("epoch", "r", "c", "red", "n")
    pairs = p.select((F.col("epoch") + 1).alias("t2"), "r", "c", F.col("red").alias("a"), F.col("n").alias("n1")).join(p.select(F.col("epoch").alias("t2"), "r", "c", F.col("red").alias("b"), F.col("n").alias("n2")), ["t2", "r", "c"])
    pairs = cc.written(pairs.withColumn("t1", F.col("t2") - 1).withColumn("pair", inc.pair_name("t1", "t2")))
    compute = lambda d: d.groupBy("pair").agg(F.count(F.lit(1)).alias("cells"), F.count_if(F.abs(F.col("b") - F.col("a")) > 500).alias("changed"))
    target = cc.scratch(spark)
    weak = ((F.col("t1") == 1995) & (F.col("n1") < 2)) | ((F.col("t2") == 1995) & (F.col("n2") < 2))
    inc.run(pairs.where(~weak), compute, target)
    inc.run(pairs, compute, target)
    if inc.run(pairs, compute, target):
        raise ValueError("a run on unchanged inputs must not do anything")
    return inc.collected(spark, target).select("pair", "cells", "changed", "run")
