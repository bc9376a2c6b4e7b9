"""Tables for people: interval states, screening tiers, sites to visit, heights, route order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def interval_status(decline: Column, exposed: Column, loss: Column, recovery: Column, ev10: Column, ev20: Column) -> Column:
    """State of a parcel in one interval from areas: at least 200 square metres and a tenth of what can be judged."""
    least = lambda ev: F.greatest(F.lit(200.0), 0.1 * ev)
    ok10, ok20 = ev10 >= 400, ev20 >= 800
    return (
        F.when(~ok10 & ~ok20, "na").when(ok20 & (exposed >= least(ev20)), "exposed").when((ok10 & (decline >= least(ev10))) | (ok20 & (loss >= least(ev20))), "veg_loss")
        .when(ok20 & (recovery >= least(ev20)), "recovery").otherwise("none")
    )


def screening_tier(states: Column, persistent: Column) -> Column:
    """1 exposed or a persistent decline, 2 any other change, 3 none, 4 nothing to judge. states: array of interval states."""
    return F.when(F.forall(states, lambda s: s == "na"), 4).when(F.array_contains(states, "exposed") | persistent, 1).when(F.exists(states, lambda s: s.isin("veg_loss", "recovery")), 2).otherwise(3)


def height(floors: Column, default: int = 2, storey: float = 3.0) -> dict[str, Column]:
    """Estimated height; no or zero floors count as missing."""
    missing = floors.isNull() | (floors == 0)
    return {"height_m": F.when(missing, F.lit(default)).otherwise(floors) * storey, "is_estimated": missing}


def zoning(shares: DataFrame, key: str, name: str, share: str, least: float = 0.5) -> DataFrame:
    """The class of the largest share, if it holds at least half."""
    g = shares.groupBy(key).agg(F.max(share).alias("share"), F.max_by(name, F.struct(share, name)).alias("zone"))
    return g.select(key, F.when(F.col("share") >= least, F.col("zone")).alias("zone"), "share")


#: Sites of a leaf of a tour's tree.
LEAF = 32


def _tour(project: str):
    """The task of one project: its sites (project, site_id, rank, score, x, y) in the order of their visit. It needs nothing of this package."""
    leaf = LEAF

    def tree(x, y, sites):
        """Nodes [x0, x1, y0, y1, places left, node above, nodes below, places of a leaf] over sites, the root first, and the leaf of each site."""
        nodes, leaf_of, todo = [], {}, [(sites, None)]
        while todo:
            of, above = todo.pop()
            px, py, me = x[of], y[of], len(nodes)
            nodes.append([float(px.min()), float(px.max()), float(py.min()), float(py.max()), len(of), above, [], None])
            if above is not None:
                nodes[above][6].append(me)
            if len(of) > leaf:
                of = of[(px if px.max() - px.min() >= py.max() - py.min() else py).argsort(kind="stable")]
                todo += [(of[: len(of) // 2], me), (of[len(of) // 2 :], me)]
            else:
                of.sort()
                nodes[me][7] = (of, x[of], y[of])
                leaf_of.update((k, me) for k in of.tolist())
        return nodes, leaf_of

    def nearest(nodes, px, py):
        """The nearest place left, of equally near ones the first."""
        best, at, todo = float("inf"), None, [(0.0, 0)]
        while todo:
            bound, n = todo.pop()
            if bound > best:
                continue
            if nodes[n][7] is not None:
                of, x, y = nodes[n][7]
                d = (x - px) * (x - px) + (y - py) * (y - py)
                k = int(d.argmin())
                if at is None or (d[k], of[k]) < (best, at):
                    best, at = float(d[k]), int(of[k])
                continue
            below = []
            for m in nodes[n][6]:
                x0, x1, y0, y1, left = nodes[m][:5]
                if left:
                    dx, dy = max(x0 - px, px - x1, 0.0), max(y0 - py, py - y1, 0.0)
                    below.append((dx * dx + dy * dy, m))
            todo += sorted(below, reverse=True)
        return at

    def taken(nodes, leaf_of, k):
        n = leaf_of[k]
        of, x, y = nodes[n][7]
        keep = of != k
        nodes[n][7] = (of[keep], x[keep], y[keep])
        while n is not None:
            nodes[n][4] -= 1
            n = nodes[n][5]

    def task(table):
        import numpy as np
        import pyarrow as pa

        table = table.sort_by([("site_id", "ascending"), ("rank", "ascending")])
        x, y = (table[c].to_numpy().astype(float) for c in ("x", "y"))  # NaN: no place
        rank, ids = table["rank"].to_numpy().astype(float), table["site_id"].to_numpy()
        unplaced, score = np.asarray(table["x"].is_null()), table["score"].to_numpy().astype(float)
        first = np.where(np.isnan(score), np.inf, -score)
        out, seen, here = [], set(), None
        for tier in range(3):
            of = np.flatnonzero((rank == tier) & ~unplaced)
            mapped = of[np.isfinite(x[of]) & np.isfinite(y[of])]
            nodes, leaf_of = tree(x, y, mapped.copy()) if len(mapped) else ([], {})
            left, lowest = set(of.tolist()), iter(of.tolist())

            def visit(k):
                left.discard(k)
                if k in leaf_of:
                    taken(nodes, leaf_of, k)
                if ids[k] in seen:
                    return False
                seen.add(ids[k])
                out.append(ids[k])
                return True

            while left:
                if not out:
                    k = int(of[first[of].argmin()])
                elif here is not None and nodes and nodes[0][4]:
                    k = nearest(nodes, *here)
                else:  # nothing to measure from or to
                    k = next(k for k in lowest if k in left)
                if visit(k):
                    here = (float(x[k]), float(y[k])) if k in leaf_of else None
        rest = ids[unplaced]
        order = np.concatenate([np.array(out, np.int64), rest])
        of = pa.repeat(table[project][0], len(order)) if len(order) else table[project].slice(0, 0)
        return pa.table({project: of, "site_id": pa.array(order, pa.int64()), "route_order": pa.array(np.arange(1, len(order) + 1), pa.int64())})

    return task


def routed(sites: DataFrame, project: str) -> DataFrame:
    """(project, site_id, route_order): a tour through each project's sites (project, site_id, tier, score, x, y).

    Each step takes the least remaining site by tier, distance from where the tour stands (at first: highest score) and id; what has no y comes last in its tier, by id. Sites without an x
    are no part of the tour and follow it by id; sites of other tiers are left out of it, those without an id altogether. As each step begins where the last one ended, a project is walked in one task, which
    holds six numbers a site; a step takes about the logarithm of the sites that remain.
    """
    rank = F.when(F.col("tier") == "HIGH", 0).when(F.col("tier") == "MEDIUM", 1).when(F.col("tier") == "LOW", 2)
    s = sites.where(F.col("site_id").isNotNull()).select(project, F.col("site_id").cast("bigint").alias("site_id"), rank.alias("rank"), *(F.col(c).cast("double").alias(c) for c in ("score", "x", "y")))
    of = sites.schema[project].dataType.simpleString()
    # few bytes and much work: a number keeps partitions from being merged by their size
    s = s.repartition(int(sites.sparkSession.conf.get("spark.sql.shuffle.partitions")), project)
    out = s.groupBy(project).applyInArrow(_tour(project), f"`{project}` {of}, site_id bigint, route_order bigint")
    return out.select(project, F.col("site_id").cast(sites.schema["site_id"].dataType).alias("site_id"), "route_order")


def ring_measures(ring: Column) -> dict[str, Column]:
    """Area, centroid and bounds of a closed ring (array of x, y)."""
    n = F.size(ring)
    pairs = F.zip_with(F.slice(ring, F.lit(1), n - 1), F.slice(ring, F.lit(2), n - 1), lambda a, b: F.struct((a.x * b.y - b.x * a.y).alias("w"), (a.x + b.x).alias("sx"), (a.y + b.y).alias("sy")))
    total = lambda f: F.aggregate(pairs, F.lit(0.0), lambda s, p: s + f(p))
    twice = total(lambda p: p.w)
    xs, ys = F.transform(ring, lambda p: p.x), F.transform(ring, lambda p: p.y)
    return {"area": F.abs(twice) / 2, "cx": total(lambda p: p.w * p.sx) / (3 * twice), "cy": total(lambda p: p.w * p.sy) / (3 * twice), "xmin": F.array_min(xs), "ymin": F.array_min(ys), "xmax": F.array_max(xs), "ymax": F.array_max(ys)}


def pending(requested: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """What is requested and not in the manifest as a success with the same keys."""
    return requested.join(manifest.where("status = 'SUCCESS'").select(*keys).distinct(), keys, "left_anti")
