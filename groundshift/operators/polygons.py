"""Polygons of any shape: coverage of cells, overlays, unions and distances, from edges alone.

A polygon is its rings: ring 0 the outline, further ones holes within it, any direction; no side crosses another. Each edge that is not vertical carries a sign, 1 where the inside lies below it and -1
where it lies above; the sum of the signs of all edges above a point is then 1 inside and 0 outside, and areas are signed sums of what lies below the edges. So an edge is worked on
where it runs, without the rest of its polygon:

* coverage cuts edges at grid columns, integrates them in the cells that they run through, and lets a running sum down each column tell the cells between;
* an overlay needs a sweep only in cells that several shapes cut; there, between the places where edges begin, end, cross or leave the cell, all edges are straight and in one order, so the
  area is width times the height at the middle;
* distances are those of sides that meet in a bucket; the nearest side is found by going down a tree of cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundshift.operators.components import written

SIZE = 10.0
#: Least side of the buckets in which sides meet: with buckets as small as a short reach a side would be in dozens of them.
BUCKET = 16.0
#: Areas below this are rounding.
LEAST = 1e-6


def sides(points: DataFrame, key: str) -> DataFrame:
    """(key, ring, xa, ya, xb, yb): all sides of the rings of points (key, ring, i, x, y); the last point is joined to the first. A ring of fewer than three points has none."""
    ring = Window.partitionBy(key, "ring").orderBy("i")
    whole = Window.partitionBy(key, "ring")
    p = points.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    p = p.withColumns({"xb": F.coalesce(F.lead("x").over(ring), F.first("x").over(ring)), "yb": F.coalesce(F.lead("y").over(ring), F.first("y").over(ring)), "n": F.count(F.lit(1)).over(whole)})
    return p.where("n >= 3 and (x <> xb or y <> yb)").select(key, "ring", F.col("x").alias("xa"), F.col("y").alias("ya"), "xb", "yb")


def edges(points: DataFrame, key: str) -> DataFrame:
    """(key, s, xa, ya, xb, yb) with xa < xb: the sides that are not vertical; s is 1 for those that bound the inside from above and -1 from below."""
    ring = Window.partitionBy(key, "ring")
    turned = F.signum(F.sum(F.col("xa") * F.col("yb") - F.col("xb") * F.col("ya")).over(ring)) * F.when(F.col("ring") == 0, 1).otherwise(-1)
    e = sides(points, key).withColumn("turned", turned).where("xa <> xb")
    ahead = F.col("xa") < F.col("xb")
    pick = lambda a, b: F.when(ahead, F.col(a)).otherwise(F.col(b))
    return e.select(key, F.when(ahead, -F.col("turned")).otherwise(F.col("turned")).cast("int").alias("s"), pick("xa", "xb").alias("xa"), pick("ya", "yb").alias("ya"), pick("xb", "xa").alias("xb"), pick("yb", "ya").alias("yb"))


def measures(points: DataFrame, key: str) -> DataFrame:
    """(key, area, perimeter, x, y): area without holes' parts, length of all rings, and the centre of mass."""
    cross = F.col("xa") * F.col("yb") - F.col("xb") * F.col("ya")
    g = sides(points, key).groupBy(key, "ring").agg(F.sum(cross).alias("a"), F.sum((F.col("xa") + F.col("xb")) * cross).alias("mx"), F.sum((F.col("ya") + F.col("yb")) * cross).alias("my"), F.sum(F.hypot(F.col("xb") - F.col("xa"), F.col("yb") - F.col("ya"))).alias("l"))
    turned = F.signum("a") * F.when(F.col("ring") == 0, 1).otherwise(-1)
    g = g.groupBy(key).agg(*(F.sum(turned * F.col(c)).alias(c) for c in ("a", "mx", "my")), F.sum("l").alias("perimeter"))
    return g.select(key, (F.col("a") / 2).alias("area"), "perimeter", F.try_divide("mx", 3 * F.col("a")).alias("x"), F.try_divide("my", 3 * F.col("a")).alias("y"))


def pieces(edge: DataFrame, size: float = SIZE) -> DataFrame:
    """edge cut at the borders of grid columns, with c and the rows lo to hi that each piece runs through."""
    first, last = F.floor(F.col("xa") / size).cast("int"), F.ceil(F.col("xb") / size).cast("int") - 1
    e = edge.withColumns({"c": F.explode(F.sequence(first, F.greatest(first, last))), "__k": (F.col("yb") - F.col("ya")) / (F.col("xb") - F.col("xa"))})
    x0, x1 = F.greatest("xa", F.col("c") * F.lit(size)), F.least("xb", (F.col("c") + 1) * F.lit(size))
    e = e.withColumns({"x0": x0, "x1": x1}).withColumns({"y0": F.col("ya") + (F.col("x0") - F.col("xa")) * F.col("__k"), "y1": F.when(F.col("x1") == F.col("xb"), F.col("yb")).otherwise(F.col("ya") + (F.col("x1") - F.col("xa")) * F.col("__k"))})
    lo = F.floor(F.least("y0", "y1") / size).cast("int")
    hi = F.greatest(lo, F.ceil(F.greatest("y0", "y1") / size).cast("int") - 1)
    rest = [x for x in edge.columns if x not in ("xa", "ya", "xb", "yb")]
    return e.where("x1 > x0").select(*rest, "c", F.col("x0").alias("xa"), F.col("y0").alias("ya"), F.col("x1").alias("xb"), F.col("y1").alias("yb"), lo.alias("lo"), hi.alias("hi"))


def _below(base: Column, size: float) -> Column:
    """Area between base and base + size below a piece."""
    u, v, wide = F.col("ya") - base, F.col("yb") - base, F.col("xb") - F.col("xa")
    held = lambda t: F.greatest(F.lit(0.0), F.least(F.lit(size), t))
    total = lambda t: held(t) * held(t) / 2 + size * F.greatest(F.lit(0.0), t - size)
    return wide * F.when(F.abs(v - u) < 1e-9, held((u + v) / 2)).otherwise((total(v) - total(u)) / (v - u))


def covered(piece: DataFrame, key: list[str], size: float = SIZE, least: float = LEAST) -> DataFrame:
    """(key, r, c, area): exact area of each polygon in each cell. Work grows with outlines and with cells that are covered, not with edges times cells."""
    p = piece.withColumn("r", F.explode(F.sequence(F.col("lo") - 1, F.col("hi"))))
    own = F.when(F.col("r") >= F.col("lo"), F.col("s") * _below(F.col("r") * F.lit(size), size)).otherwise(F.lit(0.0))
    full = F.when(F.col("r") < F.col("lo"), F.col("s") * (F.col("xb") - F.col("xa")) * size).otherwise(F.lit(0.0))
    g = p.select(*key, "c", "r", own.alias("own"), full.alias("full")).groupBy(*key, "c", "r").agg(F.sum("own").alias("own"), F.sum("full").alias("full"))
    down = Window.partitionBy(*key, "c").orderBy(F.desc("r"))
    g = g.withColumns({"run": F.sum("full").over(down.rowsBetween(Window.unboundedPreceding, 0)), "next": F.lead("r").over(down)})
    here = F.array(F.struct(F.col("r").alias("r"), (F.col("own") + F.col("run")).alias("area")))
    between = F.when((F.col("run") > least) & (F.col("next") < F.col("r") - 1), F.transform(F.sequence(F.col("next") + 1, F.col("r") - 1), lambda r: F.struct(r.alias("r"), F.col("run").alias("area"))))
    g = g.select(*key, "c", F.explode(F.concat(here, F.coalesce(between, F.array().cast("array<struct<r:int,area:double>>")))).alias("x"))
    return g.select(*key, F.col("x.r").alias("r"), "c", F.least(F.col("x.area"), F.lit(size * size)).alias("area")).where(F.col("area") > least)


#: Pieces of a task that sweeps cells.
TASK_PIECES = 40_000


def swept(piece: DataFrame, by: list[str], size: float = SIZE) -> DataFrame:
    """(by, r, c, a, b, both, either): areas inside of layer 0, of layer 1, of both and of one at least, in cells that pieces (by, r, c, layer, s, xa, ya, xb, yb) cut or lie above."""
    cell = [*by, "r", "c"]
    base = F.col("r") * F.lit(size)
    p = written(piece.withColumn("__k", (F.col("yb") - F.col("ya")) / (F.col("xb") - F.col("xa"))))
    # dealt by cell once, into as many tasks as the pieces need; all that follows keeps this partitioning
    p = p.repartition(1 + p.count() // TASK_PIECES, *cell)
    leaves = lambda y: F.when((F.col("ya") - y) * (F.col("yb") - y) < 0, F.col("xa") + (y - F.col("ya")) / F.col("__k"))
    line = ("xa", "ya", "xb", "yb")
    one = p.select(*cell, *line, "__k").distinct()
    q = one.join(one.select(*cell, *(F.col(x).alias(f"{x}_") for x in (*line, "__k"))), cell)
    here, there = F.struct(*line), F.struct(*(F.col(f"{x}_").alias(x) for x in line))
    lo, hi = F.greatest("xa", "xa_"), F.least("xb", "xb_")
    gap = lambda x: F.col("ya") + (x - F.col("xa")) * F.col("__k") - F.col("ya_") - (x - F.col("xa_")) * F.col("__k_")
    q = q.where((here <= there) & (lo < hi)).withColumns({"d0": gap(lo), "d1": gap(hi), "own": here == there})
    crossing = F.when(F.col("d0") * F.col("d1") < 0, lo + (hi - lo) * F.col("d0") / (F.col("d0") - F.col("d1")))
    # a piece that meets itself tells its own places
    x = F.when(F.col("own"), F.array("xa", "xb", leaves(base), leaves(base + size))).otherwise(F.array(crossing))
    xs = q.select(*cell, F.explode(x).alias("x")).where("x is not null").groupBy(*cell).agg(F.array_sort(F.collect_set("x")).alias("xs"))
    slab = F.explode(F.zip_with(F.slice("xs", F.lit(1), F.size("xs") - 1), F.slice("xs", F.lit(2), F.size("xs") - 1), lambda x, y: F.struct(x.alias("lo"), y.alias("hi"))))
    slabs = xs.select(*cell, slab.alias("slab")).where("slab.hi > slab.lo")
    middle = (F.col("slab.lo") + F.col("slab.hi")) / 2
    j = slabs.join(p, cell).where((F.col("xa") <= middle) & (F.col("xb") >= middle))
    y = F.greatest(base, F.least(base + size, F.col("ya") + (middle - F.col("xa")) * F.col("__k")))
    j = j.select(*cell, "slab", "layer", "s", y.alias("y"))
    down = Window.partitionBy(*cell, "slab").orderBy(F.desc("y"), "layer", "s")
    so_far = down.rowsBetween(Window.unboundedPreceding, 0)
    inside = lambda k: F.sum(F.when(F.col("layer") == k, F.col("s")).otherwise(0)).over(so_far) > 0
    j = j.withColumns({"high": F.col("y") - F.coalesce(F.lead("y").over(down), base), "in_a": inside(0), "in_b": inside(1)})
    part = lambda m: F.sum(F.when(m, F.col("high") * (F.col("slab.hi") - F.col("slab.lo"))).otherwise(0.0))
    return j.groupBy(*cell).agg(part(F.col("in_a")).alias("a"), part(F.col("in_b")).alias("b"), part(F.col("in_a") & F.col("in_b")).alias("both"), part(F.col("in_a") | F.col("in_b")).alias("either"))


class Shapes:
    """A layer of polygons: its points, its edges cut at columns, and what they cover of each cell; written once, used by every overlay."""

    def __init__(self, points: DataFrame, key: str, size: float = SIZE):
        self.key, self.size, self.points = key, size, points
        self.pieces = written(pieces(edges(points, key), size))
        self.cover = written(covered(self.pieces, [key], size))

    def renamed(self, key: str) -> Shapes:
        """The same layer under another name of its key, to be joined with itself."""
        other = object.__new__(Shapes)
        other.key, other.size = key, self.size
        other.points, other.pieces, other.cover = (d.withColumnRenamed(self.key, key) for d in (self.points, self.pieces, self.cover))
        return other

    def centres(self) -> DataFrame:
        """(key, r, c): cells whose centre lies in a polygon."""
        full = self.size**2 - LEAST
        x, y = (F.col("c") + 0.5) * self.size, (F.col("r") + 0.5) * self.size
        j = self.cover.where(F.col("area") < full).select(self.key, "r", "c").join(self.pieces, [self.key, "c"]).where((F.col("xa") <= x) & (x < F.col("xb")))
        above = F.col("ya") + (F.col("yb") - F.col("ya")) / (F.col("xb") - F.col("xa")) * (x - F.col("xa")) > y
        cut = j.where(above).groupBy(self.key, "r", "c").agg(F.sum("s").alias("s")).where("s > 0").select(self.key, "r", "c")
        return self.cover.where(F.col("area") >= full).select(self.key, "r", "c").union(cut)

    def cutting(self, cells: DataFrame, by: list[str], layer: int) -> DataFrame:
        """Pieces of the polygons of cells (by, key, r, c) that run through these cells or above."""
        p = cells.join(self.pieces, [self.key, "c"]).where(F.col("hi") >= F.col("r"))
        return p.select(*by, "r", "c", F.lit(layer).alias("layer"), "s", "xa", "ya", "xb", "yb")


def _summed(cover: DataFrame, by: list[str], full: float, name: str) -> DataFrame:
    """By cell: how many polygons lie in it, whether one fills it, and the area of the only one."""
    g = cover.groupBy(*by, "r", "c").agg(F.count(F.lit(1)).alias("n"), F.max("area").alias("most"))
    return g.select(*by, "r", "c", F.when(F.col("most") >= full - LEAST, F.lit(full)).when(F.col("n") == 1, F.col("most")).alias(name))


def union_area(shapes: Shapes, groups: DataFrame, group: str) -> DataFrame:
    """(group, area_sum, area_union): the areas of the polygons of each group (key, group) added up, and without double counting."""
    full = shapes.size**2
    cover = written(shapes.cover.join(groups.select(shapes.key, group), shapes.key))
    told = written(_summed(cover, [group], full, "area"))
    open_cells = cover.join(told.where("area is null").select(group, "r", "c"), [group, "r", "c"])
    more = swept(shapes.cutting(open_cells, [group], 0), [group], shapes.size).select(group, F.col("a").alias("area"))
    whole = told.where("area is not null").select(group, "area").union(more).groupBy(group).agg(F.sum("area").alias("area_union"))
    return cover.groupBy(group).agg(F.sum("area").alias("area_sum")).join(whole, group)


def overlaid(a: Shapes, b: Shapes) -> DataFrame:
    """(key of a, r, c, area, both): what each polygon of a covers of a cell, and how much of that lies in any polygon of b."""
    full, key = a.size**2, a.key
    of_b = written(_summed(b.cover, [], full, "b"))
    j = written(a.cover.join(of_b.withColumn("met", F.lit(True)), ["r", "c"], "left"))
    whole = F.col("area") >= full - LEAST
    both = F.when(F.col("met").isNull(), F.lit(0.0)).when(F.col("b") >= full - LEAST, F.col("area")).when(whole & F.col("b").isNotNull(), F.col("b"))
    j = j.withColumn("both", both)
    unsure = written(j.where("both is null").select(key, "r", "c"))
    of_a = a.cutting(unsure, [key], 0)
    other = b.cover.select(F.col(b.key).alias("__b"), "r", "c").join(unsure, ["r", "c"])
    cut_b = other.join(b.pieces.withColumnRenamed(b.key, "__b"), ["__b", "c"]).where(F.col("hi") >= F.col("r"))
    told = swept(of_a.union(cut_b.select(key, "r", "c", F.lit(1).alias("layer"), "s", "xa", "ya", "xb", "yb")), [key], a.size).select(key, "r", "c", F.col("both").alias("swept"))
    return j.join(told, [key, "r", "c"], "left").select(key, "r", "c", "area", F.coalesce("both", "swept", F.lit(0.0)).alias("both"))


def overlaps(a: Shapes, b: Shapes) -> DataFrame:
    """(key of a, key of b, overlap): area of each pair of polygons that share some."""
    full = a.size**2
    ka, kb = a.key, b.key
    j = written(a.cover.select(ka, "r", "c", F.col("area").alias("of_a")).join(b.cover.select(kb, "r", "c", F.col("area").alias("of_b")), ["r", "c"]))
    known = F.when(F.col("of_a") >= full - LEAST, F.col("of_b")).when(F.col("of_b") >= full - LEAST, F.col("of_a"))
    j = j.withColumn("both", known)
    unsure = written(j.where("both is null").select(ka, kb, "r", "c"))
    told = swept(a.cutting(unsure, [ka, kb], 0).union(b.cutting(unsure, [ka, kb], 1)), [ka, kb], a.size).select(ka, kb, "both")
    out = j.where("both is not null").select(ka, kb, "both").union(told).groupBy(ka, kb).agg(F.sum("both").alias("overlap"))
    return out.where(F.col("overlap") > LEAST)


def side_distance() -> Column:
    """Distance of the sides (xa, ya)-(xb, yb) and (pa, qa)-(pb, qb): zero where they cross, else from an end of one to the other."""

    def to_side(x: str, y: str, xa: str, ya: str, xb: str, yb: str) -> Column:
        dx, dy = F.col(xb) - F.col(xa), F.col(yb) - F.col(ya)
        along = ((F.col(x) - F.col(xa)) * dx + (F.col(y) - F.col(ya)) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(along, F.lit(0.0))))
        ex, ey = F.col(x) - F.col(xa) - t * dx, F.col(y) - F.col(ya) - t * dy
        return F.sqrt(ex * ex + ey * ey)

    def turn(x: str, y: str, xa: str, ya: str, xb: str, yb: str) -> Column:
        return (F.col(xb) - F.col(xa)) * (F.col(y) - F.col(ya)) - (F.col(yb) - F.col(ya)) * (F.col(x) - F.col(xa))

    one, two = ("xa", "ya", "xb", "yb"), ("pa", "qa", "pb", "qb")
    cross = (turn("pa", "qa", *one) * turn("pb", "qb", *one) < 0) & (turn("xa", "ya", *two) * turn("xb", "yb", *two) < 0)
    return F.when(cross, F.lit(0.0)).otherwise(F.least(to_side("pa", "qa", *one), to_side("pb", "qb", *one), to_side("xa", "ya", *two), to_side("xb", "yb", *two)))


def measured(pairs: DataFrame) -> DataFrame:
    """pairs of sides with distance, that of side_distance(), worked out column by column: as one expression its parts are repeated in each other, and code that long is not compiled.

    A filter of the distance would put them together again; put it behind an aggregation.
    """
    ends = (("pa", "qa", "x"), ("pb", "qb", "x"), ("xa", "ya", "p"), ("xb", "yb", "p"))  # an end, and the side that it is measured to
    of = {"x": ("xa", "ya", "__dx", "__dy"), "p": ("pa", "qa", "__ex", "__ey")}
    d = pairs.withColumns({"__dx": F.col("xb") - F.col("xa"), "__dy": F.col("yb") - F.col("ya"), "__ex": F.col("pb") - F.col("pa"), "__ey": F.col("qb") - F.col("qa")})
    long = lambda u, v: F.nullif(F.col(u) * F.col(u) + F.col(v) * F.col(v), F.lit(0.0))
    d = d.withColumns({"__lx": long("__dx", "__dy"), "__lp": long("__ex", "__ey")})
    # from the beginning of the side to the end
    d = d.withColumns({f"__{c}{i}": F.col(end) - F.col(of[to][k]) for i, (x, y, to) in enumerate(ends) for k, (c, end) in enumerate((("u", x), ("v", y)))})
    d = d.withColumns({f"__t{i}": F.coalesce((F.col(f"__u{i}") * F.col(of[to][2]) + F.col(f"__v{i}") * F.col(of[to][3])) / F.col(f"__l{to}"), F.lit(0.0)) for i, (_, _, to) in enumerate(ends)})
    d = d.withColumns({f"__t{i}": F.greatest(F.lit(0.0), F.least(F.lit(1.0), f"__t{i}")) for i in range(4)})
    d = d.withColumns({f"__{c}_{i}": F.col(f"__{c}{i}") - F.col(f"__t{i}") * F.col(of[to][k]) for i, (_, _, to) in enumerate(ends) for k, c in ((2, "u"), (3, "v"))})
    d = d.withColumns({f"__d{i}": F.col(f"__u_{i}") * F.col(f"__u_{i}") + F.col(f"__v_{i}") * F.col(f"__v_{i}") for i in range(4)})
    turn = lambda i, to: F.col(of[to][2]) * F.col(f"__v{i}") - F.col(of[to][3]) * F.col(f"__u{i}")
    cross = (turn(0, "x") * turn(1, "x") < 0) & (turn(2, "p") * turn(3, "p") < 0)
    return d.withColumn("distance", F.when(cross, F.lit(0.0)).otherwise(F.sqrt(F.least(*(f"__d{i}" for i in range(4)))))).select(*pairs.columns, "distance")


def _bucketed(side: DataFrame, reach: float, around: float) -> DataFrame:
    """side with the buckets (bx, by) of reach a side that it runs through, widened by around; long sides are cut at columns first, so that no bucket off the side is taken."""
    low, high = F.least("xa", "xb"), F.greatest("xa", "xb")
    cut = lambda x: F.floor(x / reach).cast("int")
    s = side.withColumn("bx", F.explode(F.sequence(cut(low - around), cut(high + around))))
    k = (F.col("yb") - F.col("ya")) / F.nullif(F.col("xb") - F.col("xa"), F.lit(0.0))
    at = lambda x: F.when(k.isNull(), F.lit(None)).otherwise(F.col("ya") + (F.greatest(low, F.least(high, x)) - F.col("xa")) * k)
    left, right = at(F.col("bx") * reach - around), at((F.col("bx") + 1) * reach + around)
    lo, hi = F.coalesce(F.least(left, right), F.least("ya", "yb")), F.coalesce(F.greatest(left, right), F.greatest("ya", "yb"))
    return s.withColumn("by", F.explode(F.sequence(cut(lo - around), cut(hi + around))))


def near_sides(a: DataFrame, b: DataFrame, reach: float, keep: list[str]) -> DataFrame:
    """Columns keep of both and distance, the least of their sides that are not farther apart than reach. b's sides are (pa, qa, pb, qb)."""
    size = max(reach, BUCKET)
    other = b.select(*(F.col(x) for x in b.columns if x not in ("pa", "qa", "pb", "qb")), F.col("pa").alias("xa"), F.col("qa").alias("ya"), F.col("pb").alias("xb"), F.col("qb").alias("yb"))
    other = _bucketed(other, size, 0.0)
    other = other.select(*(x for x in other.columns if x not in ("xa", "ya", "xb", "yb")), F.col("xa").alias("pa"), F.col("ya").alias("qa"), F.col("xb").alias("pb"), F.col("yb").alias("qb"))
    apart = lambda u, v, p, q: F.greatest(F.least(u, v) - F.greatest(p, q), F.least(p, q) - F.greatest(u, v))
    # boxes tell most pairs before their distance is worked out; a thousandth more than reach lets rounding tell none
    boxes = (apart("xa", "xb", "pa", "pb") <= reach * 1.001) & (apart("ya", "yb", "qa", "qb") <= reach * 1.001)
    j = _bucketed(a, size, reach).join(other, ["bx", "by"]).where(boxes)
    return measured(j).groupBy(*keep).agg(F.min("distance").alias("distance")).where(F.col("distance") <= reach)


#: Sides of a task that looks for the nearest ones.
TASK_SIDES = 10_000


def nearest_side(a: DataFrame, b: DataFrame, key: str, names: list[str], reach: float = 64.0) -> DataFrame:
    """(key, distance, names): of each key of a (key, xa, ya, xb, yb) the nearest side of b (names, pa, qa, pb, qb), ties to the least names; NULL if b is empty.

    The sides of b lie in cells of size reach by their middles, these in cells four times as large, and so on up to a few; a cell has the box of its sides. The sides of a go down from the
    largest cells: a cell is left out if its box begins farther from the side than another one's ends from a side of the same key. Only the sides of b that are left at the end are measured, so work
    grows with a and with the sides that compete for the nearest place, however far away that is; tasks grow in number with a, not in size.
    """
    cell = lambda u, v: F.floor((F.col(u) + F.col(v)) / (2 * reach)).cast("bigint")
    side = written(b.where("pa is not null and qa is not null and pb is not null and qb is not null").select(*names, "pa", "qa", "pb", "qb", cell("pa", "pb").alias("cx"), cell("qa", "qb").alias("cy")))
    ends = {"lx": F.least("pa", "pb"), "ly": F.least("qa", "qb"), "hx": F.greatest("pa", "pb"), "hy": F.greatest("qa", "qb")}
    box = lambda of: [(F.min if x[0] == "l" else F.max)(of.get(x, F.col(x))).alias(x) for x in ends]
    leaf = written(side.groupBy("cx", "cy").agg(*box(ends)))
    whole = leaf.agg(*box({})).first()
    keys = a.select(key).distinct()
    if whole["lx"] is None:
        return keys.select(key, F.lit(None).cast("double").alias("distance"), *(F.lit(None).cast(b.schema[n].dataType).alias(n) for n in names))
    top = 0
    while reach * 4**top < max(whole["hx"] - whole["lx"], whole["hy"] - whole["ly"]):
        top += 1

    def level(i: int) -> DataFrame:
        """Cells of reach * 4^i and the cells (px, py) that they lie in."""
        up = lambda x, n: F.shiftright(x, 2 * n)
        g = leaf.groupBy(up("cx", i).alias("cx"), up("cy", i).alias("cy")).agg(*box({})) if i else leaf
        return g.withColumns({"px": up("cx", 1), "py": up("cy", 1)})

    square = lambda x, y: x * x + y * y
    gap = lambda u, v, lo, hi: F.greatest(F.lit(0.0), F.col(lo) - F.greatest(u, v), F.least(u, v) - F.col(hi))
    far = lambda u, v, lo, hi: F.greatest(F.col(hi) - F.least(u, v), F.greatest(u, v) - F.col(lo))
    least, most = (square(f("xa", "xb", "lx", "hx"), f("ya", "yb", "ly", "hy")) for f in (gap, far))
    ends_apart = F.least(*(square(F.col(f"x{m}") - F.col(f"p{n}"), F.col(f"y{m}") - F.col(f"q{n}")) for m in "ab" for n in "ab"))

    def nearer(d: DataFrame, most: Column) -> DataFrame:
        """d without boxes that begin farther away than another one of the key surely reaches (most)."""
        d = d.withColumns({"__least": least, "__most": F.min(most).over(Window.partitionBy(key))})
        # a billionth more, so that rounding leaves out none
        return d.where(F.col("__least") <= F.col("__most") * 1.000000001).drop("__least", "__most")

    own = a.select(key, "xa", "ya", "xb", "yb")
    sides_ = [key, "xa", "ya", "xb", "yb"]
    parts = 1 + a.count() // TASK_SIDES
    at = nearer(own.repartition(parts, key).crossJoin(F.broadcast(level(top).drop("px", "py"))), most)
    for i in range(top, -1, -1):
        below = level(i - 1) if i else side.select(*names, "pa", "qa", "pb", "qb", *(x.alias(n) for n, x in ends.items()), F.col("cx").alias("px"), F.col("cy").alias("py"))
        at = nearer(at.select(*sides_, F.col("cx").alias("px"), F.col("cy").alias("py")).join(below, ["px", "py"]).drop("px", "py"), most if i else ends_apart)
    told = at.select(key, *names, side_distance().alias("distance")).groupBy(key, *names).agg(F.min("distance").alias("distance"))
    told = told.groupBy(key).agg(F.min(F.struct("distance", *names)).alias("m")).select(key, "m.*")
    return keys.join(told, key, "left")


def covering(corners: DataFrame, b: Shapes) -> DataFrame:
    """corners (x, y and more) with the polygons of b that cover some of their cell."""
    at = corners.withColumns({"r": F.floor(F.col("y") / b.size).cast("int"), "c": F.floor(F.col("x") / b.size).cast("int")})
    return at.join(b.cover.select(b.key, "r", "c"), ["r", "c"])


def corners_inside(corners: DataFrame, key: str, b: Shapes) -> DataFrame:
    """(key, key of b) of corners (key, x, y) that lie inside of a polygon of b: more sides end the inside above the corner than begin it. A corner meets the polygons of its cell only, not all of its column."""
    j = covering(corners, b).join(b.pieces, [b.key, "c"]).where((F.col("xa") <= F.col("x")) & (F.col("x") < F.col("xb")))
    above = F.col("ya") + (F.col("yb") - F.col("ya")) / (F.col("xb") - F.col("xa")) * (F.col("x") - F.col("xa")) > F.col("y")
    return j.where(above).groupBy(key, b.key).agg(F.sum("s").alias("s")).where("s > 0").select(key, b.key)


def touching(a: Shapes, b: Shapes, reach: float) -> DataFrame:
    """(key of a, key of b, distance): pairs of polygons not farther apart than reach; zero where they share area."""
    own, other = sides(a.points, a.key), sides(b.points, b.key)
    near = near_sides(own.drop("ring"), other.select(b.key, F.col("xa").alias("pa"), F.col("ya").alias("qa"), F.col("xb").alias("pb"), F.col("yb").alias("qb")), reach, [a.key, b.key])
    # of two polygons whose sides are far from each other one lies in the other if a corner does
    corner = lambda s, key: s.groupBy(key).agg(F.min(F.struct("xa", "ya")).alias("p")).select(key, F.col("p.xa").alias("x"), F.col("p.ya").alias("y"))
    inner = corners_inside(corner(own, a.key), a.key, b).union(corners_inside(corner(other, b.key), b.key, a).select(a.key, b.key))
    return near.union(inner.select(a.key, b.key, F.lit(0.0).alias("distance"))).groupBy(a.key, b.key).agg(F.min("distance").alias("distance"))
