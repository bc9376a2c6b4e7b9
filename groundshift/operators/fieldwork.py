"""What a field team gets: which buildings to look at closely and in which zones, what to check at a site, and the sheet to fill in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundshift.operators import polygons as pg
from groundshift.operators.components import components, written

#: What to check for each kind of change, further remarks, the text where nothing stands out.
FOCUS = {
    "NEW_BUILDING": "신축 여부 및 착공·사용승인 이력 확인",
    "EXPANSION_OR_RECONSTRUCTION": "증축·개축 범위와 허가 범위 일치 여부 확인",
    "DEMOLITION": "철거 여부 및 멸실신고 이력 확인 (근거가 약한 판정이므로 존치 여부부터 확인)",
    "OTHER_CHANGE": "토지 형질변경·야적·가설물 등 지장물 발생 여부 확인",
}
UNMATCHED = "건축물대장 미매칭 - 무허가 또는 미등록 여부 확인 필요"
DIRECTION = ("밝기 변화 방향 불일치 ", "건 - 자동판정 신뢰도 낮음, 육안 확인 필수")
BASELINE = "보상 기준일 이후 변화로 추정되며 행정근거 미확인 - 보상 실무 확인 우선"
STRONG = "복수 증거가 일치하는 무허가 의심 - 지자체 건축과 협의 검토"
MANY = ("후보 ", "건이 한 현장에 몰려 있음 - 1회 방문으로 일괄 확인 가능")
PLAIN = "변화 내용 육안 확인"
#: Columns of the sheet; those without a source are filled in by hand.
SHEET = {
    "route_order": "방문순서", "site_priority": "우선순위", "site_id": "현장ID", "dominant_type": "주요변화유형", "candidates": "후보건수", "buildings": "건물수", "area": "변화면적(m2)", "pnu_list": "관련필지PNU",
    "x": "X_EPSG5186", "y": "Y_EPSG5186", "status": "보상기준일판정", "grade": "무허가의심등급", "matched": "대장매칭건수", "flagged": "방향불일치건수", "focus": "현장확인사항",
}
BY_HAND = ["현장판정(기입)", "사진촬영(기입)", "조사자(기입)", "조사일자(기입)", "비고(기입)"]


def for_review(candidates: DataFrame) -> DataFrame:
    """Candidates that meet any criterion whose columns are there: no register record but high priority (matched, inspection_priority), brightness against the change (consistent),
    an expansion with known floors (change_type, floors), after the baseline without proof (status). Without any of these columns there is nothing to select."""
    have = set(candidates.columns)
    rules = {
        ("matched", "inspection_priority"): lambda: ~F.col("matched") & (F.col("inspection_priority") == "HIGH"), ("consistent",): lambda: ~F.col("consistent"),
        ("change_type", "floors"): lambda: (F.col("change_type") == "EXPANSION_OR_RECONSTRUCTION") & F.col("floors").isNotNull(), ("status",): lambda: F.col("status") == "POST_BASELINE_UNVERIFIED",
    }
    met = [F.coalesce(rule(), F.lit(False)) for needs, rule in rules.items() if have.issuperset(needs)]
    return candidates.where(reduce(Column.__or__, met, F.lit(False)))


def review_zones(shapes: pg.Shapes, buffer: float, size: float = 2.0) -> DataFrame:
    """(zone, members, area_m2): polygons with a buffer around them, those whose buffers touch made one. A zone is named by its least key.

    The area is that of cells of size a side whose centre lies in the buffer or the polygon, each once a zone: sides paint the cells that they reach, so work grows with outlines and area.
    """
    key = shapes.key
    pairs = written(pg.touching(shapes, shapes.renamed("__other"), 2 * buffer).where(F.col(key) < F.col("__other")).select(F.col(key).alias("a"), F.col("__other").alias("b")))
    zone = written(components(shapes.points.select(F.col(key).alias("node")).distinct(), pairs).select(F.col("node").alias(key), F.col("label").alias("zone")))
    cut = lambda x: F.floor(x / size).cast("int")
    span = lambda a, b: F.sequence(cut(F.least(a, b) - buffer), cut(F.greatest(a, b) + buffer))
    s = pg.sides(shapes.points, key).withColumn("c", F.explode(span("xa", "xb"))).withColumn("r", F.explode(span("ya", "yb")))
    x, y, dx, dy = (F.col("c") + 0.5) * size, (F.col("r") + 0.5) * size, F.col("xb") - F.col("xa"), F.col("yb") - F.col("ya")
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - F.col("xa")) * dx + (y - F.col("ya")) * dy) / (dx * dx + dy * dy)))
    far = F.sqrt(F.pow(x - F.col("xa") - t * dx, F.lit(2)) + F.pow(y - F.col("ya") - t * dy, F.lit(2)))
    near = s.where(F.round(far, 9) <= buffer).select(key, "r", "c")
    inner = pg.Shapes(shapes.points, key, size).centres().select(key, "r", "c")
    painted = near.union(inner).join(zone, key).select("zone", "r", "c").distinct().groupBy("zone").agg((F.count(F.lit(1)) * size * size).alias("area_m2"))
    members = zone.groupBy("zone").agg(F.count(F.lit(1)).alias("members"))
    return members.join(painted, "zone", "left").select("zone", "members", F.coalesce("area_m2", F.lit(0.0)).alias("area_m2"))


def survey_focus(kind: Column, candidates: Column, matched: Column, flagged: Column, status: Column, grade: Column) -> Column:
    """What to check at a site, of at most 400 characters: by its main kind of change, then what makes its verdict weak or urgent."""
    first = reduce(lambda a, kv: a.when(kind == kv[0], kv[1]), list(FOCUS.items())[1:], F.when(kind == next(iter(FOCUS)), next(iter(FOCUS.values()))))
    counted = lambda n, around: F.concat(F.lit(around[0]), n.cast("string"), F.lit(around[1]))
    text = F.concat_ws(
        " / ", first, F.when((matched == 0) & (candidates > 0), UNMATCHED), F.when(flagged > 0, counted(flagged, DIRECTION)), F.when(status == "POST_BASELINE_UNVERIFIED", BASELINE),
        F.when(grade == "A_STRONG", STRONG), F.when(candidates >= 5, counted(candidates, MANY)),
    )
    return F.when(text == "", PLAIN).otherwise(F.substring(text, 1, 400))


def work_order(sites: DataFrame) -> DataFrame:
    """The sheet of sites: labelled columns, texts blank where unknown, and columns to fill in by hand. Sites off the route come last by their id."""
    text = {f.name for f in sites.schema if f.dataType.simpleString() == "string"}
    named = [(F.coalesce(n, F.lit("")) if n in text else F.col(n)).alias(label) for n, label in SHEET.items()]
    return sites.orderBy(F.asc_nulls_last("route_order"), "site_id").select(*named, *(F.lit("").alias(label) for label in BY_HAND))
