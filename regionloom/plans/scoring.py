"""Queries of choice, scores and set operations over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from regionloom.operators import folds, selection
from regionloom.plans.registry import _I, _MATCH, query
from regionloom.plans.views import gt_boxes, pred_boxes, table


@query(f"SELECT page_id, pos FROM pred WHERE (page_id, pos) NOT IN (SELECT (page_id, pos) FROM (SELECT a.page_id, a.pos FROM pred a JOIN pred b ON a.page_id = b.page_id AND b.w * b.h < a.w * a.h AND 10 * ({_I}) >= 3 * b.w * b.h GROUP BY a.page_id, a.pos HAVING count(*) >= 2))")
def boxes_without_unions(spark, d):
    """Without boxes that cover three tenths of two or more smaller ones (looser than the usual .8: such boxes are rare in this table)."""
    return selection.without_unions(pred_boxes(spark, d), ["page_id"], 3).select("page_id", "pos")


@query("SELECT page_id, pos FROM (SELECT page_id, pos, w * h AS a, count(*) OVER (PARTITION BY page_id) AS n, median(w * h) OVER (PARTITION BY page_id) AS m FROM pred) WHERE NOT (n >= 5 AND m > 0 AND a > 2 * m)")
def boxes_without_outliers(spark, d):
    """Without boxes of over twice the median area, on pages of five boxes or more."""
    return selection.without_area_outliers(pred_boxes(spark, d), ["page_id"], times=2).select("page_id", "pos")


@query("SELECT page_id, category, pos FROM (SELECT page_id, category, pos, row_number() OVER (PARTITION BY page_id, category ORDER BY CASE source WHEN 'vlm_only' THEN 0 ELSE 1 END, pos) AS n FROM pred) WHERE n = 1")
def first_by_source(spark, d):
    """The first box of each page and category by the rank of its source."""
    return selection.first_by(pred_boxes(spark, d), ["page_id", "category"], [F.expr("IF(source = 'vlm_only', 0, 1)"), F.col("pos")]).select("page_id", "category", "pos")


@query("SELECT page_id, pos, category || ' - ' || (page_id % 20) || ' - ' || lpad(n, CAST(greatest(2, length(n)) AS INTEGER), '0') AS name FROM (SELECT page_id, pos, category, CAST(row_number() OVER (PARTITION BY category, page_id % 20 ORDER BY page_id, pos) AS VARCHAR) AS n FROM pred)")
def numbered_names(spark, d):
    """Names counted within category and zone over all pages."""
    rows = pred_boxes(spark, d).selectExpr("page_id", "pos", "category", "CAST(page_id % 20 AS STRING) AS zone")
    return selection.numbered_names(rows, "category", "zone", ["page_id", "pos"]).select("page_id", "pos", "name")


_RUNS = "SELECT page_id, x AS s, x + w AS e, max(x + w) OVER (PARTITION BY page_id ORDER BY x, x + w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM pred"


@query(f"SELECT page_id, min(s) AS \"start\", max(e) AS \"end\", count(*) AS parts FROM (SELECT *, sum(CASE WHEN s <= b + 10 THEN 0 ELSE 1 END) OVER (PARTITION BY page_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM ({_RUNS})) GROUP BY page_id, run")
def merged_spans(spark, d):
    """Horizontal extents of a page, joined over gaps of up to 10 pixels."""
    return selection.merged_intervals(pred_boxes(spark, d).selectExpr("page_id", "x", "x + w AS right"), ["page_id"], "x", "right", 10)


_CAND = "SELECT page_id % 20 AS document, c AS candidate, count(*) FILTER (line % 2 = 0) AS located, count(*) AS predictions FROM pred, (SELECT unnest(range(4)) AS c) WHERE conf_milli >= 200 * c GROUP BY ALL"


@query(f"SELECT document, candidate AS chosen, located, predictions FROM (SELECT r.*, row_number() OVER (PARTITION BY r.document ORDER BY r.l DESC, r.candidate) AS n FROM (SELECT *, sum(located) OVER (PARTITION BY candidate) - located AS l, sum(predictions) OVER (PARTITION BY candidate) - predictions AS p FROM ({_CAND})) r JOIN (SELECT document, sum(located) OVER () - located AS l0, sum(predictions) OVER () - predictions AS p0 FROM ({_CAND}) WHERE candidate = 0) b USING (document) WHERE r.l * p0 >= l0 * r.p) WHERE n = 1")
def held_out_choice(spark, d):
    """Each document under the confidence cut chosen on the other documents."""
    rows = pred_boxes(spark, d).selectExpr("page_id % 20 AS document", "conf_milli", "line", "explode(sequence(0L, 3L)) AS candidate").where("conf_milli >= 200 * candidate")
    return selection.hold_one_out(rows.groupBy("document", "candidate").agg(F.count_if(F.expr("line % 2 = 0")).alias("located"), F.count("*").alias("predictions")))


@query(f"SELECT a.category AS predicted, b.category AS truth, count(*) AS n FROM {_MATCH} JOIN pred a ON a.page_id = q.page_id AND a.pos = q.m.p JOIN gt b ON b.page_id = q.page_id AND b.pos = q.m.g GROUP BY ALL".replace(f"FROM {_MATCH} JOIN", f"FROM {_MATCH} q JOIN"), gt=True)
def category_confusions(spark, d):
    """Categories of matched boxes against those of the ground truth."""
    pred, gt = pred_boxes(spark, d), gt_boxes(spark, d)
    hits = folds.match_greedily(pred, gt, ["page_id"])
    named = hits.join(pred.selectExpr("page_id", "pos AS pred_pos", "category AS predicted"), ["page_id", "pred_pos"]).join(gt.selectExpr("page_id", "pos AS gt_pos", "category AS truth"), ["page_id", "gt_pos"])
    return named.groupBy("predicted", "truth").agg(F.count("*").alias("n"))


_CODES = (("negative", "x < 0 OR y < 0", "error"), ("outside", "x + w > 1000 OR y + h > 800", "error"), ("small", "w * h < 10000", "warning"), ("flat", "w > 3 * h", "warning"), ("unsure", "conf_milli < 300", "info"))


@query(" UNION ALL ".join(f"SELECT '{c}' AS code, '{s}' AS severity, count(*) AS n FROM pred WHERE {e} HAVING count(*) > 0" for c, e, s in _CODES))
def issue_summary(spark, d):
    """All rules that boxes break, counted; a box may break several."""
    found = ", ".join(f"IF({e}, struct('{c}' AS code, '{s}' AS severity), NULL)" for c, e, s in _CODES)
    return pred_boxes(spark, d).selectExpr(f"inline(array_compact(array({found})))").groupBy("code", "severity").agg(F.count("*").alias("n"))


@query("SELECT page_id, round(least(1::DOUBLE, 0.4::DOUBLE * avg(conf_milli) / 1000 + 0.3::DOUBLE * least(1::DOUBLE, count(*) / 4::DOUBLE) + 0.3::DOUBLE * count(*) FILTER (line % 2 = 0) / count(*)), 6) AS score FROM pred GROUP BY page_id")
def review_scores(spark, d):
    """Weighted confidence, density and completeness of each page, least certain pages being for review."""
    return pred_boxes(spark, d).groupBy("page_id").agg(F.expr("round(least(1D, 0.4D * avg(conf_milli) / 1000 + 0.3D * least(1D, count(*) / 4D) + 0.3D * count_if(line % 2 = 0) / count(*)), 6)").alias("score"))


@query("SELECT category, c_nationkey FROM (SELECT DISTINCT p.category, c.c_nationkey % 5 AS c_nationkey FROM pred p JOIN customer c ON p.page_id = c.c_custkey) EXCEPT SELECT DISTINCT 'A', r_regionkey FROM region WHERE r_regionkey < 3")
def missing_groups(spark, d):
    """Groups of one set that another lacks."""
    have = pred_boxes(spark, d).select("page_id", "category").join(table(spark, d, "customer").selectExpr("c_custkey AS page_id", "c_nationkey % 5 AS c_nationkey"), "page_id").select("category", "c_nationkey")
    return have.subtract(table(spark, d, "region").where("r_regionkey < 3").selectExpr("'A' AS category", "r_regionkey AS c_nationkey"))


@query("SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier", pred=False)
def multiset_matches(spark, d):
    """Names taken from a list as often as another list holds them."""
    return table(spark, d, "customer").selectExpr("c_nationkey AS k").intersectAll(table(spark, d, "supplier").selectExpr("s_nationkey AS k"))


def overlaps_resolved(spark, d):
    """Boxes left after overlaps are resolved pair by pair; ground-truth category N is exempt. Tested by hand, without a SQL twin."""
    return selection.resolve_overlaps(pred_boxes(spark, d), ["page_id"], F.col("category") == "N")


query()(overlaps_resolved)
