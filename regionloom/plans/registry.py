"""All queries of the library by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionloom.functions import boxes as B
from regionloom.functions import text as T
from regionloom.operators import filters, folds, joins
from regionloom.plans.views import GT_SQL, HEIGHT, PRED_SQL, WIDTH, gt_boxes, pred_boxes, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, gt: bool = False, pred: bool = True):
    """Registers a query under its name; ``sql`` sees the views pred and gt where asked for."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE_SQL[function.__name__] = (f"WITH {PRED_SQL}{', ' + GT_SQL if gt else ''} " if pred else "") + sql
        return function

    return register


_I = "greatest(least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x), 0) * greatest(least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y), 0)"
_KI = _I.replace("a.", "k.").replace("b.", "r.")
_FOLD = "list_reduce(list({{o: {order}, pos: pos, x: x, y: y, w: w, h: h}} ORDER BY {order}, pos), lambda acc, r: CASE WHEN len(list_filter(acc, lambda k: 10 * ({i}) {op} {t} * (k.w * k.h + r.w * r.h - ({i})))) > 0 THEN acc ELSE list_append(acc, r) END, []::STRUCT(o BIGINT, pos BIGINT, x BIGINT, y BIGINT, w BIGINT, h BIGINT)[])"


@query(f"SELECT page_id, u.pos AS pos FROM (SELECT page_id, unnest({_FOLD.format(order='-conf_milli', i=_KI, op='>=', t=3)}) AS u FROM pred GROUP BY page_id)")
def nms_kept_boxes(spark, d):
    """Suppression at IoU .3 by confidence, all categories of a page together."""
    return folds.suppress(pred_boxes(spark, d), ["page_id"])


@query(f"SELECT page_id, category, u.pos AS pos FROM (SELECT page_id, category, unnest({_FOLD.format(order='-w * h', i=_KI, op='>', t=5)}) AS u FROM pred GROUP BY page_id, category)")
def nms_by_area_within_category(spark, d):
    """Suppression strictly above IoU .5, the largest first, within each category."""
    return folds.suppress(pred_boxes(spark, d), ["page_id", "category"], 5, True, "-w * h")


@query("SELECT page_id, reason, count(*) AS n FROM (SELECT page_id % 100 AS page_id, CASE WHEN x < 0 OR y < 0 THEN 'negative' WHEN w <= 0 OR h <= 0 THEN 'zero_area' WHEN x >= 1000 OR y >= 800 THEN 'outside' WHEN x + w > 1000 OR y + h > 800 THEN 'out_of_bounds' WHEN w * h < 10000 THEN 'small' WHEN w > 8 * h THEN 'flat' WHEN conf_milli < 500 THEN 'low_confidence' ELSE 'kept' END AS reason FROM pred) GROUP BY ALL")
def filter_drop_account(spark, d):
    """First broken rule of each box, counted."""
    return filters.drop_account(pred_boxes(spark, d).withColumn("page_id", F.expr("page_id % 100")), ["page_id"], filters.drop_reason(WIDTH, HEIGHT, 10_000, 500))


@query("SELECT page_id, pos, greatest(x, 0) AS x, greatest(y, 0) AS y, least(x + w, 600) - greatest(x, 0) AS w, least(y + h, 500) - greatest(y, 0) AS h FROM gt WHERE least(x + w, 600) > greatest(x, 0) AND least(y + h, 500) > greatest(y, 0)", gt=True)
def clamp_boxes(spark, d):
    """Boxes cut to a smaller page."""
    return filters.clamp(gt_boxes(spark, d), 600, 500).select("page_id", "pos", "x", "y", "w", "h")


@query("SELECT page_id, pos, round(x / 1000.0::DOUBLE, 6) AS nx, round(y / 800.0::DOUBLE, 6) AS ny, round(w / 1000.0::DOUBLE, 6) AS nw, round(h / 800.0::DOUBLE, 6) AS nh FROM pred WHERE x + w <= 1000 AND y + h <= 800")
def normalized_in_bounds(spark, d):
    """Boxes within the page as shares of its size."""
    sizes = {"x": WIDTH, "y": HEIGHT, "w": WIDTH, "h": HEIGHT}
    return pred_boxes(spark, d).where(B.in_bounds(B.box(), WIDTH, HEIGHT)).select("page_id", "pos", *(F.round(F.col(c) / float(s), 6).alias(f"n{c}") for c, s in sizes.items()))


@query("SELECT page_id, pos, w > 0 AND h > 0 AND 7 * greatest(w, h) > 12 * least(w, h) AS window_shaped FROM pred")
def window_shaped(spark, d):
    """Whether a box is longer than 12/7 of its width."""
    b = B.box()
    return pred_boxes(spark, d).select("page_id", "pos", ((b.w > 0) & (b.h > 0) & (7 * F.greatest(b.w, b.h) > 12 * F.least(b.w, b.h))).alias("window_shaped"))


@query(f"SELECT a.page_id, a.pos AS l_pos, b.pos AS r_pos, {_I} AS inter FROM pred a JOIN pred b ON a.page_id = b.page_id AND a.pos < b.pos WHERE {_I} > 0")
def overlapping_pairs(spark, d):
    """Pairs of a page that overlap, by grid cells."""
    return joins.overlapping_pairs(pred_boxes(spark, d).select("page_id", "pos", "x", "y", "w", "h"), ["page_id"]).select("page_id", "l_pos", "r_pos", B.intersection(B.box("l_"), B.box("r_")).alias("inter"))


def _metric(name, value, duck):
    def run(spark, d):
        pairs = joins.overlapping_pairs(pred_boxes(spark, d).select("page_id", "pos", "x", "y", "w", "h"), ["page_id"])
        return pairs.select("page_id", "l_pos", "r_pos", F.round(value(B.box("l_"), B.box("r_")), 9).alias(name))

    run.__name__ = f"pair_{name}"
    run.__doc__ = f"{name} of overlapping pairs."
    query(f"SELECT page_id, l_pos, r_pos, round({duck}, 9) AS {name} FROM (SELECT a.page_id, a.pos AS l_pos, b.pos AS r_pos, ({_I})::DOUBLE AS i, (a.w * a.h)::DOUBLE AS aa, (b.w * b.h)::DOUBLE AS ba, (greatest(a.x + a.w, b.x + b.w) - least(a.x, b.x))::DOUBLE AS hw, (greatest(a.y + a.h, b.y + b.h) - least(a.y, b.y))::DOUBLE AS hh, (a.x + a.w / 2 - b.x - b.w / 2)::DOUBLE AS dx, (a.y + a.h / 2 - b.y - b.h / 2)::DOUBLE AS dy FROM pred a JOIN pred b ON a.page_id = b.page_id AND a.pos < b.pos) WHERE i > 0")(run)


_metric("iou", B.iou, "i / (aa + ba - i)")
_metric("containment", B.containment, "i / least(aa, ba)")
_metric("giou", B.giou, "i / (aa + ba - i) - (hw * hh - (aa + ba - i / (aa + ba - i) * least(aa, ba))) / (hw * hh)")
_metric("diou", B.diou, "i / (aa + ba - i) - (dx * dx + dy * dy) / (hw * hw + hh * hh)")


@query("SELECT page_id, pos, outer_pos FROM (SELECT g.page_id, g.pos, p.pos AS outer_pos, row_number() OVER (PARTITION BY g.page_id, g.pos ORDER BY p.w * p.h, p.pos) AS n FROM gt g JOIN pred p ON g.page_id = p.page_id AND 2 * g.x + g.w BETWEEN 2 * p.x AND 2 * (p.x + p.w) AND 2 * g.y + g.h BETWEEN 2 * p.y AND 2 * (p.y + p.h)) WHERE n = 1", gt=True)
def smallest_containing_box(spark, d):
    """The smallest predicted box that holds a ground-truth centre."""
    return joins.smallest_containing(gt_boxes(spark, d).select("page_id", "pos", "x", "y", "w", "h"), pred_boxes(spark, d).select("page_id", "pos", "x", "y", "w", "h"), ["page_id"])


_D4 = "(2 * a.x + a.w - 2 * b.x - b.w) * (2 * a.x + a.w - 2 * b.x - b.w) + (2 * a.y + a.h - 2 * b.y - b.h) * (2 * a.y + a.h - 2 * b.y - b.h)"


@query(f"SELECT page_id, pos, nearest_pos, dist4 FROM (SELECT a.page_id, a.pos, b.pos AS nearest_pos, {_D4} AS dist4, row_number() OVER (PARTITION BY a.page_id, a.pos ORDER BY {_D4}, b.pos) AS n FROM pred a JOIN gt b ON a.page_id = b.page_id WHERE {_D4} <= 4 * 300 * 300) WHERE n = 1", gt=True)
def nearest_with_cutoff(spark, d):
    """The nearest ground-truth centre within 300 pixels."""
    cols = ["page_id", "pos", "x", "y", "w", "h"]
    return joins.nearest_within(pred_boxes(spark, d).select(*cols), gt_boxes(spark, d).select(*cols), ["page_id"], 300)


@query("SELECT DISTINCT a.page_id, a.pos FROM pred a JOIN gt b ON a.page_id = b.page_id WHERE abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 AND abs(a.w - b.w) <= 1 AND abs(a.h - b.h) <= 1", gt=True)
def echo_boxes(spark, d):
    """Predictions that a ground-truth box equals within a pixel."""
    cols = ["page_id", "pos", "x", "y", "w", "h"]
    return joins.echoes(pred_boxes(spark, d).select(*cols), gt_boxes(spark, d).select(*cols), ["page_id"], 1)


_MATCH = f"(SELECT page_id, unnest(list_reduce(list({{p: p, s: s, g: g}} ORDER BY p, s, g), lambda acc, r: CASE WHEN len(list_filter(acc, lambda k: k.p = r.p OR k.g = r.g)) > 0 THEN acc ELSE list_append(acc, r) END, []::STRUCT(p BIGINT, s BIGINT, g BIGINT)[])) AS m FROM (SELECT a.page_id, a.pos AS p, -(({_I}) * 1000000 // (a.w * a.h + b.w * b.h - ({_I}))) AS s, b.pos AS g FROM pred a JOIN gt b ON a.page_id = b.page_id WHERE {_I} > 0 AND 10 * ({_I}) >= 5 * (a.w * a.h + b.w * b.h - ({_I}))) GROUP BY page_id)"


@query(f"SELECT page_id, m.p AS pred_pos, m.g AS gt_pos FROM {_MATCH}", gt=True)
def greedy_matches(spark, d):
    """Predictions matched one to one with ground truth at IoU .5."""
    return folds.match_greedily(pred_boxes(spark, d), gt_boxes(spark, d), ["page_id"])


def _scored(spark, d, key):
    pred, gt = pred_boxes(spark, d), gt_boxes(spark, d)
    hits = folds.match_greedily(pred, gt, ["page_id"]).groupBy("page_id").agg(F.count("*").alias("tp"))
    pages = pred.groupBy("page_id").agg(F.count("*").alias("predictions")).join(gt.groupBy("page_id").agg(F.count("*").alias("gts")), "page_id", "left").join(hits, "page_id", "left")
    return pages.groupBy(F.expr(f"page_id % {key}").alias("document")).agg(F.sum("predictions").alias("predictions"), F.coalesce(F.sum("gts"), F.lit(0)).alias("gts"), F.coalesce(F.sum("tp"), F.lit(0)).alias("tp"))


_SCORED = f"(SELECT p.page_id % 20 AS document, CAST(sum(n) AS BIGINT) AS predictions, CAST(coalesce(sum(gn), 0) AS BIGINT) AS gts, CAST(coalesce(sum(tp), 0) AS BIGINT) AS tp FROM (SELECT page_id, count(*) AS n FROM pred GROUP BY page_id) p LEFT JOIN (SELECT page_id, count(*) AS gn FROM gt GROUP BY page_id) USING (page_id) LEFT JOIN (SELECT page_id, count(*) AS tp FROM {_MATCH} GROUP BY page_id) USING (page_id) GROUP BY 1)"
_RATES = "round(CASE WHEN {n} > 0 THEN tp::DOUBLE / {n} ELSE 0 END, 6)"


@query(f"SELECT document, predictions, gts, tp, {_RATES.format(n='predictions')} AS precision, {_RATES.format(n='gts')} AS recall, round(CASE WHEN predictions + gts > 0 THEN 2.0::DOUBLE * tp / (predictions + gts) ELSE 0 END, 6) AS f1 FROM {_SCORED}", gt=True)
def scores_per_document(spark, d):
    """Precision, recall and F1 of each document."""
    s = _scored(spark, d, 20)
    return s.select("document", "predictions", "gts", "tp", F.round(B.ratio(F.col("tp"), F.col("predictions")), 6).alias("precision"), F.round(B.ratio(F.col("tp"), F.col("gts")), 6).alias("recall"), F.round(B.ratio(2 * F.col("tp"), F.col("predictions") + F.col("gts")), 6).alias("f1"))


@query("SELECT category, count(*) AS n, round(min(conf_milli) / 1000.0::DOUBLE, 6) AS low, round(median(conf_milli) / 1000.0::DOUBLE, 6) AS mid, round(quantile_cont(conf_milli, 0.9) / 1000.0::DOUBLE, 6) AS p90, round(max(conf_milli) / 1000.0::DOUBLE, 6) AS high FROM pred GROUP BY category")
def confidence_spread(spark, d):
    """Least, median, 90th percentile and largest confidence of each category."""
    c = F.col("conf_milli")
    return pred_boxes(spark, d).groupBy("category").agg(F.count("*").alias("n"), *(F.round(v / 1000.0, 6).alias(n) for n, v in (("low", F.min(c)), ("mid", F.median(c)), ("p90", F.percentile(c, 0.9)), ("high", F.max(c)))))


@query("SELECT page_id, round(max(w * h)::DOUBLE / median(w * h), 6) AS spread FROM pred GROUP BY page_id HAVING count(*) >= 2")
def area_spread(spark, d):
    """Largest over median area of each page with two boxes or more."""
    a = F.expr("w * h")
    return pred_boxes(spark, d).groupBy("page_id").agg(F.count("*").alias("n"), F.round(F.max(a) / F.median(a), 6).alias("spread")).where("n >= 2").drop("n")


@query("SELECT page_id, pos FROM (SELECT page_id, pos, row_number() OVER (PARTITION BY page_id ORDER BY conf_milli DESC, pos) AS n FROM pred) WHERE n <= 3")
def top_boxes_per_page(spark, d):
    """The three most confident boxes of each page (a cap as the feature)."""
    return pred_boxes(spark, d).selectExpr("page_id", "pos", "row_number() OVER (PARTITION BY page_id ORDER BY conf_milli DESC, pos) AS n").where("n <= 3").drop("n")


@query("SELECT page_id, kept AS pos FROM (SELECT page_id, unnest(list_reduce(list({s: -(w * h), o: pos} ORDER BY -(w * h), pos), lambda acc, r: CASE WHEN acc.total - r.s <= 40000 THEN {total: acc.total - r.s, kept: list_append(acc.kept, r.o)} ELSE acc END, {total: 0::BIGINT, kept: []::BIGINT[]}).kept) AS kept FROM pred GROUP BY page_id)")
def greedy_area_budget(spark, d):
    """Boxes of each page, largest first, within an area budget."""
    return folds.cap_by_budget(pred_boxes(spark, d), ["page_id"], "w * h", "pos", 40_000)


@query("SELECT o_orderkey, CASE WHEN h < 70 THEN 'train' WHEN h < 85 THEN 'val' ELSE 'test' END AS split FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 20 = 3 THEN 99 ELSE (o_orderkey % 20) * 37 % 100 END AS h FROM orders)", pred=False)
def group_safe_split(spark, d):
    """Orders to splits by document group; group 3 is pinned to test."""
    return table(spark, d, "orders").selectExpr("o_orderkey", "IF(o_orderkey % 20 = 3, 99, (o_orderkey % 20) * 37 % 100) AS h").selectExpr("o_orderkey", "CASE WHEN h < 70 THEN 'train' WHEN h < 85 THEN 'val' ELSE 'test' END AS split")


@query("SELECT event_type AS stage, date_trunc('hour', ts) AS start, count(*) AS n, round(sum(value), 2) AS total, round(max(value), 6) AS longest FROM events GROUP BY ALL", pred=False)
def metrics_by_hour(spark, d):
    """Run metrics in hours by stage; streaming/metrics.py has the stream of it."""
    return table(spark, d, "events").groupBy(F.col("event_type").alias("stage"), F.date_trunc("hour", "ts").alias("start")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"), F.round(F.max("value"), 6).alias("longest"))


@query("SELECT conv_id, count(*) AS turns, string_agg(role || ': ' || length(text), '|' ORDER BY turn, role, text) AS outline FROM conversations GROUP BY conv_id", pred=False)
def chat_examples(spark, d):
    """Conversations as ordered messages, outlined by role and length."""
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns"), F.expr("array_join(transform(array_sort(collect_list(struct(turn, role, text))), m -> concat(m.role, ': ', length(m.text))), '|')").alias("outline"))


@query("SELECT doc_id, upper_letters, alnum, least FROM (SELECT doc_id, length(trim(regexp_replace(upper(replace(text, 'ß', 'ss')), '[^A-Z ]', '', 'g'), ' ')) AS upper_letters, length(regexp_replace(upper(replace(text, 'ß', 'ss')), '[^A-Z0-9]', '', 'g')) AS alnum, CASE length(trim(text, ' ')) WHEN 1 THEN 0.85 WHEN 2 THEN 0.70 WHEN 3 THEN 0.65 WHEN 4 THEN 0.60 ELSE 0.50 END::DOUBLE AS least FROM documents)", pred=False)
def text_keys(spark, d):
    """Lengths of a text's letters and alphanumerics, and the confidence that its length needs."""
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.length(T.letters(t)).cast("long").alias("upper_letters"), F.length(T.alphanumeric(t)).cast("long").alias("alnum"), T.least_confidence(t).alias("least"))


@query("SELECT source, count(*) AS n, count(DISTINCT lang) AS langs, CAST(sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS BIGINT) AS good, CAST(sum(CASE WHEN quality IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unlabelled FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source", pred=False)
def coverage_by_source(spark, d):
    """Coverage report: documents, languages and labels of each source."""
    joined = table(spark, d, "documents").select("doc_id", "lang", "source").join(table(spark, d, "labels"), "doc_id", "left")
    return joined.groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("lang").alias("langs"), F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality").isNull()).alias("unlabelled"))


@query("SELECT page_id, c, r, c * 400 - CASE WHEN c > 0 THEN 40 ELSE 0 END AS x0, r * 400 - CASE WHEN r > 0 THEN 40 ELSE 0 END AS y0, count(*) AS boxes FROM (SELECT page_id, x, y, w, h, unnest(range(3)) AS c FROM pred) p, (SELECT unnest(range(2)) AS r) g WHERE x >= c * 400 - CASE WHEN c > 0 THEN 40 ELSE 0 END AND x + w <= (c + 1) * 400 + 40 AND y >= r * 400 - CASE WHEN r > 0 THEN 40 ELSE 0 END AND y + h <= (r + 1) * 400 + 40 GROUP BY ALL")
def tile_contents(spark, d):
    """Boxes that each tile of 400 pixels, 40 overlapping, holds whole."""
    tiles = pred_boxes(spark, d).selectExpr("*", "explode(sequence(0L, 2L)) AS c").selectExpr("*", "explode(sequence(0L, 1L)) AS r").selectExpr("*", "c * 400 - IF(c > 0, 40, 0) AS x0", "r * 400 - IF(r > 0, 40, 0) AS y0")
    return tiles.where("x >= x0 AND x + w <= (c + 1) * 400 + 40 AND y >= y0 AND y + h <= (r + 1) * 400 + 40").groupBy("page_id", "c", "r", "x0", "y0").agg(F.count("*").alias("boxes"))
