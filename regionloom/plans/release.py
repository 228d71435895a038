"""Queries of attachment, loop gates, replay, release gates and exports over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from regionloom.operators import attachment
from regionloom.plans.registry import _D4, _I, query
from regionloom.plans.views import HEIGHT, WIDTH, gt_boxes, pred_boxes, table
from regionloom.sources import exports

_BOX = ["page_id", "pos", "x", "y", "w", "h"]
_TOUCH = "a.x <= b.x + b.w AND b.x <= a.x + a.w AND a.y <= b.y + b.h AND b.y <= a.y + a.h"
_OBJECTS = "objects AS (SELECT * FROM pred WHERE line % 2 = 1), met AS (SELECT a.page_id, a.pos, b.pos AS room_pos FROM objects a JOIN gt b ON a.page_id = b.page_id AND " + _TOUCH + ")"
_NEAR = "near AS (SELECT page_id, pos, room_pos FROM (SELECT a.page_id, a.pos, b.pos AS room_pos, row_number() OVER (PARTITION BY a.page_id, a.pos ORDER BY {d}, b.pos) AS n FROM {l} a JOIN gt b ON a.page_id = b.page_id WHERE {d} <= 4 * {r} * {r}) WHERE n = 1)"


def _objects(spark, d):
    return pred_boxes(spark, d).where("line % 2 = 1")


_ATTACHED = f", {_OBJECTS}, lone AS (SELECT * FROM objects WHERE (page_id, pos) NOT IN (SELECT (page_id, pos) FROM met)), {_NEAR.format(d=_D4, l='lone', r=250)} "


@query(_ATTACHED + "SELECT page_id, pos, room_pos, 'met' AS way FROM met UNION ALL SELECT page_id, pos, room_pos, 'near' FROM near", gt=True)
def attached_objects(spark, d):
    """Objects with every room that they meet, or else the nearest within 250 pixels."""
    return attachment.attach(_objects(spark, d).select(*_BOX), gt_boxes(spark, d).select(*_BOX), ["page_id"], 250)


@query(f", {_OBJECTS} SELECT m.page_id, room_pos, bool_or(category = 'A') AS has_a, bool_or(category = 'N') AS has_n, count(*) FILTER (category NOT IN ('A', 'N')) AS unknown FROM met m JOIN objects o ON m.page_id = o.page_id AND m.pos = o.pos GROUP BY m.page_id, room_pos", gt=True)
def room_object_flags(spark, d):
    """Which kinds of objects each room has, and how many of no known kind."""
    objects = _objects(spark, d)
    attached = attachment.attach(objects.select(*_BOX), gt_boxes(spark, d).select(*_BOX), ["page_id"])
    return attachment.room_flags(attached, objects, ["page_id"], {"A": "a", "N": "n"})


@query(f", {_OBJECTS}, {_NEAR.format(d=_D4, l='objects', r=300)} SELECT o.page_id, o.pos, room_pos AS name_pos, CASE WHEN room_pos IS NULL THEN 'alone' WHEN o.pos = min(o.pos) OVER (PARTITION BY o.page_id, room_pos) THEN 'linked' ELSE 'dropped' END AS outcome FROM objects o LEFT JOIN near n ON o.page_id = n.page_id AND o.pos = n.pos", gt=True)
def linked_numbers(spark, d):
    """Numbers linked to their nearest name, which keeps the first."""
    return attachment.link_numbers(_objects(spark, d).select(*_BOX), gt_boxes(spark, d).select(*_BOX), ["page_id"])


@query("SELECT page_id, pos, outer_pos FROM (SELECT *, count(*) OVER (PARTITION BY page_id, outer_pos) AS k FROM (SELECT g.page_id, g.pos, p.pos AS outer_pos, row_number() OVER (PARTITION BY g.page_id, g.pos ORDER BY p.w * p.h, p.pos) AS n FROM gt g JOIN pred p ON g.page_id = p.page_id AND 2 * g.x + g.w BETWEEN 2 * p.x AND 2 * (p.x + p.w) AND 2 * g.y + g.h BETWEEN 2 * p.y AND 2 * (p.y + p.h)) WHERE n = 1) WHERE k = 1", gt=True)
def own_extents(spark, d):
    """The smallest face around each label, where one label alone claims it."""
    return attachment.own_extents(gt_boxes(spark, d).select(*_BOX), pred_boxes(spark, d).select(*_BOX), ["page_id"])


_BEST = f"(SELECT a.page_id, a.pos, max(CASE WHEN {_I} > 0 THEN ({_I})::DOUBLE / (a.w * a.h + b.w * b.h - {_I}) ELSE 0 END) AS best FROM gt a JOIN pred b ON a.page_id = b.page_id GROUP BY ALL)"


@query(f"SELECT page_id % 20 AS document, count(*) AS gts, count(*) FILTER (best >= 0.3) AS at_30, count(*) FILTER (best >= 0.4) AS at_40, count(*) FILTER (best >= 0.5) AS at_50 FROM {_BEST} GROUP BY ALL", gt=True)
def recall_sweep(spark, d):
    """Ground truth found at three IoUs, by document."""
    best = attachment.best_overlaps(gt_boxes(spark, d).select(*_BOX), pred_boxes(spark, d).select(*_BOX), ["page_id"])
    return best.groupBy(F.expr("page_id % 20").alias("document")).agg(F.count("*").alias("gts"), *(F.count_if(F.col("best") >= t / 100).alias(f"at_{t}") for t in (30, 40, 50)))


_COARSE = "(SELECT page_id, (x // 400) * 400 AS x, (y // 300) * 300 AS y, 1 AS w, 1 AS h FROM pred)"


@query(f"SELECT page_id, CASE WHEN most >= 3 AND 2 * most >= n THEN 'repeated' WHEN n >= 6 AND nx >= 2 AND ny >= 2 AND nx * ny >= 6 AND abs(nx * ny - n) <= 1 THEN 'lattice' ELSE 'fine' END AS verdict FROM (SELECT page_id, CAST(sum(c) AS BIGINT) AS n, max(c) AS most, count(DISTINCT x) AS nx, count(DISTINCT y) AS ny FROM (SELECT page_id, x, y, count(*) AS c FROM {_COARSE} GROUP BY ALL) GROUP BY page_id)")
def loop_verdicts(spark, d):
    """Pages that look like a model's loop; corners are made coarse, for such pages are rare in this table."""
    coarse = pred_boxes(spark, d).selectExpr("page_id", "(x DIV 400) * 400 AS x", "(y DIV 300) * 300 AS y", "1 AS w", "1 AS h")
    return attachment.loop_verdicts(coarse, ["page_id"])


@query("SELECT page_id, b AS baseline, v AS variant FROM (SELECT page_id, count(*) FILTER (conf_milli >= 300) AS b, count(*) FILTER (conf_milli >= 300 OR w > h) AS v FROM pred GROUP BY page_id) WHERE b <> v")
def replay_changes(spark, d):
    """Pages whose count of boxes changes under another filter."""
    counts = pred_boxes(spark, d).groupBy("page_id").agg(F.count_if(F.expr("conf_milli >= 300")).alias("baseline"), F.count_if(F.expr("conf_milli >= 300 OR w > h")).alias("variant"))
    return counts.where("baseline <> variant")


_RUNS = "SELECT page_id % 20 AS document, line % 5 AS run, count(*) AS n, count(*) FILTER (conf_milli >= 400) AS located FROM pred GROUP BY ALL"


@query(f"SELECT document, round(min(r) FILTER (run >= 3), 6) AS candidate, round(min(r) FILTER (run < 3), 6) AS low, round(median(r) FILTER (run < 3), 6) AS mid, round(max(r) FILTER (run < 3), 6) AS high, coalesce(min(r) FILTER (run >= 3) > max(r) FILTER (run < 3) + 0.01, FALSE) AS passed FROM (SELECT *, located::DOUBLE / n AS r FROM ({_RUNS})) GROUP BY document")
def gate_verdicts(spark, d):
    """The worst of the candidate runs against the spread of the baselines, by document."""
    runs = pred_boxes(spark, d).groupBy(F.expr("page_id % 20").alias("document"), F.expr("line % 5").alias("run")).agg((F.count_if(F.expr("conf_milli >= 400")) / F.count("*")).alias("r"))
    base, new = F.expr("CASE WHEN run < 3 THEN r END"), F.expr("CASE WHEN run >= 3 THEN r END")
    rounded = {"candidate": F.min(new), "low": F.min(base), "mid": F.median(base), "high": F.max(base)}
    return runs.groupBy("document").agg(*(F.round(c, 6).alias(n) for n, c in rounded.items()), F.coalesce(F.min(new) > F.max(base) + 0.01, F.lit(False)).alias("passed"))


@query("SELECT source, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM (SELECT source, CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split FROM documents) GROUP BY source HAVING count(DISTINCT split) > 1", pred=False)
def straddling_groups(spark, d):
    """Groups whose members lie in several splits."""
    rows = table(spark, d, "documents").selectExpr("source", "CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split")
    return rows.groupBy("source").agg(F.array_sort(F.collect_set("split")).alias("_s")).where("size(_s) > 1").select("source", F.array_join("_s", ",").alias("splits"))


@query("SELECT page_id, count(*) AS n, string_agg(printf('%d %.6f %.6f %.6f %.6f', CAST(page_id % 5 AS INTEGER), (x + w / 2.0::DOUBLE) / 1000, (y + h / 2.0::DOUBLE) / 800, w::DOUBLE / 1000, h::DOUBLE / 800), chr(10) ORDER BY pos) AS lines FROM pred WHERE x + w <= 1000 AND y + h <= 800 GROUP BY page_id")
def label_files(spark, d):
    """The label file of each page."""
    from regionloom.sources.formats import label_line

    rows = pred_boxes(spark, d).where(f"x + w <= {WIDTH} AND y + h <= {HEIGHT}").select("page_id", "pos", label_line("CAST(page_id % 5 AS INT)", WIDTH, HEIGHT).alias("line"))
    return rows.groupBy("page_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("_l")).select("page_id", "n", F.expr("array_join(transform(_l, r -> r.line), '\n')").alias("lines"))


@query("SELECT page_id, count(*) AS n, round(sum(x) * 100 / 1000.0::DOUBLE, 3) AS total FROM pred WHERE x >= 0 AND y >= 0 AND x + w <= 1000 AND y + h <= 800 GROUP BY page_id")
def review_tasks(spark, d):
    """Review tasks of each page, their left edges added up again from the JSON."""
    tasks = exports.review_tasks(pred_boxes(spark, d), "page_id", WIDTH, HEIGHT)
    read = tasks.select("page_id", "n", F.from_json("task", "result array<struct<x:double>>").alias("t"))
    return read.selectExpr("page_id", "n", "round(aggregate(t.result, 0D, (s, r) -> s + r.x), 3) AS total")


@query("SELECT conv_id, count(*) AS n, CAST(sum(coalesce(length(text), 0)) AS BIGINT) AS chars FROM conversations GROUP BY conv_id", pred=False)
def chat_records(spark, d):
    """Conversations as messages with content parts, counted."""
    rows = exports.chat_records(table(spark, d, "conversations"), "conv_id", "turn")
    return rows.selectExpr("conv_id", "CAST(size(messages) AS BIGINT) AS n", "aggregate(messages, 0L, (s, m) -> s + coalesce(length(m.content[0].text), 0)) AS chars")
