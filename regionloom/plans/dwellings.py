"""Queries of expected rooms, layers, page records and page gates over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from regionloom.operators import dwellings
from regionloom.plans.registry import query
from regionloom.plans.views import pred_boxes, table

_UNITS = "SELECT p_partkey, p_size % 4 AS bedrooms, p_partkey % 3 AS bathrooms, p_size % 3 > 0 AS living, p_partkey % 2 = 0 AS kitchen, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE (p_partkey % 100) / 100.0::DOUBLE END AS confidence FROM part"


def _one(short: str, name: str, kind: str) -> str:
    return "[{a: '" + short + "', n: '" + name + "', c: '" + kind + "'}]"


def _many(count: str, short: str, name: str, kind: str) -> str:
    none = "[]::STRUCT(a VARCHAR, n VARCHAR, c VARCHAR)[]"
    numbered = f"list_transform(range(1, {count} + 1), lambda k: {{a: '{short} ' || k, n: '{name} ' || k, c: '{kind}'}})"
    return f"CASE WHEN {count} = 1 THEN {_one(short, name, kind)} WHEN {count} > 1 THEN {numbered} ELSE {none} END"


_NONE = "[]::STRUCT(a VARCHAR, n VARCHAR, c VARCHAR)[]"
_ROOMS = " || ".join(f"({e})" for e in (
    f"CASE WHEN bedrooms = 0 THEN {_one('ST', 'STUDIO APARTMENT', 'studio')} ELSE {_NONE} END",
    _many("bedrooms", "BR", "BEDROOM", "bedroom"),
    f"CASE WHEN living AND bedrooms > 0 THEN {_one('LR', 'LIVING ROOM', 'living_room')} ELSE {_NONE} END",
    f"CASE WHEN kitchen THEN {_one('KIT', 'KITCHEN', 'kitchen')} ELSE {_NONE} END",
    _many("bathrooms", "BA", "BATHROOM", "restroom"),
    _one("ENTRY", "ENTRY/HALLWAY", "hallway"),
))


def _units(spark, d):
    made = "p_partkey", "p_size % 4 AS bedrooms", "p_partkey % 3 AS bathrooms", "p_size % 3 > 0 AS living", "p_partkey % 2 = 0 AS kitchen", "IF(p_partkey % 5 = 0, NULL, (p_partkey % 100) / 100D) AS confidence"
    return table(spark, d, "part").selectExpr(*made)


@query(f"SELECT p_partkey, CAST(k - 1 AS INTEGER) AS pos, r[k].a AS abbreviation, r[k].n AS name, r[k].c AS category, bedrooms || 'BR' || bathrooms || 'BA' AS unit_type, round(0.75::DOUBLE * (coalesce(confidence, 0.75::DOUBLE) / 0.75::DOUBLE), 6) AS confidence FROM (SELECT *, unnest(range(1, len(r) + 1)) AS k FROM (SELECT *, {_ROOMS} AS r FROM ({_UNITS})))", pred=False)
def unit_rooms(spark, d):
    """Rooms expected of dwellings by their counts."""
    return dwellings.unit_rooms(_units(spark, d), "p_partkey").withColumn("confidence", F.round("confidence", 6))


@query("SELECT page_id, category, CAST(layer AS INTEGER) AS layer, pos FROM (SELECT page_id, category, line % 3 AS layer, pos, row_number() OVER (PARTITION BY page_id, category ORDER BY line % 3, pos) AS n FROM pred) WHERE n = 1")
def first_layers(spark, d):
    """Three layers of rooms together, the first of each page and class."""
    rows = pred_boxes(spark, d).select("page_id", "category", "pos", "line")
    return dwellings.first_layers([rows.where(f"line % 3 = {k}").drop("line") for k in range(3)], ["page_id", "category"])


@query("SELECT page_id, count(*) AS n, '{\"page_id\":' || page_id || ',\"rooms\":[' || string_agg('{\"category\":\"' || category || '\"' || CASE WHEN line % 2 = 0 THEN ',\"x\":' || x ELSE '' END || '}', ',' ORDER BY pos) || ']}' AS record FROM pred GROUP BY page_id")
def page_records(spark, d):
    """Pages as JSON records of their rooms, keys of absent values left out."""
    rows = pred_boxes(spark, d).selectExpr("page_id", "pos", "category", "IF(line % 2 = 0, x, NULL) AS x")
    return dwellings.page_records(rows, "page_id", ["category", "x"])


@query("SELECT page_id, 3 <= max(n) AND 2 * max(n) >= sum(n) AS looped FROM (SELECT page_id % 500 AS page_id, x // 100 AS x, y // 100 AS y, w // 100 AS w, h // 100 AS h, count(*) AS n FROM pred GROUP BY ALL) GROUP BY page_id")
def identical_loops(spark, d):
    """Pages on which the same box comes again and again."""
    rows = pred_boxes(spark, d).selectExpr("page_id % 500 AS page_id", *(f"{c} DIV 100 AS {c}" for c in "xywh"))
    return dwellings.identical_loop(rows, ["page_id"])


_I = "greatest(least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x), 0) * greatest(least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y), 0)"


@query(f"SELECT page_id, pos FROM pred a WHERE NOT EXISTS (SELECT 1 FROM pred b WHERE a.page_id = b.page_id AND a.category = b.category AND (b.w * b.h < a.w * a.h OR b.w * b.h = a.w * a.h AND b.pos < a.pos) AND 10 * ({_I}) >= 7 * b.w * b.h)")
def boxes_without_nests(spark, d):
    """Without boxes that hold most of a smaller one of their class."""
    return dwellings.without_nested(pred_boxes(spark, d), ["page_id"], "category").select("page_id", "pos")


@query("SELECT page_id, pos, 'ocr_fallback_' || (row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1) AS room_id, 'other' AS room_type, round(CASE WHEN conf_milli % 9 = 0 THEN 0.6::DOUBLE ELSE conf_milli / 1000.0::DOUBLE END * 0.8::DOUBLE, 6) AS confidence FROM pred WHERE source = 'ocr_only'")
def text_only_rooms(spark, d):
    """Rooms from texts alone where a model failed: numbered on their page, with a lower confidence, .6 where none is given."""
    rows = pred_boxes(spark, d).where("source = 'ocr_only'").withColumn("given", F.expr("IF(conf_milli % 9 = 0, NULL, conf_milli / 1000D)"))
    confidence = F.round(F.coalesce("given", F.lit(0.6)) * dwellings.TEXT_SHARE, 6)
    return rows.select("page_id", "pos", F.expr("concat('ocr_fallback_', row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1)").alias("room_id"), F.lit("other").alias("room_type"), confidence.alias("confidence"))
