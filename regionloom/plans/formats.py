"""Queries of formats, names and geometry rules over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from regionloom.functions import vocabulary as V
from regionloom.plans.registry import query
from regionloom.plans.views import HEIGHT, WIDTH, pred_boxes, table
from regionloom.sources import formats

_LINE = "concat(page_id % 5, ' 0.', lpad(CAST(x AS {s}), 3, '0'), ' 0.', lpad(CAST(y AS {s}), 3, '0'), '  0.', lpad(CAST(w AS {s}), 3, '0'), CASE WHEN pos = 3 THEN '' WHEN pos = 2 THEN ' bad' ELSE concat(' 0.', lpad(CAST(h AS {s}), 3, '0')) END)"


@query("SELECT page_id, pos, CAST(page_id % 5 AS INTEGER) AS class_id, round(x - w / 2.0::DOUBLE, 3) AS x1, round(0.8::DOUBLE * y - 0.4::DOUBLE * h, 3) AS y1, round(x + w / 2.0::DOUBLE, 3) AS x2, round(0.8::DOUBLE * y + 0.4::DOUBLE * h, 3) AS y2 FROM pred WHERE pos NOT IN (2, 3)")
def parsed_label_lines(spark, d):
    """Label lines read as boxes; lines of a wrong length or with a word for a number are dropped."""
    lines = pred_boxes(spark, d).selectExpr("page_id", "pos", f"{_LINE.format(s='STRING')} AS line")
    return formats.parse_label_lines(lines, "line", WIDTH, HEIGHT).select("page_id", "pos", "class_id", *(F.round(c, 3).alias(c) for c in ("x1", "y1", "x2", "y2")))


@query("SELECT page_id, count(*) AS n, CAST(sum(2 * (w * h) + h * shift) AS BIGINT) AS twice FROM pred GROUP BY page_id")
def polygon_areas(spark, d):
    """Twice the area of trapezia given as flat polygons."""
    flat = pred_boxes(spark, d).selectExpr("page_id", "array(x, y, x + w + shift, y, x + w, y + h, x, y + h) AS flat")
    return flat.withColumn("twice", formats.twice_area("flat")).groupBy("page_id").agg(F.count("*").alias("n"), F.sum("twice").alias("twice"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE 3 END AS parts, CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE p_partkey * 2 + p_size END AS total FROM part", pred=False)
def model_answers(spark, d):
    """Arrays in answers of a model, with reasoning, fences and trailing commas; 0 where there is none."""
    answer = "IF(p_partkey % 7 = 0, 'no rooms', concat('<think>[9]</think>```json\n[', p_partkey, ', ', p_size, ',\n', p_partkey, ', ]``` done'))"
    parsed = table(spark, d, "part").select("p_partkey", F.from_json(formats.json_array_text(F.expr(answer)), "array<bigint>").alias("a"))
    return parsed.selectExpr("p_partkey", "IF(a IS NULL, 0, size(a)) AS parts", "coalesce(aggregate(a, 0L, (s, v) -> s + v), 0L) AS total")


@query("SELECT event_id, coalesce(last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING), -1) AS header FROM events", pred=False)
def log_headers(spark, d):
    """The last header line of each log line."""
    return formats.carried_header(table(spark, d, "events").select("event_id", "user_id", "event_type"), ["user_id"], "event_id", F.expr("IF(event_type = 'view', event_id, NULL)")).select("event_id", F.coalesce("header", F.lit(-1)).alias("header"))


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY event_type", pred=False)
def json_fields(spark, d):
    """A number in JSON text, added up."""
    return table(spark, d, "events").select("event_type", F.get_json_object("props", "$.k").cast("long").alias("k")).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("k").alias("k"))


#: Ranked forms for the query below: words of the table part.
FORMS = [("small bolt", "FASTENER S"), ("widget", "WIDGET"), ("bolt", "FASTENER"), ("gear", "DRIVE")]
SHORT = [("S", "never"), ("ECONOMY", "ECO"), ("BRAND#1", "FIRST BRAND")]
_HELD = " ".join(f"WHEN contains(n, '{f.upper()}') OR contains('{f.upper()}', n) THEN '{k}'" for f, k in FORMS)
_EQUAL = " ".join(f"WHEN n = '{f.upper()}' THEN '{k}'" for f, k in FORMS)


@query(f"SELECT p_partkey, coalesce(CASE {_EQUAL} END, CASE WHEN length(n) > 4 THEN CASE {_HELD} END END, 'OTHER') AS class, CASE WHEN b = 'BRAND#1' THEN 'FIRST BRAND' WHEN regexp_matches(b, '^BRAND#1[ 0-9-]') THEN 'FIRST BRAND' || substr(b, 8) ELSE b END AS brand FROM (SELECT p_partkey, trim(upper(p_name)) AS n, trim(upper(p_brand)) AS b FROM part)", pred=False)
def resolved_names(spark, d):
    """Classes by ranked forms, and abbreviations spelled out."""
    return table(spark, d, "part").select("p_partkey", V.resolve(F.col("p_name"), FORMS, "OTHER").alias("class"), V.expand(F.col("p_brand"), SHORT).alias("brand"))


@query("SELECT page_id, pos, category || CASE WHEN x % 5 = 0 THEN ' WITH SKYLIGHT' WHEN y % 3 = 0 THEN ' WITH OPENING' WHEN w % 2 = 0 THEN ' WITH WINDOW' ELSE '' END AS class FROM pred")
def suffixed_classes(spark, d):
    """Classes with the strongest of their openings."""
    return pred_boxes(spark, d).select("page_id", "pos", V.with_suffix(F.col("category"), F.expr("x % 5 = 0"), F.expr("y % 3 = 0"), F.expr("w % 2 = 0")).alias("class"))


@query("SELECT page_id, count(*) AS boxes, count(DISTINCT (x, y, w, h)) AS distinct_boxes FROM pred GROUP BY page_id")
def duplicate_boxes(spark, d):
    """Boxes and different boxes of each page."""
    return pred_boxes(spark, d).groupBy("page_id").agg(F.count("*").alias("boxes"), F.countDistinct("x", "y", "w", "h").alias("distinct_boxes"))


@query("SELECT o_orderkey, c, CAST(floor(c * (base - ov)) AS BIGINT) AS x0 FROM (SELECT o_orderkey, w, cols, w // cols AS base, (w // cols) // 10 AS ov FROM (SELECT o_orderkey, w, CAST(least(greatest(round_even(w / 1200.0::DOUBLE, 0), 2), 4) AS BIGINT) AS cols FROM (SELECT o_orderkey, 2000 + (o_orderkey * 37) % 7000 AS w FROM orders) WHERE w > 3000)), (SELECT unnest(range(4)) AS c) WHERE c < cols", pred=False)
def tile_grid(spark, d):
    """Left edges of the tiles of wide pages: two to four columns of some 1,200 pixels, a tenth overlapping; pages up to 3,000 stay whole."""
    wide = table(spark, d, "orders").selectExpr("o_orderkey", "2000 + (o_orderkey * 37) % 7000 AS w").where("w > 3000").selectExpr("o_orderkey", "w", "CAST(least(greatest(bround(w / 1200D), 2), 4) AS BIGINT) AS cols")
    return wide.selectExpr("o_orderkey", "w DIV cols AS base", "explode(sequence(0L, cols - 1)) AS c").selectExpr("o_orderkey", "c", "c * (base - base DIV 10) AS x0")


@query("SELECT page_id, pos, greatest(x - h // 2, 0) AS left, greatest(y - h // 2, 0) AS top, least(x + w + h // 2, 1000) AS right, least(y + h + h // 2, 800) AS bottom FROM pred")
def crop_boxes(spark, d):
    """Boxes padded by half their height, cut to the page."""
    return pred_boxes(spark, d).selectExpr("page_id", "pos", "greatest(x - h DIV 2, 0) AS left", "greatest(y - h DIV 2, 0) AS top", f"least(x + w + h DIV 2, {WIDTH}) AS right", f"least(y + h + h DIV 2, {HEIGHT}) AS bottom")


@query("SELECT page_id * 1000 + pos AS id, page_id AS image_id, k AS category_id, [x, y, w, h]::VARCHAR AS bbox, w * h AS area FROM pred JOIN (SELECT category, row_number() OVER (ORDER BY category) AS k FROM (SELECT DISTINCT category FROM pred)) USING (category)")
def coco_annotations(spark, d):
    """Boxes as annotation records; category ids are ranks of the names in use."""
    boxes = pred_boxes(spark, d)
    ranks = boxes.select("category").distinct().selectExpr("category", "CAST(row_number() OVER (ORDER BY category) AS BIGINT) AS category_id")
    return boxes.join(ranks, "category").selectExpr("page_id * 1000 + pos AS id", "page_id AS image_id", "category_id", "concat('[', concat_ws(', ', x, y, w, h), ']') AS bbox", "w * h AS area")
