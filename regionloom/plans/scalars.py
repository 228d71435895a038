"""Queries of outlines, keys, digests, times and small verdicts over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from regionloom.functions import quads as Q
from regionloom.functions import scores as S
from regionloom.functions import text as T
from regionloom.plans.registry import query
from regionloom.plans.views import HEIGHT, WIDTH, pred_boxes, table


def _quads(spark, d):
    return pred_boxes(spark, d).withColumn("outline", Q.quad(F.col("x"), F.col("y"), F.expr("x + w"), F.expr("y + h")))


def _corners(rows):
    return rows.selectExpr("page_id", "pos", *(f"outline[{k}][{a}] AS {'xy'[a]}{k}" for k in range(4) for a in (0, 1)))


@query("SELECT page_id, pos, x AS x0, y AS y0, x + w AS x1, y AS y1, x + w AS x2, y + h AS y2, x AS x3, y + h AS y3 FROM pred")
def box_corners(spark, d):
    """Boxes as outlines of four corners."""
    return _corners(_quads(spark, d))


@query("SELECT page_id, pos, (2 * x + w) / 2.0::DOUBLE AS cx, (2 * y + h) / 2.0::DOUBLE AS cy FROM pred")
def outline_centroids(spark, d):
    cx, cy = Q.centroid(F.col("outline"))
    return _quads(spark, d).select("page_id", "pos", cx.alias("cx"), cy.alias("cy"))


@query("SELECT page_id, pos, y AS x0, 799 - x AS y0, y AS x1, 799 - x - w AS y1, y + h AS x2, 799 - x - w AS y2, y + h AS x3, 799 - x AS y3 FROM pred")
def outlines_turned_back(spark, d):
    """Outlines found on turned pages, in the pages' own places."""
    return _corners(_quads(spark, d).withColumn("outline", Q.turned_back(F.col("outline"), HEIGHT)))


@query("SELECT page_id, pos, x + 512 AS x0, y + shift AS y0, x + w + 512 AS x1, y + shift AS y1, x + w + 512 AS x2, y + h + shift AS y2, x + 512 AS x3, y + h + shift AS y3 FROM pred")
def outlines_moved(spark, d):
    """Outlines of a tile in the places of the page."""
    return _corners(_quads(spark, d).withColumn("outline", Q.moved(F.col("outline"), F.lit(512), F.col("shift"))))


@query("SELECT page_id, pos, x + w // 2 AS cx, y + h // 2 AS cy FROM pred WHERE w > 0 AND h > 0")
def label_centres(spark, d):
    """Whole-number centres of labels, as seeds for regions."""
    return pred_boxes(spark, d).where("w > 0 AND h > 0").selectExpr("page_id", "pos", "x + w DIV 2 AS cx", "y + h DIV 2 AS cy")


@query("SELECT page_id, pos, CAST(trunc(x * least(1.0::DOUBLE, 640.0::DOUBLE / greatest(w, h + 600))) AS BIGINT) AS x, CAST(trunc(w * least(1.0::DOUBLE, 640.0::DOUBLE / greatest(w, h + 600))) AS BIGINT) AS w FROM pred")
def rescaled_boxes(spark, d):
    """Boxes on pages scaled down to 640 pixels, cut to whole numbers."""
    factor = Q.shrink_factor(F.col("w"), F.expr("h + 600"), 640)
    return pred_boxes(spark, d).select("page_id", "pos", (F.col("x") * factor).cast("long").alias("x"), (F.col("w") * factor).cast("long").alias("w"))


_NEXT = "SELECT a.page_id, a.pos, {} FROM pred a JOIN pred b ON a.page_id = b.page_id AND b.pos = a.pos + 1"


def _neighbours(spark, d):
    rows = pred_boxes(spark, d)
    return rows.alias("a").join(rows.selectExpr("page_id", "pos - 1 AS pos", "x", "y", "w", "h", "category").alias("b"), ["page_id", "pos"])


@query(_NEXT.format("greatest(a.x - b.x - b.w, b.x - a.x - a.w, 0) AS dx, greatest(a.y - b.y - b.h, b.y - a.y - a.h, 0) AS dy, abs(2 * a.y + a.h - 2 * b.y - b.h) <= 40 AS same_line, round(sqrt(((2 * a.x + a.w - 2 * b.x - b.w) ** 2 + (2 * a.y + a.h - 2 * b.y - b.h) ** 2) / 4.0::DOUBLE), 6) AS apart"))
def neighbour_gaps(spark, d):
    """Of boxes that follow each other: the space between them on each axis, whether they are on one line (20 pixels), how far their centres are apart."""
    dx = Q.axis_gap(F.col("a.x"), F.expr("a.x + a.w"), F.col("b.x"), F.expr("b.x + b.w"))
    dy = Q.axis_gap(F.col("a.y"), F.expr("a.y + a.h"), F.col("b.y"), F.expr("b.y + b.h"))
    apart = "round(sqrt((power(2 * a.x + a.w - 2 * b.x - b.w, 2) + power(2 * a.y + a.h - 2 * b.y - b.h, 2)) / 4D), 6) AS apart"
    return _neighbours(spark, d).select("page_id", "pos", dx.alias("dx"), dy.alias("dy"), F.expr("abs(2 * a.y + a.h - 2 * b.y - b.h) <= 40").alias("same_line"), F.expr(apart))


_IOU = "(greatest(least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x), 0) * greatest(least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y), 0))"
_DIOU = f"({_IOU} / CAST(a.w * a.h + b.w * b.h - {_IOU} AS DOUBLE) - (power(2 * a.x + a.w - 2 * b.x - b.w, 2) + power(2 * a.y + a.h - 2 * b.y - b.h, 2)) / 4 / (power(greatest(a.x + a.w, b.x + b.w) - least(a.x, b.x), 2) + power(greatest(a.y + a.h, b.y + b.h) - least(a.y, b.y), 2)))"
_V = "(4 / power(pi(), 2) * power(atan(a.w / CAST(a.h AS DOUBLE)) - atan(b.w / CAST(b.h AS DOUBLE)), 2))"
_CIOU = f"round({_DIOU} - CASE WHEN {_IOU} < a.w * a.h + b.w * b.h - {_IOU} THEN CASE WHEN {_V} = 0 THEN 0 ELSE {_V} / (1 - {_IOU} / CAST(a.w * a.h + b.w * b.h - {_IOU} AS DOUBLE) + {_V}) END ELSE {_V} END * {_V}, 6) AS ciou"


@query(_NEXT.format(_CIOU))
def pair_ciou(spark, d):
    """Complete IoU of boxes that follow each other: distance IoU less a term of unlike proportions."""
    return _neighbours(spark, d).select("page_id", "pos", F.expr(_CIOU))


@query("SELECT page_id, round(coalesce(count(*) FILTER (h > w) / nullif(count(*) FILTER (w > 0 AND length(category) >= 1), 0)::DOUBLE, 0), 6) AS share FROM pred GROUP BY page_id")
def upright_share(spark, d):
    """Share of a page's texts that are taller than wide: near 1 on a turned page."""
    left, top, right, bottom = Q.extent(F.col("outline"))
    rows = _quads(spark, d).select("page_id", (right - left).alias("w"), (bottom - top).alias("h"), "category").where("w > 0 AND length(trim(category)) >= 1")
    return rows.groupBy("page_id").agg(F.expr("round(count_if(h > w) / CAST(count(*) AS DOUBLE), 6)").alias("share"))


@query("SELECT page_id, pos, x AS x1, y AS y1, CASE WHEN w < x OR h < y THEN w ELSE x + w END AS x2, CASE WHEN w < x OR h < y THEN h ELSE y + h END AS y2 FROM pred")
def guessed_corners(spark, d):
    """Four numbers read as two corners where the latter two are less than the former, else as a corner and sides (as the format has it)."""
    corners = F.expr("w < x OR h < y")
    return pred_boxes(spark, d).select("page_id", "pos", F.col("x").alias("x1"), F.col("y").alias("y1"), F.when(corners, F.col("w")).otherwise(F.expr("x + w")).alias("x2"), F.when(corners, F.col("h")).otherwise(F.expr("y + h")).alias("y2"))


@query("SELECT page_id, pos, CASE WHEN category = 'A' AND w <= h THEN x + w / 2.0::DOUBLE - w * 1.5::DOUBLE / 2 ELSE x END AS x1, CASE WHEN category = 'A' AND w > h THEN y + h / 2.0::DOUBLE - h * 1.5::DOUBLE / 2 ELSE y END AS y1, CASE WHEN category = 'A' AND w <= h THEN x + w / 2.0::DOUBLE + w * 1.5::DOUBLE / 2 ELSE x + w END AS x2, CASE WHEN category = 'A' AND w > h THEN y + h / 2.0::DOUBLE + h * 1.5::DOUBLE / 2 ELSE y + h END AS y2 FROM pred")
def thickened_boxes(spark, d):
    """The shorter side of one category's boxes made half as long again, about the centre."""
    side = lambda low, size, sign, is_short: F.when((F.col("category") == "A") & F.expr(is_short), F.col(low) + F.col(size) / 2.0 + sign * F.col(size) * 1.5 / 2).otherwise(F.col(low) + (F.col(size) if sign > 0 else 0))
    sides = {"x1": side("x", "w", -1, "w <= h"), "y1": side("y", "h", -1, "w > h"), "x2": side("x", "w", 1, "w <= h"), "y2": side("y", "h", 1, "w > h")}
    return pred_boxes(spark, d).select("page_id", "pos", *(c.alias(n) for n, c in sides.items()))


_STEM = "(CASE WHEN p_partkey % 3 = 0 THEN 'in/0a1b2c3d-' ELSE 'in/' END || p_name || ' ' || p_brand || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE '_page' || p_size END)"


@query(f"SELECT p_partkey, lower(regexp_replace(regexp_replace(regexp_replace(f, '^.*/', ''), '^[0-9a-f]{{8}}-', ''), '[^A-Za-z0-9]+', '_', 'g')) AS page_key, lower(regexp_replace(f, '_page\\d+$', '')) AS document_key, nullif(regexp_extract(f, '^(.+)_page(\\d+)$', 1), '') AS stem, CAST(nullif(regexp_extract(f, '^(.+)_page(\\d+)$', 2), '') AS INTEGER) AS page, replace(lower(trim(p_name)), ' ', '_') AS slug FROM (SELECT *, {_STEM} AS f FROM part)", pred=False)
def file_keys(spark, d):
    """Keys of pages and documents from file names, the source page, and names as slugs."""
    f = F.expr(_STEM)
    stem, page = T.page_source(f)
    return table(spark, d, "part").select("p_partkey", T.page_key(F.concat(f, F.lit(".png"))).alias("page_key"), F.lower(T.document_key(f)).alias("document_key"), stem.alias("stem"), page.alias("page"), T.slug(F.col("p_name")).alias("slug"))


@query("SELECT p_partkey, trim(regexp_replace(regexp_replace('? ' || p_name || '??  ' || p_brand || ' ?', '\\?+', '', 'g'), '\\s+', ' ', 'g')) AS name, trim(regexp_replace(upper(p_brand || ' ' || p_name), '[^A-Z ]', '', 'g')) AS words FROM part", pred=False)
def cleaned_names(spark, d):
    """Names without placeholders, and their letters alone."""
    return table(spark, d, "part").select("p_partkey", T.without_placeholders(F.expr("'? ' || p_name || '??  ' || p_brand || ' ?'")).alias("name"), T.letters(F.expr("p_brand || ' ' || p_name")).alias("words"))


@query("SELECT p_partkey, substr(sha256(p_name), 1, 12) AS short, sha256(p_brand) AS whole, sha256(p_brand) = sha256(trim(p_brand)) AS same FROM part", pred=False)
def text_digests(spark, d):
    """Digests of contents, short and whole, and whether they are what was expected."""
    return table(spark, d, "part").select("p_partkey", S.short_digest(F.col("p_name")).alias("short"), F.sha2("p_brand", 256).alias("whole"), (F.sha2("p_brand", 256) == F.sha2(F.trim("p_brand"), 256)).alias("same"))


@query("SELECT p_type, substr(sha256(string_agg(lpad(CAST(p_partkey AS VARCHAR), 12, '0') || p_name, '' ORDER BY p_partkey)), 1, 12) AS fingerprint FROM part GROUP BY p_type", pred=False)
def folder_fingerprints(spark, d):
    """One digest of the files of each folder, paths and contents in the order of paths."""
    rows = table(spark, d, "part").selectExpr("p_type", "lpad(CAST(p_partkey AS STRING), 12, '0') AS path", "p_name AS content")
    joined = F.expr("concat_ws('', transform(array_sort(collect_list(struct(path, content))), f -> f.path || f.content))")
    return rows.groupBy("p_type").agg(S.short_digest(joined).alias("fingerprint"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d_%H%M%S') AS run_name, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(ts, '%Y%m%d') AS day, CAST(round_even((epoch_us(ts) % 7777777) / 1000.0::DOUBLE, 0) AS BIGINT) AS took_ms FROM events", pred=False)
def run_times(spark, d):
    """Run names, manifest times, names of daily files, and durations in whole milliseconds."""
    took = "CAST(bround((unix_micros(CAST(ts AS TIMESTAMP)) % 7777777) / 1000D) AS BIGINT) AS took_ms"
    return table(spark, d, "events").selectExpr("event_id", "date_format(ts, 'yyyy-MM-dd_HHmmss') AS run_name", "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") AS iso", "date_format(ts, 'yyyyMMdd') AS day", took)


_GROWN = "w * h * (1 + pos % 4) * 3"


@query(f"SELECT page_id, pos, w * h > 50000 AS by_box, {_GROWN} < w * h * 5 AND w * h * 5 <= 150000 AS collapsed, CASE WHEN {_GROWN} > 160000 THEN 'over_segmentation' WHEN line % 7 = 0 THEN 'flood_swallowed_seed' WHEN {_GROWN} < w * h * 5 AND w * h * 5 <= 150000 THEN 'collapse' WHEN {_GROWN} < 10000 THEN 'label_scale_noop' ELSE 'applied' END AS outcome FROM pred")
def growth_outcomes(spark, d):
    """What became of regions grown from boxes, in the order of the guards."""
    grown, original = F.expr(_GROWN), F.expr("w * h * 5")
    return pred_boxes(spark, d).select("page_id", "pos", (F.expr("w * h") > S.BOX_PROMPT_AREA).alias("by_box"), S.collapsed(grown, original).alias("collapsed"), S.growth_outcome(grown / float(WIDTH * HEIGHT), 0.2, F.expr("line % 7 = 0"), grown, original).alias("outcome"))


@query("SELECT page_id, pos, CASE source WHEN 'vlm_only' THEN 'room_extent' WHEN 'ocr_only' THEN 'label' END AS convention, CASE line % 6 WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 0.8::DOUBLE WHEN 2 THEN 0.7::DOUBLE WHEN 4 THEN 0.9::DOUBLE ELSE 0.3::DOUBLE END AS classified, CASE WHEN w >= h THEN 'horizontal' ELSE 'vertical' END AS band, CASE WHEN conf_milli >= 650 THEN 'kept' ELSE 'low_confidence' END AS verdict FROM pred")
def box_verdicts(spark, d):
    """What a box encloses by its source, the score of its match, the way it runs, and whether .65 keeps it."""
    match = F.expr("element_at(array('exact', 'substring', 'fuzzy', 'fallback', 'vlm', 'guess'), CAST(line % 6 AS INT) + 1)")
    band, verdict = F.expr("IF(w >= h, 'horizontal', 'vertical')"), F.expr("IF(conf_milli >= 650, 'kept', 'low_confidence')")
    return pred_boxes(spark, d).select("page_id", "pos", S.looked_up(F.col("source"), S.CONVENTIONS).alias("convention"), S.looked_up(match, S.MATCH_SCORES, 0.3).alias("classified"), band.alias("band"), verdict.alias("verdict"))


@query("SELECT page_id, pos, round(least(1.0::DOUBLE, 0.0::DOUBLE + 0.3::DOUBLE * least(1.0::DOUBLE, conf_milli / 700.0::DOUBLE) + 0.4::DOUBLE * 0.8::DOUBLE + 0.3::DOUBLE * 0.7::DOUBLE + 0.1::DOUBLE * (line % 2)), 4) AS confidence, round(least(1.0::DOUBLE, conf_milli / 1000.0::DOUBLE + 0.15::DOUBLE), 4) AS recovered, round(conf_milli / 1000.0::DOUBLE * 0.8::DOUBLE, 4) AS fallback FROM pred")
def combined_confidences(spark, d):
    """Weighted confidence with a corroboration bonus, that of recovered abbreviations, and that of texts alone."""
    own = F.col("conf_milli") / 1000.0
    combined = S.combined_confidence(F.col("conf_milli") / 700.0, F.lit(0.8), F.lit(0.7), (F.col("line") % 2).cast("double"), 0.1)
    return pred_boxes(spark, d).select("page_id", "pos", combined.alias("confidence"), F.round(F.least(F.lit(1.0), own + 0.15), 4).alias("recovered"), F.round(own * 0.8, 4).alias("fallback"))


@query("SELECT p_partkey, regexp_replace(p_name || CASE p_partkey % 4 WHEN 0 THEN ' w/ windows' WHEN 1 THEN ' w/ skylights' WHEN 2 THEN ' w/ side openings' ELSE ' w/ doors' END, ' (w/ skylights|w/ side openings|w/ windows)$', '') AS base, CASE WHEN p_size % 6 = 0 THEN 'studio' ELSE (p_size % 6) || 'br' || (CASE WHEN p_size % 6 <= 3 AND p_partkey % 4 <> 1 THEN 2 ELSE p_partkey % 4 END) || 'ba' END AS code, greatest(1, p_size // 10) AS units FROM part", pred=False)
def dwelling_codes(spark, d):
    """Classes without window suffixes, codes of dwellings, and units by fixtures (ten each, one at least)."""
    suffixed = F.expr("p_name || CASE p_partkey % 4 WHEN 0 THEN ' w/ windows' WHEN 1 THEN ' w/ skylights' WHEN 2 THEN ' w/ side openings' ELSE ' w/ doors' END")
    return table(spark, d, "part").select("p_partkey", S.without_suffix(suffixed).alias("base"), S.dwelling_code(F.expr("p_size % 6"), F.expr("p_partkey % 4")).alias("code"), F.expr("CAST(greatest(1, p_size DIV 10) AS INT)").alias("units"))
