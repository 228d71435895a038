"""Queries of reports, samples, splits and set operations over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from regionloom.functions import scores as S
from regionloom.operators import selection
from regionloom.plans.registry import query
from regionloom.plans.views import pred_boxes, table


@query("SELECT page_id, count(*) AS rooms, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources, count(*) FILTER (conf_milli < 100) AS untagged, round(CASE WHEN count(*) >= 2 THEN max(w * h) / nullif(median(w * h), 0) END, 6) AS spread FROM pred GROUP BY page_id")
def page_consistency(spark, d):
    """Boxes, conventions, boxes without one, and the spread of areas of each page."""
    spread = "round(IF(count(*) >= 2, max(w * h) / nullif(median(w * h), 0D), NULL), 6)"
    return pred_boxes(spark, d).groupBy("page_id").agg(F.count("*").alias("rooms"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"), F.count_if(F.expr("conf_milli < 100")).alias("untagged"), F.expr(spread).alias("spread"))


@query("SELECT page_id, spread FROM (SELECT page_id, round(max(w * h) / median(w * h), 6) AS spread FROM pred GROUP BY page_id HAVING count(*) >= 2) ORDER BY spread DESC, page_id LIMIT 15")
def widest_pages(spark, d):
    """The fifteen pages with the widest spread of areas (a top-k report)."""
    rows = pred_boxes(spark, d).groupBy("page_id").agg(F.count("*").alias("n"), F.expr("round(max(w * h) / median(w * h), 6)").alias("spread")).where("n >= 2")
    return rows.orderBy(F.desc("spread"), "page_id").limit(15).select("page_id", "spread")


@query("SELECT category, round(quantile_cont(CAST(w AS DOUBLE) / h, 0.5), 6) AS p50, round(quantile_cont(CAST(w AS DOUBLE) / h, 0.9), 6) AS p90, round(max(CAST(w AS DOUBLE) / h), 6) AS most FROM pred GROUP BY category")
def ratio_percentiles(spark, d):
    """Median, ninetieth percentile and maximum of ratios, exact with linear interpolation."""
    ratio = "CAST(w AS DOUBLE) / h"
    return pred_boxes(spark, d).groupBy("category").agg(F.expr(f"round(percentile({ratio}, 0.5), 6)").alias("p50"), F.expr(f"round(percentile({ratio}, 0.9), 6)").alias("p90"), F.expr(f"round(max({ratio}), 6)").alias("most"))


@query("SELECT CAST(p AS INTEGER) AS percentile, round(quantile_cont(a, p / 100.0::DOUBLE), 6) AS cutoff FROM (SELECT sqrt(w * h) AS a FROM pred), (SELECT unnest([50, 75, 90]) AS p) GROUP BY p, p / 100.0::DOUBLE".replace("quantile_cont(a, p / 100.0::DOUBLE)", "CASE p WHEN 50 THEN quantile_cont(a, 0.5) WHEN 75 THEN quantile_cont(a, 0.75) ELSE quantile_cont(a, 0.9) END").replace("GROUP BY p, p / 100.0::DOUBLE", "GROUP BY p"))
def distance_cutoffs(spark, d):
    """Cutoffs for attachment taken from the data, at three percentiles."""
    found = pred_boxes(spark, d).agg(F.expr("percentile(sqrt(w * h), array(0.5, 0.75, 0.9))").alias("c"))
    return found.selectExpr("posexplode(c) AS (k, cutoff)").selectExpr("array(50, 75, 90)[k] AS percentile", "round(cutoff, 6) AS cutoff")


@query("SELECT round(avg(p), 6) AS precision, round(avg(r), 6) AS recall, count(*) AS documents FROM (SELECT page_id % 20 AS document, count(*) FILTER (conf_milli >= 500 AND line % 2 = 0) / nullif(count(*) FILTER (conf_milli >= 500), 0)::DOUBLE AS p, count(*) FILTER (conf_milli >= 500 AND line % 2 = 0) / nullif(count(*) FILTER (line % 2 = 0), 0)::DOUBLE AS r FROM pred GROUP BY page_id % 20)")
def macro_average(spark, d):
    """Precision and recall averaged over documents, each counting alike."""
    hit = "count_if(conf_milli >= 500 AND line % 2 = 0)"
    per = pred_boxes(spark, d).groupBy(F.expr("page_id % 20").alias("document")).agg(F.expr(f"{hit} / CAST(nullif(count_if(conf_milli >= 500), 0) AS DOUBLE)").alias("p"), F.expr(f"{hit} / CAST(nullif(count_if(line % 2 = 0), 0) AS DOUBLE)").alias("r"))
    return per.agg(F.round(F.avg("p"), 6).alias("precision"), F.round(F.avg("r"), 6).alias("recall"), F.count("*").alias("documents"))


@query("SELECT r_name AS category, count(n_nationkey) AS n FROM region LEFT JOIN nation ON n_regionkey = r_regionkey AND n_nationkey % 2 = 1 WHERE r_name NOT IN ('ASIA', 'EUROPE') GROUP BY r_name", pred=False)
def unscored_categories(spark, d):
    """Categories that no merge rule takes, with their counts, zero ones too."""
    merged = spark.createDataFrame([("ASIA",), ("EUROPE",)], "r_name string")
    left = table(spark, d, "region").join(F.broadcast(merged), "r_name", "left_anti")  # a literal list of two
    counts = table(spark, d, "nation").where("n_nationkey % 2 = 1").groupBy("n_regionkey").agg(F.count("*").alias("n"))
    return left.join(counts, F.expr("n_regionkey = r_regionkey"), "left").selectExpr("r_name AS category", "coalesce(n, 0L) AS n")


_BEST = "(conf_milli % 500) / 1000.0::DOUBLE"
_KIND = f"CASE WHEN {_BEST} >= 0.3 THEN 'matched' WHEN {_BEST} > 0 THEN 'near_miss' ELSE 'pure_miss' END"


@query(f"SELECT {_KIND} AS kind, count(*) AS n, round(median(CASE WHEN {_KIND} = 'near_miss' THEN w / CAST(h AS DOUBLE) END), 6) AS near_ratio FROM pred GROUP BY {_KIND}")
def miss_diagnosis(spark, d):
    """Boxes by how nearly they were found, and the median ratio of near misses."""
    rows = pred_boxes(spark, d).withColumn("kind", S.miss_kind(F.expr("(conf_milli % 500) / 1000D"), 0.3))
    return rows.groupBy("kind").agg(F.count("*").alias("n"), F.expr("round(median(IF(kind = 'near_miss', w / CAST(h AS DOUBLE), NULL)), 6)").alias("near_ratio"))


@query("SELECT least(n, 5) AS boxes, count(*) AS pages FROM (SELECT page_id, count(*) AS n FROM pred GROUP BY page_id) GROUP BY ALL")
def capped_histogram(spark, d):
    """Pages by their number of boxes, five and more together."""
    per = pred_boxes(spark, d).groupBy("page_id").agg(F.count("*").alias("n"))
    return per.groupBy(F.expr("least(n, 5L)").alias("boxes")).agg(F.count("*").alias("pages"))


@query("SELECT category AS bucket, count(*) AS n_rooms, list_sort(list(conf_milli))[CAST(count(*) // 2 + 1 AS BIGINT)] AS upper_median, round(count(*) FILTER (conf_milli >= 500) / count(*)::DOUBLE, 6) AS accuracy_at_5, round(count(*) FILTER (2 * w < h) / count(*)::DOUBLE, 6) AS undershoot, round(count(*) FILTER (w > 2 * h) / count(*)::DOUBLE, 6) AS flood FROM pred GROUP BY category")
def bucket_summaries(spark, d):
    """Per bucket the upper median (of an even count the greater of the middle two) and shares; the median by ranks, so that no bucket is one row."""
    rows = pred_boxes(spark, d)
    ranked = rows.groupBy("category", "conf_milli").agg(F.count("*").alias("n"))
    run = Window.partitionBy("category").orderBy("conf_milli")
    placed = ranked.select("category", "conf_milli", F.sum("n").over(run).alias("upto"), F.sum("n").over(Window.partitionBy("category")).alias("total"))
    middle = placed.where("upto > total DIV 2").groupBy("category").agg(F.min("conf_milli").alias("upper_median"))
    shares = rows.groupBy("category").agg(F.count("*").alias("n_rooms"), *(F.expr(f"round(count_if({e}) / CAST(count(*) AS DOUBLE), 6)").alias(n) for n, e in (("accuracy_at_5", "conf_milli >= 500"), ("undershoot", "2 * w < h"), ("flood", "w > 2 * h"))))
    return shares.join(middle, "category").withColumnRenamed("category", "bucket")


@query(" UNION ALL ".join(f"SELECT '{f}' AS field, round(avg({f}), 6) AS mean, round(median({f}), 6) AS median, round(stddev_samp({f}), 6) AS deviation, min({f}) AS least, max({f}) AS most, max({f}) - min({f}) AS range FROM pred" for f in "xywh"))
def field_statistics(spark, d):
    """Mean, median, deviation, extremes and range of each field, in one pass."""
    made = ", ".join(f"struct('{f}' AS field, round(avg({f}), 6) AS mean, round(median({f}), 6) AS median, round(stddev_samp({f}), 6) AS deviation, min({f}) AS least, max({f}) AS most, max({f}) - min({f}) AS range)" for f in "xywh")
    return pred_boxes(spark, d).agg(F.expr(f"array({made})").alias("all")).selectExpr("inline(all)")


@query("SELECT count(*) AS before, count(*) FILTER (conf_milli >= 500) AS after, round(count(*) FILTER (conf_milli >= 500) / count(*)::DOUBLE, 6) AS rate FROM pred")
def filter_report(spark, d):
    """How many boxes a threshold leaves."""
    kept = "count_if(conf_milli >= 500)"
    return pred_boxes(spark, d).agg(F.count("*").alias("before"), F.expr(kept).alias("after"), F.expr(f"round({kept} / CAST(count(*) AS DOUBLE), 6)").alias("rate"))


@query("SELECT page_id, count(*) AS annotations, array_to_string(list(category ORDER BY pos) [1:8], ',') AS names FROM pred GROUP BY page_id")
def annotation_counts(spark, d):
    """Annotations of each page and the names of the first eight."""
    names = "array_join(transform(slice(array_sort(collect_list(struct(pos, category))), 1, 8), r -> r.category), ',')"
    return pred_boxes(spark, d).groupBy("page_id").agg(F.count("*").alias("annotations"), F.expr(names).alias("names"))


@query("SELECT category, count(*) AS n FROM pred GROUP BY category")
def detection_summary(spark, d):
    return pred_boxes(spark, d).groupBy("category").agg(F.count("*").alias("n"))


@query("SELECT page_id, bool_or(category IN ('A', 'R')) AS dwelling, count(*) FILTER (category = 'A') = max(line) // 3 AS bedrooms_match, count(*) FILTER (category = 'R') = max(line) // 4 AS bathrooms_match FROM pred GROUP BY page_id")
def dwelling_checks(spark, d):
    """Whether a page shows a dwelling by its words, and whether rooms of two kinds are as many as the unit says."""
    word = F.expr("CASE category WHEN 'A' THEN 'Bedroom 1' WHEN 'R' THEN 'studio bath' ELSE 'OFFICE' END")
    rows = pred_boxes(spark, d).withColumn("name", F.upper(word))
    return rows.groupBy("page_id").agg(F.bool_or(F.col("name").rlike("|".join(S.DWELLINGS))).alias("dwelling"), F.expr("count_if(contains(name, 'BEDROOM')) = max(line) DIV 3").alias("bedrooms_match"), F.expr("count_if(contains(name, 'BATH')) = max(line) DIV 4").alias("bathrooms_match"))


@query("SELECT page_id, pos, CASE WHEN category = 'N' AND bool_or(category = 'A') OVER (PARTITION BY page_id) THEN 'A' ELSE category END AS resolved FROM pred")
def context_types(spark, d):
    """An ambiguous class takes the class that another box of the page carries unambiguously."""
    return selection.resolved_by_context(pred_boxes(spark, d), ["page_id"], "category", {"N": "A"}).selectExpr("page_id", "pos", "resolved")


_SIZES = "SELECT c_nationkey AS g, count(*) AS n FROM customer GROUP BY c_nationkey"
_SPLITS = f"list_reduce(list_prepend({{g: NULL::INTEGER, n: 0::BIGINT, a: 0::BIGINT, b: 0::BIGINT, c: (SELECT count(*) FROM customer WHERE c_nationkey = 3)::BIGINT, done: []::STRUCT(g INTEGER, s VARCHAR)[]}}, list({{g: g, n: n, a: 0::BIGINT, b: 0::BIGINT, c: 0::BIGINT, done: []::STRUCT(g INTEGER, s VARCHAR)[]}} ORDER BY n DESC, g)), lambda s, r: CASE WHEN 8 * t - 10 * s.a >= greatest(t - 10 * s.b, t - 10 * s.c) THEN {{g: r.g, n: r.n, a: s.a + r.n, b: s.b, c: s.c, done: list_append(s.done, {{g: r.g, s: 'train'}})}} WHEN t - 10 * s.b >= t - 10 * s.c THEN {{g: r.g, n: r.n, a: s.a, b: s.b + r.n, c: s.c, done: list_append(s.done, {{g: r.g, s: 'val'}})}} ELSE {{g: r.g, n: r.n, a: s.a, b: s.b, c: s.c + r.n, done: list_append(s.done, {{g: r.g, s: 'test'}})}} END)"


@query(f"SELECT u.g AS grp, u.s AS split FROM (SELECT unnest((q).done) AS u FROM (SELECT {_SPLITS} AS q FROM (SELECT *, (SELECT count(*) FROM customer) AS t FROM ({_SIZES})) WHERE g <> 3 GROUP BY t)) UNION ALL SELECT 3, 'test' WHERE EXISTS (SELECT 1 FROM customer WHERE c_nationkey = 3)", pred=False)
def deficit_split(spark, d):
    """Groups dealt whole, the largest first, to the split that lacks most of its share (.8, .1, .1); pinned groups are for the test."""
    sizes = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("grp")).agg(F.count("*").alias("n"))
    return selection.deficit_split(sizes, "grp", "n", (8, 1, 1), pinned=[3])


@query("SELECT c_custkey, CASE WHEN c_nationkey % 4 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE 'group ' || c_nationkey END AS grp FROM customer", pred=False)
def group_of(spark, d):
    """The group of a document, or the document itself where no group takes it."""
    groups = table(spark, d, "nation").where("n_nationkey % 4 <> 0").selectExpr("n_nationkey AS c_nationkey", "concat('group ', n_nationkey) AS named")
    return table(spark, d, "customer").join(groups, "c_nationkey", "left").selectExpr("c_custkey", "coalesce(named, CAST(c_custkey AS STRING)) AS grp")


@query("SELECT p_partkey, bucket FROM (SELECT p_partkey, p_type AS bucket, row_number() OVER (PARTITION BY p_type ORDER BY p_name, p_partkey) AS n FROM part) WHERE n <= 5", pred=False)
def stratified_sample(spark, d):
    """The first five of each bucket in the order of paths; the bucket is the path's third part from the end."""
    rows = table(spark, d, "part").selectExpr("p_partkey", "concat_ws('/', 'root', p_type, p_name, 'F1.svg') AS path")
    bucketed = rows.withColumn("bucket", F.element_at(F.split("path", "/"), -3))
    return selection.first_by(bucketed, ["bucket"], [F.col("path"), F.col("p_partkey")], 5).select("p_partkey", "bucket")


@query("SELECT page_id, pos, w AS tokens FROM pred WHERE w <= 200 ORDER BY w DESC, page_id, pos LIMIT 50")
def longest_examples(spark, d):
    """Of the examples within a token budget the fifty longest (a top-k report)."""
    return pred_boxes(spark, d).where("w <= 200").orderBy(F.desc("w"), "page_id", "pos").limit(50).selectExpr("page_id", "pos", "w AS tokens")


@query("SELECT page_id, tx, ty, count(*) AS n FROM (SELECT page_id, (2 * x + w) // 668 AS tx, (2 * y + h) // 800 AS ty FROM pred) GROUP BY ALL ORDER BY n DESC, page_id, tx, ty LIMIT 20")
def densest_tiles(spark, d):
    """The twenty tiles that hold most centres (a top-k report)."""
    tiles = pred_boxes(spark, d).selectExpr("page_id", "(2 * x + w) DIV 668 AS tx", "(2 * y + h) DIV 800 AS ty").groupBy("page_id", "tx", "ty").agg(F.count("*").alias("n"))
    return tiles.orderBy(F.desc("n"), "page_id", "tx", "ty").limit(20)


@query("SELECT page_id, pos, category, 'text' AS origin FROM pred WHERE source = 'ocr_only' UNION ALL SELECT page_id, pos, category, 'extra' FROM pred p WHERE source <> 'ocr_only' AND NOT EXISTS (SELECT 1 FROM pred o WHERE o.page_id = p.page_id AND o.source = 'ocr_only' AND o.category = p.category)")
def texts_and_extras(spark, d):
    """Detections of texts, and further ones that collide with none."""
    rows = pred_boxes(spark, d)
    texts = rows.where("source = 'ocr_only'")
    extras = rows.where("source <> 'ocr_only'").join(texts.select("page_id", "category"), ["page_id", "category"], "left_anti")
    return texts.selectExpr("page_id", "pos", "category", "'text' AS origin").unionByName(extras.selectExpr("page_id", "pos", "category", "'extra' AS origin"))


@query("SELECT page_id, pos FROM pred WHERE line % 2 = 0 UNION SELECT page_id, pos FROM pred p WHERE line % 2 = 1 AND NOT EXISTS (SELECT 1 FROM pred o WHERE o.page_id = p.page_id AND o.pos = p.pos - 1)")
def names_and_unlinked_numbers(spark, d):
    """Candidates by name, and numbers that no name before them took."""
    rows = pred_boxes(spark, d)
    linked = rows.selectExpr("page_id", "pos + 1 AS pos")
    return rows.where("line % 2 = 0").select("page_id", "pos").unionByName(rows.where("line % 2 = 1").join(linked, ["page_id", "pos"], "left_anti").select("page_id", "pos"))


@query("SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_custkey % 3 = 0 INTERSECT SELECT s_nationkey FROM supplier", pred=False)
def held_out_leaks(spark, d):
    """Documents that are in training and in evaluation."""
    return table(spark, d, "customer").where("c_custkey % 3 = 0").selectExpr("c_nationkey AS k").intersect(table(spark, d, "supplier").selectExpr("s_nationkey AS k"))


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier", pred=False)
def training_documents(spark, d):
    """All documents of all training sets, each once."""
    return table(spark, d, "customer").selectExpr("c_nationkey AS k").unionByName(table(spark, d, "supplier").selectExpr("s_nationkey AS k")).distinct()


@query("SELECT page_id % 50 AS document FROM pred WHERE category IN ('A', 'N', 'R') GROUP BY ALL HAVING count(DISTINCT category) = 3")
def common_documents(spark, d):
    """Documents that every member of a band has."""
    rows = pred_boxes(spark, d).where("category IN ('A', 'N', 'R')").selectExpr("page_id % 50 AS document", "category").distinct()
    return rows.groupBy("document").agg(F.count("*").alias("n")).where("n = 3").select("document")


@query("SELECT page_id, pos FROM pred p WHERE NOT EXISTS (SELECT 1 FROM pred b WHERE b.page_id = p.page_id AND b.line % 3 = 0 AND b.category = p.category AND b.x = p.x AND b.y = p.y AND b.w = p.w AND b.h = p.h)")
def second_pass_boxes(spark, d):
    """Recorded boxes that the baseline lacks, by name and place."""
    rows = pred_boxes(spark, d)
    return rows.join(rows.where("line % 3 = 0").select("page_id", "category", "x", "y", "w", "h"), ["page_id", "category", "x", "y", "w", "h"], "left_anti").select("page_id", "pos")


@query("SELECT page_id, pos, CASE WHEN conf_milli % 7 = 0 THEN 'archived' ELSE 'kept' END AS fate FROM pred")
def synthetic_archived(spark, d):
    """Made-up rooms are archived, the others stay; a row without a mark stays."""
    made = F.expr("coalesce(conf_milli % 7 = 0, FALSE)")
    return pred_boxes(spark, d).select("page_id", "pos", F.when(made, "archived").otherwise("kept").alias("fate"))
