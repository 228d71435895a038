"""Foreign formats to boxes and back: label lines, flat polygons, text of models, logs, nested JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COCO = "images array<struct<id:bigint,file_name:string,width:int,height:int>>, categories array<struct<id:bigint,name:string>>, annotations array<struct<id:bigint,image_id:bigint,category_id:bigint,bbox:array<double>,segmentation:array<array<double>>>>"


def read_coco(spark: SparkSession, path: str, merge: DataFrame) -> DataFrame:
    """file_name, category, x, y, w, h: the annotations of COCO files whose category ``merge`` (name, category) knows."""
    whole = spark.read.schema(COCO).json(path, multiLine=True).withColumn("_file", F.input_file_name())
    images = whole.select("_file", F.explode("images").alias("i")).select("_file", F.col("i.id").alias("image_id"), "i.file_name")
    names = whole.select("_file", F.explode("categories").alias("c")).select("_file", F.col("c.id").alias("category_id"), "c.name").join(merge, "name")
    boxes = whole.select("_file", F.explode("annotations").alias("a")).where("size(a.bbox) = 4").selectExpr("_file", "a.image_id", "a.category_id", "a.bbox[0] AS x", "a.bbox[1] AS y", "a.bbox[2] AS w", "a.bbox[3] AS h")
    return boxes.join(names, ["_file", "category_id"]).join(images, ["_file", "image_id"]).select("file_name", "category", "x", "y", "w", "h")


def parse_label_lines(lines: DataFrame, line: str, width: int, height: int) -> DataFrame:
    """``lines`` with class_id and x1, y1, x2, y2 in pixels from 'class cx cy w h' in shares of the page; malformed lines go."""
    f = lines.withColumn("_f", F.split(F.trim(line), r"\s+")).where("size(_f) = 5")
    numbers = f.select("*", F.expr("try_cast(_f[0] AS INT)").alias("class_id"), *(F.expr(f"try_cast(_f[{k}] AS DOUBLE)").alias(n) for k, n in enumerate(("_cx", "_cy", "_w", "_h"), 1)))
    whole = numbers.dropna(subset=["class_id", "_cx", "_cy", "_w", "_h"])
    corners = {"x1": f"(_cx - _w / 2) * {width}", "y1": f"(_cy - _h / 2) * {height}", "x2": f"(_cx + _w / 2) * {width}", "y2": f"(_cy + _h / 2) * {height}"}
    return whole.select("*", *(F.expr(e).alias(n) for n, e in corners.items())).drop("_f", "_cx", "_cy", "_w", "_h")


def label_line(class_id: str, width: int, height: int) -> Column:
    """The line of a box x, y, w, h, with six places."""
    return F.expr(f"format_string('%d %.6f %.6f %.6f %.6f', {class_id}, (x + w / 2D) / {width}, (y + h / 2D) / {height}, CAST(w AS DOUBLE) / {width}, CAST(h AS DOUBLE) / {height})")


def twice_area(flat: str) -> Column:
    """Twice the area of a flat polygon (x, y, x, y, ...) by cross products; null below three corners."""
    n = f"(size({flat}) DIV 2)"
    at = f"element_at({flat}, CAST(2 * (k % {n}) + {{}} AS INT))"
    after = f"element_at({flat}, CAST(2 * ((k + 1) % {n}) + {{}} AS INT))"
    step = f"s + {at.format(1)} * {after.format(2)} - {after.format(1)} * {at.format(2)}"
    return F.expr(f"CASE WHEN size({flat}) >= 6 THEN abs(aggregate(sequence(0, {n} - 1), 0L, (s, k) -> {step})) END")


def json_array_text(answer: Column) -> Column:
    """The JSON array in a model's answer: reasoning and fences off, from the first [ to the last ], without trailing commas; null without one."""
    bare = F.regexp_replace(F.regexp_replace(answer, r"(?s)<think>.*?</think>", ""), r"```[a-z]*", "")
    found = F.nullif(F.regexp_extract(bare, r"(?s)\[.*\]", 0), F.lit(""))
    return F.regexp_replace(found, r",\s*([\]}])", "$1")


def carried_header(rows: DataFrame, keys: list[str], order: str, header: Column) -> DataFrame:
    """``rows`` with header: the last one met up to each row in a log's order."""
    from pyspark.sql import Window

    return rows.withColumn("header", F.last(header, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def flattened(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs as columns with joined names."""

    def leaves(schema: StructType, path: tuple[str, ...]) -> list[Column]:
        found = []
        for f in schema:
            at = (*path, f.name)
            found += leaves(f.dataType, at) if isinstance(f.dataType, StructType) else [F.col(".".join(f"`{p}`" for p in at)).alias(sep.join(at))]
        return found

    return df.select(leaves(df.schema, ()))
