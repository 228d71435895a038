"""Writers of training and review formats. Files are Spark's part files, so that no writer holds a whole corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regionloom.sources.formats import label_line


def write_label_files(boxes: DataFrame, folder: str, page: str, class_id: str, width: int, height: int) -> None:
    """A folder of label lines for each page."""
    lines = boxes.select(page, label_line(class_id, width, height).alias("value"))
    lines.repartition(page).write.partitionBy(page).text(folder)


def write_coco(images: DataFrame, annotations: DataFrame, folder: str) -> None:
    """images, categories and annotations as JSON lines; category ids are ranks of the names in use."""
    names = annotations.select("category").distinct()
    ranked = names.selectExpr("CAST(row_number() OVER (ORDER BY category) AS BIGINT) AS id", "category AS name")  # a vocabulary, small by nature
    images.write.json(f"{folder}/images")
    ranked.write.json(f"{folder}/categories")
    annotations.join(ranked.withColumnRenamed("name", "category"), "category").withColumnRenamed("id", "category_id").drop("category").write.json(f"{folder}/annotations")


def review_tasks(boxes: DataFrame, page: str, width: int, height: int, places: int = 3) -> DataFrame:
    """A row a page: page, n, task (JSON of its boxes as percentages; boxes that leave the page are left out)."""
    shares = [F.round(F.col(c) * 100 / float(size), places).alias(n) for c, n, size in (("x", "x", width), ("y", "y", height), ("w", "width", width), ("h", "height", height))]
    inside = boxes.where(f"x >= 0 AND y >= 0 AND x + w <= {width} AND y + h <= {height}")
    rows = inside.select(page, "pos", F.struct("category", *shares).alias("value"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "value")))
    return rows.groupBy(page).agg(F.count("*").alias("n"), ordered.alias("_all")).select(page, "n", F.to_json(F.struct(F.expr("transform(_all, r -> r.value)").alias("result"))).alias("task"))


def chat_records(turns: DataFrame, conversation: str, turn: str) -> DataFrame:
    """A row a conversation: its id and messages (role and content parts) in the order of turns."""
    message = F.struct(turn, F.col("role"), F.array(F.struct(F.lit("text").alias("type"), F.col("text"))).alias("content"))
    rows = turns.groupBy(conversation).agg(F.array_sort(F.collect_list(message)).alias("_all"))
    return rows.select(conversation, F.expr("transform(_all, m -> struct(m.role AS role, m.content AS content))").alias("messages"))


def write_by_split(rows: DataFrame, folder: str, split: str = "split") -> None:
    """JSON lines in a folder for each split."""
    rows.write.partitionBy(split).json(folder)
