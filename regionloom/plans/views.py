"""The driver's tables as pages, boxes and other shapes that the operators work on, in whole numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

WIDTH, HEIGHT = 1000, 800


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pred_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, pos, x, y, w, h, conf_milli, category, source: a box a line item on its order's page."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS page_id",
        "CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS BIGINT) AS pos",
        "(l_partkey * 37) % 800 AS x",
        "(l_suppkey * 53 + l_linenumber * 97) % 600 AS y",
        "40 + CAST(l_quantity AS BIGINT) * 4 AS w",
        "40 + (l_partkey % 40) * 3 AS h",
        "l_partkey % 1000 AS conf_milli",
        "l_returnflag AS category",
        "IF(l_linestatus = 'O', 'ocr_only', 'vlm_only') AS source",
        "l_linenumber AS line",
        "(l_suppkey % 21) - 10 AS shift",
    )


def gt_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boxes of even line numbers, moved by -10 to 10."""
    return pred_boxes(spark, sf_dir).where("line % 2 = 0").selectExpr("page_id", "pos", "x + shift AS x", "y + shift AS y", "w", "h", "category")


#: The same views for the SQL twins.
PRED_SQL = """pred AS (
  SELECT l_orderkey AS page_id,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos,
    (l_partkey * 37) % 800 AS x, (l_suppkey * 53 + l_linenumber * 97) % 600 AS y,
    40 + CAST(l_quantity AS BIGINT) * 4 AS w, 40 + (l_partkey % 40) * 3 AS h,
    l_partkey % 1000 AS conf_milli, l_returnflag AS category,
    CASE WHEN l_linestatus = 'O' THEN 'ocr_only' ELSE 'vlm_only' END AS source, l_linenumber AS line, (l_suppkey % 21) - 10 AS shift
  FROM lineitem)"""
GT_SQL = "gt AS (SELECT page_id, pos, x + shift AS x, y + shift AS y, w, h, category FROM pred WHERE line % 2 = 0)"
