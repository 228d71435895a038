"""Objects to rooms, numbers to names and faces to labels, by joins within pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regionloom.functions import boxes as B
from regionloom.operators.joins import cell_join, nearest_within, smallest_containing


def attach(objects: DataFrame, rooms: DataFrame, keys: list[str], reach: int | None = None) -> DataFrame:
    """keys, pos, room_pos, way: every room that an object meets ('met', touching counts), else the nearest centre within ``reach`` ('near')."""
    met = cell_join(objects, rooms, keys, B.near(B.box("l_"), B.box("r_"), 0)).select(*keys, F.col("l_pos").alias("pos"), F.col("r_pos").alias("room_pos"), F.lit("met").alias("way"))
    if reach is None:
        return met
    left = objects.join(met.select(*keys, "pos").distinct(), [*keys, "pos"], "left_anti")
    near = nearest_within(left.select(*objects.columns), rooms, keys, reach)
    return met.unionByName(near.select(*keys, "pos", F.col("nearest_pos").alias("room_pos"), F.lit("near").alias("way")))


def room_flags(attached: DataFrame, objects: DataFrame, keys: list[str], kinds: dict[str, str]) -> DataFrame:
    """Of each room that has objects: a flag for each kind of ``kinds`` (category to name), and the objects of no such kind counted."""
    named = attached.join(objects.select(*keys, "pos", "category"), [*keys, "pos"])
    flags = [F.bool_or(F.col("category") == kind).alias(f"has_{name}") for kind, name in kinds.items()]
    return named.groupBy(*keys, "room_pos").agg(*flags, F.count_if(~F.col("category").isin(*kinds)).alias("unknown"))


def link_numbers(numbers: DataFrame, names: DataFrame, keys: list[str], reach: int = 300) -> DataFrame:
    """keys, pos, name_pos, outcome of each number: 'linked' to its nearest name, 'dropped' where a number of smaller pos has that name, 'alone' without a name within ``reach``."""
    near = nearest_within(numbers, names, keys, reach)
    first = F.min("pos").over(Window.partitionBy(*keys, "nearest_pos"))
    linked = near.select(*keys, "pos", F.col("nearest_pos").alias("name_pos"), F.when(F.col("pos") == first, "linked").otherwise("dropped").alias("outcome"))
    return numbers.select(*keys, "pos").join(linked, [*keys, "pos"], "left").select(*keys, "pos", "name_pos", F.coalesce("outcome", F.lit("alone")).alias("outcome"))


def own_extents(labels: DataFrame, faces: DataFrame, keys: list[str]) -> DataFrame:
    """keys, pos, outer_pos: the smallest face around each label's centre, where no other label has the same one."""
    claims = smallest_containing(labels, faces, keys)
    return claims.withColumn("_n", F.count("*").over(Window.partitionBy(*keys, "outer_pos"))).where("_n = 1").drop("_n")


def best_overlaps(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """keys, pos, best: the largest IoU of each left box with a right one, 0 without."""
    met = cell_join(left, right, keys, B.intersection(B.box("l_"), B.box("r_")) > 0)
    best = met.groupBy(*keys, F.col("l_pos").alias("pos")).agg(F.max(B.iou(B.box("l_"), B.box("r_"))).alias("best"))
    return left.select(*keys, "pos").join(best, [*keys, "pos"], "left").select(*keys, "pos", F.coalesce("best", F.lit(0.0)).alias("best"))


def loop_verdicts(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """keys, verdict of each page: 'repeated' when one box makes up half of a page and comes three times or more, 'lattice' when
    six boxes or more fill a grid of their distinct edges to within one, else 'fine'."""
    same = boxes.groupBy(*keys, "x", "y", "w", "h").agg(F.count("*").alias("times"))
    page = same.groupBy(*keys).agg(F.sum("times").alias("n"), F.max("times").alias("most"), F.countDistinct("x").alias("nx"), F.countDistinct("y").alias("ny"))
    lattice = "n >= 6 AND nx >= 2 AND ny >= 2 AND nx * ny >= 6 AND abs(nx * ny - n) <= 1"
    return page.selectExpr(*keys, f"CASE WHEN most >= 3 AND 2 * most >= n THEN 'repeated' WHEN {lattice} THEN 'lattice' ELSE 'fine' END AS verdict")
