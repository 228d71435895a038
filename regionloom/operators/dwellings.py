"""Rooms expected of dwellings, made from their counts, and page records of rooms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The confidence that units are scaled by, and what a text alone or a recovered abbreviation changes.
UNIT_CONFIDENCE, TEXT_SHARE, RECOVERED_BONUS = 0.75, 0.8, 0.15


def _counted(n: Column, short: str, name: str, kind: str) -> Column:
    """Rooms of one kind: without a number if there is one."""
    one = F.array(_room(F.lit(short), F.lit(name), kind))
    many = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1)).cast("int")), lambda k: _room(F.concat(F.lit(short + " "), k), F.concat(F.lit(name + " "), k), kind))
    return F.when(n == 1, one).when(n > 1, many).otherwise(F.filter(one, lambda _: F.lit(False)))


def _room(short: Column, name: Column, kind: str) -> Column:
    return F.struct(short.cast("string").alias("abbreviation"), name.cast("string").alias("name"), F.lit(kind).alias("category"))


def _if(condition: Column, short: str, name: str, kind: str) -> Column:
    return _counted(F.when(condition, 1).otherwise(0), short, name, kind)


def expected_rooms(bedrooms: Column, bathrooms: Column, living: Column, kitchen: Column) -> Column:
    """The rooms of a dwelling in order: studio or bedrooms, living room (not in a studio), kitchen, bathrooms, entry."""
    return F.concat(
        _if(bedrooms == 0, "ST", "STUDIO APARTMENT", "studio"),
        _counted(bedrooms, "BR", "BEDROOM", "bedroom"),
        _if(living & (bedrooms > 0), "LR", "LIVING ROOM", "living_room"),
        _if(kitchen, "KIT", "KITCHEN", "kitchen"),
        _counted(bathrooms, "BA", "BATHROOM", "restroom"),
        _if(F.lit(True), "ENTRY", "ENTRY/HALLWAY", "hallway"),
    )


def unit_rooms(units: DataFrame, key: str, base_confidence: float = UNIT_CONFIDENCE) -> DataFrame:
    """A row for each expected room of each unit (key, bedrooms, bathrooms, living, kitchen, confidence): key, pos (from 0), abbreviation, name, category, unit_type, confidence.

    Null counts mean none, null flags no, a null confidence the usual one.
    """
    n, m = (F.coalesce(F.col(c), F.lit(0)) for c in ("bedrooms", "bathrooms"))
    rooms = expected_rooms(n, m, *(F.coalesce(F.col(c), F.lit(False)) for c in ("living", "kitchen")))
    scaled = F.lit(base_confidence) * (F.coalesce("confidence", F.lit(UNIT_CONFIDENCE)) / UNIT_CONFIDENCE)
    kept = units.select(key, F.concat(n, F.lit("BR"), m, F.lit("BA")).alias("unit_type"), scaled.alias("confidence"), F.posexplode(rooms).alias("pos", "room"))
    return kept.select(key, "pos", "room.*", "unit_type", "confidence")


def first_layers(layers: list[DataFrame], keys: list[str]) -> DataFrame:
    """The union of layers of rooms, of each key the row of the first layer that has it (``pos`` parts rows of a layer)."""
    every = None
    for rank, layer in enumerate(layers):
        ranked = layer.withColumn("layer", F.lit(rank))
        every = ranked if every is None else every.unionByName(ranked)
    best = every.groupBy(*keys).agg(F.min(F.struct("layer", "pos")).alias("first"))
    return best.select(*keys, "first.layer", "first.pos")


def page_records(rooms: DataFrame, page: str, columns: list[str]) -> DataFrame:
    """A JSON record for each page: its rooms in order of ``pos``, absent values left out. A page's rooms are held in one row."""
    room = F.struct("pos", F.struct(*columns).alias("room"))
    listed = rooms.groupBy(page).agg(F.array_sort(F.collect_list(room)).alias("rooms"), F.count("*").alias("n"))
    return listed.select(page, "n", F.to_json(F.struct(F.col(page), F.col("rooms.room").alias("rooms"))).alias("record"))


def identical_loop(boxes: DataFrame, page: list[str]) -> DataFrame:
    """Pages of which three boxes or more, and half of all, are the same: the first gate against made-up rooms."""
    same = boxes.groupBy(*page, "x", "y", "w", "h").agg(F.count("*").alias("n"))
    return same.groupBy(*page).agg(F.max("n").alias("most"), F.sum("n").alias("total")).select(*page, (F.expr("most >= 3 AND 2 * most >= total")).alias("looped"))


def without_nested(rows: DataFrame, page: list[str], kind: str, tenths: int = 7) -> DataFrame:
    """``rows`` without boxes that are ``tenths`` / 10 covered, by the smaller one, with a smaller box of the same class (of equal ones the later pos goes)."""
    a, b = rows.alias("a"), rows.alias("b")
    i = "greatest(least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x), 0) * greatest(least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y), 0)"
    smaller = F.expr("b.w * b.h < a.w * a.h OR b.w * b.h = a.w * a.h AND b.pos < a.pos")
    clash = a.join(b, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in [*page, kind]] + [smaller, F.expr(f"10 * ({i}) >= {tenths} * b.w * b.h")], "left_anti")
    return clash
