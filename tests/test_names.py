"""Name resolution, likeness, second readings and whole-group splits against plain loops."""

from difflib import SequenceMatcher

from pyspark.sql import functions as F

from regionloom.functions import quads
from regionloom.operators import naming, selection
from regionloom.plans import names

DATA = "/root/testdata/sf0.001"


def test_likeliest_classes(spark):
    taxonomy = names.TAXONOMY.with_forms("WIDGET ROOM", ("NEW WIDGET",))
    rows = spark.createDataFrame([(1, "lagre bolt"), (2, "new widgte"), (3, "zzzzzz"), (4, "icebox"), (5, ""), (6, None), (7, "new widgte")], "k long, r string")

    def slow(name):
        name = (name or "").strip()
        found = {"": None}.get(name)
        if len(name) >= 5:
            best = max(((SequenceMatcher(None, name.lower(), f.lower()).ratio(), -n, k) for n, (k, f) in enumerate((k, f) for k, fs in taxonomy.classes.items() for f in fs)), default=(0, 0, None))
            found = best[2] if best[0] >= 0.85 else None
        return found or "STORAGE ROOM"

    got = {r.k: r.kind for r in naming.normalised(rows, "r", taxonomy).collect()}
    assert got == {r.k: slow(r.r) for r in rows.collect()}
    assert got[1] == "BOLT HALL" and got[2] == "WIDGET ROOM"
    assert naming.normalised(rows.where("false"), "r", taxonomy).count() == 0


def test_applied_rereads(spark):
    def slow(text, again):
        a, b = ("".join(c for c in (t or "").upper() if c.isascii() and c.isalnum()) for t in (text, again))
        return again if b and (a in b or SequenceMatcher(None, a, b).ratio() >= 0.8) else text

    part = {r.p_partkey: r.p_name for r in spark.read.parquet(f"{DATA}/part.parquet").collect()}
    again = {k: (n + " 1", n[::-1], n[1:] + "s", "")[k % 4] for k, n in part.items() if k % 3}
    got = {r.p_partkey: r.final for r in names.applied_rereads(spark, DATA).collect()}
    assert got == {k: slow(n, again.get(k)) for k, n in part.items()}
    assert {k for k in part if got[k] != part[k]}


def test_resolution_order(spark):
    """A class before its forms, short names whole only, whole words for short forms, nothing for noise."""
    rows = spark.createDataFrame([("widget room",), ("ST",), ("STX",), ("old st east",), ("oldst east",), ("hot",), ("",), ("   ",), ("ICE",), ("plates",)], "r string")
    got = {r.r: r.kind for r in rows.withColumn("kind", naming.resolve(F.col("r"), names.TAXONOMY)).collect()}
    assert got == {"widget room": "WIDGET ROOM", "ST": "STORAGE ROOM", "STX": None, "old st east": "STORAGE ROOM", "oldst east": None, "hot": "COLD STORE", "": None, "   ": None, "ICE": None, "plates": "BOLT HALL"}


def test_deficit_split(spark):
    def slow(sizes, ratios, pinned):
        total, out = sum(sizes.values()), {g: "test" for g in pinned if g in sizes}
        counts = {"train": 0, "val": 0, "test": sum(sizes[g] for g in out)}
        targets = dict(zip(counts, (r * total / sum(ratios) for r in ratios), strict=True))
        for g in sorted((g for g in sizes if g not in out), key=lambda g: (-sizes[g], g)):
            out[g] = max(counts, key=lambda s: targets[s] - counts[s])
            counts[out[g]] += sizes[g]
        return out

    sizes = {f"g{k}": (k * 37) % 11 + 1 for k in range(40)}
    table = spark.createDataFrame(list(sizes.items()), "grp string, n long")
    got = {r.grp: r.split for r in selection.deficit_split(table, "grp", "n", (8, 1, 1), ["g3", "none"]).collect()}
    assert got == slow(sizes, (8, 1, 1), ["g3", "none"])
    assert selection.deficit_split(table.where("false"), "grp", "n", (8, 1, 1)).count() == 0


def test_turned_outlines_come_back(spark):
    """A quarter turn clockwise and back."""
    row = spark.sql("SELECT 10 AS x, 20 AS y, 30 AS r, 50 AS b").select(quads.quad(*map(F.col, "xyrb")).alias("o"))
    turned = row.select(F.transform("o", lambda p: F.array(F.lit(799) - p[1], p[0])).alias("o"))
    assert turned.select(quads.turned_back(F.col("o"), 800).alias("o")).first().o == row.first().o
