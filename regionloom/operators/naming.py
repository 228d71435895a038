"""Names to classes by a taxonomy that is a parameter: ordered tables of classes and their written forms."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Names up to this length are only ever resolved whole. A fixed value, as are the least likeness and the least length for it.
SHORT, LIKE, LIKE_LENGTH = 4, 0.85, 5


@dataclass(frozen=True)
class Taxonomy:
    """classes and extended: class to written forms, in the order in which they're tried; the latter lead to a class by ``nearest``.

    categories: lower-case model words to classes; forms: whole names to classes; patterns: (regular expression, class).
    All are a vocabulary's size and literal in the plan.
    """

    classes: dict[str, tuple[str, ...]]
    categories: dict[str, str] = field(default_factory=dict)
    forms: dict[str, str] = field(default_factory=dict)
    patterns: tuple[tuple[str, str], ...] = ()
    extended: dict[str, tuple[str, ...]] = field(default_factory=dict)
    nearest: dict[str, str] = field(default_factory=dict)
    default: str = "STORAGE ROOM"

    def with_forms(self, kind: str, forms: tuple[str, ...]) -> Taxonomy:
        """A taxonomy that knows more written forms of a class."""
        return Taxonomy(self.classes | {kind: (*self.classes.get(kind, ()), *forms)}, self.categories, self.forms, self.patterns, self.extended, self.nearest, self.default)

    def whole(self) -> dict[str, str]:
        """Written form to class; of a form that several classes have, the first's."""
        out: dict[str, str] = {}
        for kind, forms in self.classes.items():
            for form in forms:
                out.setdefault(form, kind)
        return out


def _table(key: Column, values: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(v) for pair in values.items() for v in pair))[key] if values else F.lit(None).cast("string")


def _first_part(name: Column, ranked: list[tuple[str, str]], words: bool) -> Column:
    """The class of the first form that holds or is held by the name; short forms count as whole words if ``words``."""
    if not ranked:
        return F.lit(None).cast("string")
    table = F.array(*(F.struct(F.lit(kind).alias("kind"), F.lit(form).alias("form"), F.lit(rf"\b{re.escape(form)}\b" if words and len(form) <= SHORT else None).cast("string").alias("word")) for kind, form in ranked))
    held = F.filter(table, lambda f: F.when(f["word"].isNotNull(), F.regexp_like(name, f["word"])).otherwise(F.contains(name, f["form"]) | F.contains(f["form"], name)))
    return F.get(held, F.lit(0))["kind"]


def resolve_short(text: Column, taxonomy: Taxonomy) -> Column:
    """The class of a name of up to SHORT characters that is a written form; null for others."""
    name = F.upper(F.trim(text))
    return F.when(F.length(name) <= SHORT, _table(name, taxonomy.whole()))


def resolve(text: Column, taxonomy: Taxonomy) -> Column:
    """The class of a name, or null: a class itself, a model word, a whole form, a pattern, a short form, part of a form or one part of it, the same in extended types."""
    raw = F.trim(text)
    name = F.upper(raw)
    classes = F.when(name.isin(list(taxonomy.classes)), name)
    patterns = [F.when(raw.rlike(f"^(?:{p})"), F.lit(kind)) for p, kind in taxonomy.patterns]
    first = F.coalesce(classes, _table(F.lower(raw), taxonomy.categories), _table(name, taxonomy.forms), *patterns)
    parts = _first_part(name, [(k, f) for k, forms in taxonomy.classes.items() for f in forms], True)
    further = _first_part(name, [(taxonomy.nearest.get(k, taxonomy.default), f) for k, forms in taxonomy.extended.items() for f in forms], False)
    found = F.coalesce(first, F.when(F.length(name) <= SHORT, _table(name, taxonomy.whole())).otherwise(F.coalesce(parts, further)))
    return F.when(F.length(text) > 0, found)


def extended_type(text: Column, taxonomy: Taxonomy) -> Column:
    """The finer type whose written form is, holds or is part of the name; null if none."""
    name = F.upper(F.trim(text))
    return F.when(F.length(name) > 0, _first_part(name, [(k, f) for k, forms in taxonomy.extended.items() for f in forms], False))


def likeness(a: str, b: str) -> float:
    """Ratcliff and Obershelp's ratio, from 0 to 1."""
    return SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """``likeness`` of two texts; null if one is."""
    return pd.Series([None if x is None or y is None else likeness(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def normalised(names: DataFrame, column: str, taxonomy: Taxonomy) -> DataFrame:
    """``names`` with ``kind``: the resolved class, else that of the likeliest written form (LIKE and LIKE_LENGTH at least), else the default.

    Only distinct names that nothing else resolves are compared with all forms, in Arrow batches.
    """
    forms = [(kind, form.lower()) for kind, all_forms in taxonomy.classes.items() for form in all_forms]

    @F.pandas_udf("string")
    def likeliest(labels: pd.Series) -> pd.Series:
        def best(label: str) -> str | None:
            found, score = None, 0.0
            for kind, form in forms:
                if (s := likeness(label, form)) > score:
                    found, score = kind, s
            return found if score >= LIKE else None

        return labels.map(best)

    kinds = names.select(F.col(column).alias("name")).distinct().withColumn("found", resolve(F.col("name"), taxonomy))
    unresolved = F.coalesce("found", F.lit(taxonomy.default)) == taxonomy.default
    open_names = kinds.where(unresolved & (F.length(F.trim("name")) >= LIKE_LENGTH)).select("name", likeliest(F.lower(F.trim("name"))).alias("like"))
    all_kinds = kinds.join(open_names, "name", "left").select(F.col("name").alias("of_name"), F.coalesce("like", "found", F.lit(taxonomy.default)).alias("kind"))
    return names.join(all_kinds, F.col(column).eqNullSafe(F.col("of_name")), "left").drop("of_name")


def consistent(original: Column, reread: Column, least: float) -> Column:
    """Whether a second reading extends the first, or is like it: letters and digits alone are compared; an empty one isn't."""
    before, after = (F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), "[^A-Z0-9]", "") for c in (original, reread))
    return (F.length(after) > 0) & (F.contains(after, before) | (similarity(before, after) >= least))


def rereads_applied(texts: DataFrame, rereads: DataFrame, keys: list[str], least: float) -> DataFrame:
    """``texts`` (keys, text) with ``final``: the second reading (keys, reread) where there is a consistent one."""
    joined = texts.join(rereads, keys, "left")
    return joined.withColumn("final", F.when(consistent(F.col("text"), F.col("reread"), least), F.col("reread")).otherwise(F.col("text"))).drop("reread")


def without_redundant_extents(rows: DataFrame, page: list[str], kind: str, is_extent: Column, is_label: Column) -> DataFrame:
    """``rows`` (page, pos, x, y, w, h, the kind) without extents that hold the centre of a label of the same kind on the page: the same room said twice."""
    extents = rows.where(is_extent)
    labels = rows.where(is_label).select(*page, F.col(kind).alias("of_kind"), F.expr("2 * x + w").alias("cx"), F.expr("2 * y + h").alias("cy"))
    inside = F.expr("cx >= 2 * x AND cx <= 2 * (x + w) AND cy >= 2 * y AND cy <= 2 * (y + h)")
    held = extents.alias("e").join(labels.alias("l"), [F.col(f"e.{c}") == F.col(f"l.{c}") for c in page] + [F.col(kind).eqNullSafe(F.col("of_kind")), inside], "left_semi")
    return rows.join(held.select(*page, "pos"), [*page, "pos"], "left_anti")
