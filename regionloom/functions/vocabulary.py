"""Names resolved against a vocabulary of ranked surface forms. Vocabularies are parameters, small by nature and literal in the plan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def resolve(text: Column, forms: list[tuple[str, str]], fallback: str | None = None) -> Column:
    """The class of a name: that of the equal form, else (from five characters on) of the first form that holds or is held by the name; else ``fallback``."""
    name = F.trim(F.upper(text))
    exact = F.coalesce(*(F.when(name == form.upper(), kind) for form, kind in forms))
    part = F.coalesce(*(F.when(name.contains(form.upper()) | F.lit(form.upper()).contains(name), kind) for form, kind in forms))
    return F.coalesce(exact, F.when(F.length(name) > 4, part), F.lit(fallback).cast("string"))


def expand(text: Column, short: list[tuple[str, str]]) -> Column:
    """A name whose abbreviation is spelled out: the equal one, else the first that the name starts with before a space, hyphen or digit.

    Single letters aren't expanded; other names stay as they are.
    """
    name = F.trim(F.upper(text))
    usable = [(a.upper(), b) for a, b in short if len(a) > 1]
    whole = F.coalesce(*(F.when(name == a, b) for a, b in usable))
    starts = F.coalesce(*(F.when(name.rlike(f"^{a}[ 0-9-]"), F.concat(F.lit(b), F.substring(name, len(a) + 1, 1 << 20))) for a, b in usable))
    return F.coalesce(whole, starts, name)


def with_suffix(kind: Column, skylights: Column, openings: Column, windows: Column) -> Column:
    """Class with the strongest of its openings: skylight, then opening, then window."""
    return F.when(skylights, F.concat(kind, F.lit(" WITH SKYLIGHT"))).when(openings, F.concat(kind, F.lit(" WITH OPENING"))).when(windows, F.concat(kind, F.lit(" WITH WINDOW"))).otherwise(kind)
