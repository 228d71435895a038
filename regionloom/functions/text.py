"""Keys and names from text, as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def page_source(stem: Column) -> tuple[Column, Column]:
    """Document stem and page number of '<stem>_page<N>'; nulls for other names."""
    pattern = r"^(.+)_page(\d+)$"
    return F.nullif(F.regexp_extract(stem, pattern, 1), F.lit("")), F.nullif(F.regexp_extract(stem, pattern, 2), F.lit("")).cast("int")


def page_key(name: Column) -> Column:
    """File name without folders, upload prefix of eight hexadecimal digits and suffix, other characters as _, in lower case."""
    base = F.regexp_replace(F.regexp_replace(name, r"^.*[/\\]", ""), r"\.[A-Za-z0-9]+$", "")
    return F.lower(F.regexp_replace(F.regexp_replace(base, "^[0-9a-f]{8}-", ""), "[^A-Za-z0-9]+", "_"))


def document_key(stem: Column) -> Column:
    """The document of a page: the name without its page number."""
    return F.regexp_replace(stem, r"_page\d+$", "")


def slug(text: Column) -> Column:
    return F.replace(F.lower(F.trim(text)), F.lit(" "), F.lit("_"))


def letters(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.upper(text), "[^A-Z ]", ""))


def alphanumeric(text: Column) -> Column:
    return F.regexp_replace(F.upper(text), "[^A-Z0-9]", "")


def without_placeholders(text: Column) -> Column:
    """Without question marks, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"\?+", ""), r"\s+", " "))


def least_confidence(text: Column) -> Column:
    """The confidence that a detection of so many characters needs; fixed values."""
    n = F.length(F.trim(text))
    return F.when(n == 1, 0.85).when(n == 2, 0.70).when(n == 3, 0.65).when(n == 4, 0.60).otherwise(0.50)
