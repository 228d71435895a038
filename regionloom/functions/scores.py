"""Scores, conventions and small verdicts of rooms, as Column functions. Numbers and names here are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a box of each source encloses.
CONVENTIONS = {"ocr_only": "label", "ocr_abbreviation_recovered": "label", "vlm_ocr_merged": "label", "vlm_only": "room_extent"}
#: Classification score by how a name was matched; others count as a fallback.
MATCH_SCORES = {"exact": 1.0, "substring": 0.8, "fuzzy": 0.7, "fallback": 0.3, "vlm": 0.9}
WEIGHTS = (0.3, 0.4, 0.3)
SUFFIXES = ("w/ skylights", "w/ side openings", "w/ windows")
#: Areas in pixels: a prompt by box from, labels up to, and what is still the size of a label.
BOX_PROMPT_AREA, LABEL_AREA, LEAST_GROWN_AREA = 50_000, 150_000, 10_000
DWELLINGS = ("RESIDENTIAL", "APARTMENT", "BEDROOM", "STUDIO")


def looked_up(key: Column, table: dict, default=None) -> Column:
    """The value of a small fixed table, else the default."""
    out = F.lit(default)
    for k, v in table.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def _unit(score: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def combined_confidence(detection: Column, classification: Column, ocr: Column, corroboration: Column | None = None, bonus: float = 0.0) -> Column:
    """Weighted scores, each within 0 to 1, and a bonus that never takes away, to four places."""
    base = sum((F.lit(w) * _unit(s) for w, s in zip(WEIGHTS, (detection, classification, ocr), strict=True)), F.lit(0.0))
    return F.round(_unit(base + F.lit(bonus) * _unit(corroboration if corroboration is not None else F.lit(0.0))), 4)


def without_suffix(kind: Column) -> Column:
    """The class without one of the window suffixes."""
    return F.regexp_replace(kind, f" ({'|'.join(SUFFIXES)})$", "")


def collapsed(found: Column, original: Column) -> Column:
    """A region that shrank below an original of a label's size."""
    return (found < original) & (original <= LABEL_AREA)


def growth_outcome(share: Column, most_share: float, swallowed: Column, found: Column, original: Column) -> Column:
    """What became of a grown region; the first that holds."""
    return (
        F.when(share > most_share, "over_segmentation")
        .when(swallowed, "flood_swallowed_seed")
        .when(collapsed(found, original), "collapse")
        .when(found < LEAST_GROWN_AREA, "label_scale_noop")
        .otherwise("applied")
    )


def miss_kind(best: Column, threshold: float) -> Column:
    return F.when(best >= threshold, "matched").when(best > 0, "near_miss").otherwise("pure_miss")


def dwelling_code(bedrooms: Column, bathrooms: Column) -> Column:
    """studio, or bedrooms and bathrooms; up to three bedrooms any but one bathroom counts as two."""
    exact = F.when((bedrooms <= 3) & (bathrooms != 1), F.lit(2).cast("long")).otherwise(bathrooms.cast("long"))
    return F.when(bedrooms == 0, "studio").otherwise(F.concat(bedrooms.cast("string"), F.lit("br"), exact.cast("string"), F.lit("ba")))


def short_digest(text: Column) -> Column:
    """The first twelve hexadecimal digits of the SHA-256."""
    return F.substring(F.sha2(text, 256), 1, 12)
