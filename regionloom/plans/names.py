"""Queries of names and classes over the driver's tables, with a taxonomy made up for their words."""

from __future__ import annotations

from pyspark.sql import functions as F

from regionloom.functions import vocabulary
from regionloom.operators import naming
from regionloom.plans.registry import query
from regionloom.plans.views import pred_boxes, table

TAXONOMY = naming.Taxonomy(
    classes={"WIDGET ROOM": ("WIDGET", "WID"), "COLD STORE": ("COLD", "ICE BOX", "CS"), "BOLT HALL": ("LARGE BOLT", "BOLT", "BH"), "STORAGE ROOM": ("STORE", "ST")},
    categories={"gear": "BOLT HALL", "hot": "COLD STORE"},
    forms={"SMALL GEAR": "WIDGET ROOM"},
    patterns=((r"(?i)unit\s*\d+", "WIDGET ROOM"),),
    extended={"PLATE WORKS": ("PLATE", "BRAND#1"), "GEAR WORKS": ("GEAR",)},
    nearest={"PLATE WORKS": "BOLT HALL"},
)
SHORT_FORMS = [("CS", "COLD STORE"), ("LB", "LARGE BOLT"), ("W", "WIDGET")]

_RAW = "CASE p_partkey % 9 WHEN 0 THEN p_name WHEN 1 THEN substr(p_name, 1, 3) WHEN 2 THEN ' cold store ' WHEN 3 THEN 'Unit 12 ' || p_name WHEN 4 THEN p_brand WHEN 5 THEN '' WHEN 6 THEN 'cs' WHEN 7 THEN 'hot' ELSE upper(p_name) || ' ST' END"


def _list(pairs) -> str:
    return "[" + ", ".join(f"{{k: '{k}', f: '{f}'}}" for k, f in pairs) + "]"


def _case(key: str, values: dict[str, str]) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


_PARTS = _list((k, f) for k, forms in TAXONOMY.classes.items() for f in forms)
_MORE = _list((TAXONOMY.nearest.get(k, TAXONOMY.default), f) for k, forms in TAXONOMY.extended.items() for f in forms)
_FINE = _list((k, f) for k, forms in TAXONOMY.extended.items() for f in forms)
_HELD = "lambda v: contains(u, v.f) OR contains(v.f, u)"
_RESOLVED = f"""CASE WHEN r = '' THEN NULL ELSE coalesce(
  CASE WHEN u IN ({", ".join(f"'{c}'" for c in TAXONOMY.classes)}) THEN u END,
  {_case("lower(trim(r))", TAXONOMY.categories)}, {_case("u", TAXONOMY.forms)},
  CASE WHEN regexp_matches(trim(r), '^(?:(?i)unit\\s*\\d+)') THEN 'WIDGET ROOM' END,
  CASE WHEN length(u) <= 4 THEN {_case("u", TAXONOMY.whole())} ELSE coalesce(
    list_filter({_PARTS}, lambda v: CASE WHEN length(v.f) <= 4 THEN regexp_matches(u, '\\b' || v.f || '\\b') ELSE contains(u, v.f) OR contains(v.f, u) END)[1].k,
    list_filter({_MORE}, {_HELD})[1].k) END) END"""
_NAMES = f"(SELECT p_partkey, r, upper(trim(r)) AS u FROM (SELECT p_partkey, {_RAW} AS r FROM part))"


def _names(spark, d):
    return table(spark, d, "part").selectExpr("p_partkey", f"{_RAW} AS r")


@query(f"SELECT p_partkey, {_RESOLVED} AS kind, coalesce({_RESOLVED}, 'STORAGE ROOM') AS filled, CASE WHEN length(u) <= 4 THEN {_case('u', TAXONOMY.whole())} END AS short, CASE WHEN u <> '' THEN list_filter({_FINE}, {_HELD})[1].k END AS fine FROM {_NAMES}", pred=False)
def resolved_classes(spark, d):
    """Classes of names by the whole chain, with and without the default; of short names; and finer types."""
    kind = naming.resolve(F.col("r"), TAXONOMY)
    return _names(spark, d).select("p_partkey", kind.alias("kind"), F.coalesce(kind, F.lit(TAXONOMY.default)).alias("filled"), naming.resolve_short(F.col("r"), TAXONOMY).alias("short"), naming.extended_type(F.col("r"), TAXONOMY).alias("fine"))


@query(f"SELECT p_partkey, coalesce(s, {_RESOLVED}, 'STORAGE ROOM') AS kind FROM (SELECT p_partkey, CASE WHEN length(u) <= 4 THEN {_case('u', TAXONOMY.whole())} END AS s, e AS r, upper(trim(e)) AS u FROM (SELECT *, CASE WHEN u = 'CS' THEN 'COLD STORE' WHEN u = 'LB' THEN 'LARGE BOLT' WHEN regexp_matches(u, '^CS[ 0-9-]') THEN 'COLD STORE' || substr(u, 3) WHEN regexp_matches(u, '^LB[ 0-9-]') THEN 'LARGE BOLT' || substr(u, 3) ELSE u END AS e FROM {_NAMES}))", pred=False)
def normalised_names(spark, d):
    """Short forms first, then names with abbreviations spelled out, by the chain, else the default."""
    expanded = vocabulary.expand(F.col("r"), SHORT_FORMS)
    kind = F.coalesce(naming.resolve_short(F.col("r"), TAXONOMY), naming.resolve(expanded, TAXONOMY), F.lit(TAXONOMY.default))
    return _names(spark, d).select("p_partkey", kind.alias("kind"))


@query()
def likeliest_classes(spark, d):
    """Classes with misspelt names compared with all forms; tested against a plain loop."""
    rows = table(spark, d, "part").selectExpr("p_partkey", "concat(p_name, 'x') AS r")
    return naming.normalised(rows, "r", TAXONOMY.with_forms("WIDGET ROOM", ("NEW WIDGET",)))


@query()
def applied_rereads(spark, d):
    """Second readings taken where they extend or resemble the first; tested against a plain loop."""
    rows = table(spark, d, "part")
    rereads = rows.where("p_partkey % 3 <> 0").selectExpr("p_partkey", "CASE p_partkey % 4 WHEN 0 THEN concat(p_name, ' 1') WHEN 1 THEN reverse(p_name) WHEN 2 THEN concat(substr(p_name, 2), 's') ELSE '' END AS reread")
    return naming.rereads_applied(rows.selectExpr("p_partkey", "p_name AS text"), rereads, ["p_partkey"], 0.8)


@query("SELECT page_id, pos FROM pred e WHERE NOT (source = 'vlm_only' AND EXISTS (SELECT 1 FROM pred l WHERE l.page_id = e.page_id AND l.source = 'ocr_only' AND l.category = e.category AND 2 * l.x + l.w BETWEEN 2 * e.x AND 2 * (e.x + e.w) AND 2 * l.y + l.h BETWEEN 2 * e.y AND 2 * (e.y + e.h)))")
def extents_said_once(spark, d):
    """Boxes without extents that hold a label of the same class."""
    rows = pred_boxes(spark, d)
    return naming.without_redundant_extents(rows, ["page_id"], "category", F.col("source") == "vlm_only", F.col("source") == "ocr_only").select("page_id", "pos")
