"""Queries of the general data problems: pN_ names, each over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.text import NO_DATA
from ..operators.segment import packed_cells, split_fields
from ..operators.units import CEILING, METRIC_QUANTITY, common_amounts, unit_rows
from ..sources.tables import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Amounts of cementitious and metric_intel in one unit per quantity."""
    return common_amounts(table(spark, d, "cementitious"), table(spark, d, "metric_intel"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """One row per value of the packed fields."""
    scm, cem = table(spark, d, "scm_discovery"), table(spark, d, "cementitious")
    cells = packed_cells([(scm, "discovery_record_id", ["alternative_names"]), (cem, "record_id", ["processing_methods", "alternative_classification"])])
    return split_fields(cells)


QUERIES = {"p2_found": p2_found, "p5_found": p5_found}

_RAISED, _DIGITS = "⁰¹²³⁴⁵⁶⁷⁸⁹₀₁₂₃₄₅₆₇₈₉", "01234567890123456789"
_W = r"[\s\x{00A0}\x{2007}\x{202F}\x{200B}\x{FEFF}]"
_SKIPPED = "(" + ", ".join(f"'{m}'" for m in (*NO_DATA, "-", "see name")) + ")"


def _unit_key(c: str) -> str:
    s = rf"trim(regexp_replace(trim(regexp_replace(lower(translate(coalesce({c}, ''), '{_RAISED}', '{_DIGITS}')), '{_W}+', ' ', 'g'), ' '), '\((?:dry|wet) basis\)', '', 'g'), ' ')"
    s = f"CASE WHEN {s} IN {_SKIPPED} THEN '' ELSE {s} END"
    s = rf"regexp_replace({s}, 'co2(?:[ -]?eq?\b\.?|eq?)?', '', 'g')"
    s = rf"regexp_replace({s}, '\b(?:of )?(?:cement|clinker|binder|concrete|blaine|product)\b', '', 'g')"
    return rf"regexp_replace(regexp_replace(regexp_replace({s}, '\bper\b', '/', 'g'), 'p\. ?a\.?$', '/yr', 'g'), '[ .]', '', 'g')"


def _amounts(rows: str, units: list[str], quantities: list[str], text: bool) -> str:
    """(row_key, quantity, common_value) of ``rows``, a query with row_key and v."""
    keys = ", ".join(f"{_unit_key(u)} AS k{n}" for n, u in enumerate(units, 1))
    allowed = "(" + ", ".join(f"'{q}'" for q in quantities) + ")"
    ceiling = "CASE q " + " ".join(f"WHEN '{q}' THEN {c}" for q, c in CEILING.items()) + " END"
    if text:
        p = rf"trim(regexp_replace(lower(translate(coalesce(v, ''), '{_RAISED}', '{_DIGITS}')), '{_W}+', ' ', 'g'), ' ')"
        for _ in range(4):  # a blank before three digits and no fourth is a mark for thousands; this dialect can't look ahead
            p = f"regexp_replace({p}, '([0-9]) ([0-9]{{3}})([^0-9]|$)', '\\1' || chr(2) || '\\2\\3', 'g')"
        number = r"^(?:(?:~|≈|approx\.?|ca\.?|circa|about|c\.)\s*)?\+?([0-9](?:[0-9.,'']|' || chr(2) || ')*)(e[+-]?[0-9]+)?(.*)$"
        steps = f"""a AS (SELECT *, {p} AS p FROM ({rows})), b AS (SELECT *, regexp_replace(regexp_extract(p, '{number}', 1), '['' ' || chr(2) || ']', '', 'g') AS t, regexp_extract(p, '{number}', 2) AS e, {_unit_key(f"replace(trim(regexp_extract(p, '{number}', 3), ' '), chr(2), ' ')")} AS k0, {keys} FROM a),
c AS (SELECT *, contains(t, ',') AS cm, contains(t, '.') AS dt FROM b), d AS (SELECT *, CASE WHEN NOT cm AND NOT dt THEN t WHEN cm AND dt AND position(',' IN reverse(t)) > position('.' IN reverse(t)) THEN replace(t, ',', '') WHEN cm AND dt THEN replace(replace(t, '.', ''), ',', '.')
 WHEN cm AND regexp_matches(t, '^[1-9][0-9]{{0,2}}(,[0-9]{{3}})+$') THEN replace(t, ',', '') WHEN cm AND regexp_matches(t, '^[0-9]+,[0-9]+$') THEN replace(t, ',', '.') WHEN dt AND regexp_matches(t, '^[1-9][0-9]{{0,2}}(\\.[0-9]{{3}}){{2,}}$') THEN replace(t, '.', '') WHEN cm THEN NULL ELSE t END AS plain FROM c),
f AS (SELECT row_key, says, try_cast(nullif(plain, '') || e AS DOUBLE) AS x, CASE WHEN regexp_matches(t, '^[1-9][0-9]{{0,2}},[0-9]{{3}}$') THEN try_cast(replace(t, ',', '.') AS DOUBLE) END AS other, coalesce(nullif(k0, ''), {", ".join(f"nullif(k{n}, '')" for n in range(1, len(units) + 1))}) AS k FROM d)"""
    else:
        steps = f"""b AS (SELECT *, {keys} FROM ({rows})), f AS (SELECT row_key, says, CASE WHEN NOT isnan(v) THEN v END AS x, NULL::DOUBLE AS other, coalesce({", ".join(f"nullif(k{n}, '')" for n in range(1, len(units) + 1))}) AS k FROM b)"""
    return f"""(WITH {steps}, g AS (SELECT row_key, says, u.q, u.a * CASE WHEN u.a * x + u.b > {ceiling} AND other IS NOT NULL THEN other ELSE x END + u.b AS y FROM f JOIN u ON u.k = f.k WHERE u.q IN {allowed})
SELECT row_key, q AS quantity, round(y * 100)::BIGINT AS common_value FROM g WHERE y IS NOT NULL AND (says IS NULL OR says = q))"""


def _noted(topic: str) -> str:
    return rf"regexp_extract(coalesce(notes, ''), '(?i)(?:unit of )?{topic}(?::| given in| as) *([^;\]]+?) *(?: in table [0-9]+ *)?(?:[;\]]|$)', 1)"


_NAME = r"coalesce(nullif(regexp_extract(coalesce(metric_name, ''), ',\s+(.+)$', 1), ''), nullif(regexp_extract(coalesce(metric_name, ''), '\s+in\s+(\S.*)$', 1), ''), nullif(regexp_extract(coalesce(metric_name, ''), '\[([^\[\]]+)\]\s*$', 1), ''), nullif(regexp_extract(coalesce(metric_name, ''), '\(([^()]*(?:\([^()]*\))?[^()]*)\)\s*$', 1), ''), '')"
_REMARK = r"coalesce(nullif(regexp_extract(coalesce(notes, ''), '(?i)unit: *(.+?) *(?:\(from table\))? *(?:;|$)', 1), ''), nullif(regexp_extract(coalesce(notes, ''), '(?i)(?:value in|reported as|given in|expressed in) +(.+?) *(?:;|$)', 1), ''), nullif(regexp_extract(coalesce(notes, ''), '(?i)^[~+]?[0-9][0-9.,]*(?:e[+-]?[0-9]+)? *(.+?) +at steady state', 1), ''))"
_SAYS = "CASE " + " ".join(f"WHEN regexp_matches(lower(coalesce(metric_name, '')), '{p}') THEN '{q}'" for p, q in METRIC_QUANTITY) + " END"

SQL = {
    "p2_found": f"""WITH u AS (SELECT * FROM (VALUES {", ".join(f"('{k}', '{q}', {a!r}::DOUBLE, {b!r}::DOUBLE)" for k, q, a, b in unit_rows())}) AS t(k, q, a, b))
SELECT DISTINCT * FROM (SELECT 'cementitious' AS origin, * FROM {_amounts("SELECT record_id AS row_key, NULL AS says, compressive_strength_value AS v, compressive_strength_unit, notes FROM cementitious WHERE record_id IS NOT NULL", ["compressive_strength_unit", _noted("strength")], ["strength"], True)}
UNION ALL SELECT 'cementitious', * FROM {_amounts("SELECT record_id AS row_key, NULL AS says, co2_reduction_value AS v, co2_reduction_unit, notes FROM cementitious WHERE record_id IS NOT NULL", ["co2_reduction_unit", _noted("CO2 saving")], ["co2_mass", "co2_volume", "co2_year"], True)}
UNION ALL SELECT 'metric_intel', * FROM {_amounts(f"SELECT metric_id::VARCHAR AS row_key, {_SAYS} AS says, metric_value AS v, unit, notes, metric_name FROM metric_intel WHERE metric_id IS NOT NULL", ["unit", _NAME, _REMARK], list(CEILING), False)})"""
}
