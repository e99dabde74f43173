"""Queries of the field normalisers, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import normalise as N
from ..functions import scalars as S
from ..functions.text import known, present
from ..operators import records as R
from ..sources.tables import table
from .book import Book
from .reference import _fold, _has, _known

book = Book()
query = book.query
QUERIES, SQL = book.queries, book.sql

LEVELS = ("High", "Medium", "Low")
LEVEL_ALIASES = {"h": "High", "hi": "High", "med": "Medium", "mid": "Medium", "m": "Medium", "l": "Low"}
STAGES = ("Laboratory", "Pilot", "Demonstration", "Commercial")
STAGE_PATTERNS = [("pilot|semi-industrial", "Pilot"), ("demo|first of a kind", "Demonstration"), ("commerc|industrial|full[ -]scale", "Commercial"), ("^lab|bench", "Laboratory")]
PLANS = "planned|expected|by 20[3-9][0-9]|will be"
ORIGINS = {"literature": "Literature", "paper": "Literature", "journal": "Literature", "web": "Web", "internet": "Web", "website": "Web"}
DIMENSIONS = ("CO2 Reduction", "Energy", "Cost", "Other")
DIMENSION_ALIASES = {"co2": "CO2 Reduction", "emissions": "CO2 Reduction", "energy use": "Energy", "price": "Cost"}
UNITS = ["GJ/t", "MJ/t", "kWh/t", "kg/m3", "kg/t", "MPa", "N/mm2", "psi", "%", "tonnes?"]
METRICS = [("capital|capex", "capital cost"), ("opex|operating", "operating cost"), ("penalty|regeneration", "energy penalty"), ("capture rate", "capture rate"), ("strength", "strength"), ("co2|emission", "emissions")]
SIXTEEN = ("", "n.a.", "na", "n/a", "not reported", "unknown", "not available", "none", "null", "nan", "-", "--", "tbd", "?", "nil", "not stated")


def _q(xs) -> str:
    return "(" + ", ".join(f"'{x}'" for x in xs) + ")"


def _missing_to(c: str, sentinel: str, tokens) -> str:
    return f"(CASE WHEN {c} IS NULL OR trim({c}) = '' OR lower(trim({c})) IN {_q(tokens)} THEN '{sentinel}' ELSE trim({c}) END)"


def _word(t: str, w: str) -> str:
    return f"regexp_matches({t}, '(?:^|[^a-z0-9_]){w.lower()}(?:$|[^a-z0-9_])')"


def _vocab(c: str, allowed, aliases=None, patterns=(), veto=None, words=True, default="N.A.") -> tuple[str, str]:
    t, low = f"trim({_known(c)})", f"lower(trim({_known(c)}))"
    cases = [f"WHEN {t} IS NULL THEN '{default}'", f"WHEN {t} IN {_q(allowed)} THEN {t}"]
    cases += [f"WHEN regexp_matches({low}, '{veto}') THEN '{default}'"] if veto else []
    cases += [f"WHEN {low} = '{k}' THEN '{v}'" for k, v in (aliases or {}).items()]
    cases += [f"WHEN regexp_matches({low}, '{p}') THEN '{v}'" for p, v in patterns]
    cases += [f"WHEN {_word(low, a)} THEN '{a}'" for a in allowed] if words else []
    v = f"(CASE {' '.join(cases)} ELSE '{default}' END)"
    return v, f"({t} IS NOT NULL AND {v} <> {t})"


@query(f"""SELECT DISTINCT record_id, {_missing_to("project_name", "N.A.", SIXTEEN)} AS as_na_dots, {_missing_to("country", "", SIXTEEN[:11])} AS as_blank, {_missing_to("doi", "NA", SIXTEEN[:7])} AS as_na FROM cementitious""")
def three_sentinels(spark, d):
    """What is missing under three products' sentinels and token lists."""
    c = table(spark, d, "cementitious")
    return c.select("record_id", N.missing_to("project_name", "N.A.", SIXTEEN).alias("as_na_dots"), N.missing_to("country", "", SIXTEEN[:11]).alias("as_blank"), N.missing_to("doi", "NA", SIXTEEN[:7]).alias("as_na")).distinct()


@query("SELECT DISTINCT company_id, CASE WHEN coalesce(len(associated_projects), 0) > 0 THEN to_json(associated_projects)::VARCHAR ELSE 'NA' END AS projects FROM company_intel")
def list_sentinel(spark, d):
    """Lists as JSON text, empty ones as the sentinel."""
    return table(spark, d, "company_intel").select("company_id", N.list_text(F.col("associated_projects")).alias("projects")).distinct()


_CONF, _STAGE, _ORIG = _vocab("extraction_confidence", LEVELS, LEVEL_ALIASES), _vocab("deployment_stage", STAGES, None, STAGE_PATTERNS, PLANS), _vocab("source_type", ("Literature", "Web"), ORIGINS, words=False)


@query(f"SELECT {_CONF[0]} AS level, {_CONF[1]} AS corrected, count(*) AS n FROM cementitious GROUP BY ALL")
def confidence_levels(spark, d):
    """Confidence words: exact, alias, word in the text, with corrections counted."""
    v = N.vocabulary("extraction_confidence", LEVELS, LEVEL_ALIASES)
    return table(spark, d, "cementitious").select(v.alias("v")).groupBy(F.col("v.value").alias("level"), F.col("v.corrected").alias("corrected")).agg(F.count("*").alias("n"))


@query(f"SELECT {_STAGE[0]} AS stage, {_STAGE[1]} AS corrected, count(*) AS n FROM cementitious GROUP BY ALL")
def deployment_stages(spark, d):
    """Deployment stages by patterns; plans for the future are no stage."""
    v = N.vocabulary("deployment_stage", STAGES, None, STAGE_PATTERNS, PLANS)
    return table(spark, d, "cementitious").select(v.alias("v")).groupBy(F.col("v.value").alias("stage"), F.col("v.corrected").alias("corrected")).agg(F.count("*").alias("n"))


@query(f"SELECT {_ORIG[0]} AS origin, {_ORIG[1]} AS corrected, count(*) AS n FROM scm_discovery GROUP BY ALL")
def source_type_labels(spark, d):
    """Source types in two words."""
    v = N.vocabulary("source_type", ("Literature", "Web"), ORIGINS, words=False)
    return table(spark, d, "scm_discovery").select(v.alias("v")).groupBy(F.col("v.value").alias("origin"), F.col("v.corrected").alias("corrected")).agg(F.count("*").alias("n"))


_SHORT = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"


def _concise(c: str, words: int = 12, default: str = "N.A.") -> str:
    s = _SHORT.format(_known(c))
    first = f"trim(string_split_regex({s}, '[.;] ')[1])"
    return f"coalesce(CASE WHEN {first} <> '' THEN array_to_string(string_split({first}, ' ')[1:{words}], ' ') END, '{default}')"


def _concise_list(c: str) -> str:
    s = _SHORT.format(_known(c))
    return f"coalesce(CASE WHEN length({s}) > 120 THEN CASE WHEN contains(left({s}, 120), ',') THEN regexp_replace(left({s}, 120), ',[^,]*$', '') ELSE left({s}, 120) END ELSE {s} END, 'N.A.')"


@query(f"SELECT DISTINCT record_id, {_concise('curing_conditions')} AS curing, {_concise('notes', 5)} AS note, {_concise_list('evidence_text')} AS evidence FROM cementitious")
def concise_fields(spark, d):
    """First clauses of few words, and phrase lists cut at a comma."""
    c = table(spark, d, "cementitious")
    return c.select("record_id", N.concise("curing_conditions").alias("curing"), N.concise("notes", 5).alias("note"), N.concise_list("evidence_text").alias("evidence")).distinct()


def _number(s: str) -> str:
    return f"nullif(regexp_extract({s}, '([-+]?[0-9]+(?:\\.[0-9]+)?)', 1), '')"


def _split_unit(v: str, u: str) -> tuple[str, str]:
    s, tail, unit = _SHORT.format(_known(v)), f"(?i) ({'|'.join(UNITS)})$", _concise(u, 4)
    found = f"regexp_extract({s}, '{tail}', 1)"
    cut = f"({unit} = 'N.A.' AND coalesce({found}, '') <> '')"
    return f"CASE WHEN {cut} THEN left(trim(regexp_replace({s}, '{tail}', '')), 60) ELSE coalesce(left({s}, 60), 'N.A.') END", f"CASE WHEN {cut} THEN {found} WHEN {s} IS NULL AND NOT {_has(u)} THEN 'N.A.' ELSE {unit} END"


_SV = _split_unit("compressive_strength_value", "compressive_strength_unit")


@query(f"""SELECT DISTINCT record_id, {_SV[0]} AS value, {_SV[1]} AS unit, coalesce({_number(f"trim({_known('co2_reduction_value')})")}, left(trim({_known("co2_reduction_value")}), 40), 'N.A.') AS co2 FROM cementitious""")
def value_unit_split(spark, d):
    """Units at the end of values moved to their column; the first number of a text."""
    v = N.split_unit("compressive_strength_value", "compressive_strength_unit", UNITS)
    return table(spark, d, "cementitious").select("record_id", v.alias("v"), N.concise_number("co2_reduction_value").alias("co2")).select("record_id", "v.value", "v.unit", "co2").distinct()


_DIM = _vocab("m", DIMENSIONS, DIMENSION_ALIASES, [("co2|emission", "CO2 Reduction"), ("energy|heat|power", "Energy"), ("cost|price", "Cost")], words=False, default="Other")


@query(f"""WITH r AS (SELECT DISTINCT metric_id, metric_name AS m, metric_value AS x, unit AS u, notes AS t FROM metric_intel),
s AS (SELECT metric_id, {_DIM[0]} AS dimension, coalesce(x::VARCHAR, 'N.A.') AS value, {_concise("u", 4)} AS unit, {_concise("m")} AS own, lower(concat_ws(' ', coalesce(m, ''), coalesce(t, ''))) AS blob, x FROM r),
n AS (SELECT *, CASE WHEN own <> 'N.A.' THEN own WHEN x IS NULL THEN 'N.A.' {" ".join(f"WHEN regexp_matches(blob, '{p}') THEN '{v}'" for p, v in METRICS)} WHEN dimension = 'CO2 Reduction' THEN 'capture rate' WHEN dimension = 'Energy' THEN 'energy penalty' WHEN dimension = 'Cost' THEN 'capital cost' ELSE 'N.A.' END AS name FROM s)
SELECT metric_id, dimension, unit, name, CASE WHEN x IS NULL OR dimension <> 'Energy' THEN 'N.A.' ELSE left(round(x)::BIGINT::VARCHAR || CASE WHEN unit = 'N.A.' THEN '' ELSE ' ' || unit END, 60) END AS energy_impact FROM n""")
def metric_fields(spark, d):
    """Dimension, name and summary of each metric: own values first, then what the remarks say, then the dimension's default."""
    m = table(spark, d, "metric_intel").select("metric_id", "metric_name", "metric_value", "unit", "notes").distinct()
    return R.metric_fields(m, DIMENSIONS, DIMENSION_ALIASES, [("co2|emission", "CO2 Reduction"), ("energy|heat|power", "Energy"), ("cost|price", "Cost")], METRICS, {"CO2 Reduction": "capture rate", "Energy": "energy penalty", "Cost": "capital cost"}).select("metric_id", "dimension", "unit", "name", "energy_impact")


def _encode(c: str) -> str:
    t = f"trim({_known(c)})"
    parts = f"list_filter(list_transform(string_split({t}, ','), lambda x: trim(x)), lambda x: x <> '')"
    return f"coalesce(CASE WHEN starts_with({t}, '[') THEN CASE WHEN json_valid({t}) THEN to_json(from_json({t}, '[\"VARCHAR\"]'))::VARCHAR ELSE {t} END WHEN len({parts}) > 0 THEN to_json({parts})::VARCHAR END, 'NA')"


@query(f"SELECT DISTINCT discovery_record_id, {_encode('processing_method')} AS as_list FROM scm_discovery")
def encode_list_fields(spark, d):
    """Lists of several notations as JSON text."""
    return table(spark, d, "scm_discovery").select("discovery_record_id", N.encode_list("processing_method").alias("as_list")).distinct()


@query("""WITH p AS (SELECT DISTINCT screening_id, mentioned_materials AS t FROM screening)
SELECT screening_id, unnest(CASE WHEN starts_with(trim(t), '[') THEN CASE WHEN json_valid(t) THEN from_json(trim(t), '["VARCHAR"]') ELSE [] END ELSE list_filter(list_transform(string_split(trim(t), ','), lambda x: trim(x)), lambda x: x <> '') END) AS part FROM p WHERE """ + _has("t"))
def decode_list_fields(spark, d):
    """The parts of JSON lists and of texts with commas."""
    return table(spark, d, "screening").select("screening_id", "mentioned_materials").distinct().select("screening_id", F.explode(N.decode_list("mentioned_materials")).alias("part"))


@query(f"""SELECT DISTINCT discovery_record_id, regexp_extract(replace(coalesce(replacement_percentage, ''), ',', ''), '(-?[0-9]+(?:\\.[0-9]+)?)', 1) AS share_text, try_cast(nullif(regexp_extract(replace(coalesce(replacement_percentage, ''), ',', ''), '(-?[0-9]+(?:\\.[0-9]+)?)', 1), '') AS DOUBLE) AS share,
try_cast(nullif(regexp_extract(replace(coalesce(replacement_percentage, ''), ',', ''), '(-?[0-9]+)', 1), '') AS BIGINT) AS whole, CASE WHEN lower(trim(strength_evidence_present)) IN ('true', 'yes', '1') THEN 'true' WHEN lower(trim(strength_evidence_present)) IN ('false', 'no', '0') THEN 'false' ELSE 'NA' END AS strength, CASE WHEN lower(trim(cost_evidence_present)) IN ('true', 'yes', '1') THEN 'true' WHEN lower(trim(cost_evidence_present)) IN ('false', 'no', '0') THEN 'false' ELSE 'NA' END AS cost FROM scm_discovery""")
def numbers_and_booleans(spark, d):
    """First decimals and integers of texts, and booleans of three values."""
    s = table(spark, d, "scm_discovery")
    n = N.number_in("replacement_percentage")
    text = F.regexp_extract(F.replace(F.coalesce("replacement_percentage", F.lit("")), F.lit(","), F.lit("")), r"(-?[0-9]+(?:\.[0-9]+)?)", 1)
    return s.select("discovery_record_id", text.alias("share_text"), n.alias("share"), N.integer_in("replacement_percentage").alias("whole"), N.three_way("strength_evidence_present").alias("strength"), N.three_way("cost_evidence_present").alias("cost")).distinct()


_FAMILIES, _FAMILY_ALIASES = ("Ash", "Slag", "Clay", "Glass"), {"fume": "Ash", "scoria": "Slag"}


@query(f"""WITH t AS (SELECT DISTINCT raw_material_family AS f, trim({_known("raw_material_family")}) AS t FROM scm_discovery)
SELECT f, CASE WHEN t IS NULL THEN 'Other' WHEN t IN {_q(_FAMILIES)} THEN t {" ".join(f"WHEN lower(t) = '{k}' THEN '{v}'" for k, v in _FAMILY_ALIASES.items())} {" ".join(f"WHEN lower(t) = '{a.lower()}' THEN '{a}'" for a in _FAMILIES)} {" ".join(f"WHEN contains(lower(t), '{a.lower()}') OR contains('{a.lower()}', lower(t)) THEN '{a}'" for a in _FAMILIES)} ELSE 'Other' END AS family FROM t""")
def coerced_categories(spark, d):
    """Families: exact, by alias, by case, by containment, or Other."""
    return table(spark, d, "scm_discovery").select(F.col("raw_material_family").alias("f"), N.category("raw_material_family", _FAMILIES, _FAMILY_ALIASES).alias("family")).distinct()


@query(f"""SELECT DISTINCT record_id, list_filter(list_transform(CASE WHEN contains(coalesce(processing_methods, ''), ';') THEN string_split(trim(processing_methods), ';') ELSE string_split(trim(coalesce(processing_methods, '')), ',') END, lambda x: trim(x)), lambda x: {_has("x")}) AS parts FROM cementitious""")
def text_lists(spark, d):
    """Parts between semicolons or else commas, missing ones left out."""
    return table(spark, d, "cementitious").select("record_id", N.text_list("processing_methods").alias("parts")).distinct()


_EVIDENCE = f"""r AS (SELECT DISTINCT record_id, try_cast(nullif(regexp_extract(replace(coalesce(cement_replacement_percentage, ''), ',', ''), '(-?[0-9]+(?:\\.[0-9]+)?)', 1), '') AS DOUBLE) AS pct, {_has("co2_reduction_value")} AND NOT {_has("co2_reduction_unit")} AS no_unit, {_has("compressive_strength_value")} AND NOT {_has("testing_age_days")} AS no_age FROM cementitious)"""


@query(f"""WITH {_EVIDENCE} SELECT record_id, w AS warning FROM (SELECT record_id, unnest([CASE WHEN pct < 0 OR pct > 100 THEN 'replacement out of bounds' END, CASE WHEN no_unit THEN 'reduction without unit' END, CASE WHEN no_age THEN 'strength without age' END]) AS w FROM r) WHERE w IS NOT NULL""")
def evidence_warnings(spark, d):
    """Records whose fields contradict or lack each other, by rule."""
    pct = N.number_in("cement_replacement_percentage")
    rules = {"replacement out of bounds": (pct < 0) | (pct > 100), "reduction without unit": present("co2_reduction_value") & ~present("co2_reduction_unit"), "strength without age": present("compressive_strength_value") & ~present("testing_age_days")}
    return R.warnings(table(spark, d, "cementitious"), "record_id", rules).distinct()


@query(f"""WITH r AS (SELECT DISTINCT discovery_record_id, CASE WHEN lower(trim(seed_category_match)) IN ('true', 'yes', '1') THEN 'true' WHEN lower(trim(seed_category_match)) IN ('false', 'no', '0') THEN 'false' ELSE 'NA' END AS m, {_has("matched_seed_category")} AS has, {_has("proposed_canonical_name")} AS named FROM scm_discovery)
SELECT discovery_record_id, w AS warning FROM (SELECT discovery_record_id, unnest([CASE WHEN m = 'false' AND has THEN 'no match but a category' END, CASE WHEN m = 'true' AND NOT has THEN 'match without category' END, CASE WHEN m = 'true' AND NOT named THEN 'match without a name' END]) AS w FROM r) WHERE w IS NOT NULL""")
def discovery_warnings(spark, d):
    """Flags that contradict their labels."""
    m = N.three_way("seed_category_match")
    rules = {"no match but a category": (m == "false") & present("matched_seed_category"), "match without category": (m == "true") & ~present("matched_seed_category"), "match without a name": (m == "true") & ~present("proposed_canonical_name")}
    return R.warnings(table(spark, d, "scm_discovery"), "discovery_record_id", rules).distinct()


@query(f"""SELECT DISTINCT record_id, {_STAGE[0]} AS deployment_stage, {_CONF[0]} AS confidence, coalesce(nullif(regexp_extract(coalesce(project_year, ''), '(?:^|[^0-9])((?:19|20)[0-9]{{2}})(?:$|[^0-9])', 1), ''), 'N.A.') AS project_year, {_missing_to("company_or_organization", "N.A.", SIXTEEN)} AS company, {_concise("canonical_technology_name")} AS technology,
({_STAGE[1]}::INT + {_CONF[1]}::INT)::INT AS corrected FROM cementitious""")
def normalised_rows(spark, d):
    """Whole rows through the normalisers, with the number of corrected values."""
    spec = {
        "deployment_stage": N.vocabulary("deployment_stage", STAGES, None, STAGE_PATTERNS, PLANS), "confidence": N.vocabulary("extraction_confidence", LEVELS, LEVEL_ALIASES), "project_year": F.coalesce(S.year_in("project_year").cast("string"), F.lit("N.A.")),
        "company": N.missing_to("company_or_organization", "N.A.", SIXTEEN), "technology": N.concise("canonical_technology_name"),
    }
    return R.normalise(table(spark, d, "cementitious"), ["record_id"], spec).distinct()


_SEED = _vocab("classification_confidence", LEVELS, LEVEL_ALIASES, default="NA")


@query(f"""SELECT DISTINCT discovery_record_id, {_SEED[0]} AS confidence, CASE WHEN lower(trim(seed_category_match)) IN ('true', 'yes', '1') THEN 'true' WHEN lower(trim(seed_category_match)) IN ('false', 'no', '0') THEN 'false' ELSE 'NA' END AS seed_match, {_encode("processing_method")} AS methods, {_missing_to("raw_material_origin", "NA", SIXTEEN)} AS origin, {_SEED[1]}::INT AS corrected FROM scm_discovery""")
def normalised_discovery_rows(spark, d):
    """Discovery rows through the normalisers."""
    spec = {"confidence": N.vocabulary("classification_confidence", LEVELS, LEVEL_ALIASES, default="NA"), "seed_match": N.three_way("seed_category_match"), "methods": N.encode_list("processing_method"), "origin": N.missing_to("raw_material_origin", "NA", SIXTEEN)}
    return R.normalise(table(spark, d, "scm_discovery"), ["discovery_record_id"], spec).distinct()


@query(f"""SELECT DISTINCT record_id, coalesce(trim({_known("canonical_technology_name")}), trim({_known("raw_technology_name")})) AS technology, coalesce(trim({_known("project_year")}), trim({_known("publication_year")})) AS year, coalesce(trim({_known("source_url")}), trim({_known("doi")})) AS link FROM cementitious""")
def legacy_columns(spark, d):
    """Old column names mapped to new ones, the first that holds a value."""
    return R.map_columns(table(spark, d, "cementitious"), ["record_id"], {"technology": ["canonical_technology_name", "raw_technology_name"], "year": ["project_year", "publication_year"], "link": ["source_url", "doi"]}).distinct()


@query("SELECT * FROM (VALUES ('notes', 'Notes, notes.1, notes_2'), ('unit', 'UNIT, unit')) AS t(name, columns)")
def duplicate_columns(spark, d):
    """Headers that mean the same column, from a list of headers."""
    found = R.duplicate_columns(["Notes", "unit", "value", "notes_2", "notes.1", "UNIT", "valued"])
    return spark.createDataFrame(sorted((k, ", ".join(sorted(v))) for k, v in found.items()), "name string, columns string")


def _year3(c: str) -> str:
    return f"nullif(regexp_extract(coalesce({c}::VARCHAR, ''), '(?:^|[^0-9])((?:19|20)[0-9]{{2}})(?:$|[^0-9])', 1), '')"


_DOI = "lower(coalesce(doi, ''))"


@query(rf"""WITH r AS (SELECT DISTINCT source_id, coalesce({_year3("pub_year")}, {_year3("retrieval_date")}) AS own, coalesce(nullif(regexp_extract({_DOI}, '[./-]((?:19|20)[0-9]{{2}})(?:[./-]|$)', 1), ''), nullif(regexp_extract({_DOI}, '[a-z._/-]((?:19|20)[0-9]{{2}})(?:[^0-9]|$)', 1), '')) AS inferred FROM registered_sources)
SELECT DISTINCT source_id, coalesce(own, inferred, 'Not Reported') AS year, CASE WHEN own IS NOT NULL THEN 'metadata' WHEN inferred IS NOT NULL THEN 'doi_inferred' ELSE 'not_reported' END AS year_source FROM r""")
def publication_years(spark, d):
    """Years from several columns, then from the DOI by several patterns."""
    y = N.year_of(["pub_year", "retrieval_date"], "doi")
    return table(spark, d, "registered_sources").select("source_id", y.alias("y")).select("source_id", "y.year", "y.year_source").distinct()


@query(f"""WITH r AS (SELECT DISTINCT raw_material_name AS raw, proposed_canonical_name AS proposed FROM scm_discovery), t AS (SELECT *, trim(regexp_replace(coalesce(raw, ''), '\\s+', ' ', 'g')) AS s, {_fold("raw")} AS k FROM r)
SELECT raw, proposed, CASE WHEN k = 'pfa' THEN 'Fly ash' WHEN k = 'ggbs' THEN 'Slag' WHEN {_has("proposed")} THEN trim(proposed) WHEN {_has("raw")} THEN CASE WHEN length(s) <= 6 AND s = upper(s) THEN s ELSE upper(left(s, 1)) || substr(s, 2) END ELSE 'NA' END AS material,
CASE WHEN k IN ('pfa', 'ggbs') THEN 'override' WHEN {_has("proposed")} THEN 'proposed' WHEN {_has("raw")} THEN 'light' ELSE 'missing' END AS method, CASE WHEN k IN ('pfa', 'ggbs') THEN 'High' WHEN {_has("proposed")} THEN 'Medium' WHEN {_has("raw")} THEN 'Low' ELSE 'NA' END AS confidence FROM t""")
def material_overrides(spark, d):
    """Material names by override, by proposal, or lightly canonical, with method and confidence."""
    s = table(spark, d, "scm_discovery").select(F.col("raw_material_name").alias("raw"), F.col("proposed_canonical_name").alias("proposed")).distinct()
    return R.material_names(s, "raw", "proposed", {"pfa": "Fly ash", "ggbs": "Slag"}).select("raw", "proposed", "material", "method", "confidence")


@query(f"""SELECT DISTINCT record_id, coalesce(trim({_known("taxonomy_level_1")}), 'N.A.') AS level_0, coalesce(CASE WHEN {_has("taxonomy_level_1")} THEN trim({_known("taxonomy_level_2")}) END, 'N.A.') AS level_1, coalesce(CASE WHEN {_has("taxonomy_level_1")} AND {_has("taxonomy_level_2")} THEN trim({_known("taxonomy_level_3")}) END, 'N.A.') AS level_2 FROM cementitious""")
def padded_levels(spark, d):
    """A node's labels as padded level columns; levels under a missing one are padded too."""
    labels = F.array(*[F.trim(known(f"taxonomy_level_{i}")) for i in (1, 2, 3)])
    stop = F.array_position(F.transform(labels, lambda x: x.isNull()), True)
    whole = F.when(stop > 0, F.slice(labels, F.lit(1), (stop - 1).cast("int"))).otherwise(labels)
    return table(spark, d, "cementitious").select("record_id", *N.pad_levels(whole, 3)).distinct()
