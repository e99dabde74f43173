"""Queries of the material-name cascade and its reports, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import materials as M
from ..sources.tables import table
from .book import Book

book = Book()
query = book.query
QUERIES, SQL = book.queries, book.sql

KEYWORDS = ("ash", "slag", "cement", "clay", "fume", "lime", "glass", "dust", "rock")
ARTEFACTS = ("table", "figure", "sample", "samples", "mix", "mixture", "control", "composition", "total", "na", "n/a", "none", "unknown", "not reported", "n.a.", "not available")
SENSES = (("rha", "rice husk ash"), ("rha", "road harvest ash"), ("mk", "metakaolin"), ("mk", "mixed kiln dust"), ("ggbs", "slag"), ("fa", "fly ash"), ("fa", "fine ash"))


def _clean(c: str) -> str:
    t = f"trim(translate(replace(coalesce({c}, ''), chr(8203), ''), chr(160) || '–—′’', ' --'''''))"
    t = rf"regexp_replace({t}, '^[\"''`]+|[\"''`]+$', '', 'g')"
    t = rf"regexp_replace(regexp_replace(regexp_replace({t}, '\s+', ' ', 'g'), '\s*/\s*', '/', 'g'), '\s*-\s*', '-', 'g')"
    t = rf"regexp_replace({t}, '\s*\((?:[SMVCFRPT]?[0-9]+[a-zA-Z]?|[Mm]ix\s*[0-9]+)\)\s*$', '')"
    return f"regexp_replace({t}, '^[ ,;:]+|[ ,;:]+$', '', 'g')"


def _key(clean: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(replace(lower({clean}), '&', ' and '), '[^\p{{L}}\p{{N}}_\s.+]', ' ', 'g'), '\s+', ' ', 'g'))"


_CODE = r"^(?:mix|sample|specimen|batch|series)[\s_-]*[a-z]?[0-9]+[a-z]?$|^[a-z][0-9]{1,3}[a-z]?$|^[0-9]{2,4}[a-z]$|^[mscvfr][\s_-]*[0-9]+[a-z]?$"
_SPARED = " OR ".join(f"contains(lower(clean), '{k}')" for k in KEYWORDS)
_AUTHOR = r"regexp_matches(clean, '^[A-Z][a-z]+(?:\s+[A-Z]\.?)?(?:\s+(?:and|&)\s+[A-Z][a-z]+)+(?:\s+et\s+al\.?)?$|^[A-Z][a-z]+(?:\s+[A-Z]\.?)*\s+et\s+al\.?$')"
_SKIP = rf"""CASE WHEN clean = '' OR lower(clean) IN {ARTEFACTS} OR regexp_matches(lower(clean), '^(?:table|fig|figure) ') OR regexp_matches(lower(clean), 'doi\s*:|https?://|et\s+al\.|vol\.|pp\.|\([0-9]{{4}}\)') OR ({_AUTHOR} AND NOT ({_SPARED})) THEN 'artefact'
 WHEN length(clean) <= 24 AND regexp_matches(lower(clean), '{_CODE}') AND NOT ({_SPARED}) THEN 'sample_id' END"""
_LEX = f"""x AS (SELECT ref_id AS leaf, list_name AS parent, 'display' AS kind, 0 AS r, canonical_name AS term FROM canonical_names UNION ALL SELECT ref_id, list_name, 'synonym', 2, unnest(aliases) FROM canonical_names
  UNION ALL SELECT ref_id, list_name, 'cue', 3, split_part(canonical_name, ' ', 1) FROM canonical_names WHERE length(split_part(canonical_name, ' ', 1)) >= 4),
lex AS (SELECT DISTINCT {_key(_clean("term"))} AS key, kind, r, leaf, parent FROM x WHERE length(term) >= 2 AND length({_key(_clean("term"))}) >= 2)"""
_NAMES = f"""n AS (SELECT DISTINCT raw_material_name AS name, lower(coalesce(notes, '')) || ' ' || lower(coalesce(proposed_canonical_name, '')) AS context FROM scm_discovery),
c AS (SELECT *, {_clean("name")} AS clean FROM n), k AS (SELECT *, {_key("clean")} AS key, {_SKIP} AS skip FROM c)"""
_SENSE = "sn AS (SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in SENSES) + ") AS t(key, sense))"
_HITS = f"""ks AS (SELECT DISTINCT key FROM (SELECT key FROM k WHERE skip IS NULL UNION ALL SELECT sense FROM sn) WHERE key <> ''),
ex AS (SELECT key, count(DISTINCT leaf) AS leaves, arg_min(struct_pack(kind := kind, leaf := leaf, parent := parent), [lpad(r::VARCHAR, 2, '0'), kind, lpad(leaf::VARCHAR, 9, '0')]) AS b FROM ks JOIN lex USING (key) GROUP BY 1),
pc AS (SELECT ks.key, lex.key AS term, kind, r, leaf, parent FROM ks JOIN lex ON length(lex.key) >= 4 AND (kind <> 'cue' OR length(lex.key) >= 8) AND (contains(ks.key, lex.key) OR contains(lex.key, ks.key)) WHERE ks.key NOT IN (SELECT key FROM ex)),
pt AS (SELECT * FROM pc QUALIFY rank() OVER (PARTITION BY key ORDER BY length(term) DESC) = 1),
pa AS (SELECT key, count(DISTINCT leaf) AS leaves, arg_min(struct_pack(kind := kind, leaf := leaf, parent := parent), [term, lpad(r::VARCHAR, 2, '0'), kind, lpad(leaf::VARCHAR, 9, '0')]) AS b FROM pt GROUP BY 1),
h AS (SELECT key, CASE WHEN leaves > 1 THEN 'ambiguous' ELSE how END AS how, CASE WHEN leaves = 1 THEN b.kind END AS kind, CASE WHEN leaves = 1 THEN b.leaf END AS leaf, CASE WHEN leaves = 1 THEN b.parent END AS parent FROM (SELECT *, 'exact' AS how FROM ex UNION ALL SELECT *, 'partial' FROM pa))"""


def _names(spark, d):
    return table(spark, d, "scm_discovery").select(F.col("raw_material_name").alias("name"), F.concat(F.lower(F.coalesce("notes", F.lit(""))), F.lit(" "), F.lower(F.coalesce("proposed_canonical_name", F.lit("")))).alias("context")).distinct()


def _lexicon(spark, d):
    ref = table(spark, d, "canonical_names")
    return M.lexicon(ref, "ref_id", F.col("list_name"), {"display": F.array("canonical_name"), "synonym": F.col("aliases"), "cue": F.array(F.substring_index("canonical_name", " ", 1))})


def _senses(spark):
    return spark.createDataFrame([(a, b, b) for a, b in SENSES], "key string, sense string, sense_key string")


@query(f"WITH {_NAMES} SELECT DISTINCT name, clean, key, skip FROM k")
def clean_names(spark, d):
    """Clean names, match keys, and which are artefacts or sample codes."""
    n = _names(spark, d).select("name").distinct()
    x = M.compatible(n.withColumn("n", F.coalesce("name", F.lit(""))), "n").select("name", M.clean_name(F.col("n")).alias("clean")).withColumn("key", M.match_key(F.col("clean")))
    return x.withColumn("skip", F.when(M.is_artefact(F.col("clean"), ARTEFACTS, KEYWORDS), "artefact").when(M.is_sample_code(F.col("clean"), KEYWORDS), "sample_id"))


@query(f"WITH {_LEX} SELECT key, kind, leaf, parent FROM lex")
def lexicon_terms(spark, d):
    """The lexicon of the canonical names: names, synonyms, cues."""
    return _lexicon(spark, d).select("key", "kind", "leaf", "parent")


@query(f"WITH {_NAMES}, {_LEX}, {_SENSE}, {_HITS} SELECT key, how, kind, leaf, parent FROM h WHERE key IN (SELECT key FROM k WHERE skip IS NULL)")
def lexicon_hits(spark, d):
    """Names that hit the lexicon, by equality or by the longest contained term."""
    n = M.compatible(_names(spark, d).select(F.coalesce("name", F.lit("")).alias("n")), "n").select(M.clean_name(F.col("n")).alias("clean")).where(~M.is_artefact(F.col("clean"), ARTEFACTS, KEYWORDS) & ~M.is_sample_code(F.col("clean"), KEYWORDS))
    return M.lexicon_hits(n.select(M.match_key(F.col("clean")).alias("key")), _lexicon(spark, d)).select("key", "how", "kind", "leaf", "parent")


_CASCADE = f"""WITH {_NAMES}, {_LEX}, {_SENSE}, {_HITS},
am AS (SELECT k.key, k.context, sense, contains(k.context, sense) AS inside FROM (SELECT DISTINCT key, context FROM k WHERE skip IS NULL) k JOIN sn USING (key)),
ao AS (SELECT key, context, count(*) FILTER (inside) AS n, min(sense) FILTER (inside) AS s FROM am GROUP BY 1, 2),
a AS (SELECT ao.key, context, CASE WHEN n = 1 AND h.leaf IS NOT NULL THEN s END AS sense, CASE WHEN n = 1 THEN h.leaf END AS leaf, CASE WHEN n = 1 THEN h.parent END AS parent FROM ao LEFT JOIN h ON h.key = s),
j AS (SELECT k.*, a.key IS NOT NULL AS abbr, a.sense AS a_sense, a.leaf AS a_leaf, a.parent AS a_parent, h.how, h.kind, h.leaf AS h_leaf, h.parent AS h_parent FROM k LEFT JOIN a ON k.skip IS NULL AND a.key = k.key AND a.context = k.context LEFT JOIN h ON h.key = k.key AND k.skip IS NULL),
sl AS (SELECT context, count(DISTINCT leaf) AS leaves, min(leaf) AS leaf, arg_min(parent, leaf) AS parent FROM (SELECT DISTINCT context FROM j WHERE skip IS NULL AND NOT abbr AND how IS NULL) JOIN lex ON kind IN ('display', 'synonym') AND length(lex.key) >= 5 AND contains(context, lex.key) GROUP BY 1),
f AS (SELECT j.*, coalesce(leaves, 0) AS leaves, sl.leaf AS s_leaf, sl.parent AS s_parent FROM j LEFT JOIN sl ON sl.context = j.context AND skip IS NULL AND NOT abbr AND how IS NULL),
o AS (SELECT name, context, clean, key, CASE WHEN skip IS NOT NULL THEN skip WHEN abbr THEN 'ambiguous' WHEN how IS NOT NULL THEN CASE WHEN h_leaf IS NOT NULL THEN 'mapped' ELSE 'ambiguous' END WHEN leaves > 0 THEN 'ambiguous' ELSE 'unresolved' END AS status,
 CASE WHEN skip IS NOT NULL THEN 'Artefact' WHEN abbr THEN CASE WHEN a_leaf IS NOT NULL THEN 'Medium' ELSE 'Low' END WHEN how IS NOT NULL THEN CASE WHEN h_leaf IS NULL THEN 'Low' WHEN how = 'exact' THEN 'High' ELSE 'Medium' END WHEN leaves > 0 THEN 'Low' ELSE 'Unresolved' END AS confidence,
 CASE WHEN skip IS NOT NULL THEN 'no material' WHEN abbr THEN 'abbreviation:' || coalesce(a_sense, '?') WHEN how IS NOT NULL THEN how || ':' || coalesce(kind, 'several leaves') WHEN leaves = 1 THEN 'context:one leaf' WHEN leaves > 1 THEN 'context:several leaves' ELSE 'no match' END AS rationale,
 CASE WHEN skip IS NOT NULL THEN NULL WHEN abbr THEN a_leaf WHEN how IS NOT NULL THEN h_leaf WHEN leaves = 1 THEN s_leaf END AS leaf, CASE WHEN skip IS NOT NULL THEN NULL WHEN abbr THEN a_parent WHEN how IS NOT NULL THEN h_parent WHEN leaves = 1 THEN s_parent END AS parent,
 skip IS NOT NULL OR abbr OR how IS NULL OR h_leaf IS NULL OR how <> 'exact' AS review FROM f)"""


def _mapped(spark, d):
    return M.map_names(_names(spark, d), _lexicon(spark, d), _senses(spark), ARTEFACTS, KEYWORDS)


@query(_CASCADE + " SELECT * FROM o")
def material_cascade(spark, d):
    """Material names through the whole cascade: artefact, sample code, abbreviation, lexicon, context."""
    return _mapped(spark, d).drop("variant")


@query(_CASCADE + f""", w AS (SELECT raw_material_name AS name, lower(coalesce(notes, '')) || ' ' || lower(coalesce(proposed_canonical_name, '')) AS context, count(*) AS n FROM scm_discovery GROUP BY 1, 2)
SELECT status, confidence, count(*) AS n_names, sum(n)::BIGINT AS n_rows, round(100.0 * count(*) / sum(count(*)) OVER (), 3)::DOUBLE AS pct_names, round(100.0 * sum(n) / sum(sum(n)) OVER (), 3)::DOUBLE AS pct_rows FROM o JOIN w ON o.name IS NOT DISTINCT FROM w.name AND o.context = w.context GROUP BY 1, 2""")
def cascade_coverage(spark, d):
    """Coverage by status and confidence: shares of names, and weighted by rows."""
    s = table(spark, d, "scm_discovery").groupBy(F.col("raw_material_name").alias("name"), F.concat(F.lower(F.coalesce("notes", F.lit(""))), F.lit(" "), F.lower(F.coalesce("proposed_canonical_name", F.lit("")))).alias("context")).agg(F.count("*").alias("n"))
    m = _mapped(spark, d).select(F.col("name").alias("m_name"), F.col("context").alias("m_context"), "status", "confidence")
    j = m.join(s, m.m_name.eqNullSafe(s.name) & (m.m_context == s.context))
    g = j.groupBy("status", "confidence").agg(F.count("*").alias("n_names"), F.sum("n").alias("n_rows"))
    t = g.agg(F.sum("n_names").alias("tn"), F.sum("n_rows").alias("tr"))
    return g.crossJoin(F.broadcast(t)).select("status", "confidence", "n_names", "n_rows", F.round(100.0 * F.col("n_names") / F.col("tn"), 3).alias("pct_names"), F.round(100.0 * F.col("n_rows") / F.col("tr"), 3).alias("pct_rows"))


@query(f"""WITH r AS (SELECT {_key(_clean("raw_material_name"))} AS key, raw_material_name AS nm, source_id AS s, trim(coalesce(raw_material_family, '')) AS g, trim(coalesce(source_title, '')) AS c, discovery_record_id AS o FROM scm_discovery),
d AS (SELECT * FROM r WHERE key <> ''), b AS (SELECT key, arg_max(nm, [lpad(length(nm)::VARCHAR, 9, '0'), nm]) AS longest, count(*) AS n_rows, count(DISTINCT s) AS n_sources FROM d GROUP BY 1),
g1 AS (SELECT key, g, count(*) AS n FROM d WHERE g <> '' GROUP BY 1, 2), g2 AS (SELECT key, g FROM g1 QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, g) = 1),
c1 AS (SELECT key, c, min(o) AS o FROM d WHERE c <> '' GROUP BY 1, 2), c2 AS (SELECT key, c, row_number() OVER (PARTITION BY key ORDER BY o, c) AS rn FROM c1), c3 AS (SELECT key, string_agg(c, ' | ' ORDER BY rn) AS captions FROM c2 WHERE rn <= 8 GROUP BY 1)
SELECT b.key, longest, n_rows, n_sources, coalesce(g, '') AS top_group, coalesce(captions, '') AS captions FROM b LEFT JOIN g2 USING (key) LEFT JOIN c3 USING (key)""")
def name_statistics(spark, d):
    """Each material name's spellings, sources, families and captions."""
    return M.name_statistics(table(spark, d, "scm_discovery"), "raw_material_name", "source_id", "raw_material_family", "source_title", "discovery_record_id")


@query(_CASCADE + """, p AS (SELECT key, leaf, count(*) AS n FROM o WHERE status = 'mapped' AND rationale NOT LIKE 'exact%' GROUP BY 1, 2) SELECT key, leaf, n FROM p WHERE NOT EXISTS (SELECT 1 FROM lex WHERE lex.key = p.key)""")
def synonym_proposals(spark, d):
    """Keys that a contained term maps and the lexicon lacks: proposals of synonyms (an anti-join)."""
    m = _mapped(spark, d).where("status = 'mapped' AND rationale NOT LIKE 'exact%'").groupBy("key", "leaf").agg(F.count("*").alias("n"))
    return m.join(_lexicon(spark, d).select("key").distinct(), "key", "left_anti")


@query("""WITH v AS (SELECT DISTINCT metric_id, technology_name AS t, regexp_replace(unit, '%', '') AS u, metric_value AS x FROM metric_intel), g AS (SELECT t, count(*) AS n, avg(x) AS m FROM v WHERE x IS NOT NULL AND NOT isnan(x) AND u = 'MPa' GROUP BY 1)
SELECT t AS technology, n, CASE WHEN m < 20 THEN 'low' WHEN m > 60 THEN 'high' ELSE 'usual' END AS signal FROM g""")
def numeric_signals(spark, d):
    """A second opinion on names from the mean of their measured values."""
    v = table(spark, d, "metric_intel").select("metric_id", F.col("technology_name").alias("technology"), F.regexp_replace("unit", "%", "").alias("u"), "metric_value").distinct()
    g = v.where("metric_value IS NOT NULL AND NOT isnan(metric_value) AND u = 'MPa'").groupBy("technology").agg(F.count("*").alias("n"), F.avg("metric_value").alias("m"))
    return g.select("technology", "n", F.when(F.col("m") < 20, "low").when(F.col("m") > 60, "high").otherwise("usual").alias("signal"))
