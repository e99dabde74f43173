"""Queries of the training-data problems: pN_ names, each over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table
from .bpe import encode_corpus
from .canonical import ABBREVIATIONS, LEADING, canonical_names, raw_names, unmatched
from .grouptop import best_papers
from .leakage import find_leaks
from .level import reading_levels
from .names import link_names, name_pairs
from .pagebody import page_bodies
from .survivor import BUNDLES, survivors


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """The lines of the main body of pages and snippets."""
    return page_bodies(table(spark, d, "web_stages"), table(spark, d, "registered_sources"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """The best five papers of each branch and shard."""
    return best_papers(table(spark, d, "screening")).select("shard_id", "branch", "corpus_index")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The surviving record of each duplicate group."""
    return survivors(table(spark, d, "cementitious")).select("duplicate_group_id", "record_id", "complementary_fields_filled")


def p4_filled(spark: SparkSession, d: str) -> DataFrame:
    """The surviving records with their fields after filling, and the donors."""
    return survivors(table(spark, d, "cementitious"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Material and technology names on the canonical lists."""
    return canonical_names(table(spark, d, "scm_discovery"), table(spark, d, "cementitious"), table(spark, d, "canonical_names"))


def p6_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The typed names without an entry and how many records have each: those with ref_id -1 in p6_found."""
    return unmatched(raw_names(table(spark, d, "scm_discovery"), table(spark, d, "cementitious")), table(spark, d, "canonical_names"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of spellings of the same organisation."""
    columns = [("cementitious", "company_or_organization"), ("scm_discovery", "company_or_organization"), ("company_intel", "name")]
    return name_pairs(link_names([(table(spark, d, t), c) for t, c in columns]))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of all documents."""
    return encode_corpus(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold passages of evaluation items."""
    return find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """The reading level of each English prose document."""
    return reading_levels(table(spark, d, "documents"), table(spark, d, "level_samples"))


QUERIES = {"p1_found": p1_found, "p3_found": p3_found, "p4_found": p4_found, "p4_filled": p4_filled, "p6_found": p6_found, "p6_unmatched": p6_unmatched, "p7_found": p7_found, "p8_ids": p8_ids, "p9_found": p9_found, "p10_found": p10_found}

_FIELDS = [f for b in BUNDLES.values() for f in b]
_MISSING = "('', 'n.a.', 'na', 'n/a', 'not reported', 'unknown', 'not available')"
_HAS = {f: f"(coalesce(lower(trim({f}, ' \t\r\n')), '') NOT IN {_MISSING})::INT" for f in _FIELDS}

SQL = {
    "p3_found": r"""
WITH l AS (
  SELECT shard_id, corpus_index, confidence,
         list_distinct(list_filter(list_transform(string_split(coalesce(matched_taxonomy_branches, ''), ';'),
           lambda x: regexp_replace(lower(regexp_replace(x, '^[\s\x{00A0}]+|[\s\x{00A0}]+$', '', 'g')), '[\s\x{00A0}]+', '_', 'g')),
           lambda x: x NOT IN ('', 'n.a.', 'na', 'n/a', 'not_reported', 'unknown', 'not_available'))) AS b
  FROM screening WHERE confidence >= 0 AND confidence <= 1 AND shard_id IS NOT NULL AND corpus_index IS NOT NULL),
e AS (SELECT shard_id, corpus_index, confidence, unnest(CASE WHEN len(b) = 0 THEN ['unknown'] ELSE b END) AS branch FROM l),
m AS (SELECT shard_id, branch, corpus_index, max(confidence) AS c FROM e GROUP BY ALL)
SELECT shard_id, branch, corpus_index FROM m
QUALIFY row_number() OVER (PARTITION BY shard_id, branch ORDER BY c DESC, corpus_index) <= 5""",
    "p4_found": f"""
WITH r AS (
  SELECT duplicate_group_id, record_id, {", ".join(f"{x} AS h_{f}" for f, x in _HAS.items())}, {" + ".join(_HAS.values())} AS n,
    epoch_us(coalesce(
      CASE WHEN regexp_matches(trim(retrieval_timestamp), '^[0-9]{{9,10}}$') THEN make_timestamptz(trim(retrieval_timestamp)::BIGINT * 1000000) END,
      CASE WHEN regexp_matches(trim(retrieval_timestamp), '^[0-9]{{4}}-.*(Z|[+-][0-9]{{2}}:[0-9]{{2}})$') THEN try_cast(trim(retrieval_timestamp) AS TIMESTAMPTZ) END,
      CASE WHEN regexp_matches(trim(retrieval_timestamp), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9:]+$') THEN try_cast(trim(retrieval_timestamp) || '+00' AS TIMESTAMPTZ) END,
      try_strptime(trim(retrieval_timestamp) || ' +00', '%d %b %Y %H:%M %z'))) AS t
  FROM cementitious WHERE coalesce(lower(trim(duplicate_group_id)), '') NOT IN {_MISSING} AND record_id IS NOT NULL),
s AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY duplicate_group_id ORDER BY n DESC, t DESC NULLS LAST, record_id) = 1),
a AS (SELECT duplicate_group_id, {", ".join(f"max(h_{f}) AS a_{f}" for f in _FIELDS)} FROM r GROUP BY 1 HAVING count(DISTINCT record_id) > 1)
SELECT duplicate_group_id, record_id, ({" + ".join(f"a_{f} - h_{f}" for f in _FIELDS)})::BIGINT AS complementary_fields_filled
FROM s JOIN a USING (duplicate_group_id)""",
}

_CLEAN = r"regexp_replace(regexp_replace(lower(replace({0}, '_', ' ')), '(\d)[.,\s](\d)', '\1\2', 'g'), '(\d)[.,\s](\d)', '\1\2', 'g')"
_SHINGLES = "list_distinct(list_transform(range(1, len({0}) - 1), lambda i: {0}[i] || ' ' || {0}[i + 1] || ' ' || {0}[i + 2]))"

#: Every item against every document by exact shingles, without MinHash: what the search must find.
SQL["p9_found"] = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all({_CLEAN.format("text")}, '[\p{{L}}\p{{N}}]+') AS w FROM documents WHERE doc_id IS NOT NULL AND length(text) > 0),
ds AS (SELECT doc_id, unnest({_SHINGLES.format("w")}) AS s FROM dw),
it AS (SELECT item_id, any_value(regexp_replace(trim(text), '(^|([.!?])\s+|\n)[^.!?\n]*\?\s*$', '\2')) AS p FROM eval_items WHERE item_id IS NOT NULL AND text IS NOT NULL GROUP BY 1),
iw AS (SELECT item_id, regexp_extract_all({_CLEAN.format("p")}, '[\p{{L}}\p{{N}}]+') AS w FROM it), iss AS (SELECT item_id, unnest({_SHINGLES.format("w")}) AS s FROM iw),
own AS (SELECT s, count(*) = 1 AS own FROM iss GROUP BY 1), i2 AS (SELECT item_id, s, own FROM iss JOIN own USING (s)), size AS (SELECT item_id, count(*) AS n, count(*) FILTER (own) AS o FROM i2 GROUP BY 1),
hit AS (SELECT doc_id, item_id, count(*) AS n, count(*) FILTER (own) AS o FROM (SELECT DISTINCT doc_id, item_id, s, own FROM ds JOIN i2 USING (s)) GROUP BY 1, 2)
SELECT doc_id, item_id FROM hit JOIN size USING (item_id) WHERE hit.n >= 0.2 * size.n AND CASE WHEN size.o = 0 THEN true ELSE hit.o >= 0.17 * size.o END"""

_B = r"[\s\x{00A0}]"
_BARE = rf"regexp_replace(regexp_replace(regexp_replace(raw_name, '^{_B}*(?:[-*•]{_B}+|[0-9]{{1,2}}[.)]{_B}+)?', ''), '^(?i:{"|".join(LEADING)}){_B}+', ''), '{_B}*(?:\([^()]*\))?[\s\x{{00A0}}?*.]*$', '')"
_FORM = "replace(translate(regexp_replace(translate(lower({0}), 'àáâãäåçèéêëìíîïñòóôõöøùúûüýÿ', 'aaaaaaceeeeiiiinoooooouuuuyy'), '[^a-z0-9]', '', 'g'), 'zy', 'si'), 'ph', 'f')"
_TYPED = rf"""nm AS (SELECT DISTINCT 'scm_discovery' AS origin, discovery_record_id AS row_key, 'material' AS list_name, raw_material_name AS raw_name FROM scm_discovery UNION SELECT DISTINCT 'cementitious', record_id, 'technology', raw_technology_name FROM cementitious),
ty AS (SELECT *, {_FORM.format(_BARE)} AS form FROM nm WHERE row_key IS NOT NULL AND coalesce(regexp_replace(lower(raw_name), '^{_B}+|{_B}+$', '', 'g'), '') NOT IN {_MISSING})"""
#: Every typed form against every written form of the list by levenshtein, without the pigeonhole join.
_ALL_PAIRS = rf"""WITH RECURSIVE {_TYPED}, ky AS (SELECT DISTINCT list_name, form FROM ty),
ref AS (SELECT list_name, ref_id, unnest(list_append(coalesce(aliases, []), canonical_name)) AS name FROM canonical_names),
wd AS (SELECT DISTINCT list_name, ref_id, list_filter(string_split_regex(regexp_replace(lower(name), '[^a-z0-9 -]', '', 'g'), ' +'), lambda x: x <> '') AS words FROM ref WHERE name IS NOT NULL),
ow AS (SELECT DISTINCT unnest(words) AS word FROM wd), opt AS (SELECT word, word AS o FROM ow UNION SELECT word, short FROM (VALUES {", ".join(f"('{a}', '{b}')" for a, b in ABBREVIATIONS.items())}) AS v(word, short)),
ex AS (SELECT list_name, ref_id, words, 0 AS i, '' AS acc FROM wd UNION ALL SELECT ex.list_name, ex.ref_id, ex.words, ex.i + 1, trim(ex.acc || ' ' || opt.o) FROM ex JOIN opt ON opt.word = ex.words[ex.i + 1] WHERE ex.i < len(ex.words)),
fu AS (SELECT DISTINCT list_name, ref_id, string_split(acc, ' ') AS ws FROM ex WHERE i = len(words) AND i > 0), ro AS (SELECT list_name, ref_id, ws, unnest(range(0, len(ws))) AS k FROM fu),
one AS (SELECT list_name, ref_id, array_to_string(ws[k + 1:], '') || array_to_string(ws[1:k], '') AS one FROM ro), va AS (SELECT list_name, ref_id, unnest([one, one || 's']) AS v FROM one),
fo AS (SELECT list_name, form, min(ref_id) AS ref_id, CASE WHEN length(form) <= 5 THEN 0 WHEN length(form) <= 8 THEN 1 WHEN length(form) <= 13 THEN 2 ELSE 3 END AS edits FROM (SELECT list_name, ref_id, {_FORM.format("v")} AS form FROM va) WHERE form <> '' GROUP BY 1, 2),
pr AS (SELECT ky.list_name, ky.form, fo.ref_id, edits, levenshtein(ky.form, fo.form) AS distance FROM ky JOIN fo ON ky.list_name = fo.list_name AND abs(length(ky.form) - length(fo.form)) <= edits AND ky.form <> ''),
be AS (SELECT list_name, form, ref_id FROM pr WHERE distance <= edits QUALIFY row_number() OVER (PARTITION BY list_name, form ORDER BY distance, ref_id) = 1)"""
SQL["p6_found"] = _ALL_PAIRS + " SELECT DISTINCT origin, row_key, coalesce(be.ref_id, -1) AS ref_id FROM ty LEFT JOIN be USING (list_name, form)"
SQL["p6_unmatched"] = _ALL_PAIRS + " SELECT list_name, raw_name, count(*) AS n FROM ty WHERE NOT EXISTS (SELECT 1 FROM be WHERE be.list_name = ty.list_name AND be.form = ty.form) GROUP BY 1, 2"
