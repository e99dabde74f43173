"""Queries of the evidence-mining operators over whole tables, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.text import known, present
from ..operators import dedupe, lexicon, merging, quality, ranking, records, reshape, scoring, taxonomy
from ..sources.tables import table

TIERS = {
    "core": {"fly ash": 4, "silica fume": 4, "calcined clay": 4, "granulated slag": 3, "clinker": 2},
    "process": {"kiln": 1.5, "grout": 1, "mortar": 1, "calorimetry": 2},
    "impact": {"emissions": 2, "energy demand": 2.5, "inventory": 1, "co2": 3},
}
NEGATIVE = {"school": 1, "road": 0.5, "shoe": 2}
PATTERNS = [r"[0-9]+ percent", r"[0-9]+ days", r"[0-9,]+ mj per tonne"]
CONFIDENCE = {"high": "High", "medium": "Medium", "med": "Medium", "low": "Low"}
LEVELS = ["category", "subcategory", "taxonomy_level_1", "taxonomy_level_2", "taxonomy_level_3", "taxonomy_level_4"]
STAGES = ("laboratory", "pilot", "pilot-scale", "demonstration", "commercial")
#: Parts of the key of exact duplicates and of the looser key of possible ones; a tuple is the first of several columns with a value.
EXACT = {
    "origin": ("evidence_origin",), "technology": ("canonical_technology_name", "alternative_classification"), "source": ("source_id",), "url": ("source_url",), "project": ("project_name",), "company": ("company_or_organization",), "place": ("country",), "year": ("project_year", "publication_year"),
    "replacement": ("cement_replacement_percentage",), "age": ("testing_age_days",), "reduction": ("co2_reduction_value",), "strength": ("compressive_strength_value",), "leaf": ("subcategory",), "level_3": ("taxonomy_level_3",), "level_4": ("taxonomy_level_4",),
}
SEMANTIC = {"origin": ("evidence_origin",), "name": ("canonical_technology_name", "raw_technology_name"), "source": ("source_id",), "url": ("source_url",), "project": ("project_name",), "company": ("company_or_organization",), "leaf": ("subcategory",)}
FILLED = ["company_or_organization", "project_name", "deployment_stage", "country", "project_year", "study_type", "journal_or_site", "doi", "functional_unit", "curing_conditions"]

MISS = "('', 'n.a.', 'na', 'n/a', 'not reported', 'unknown', 'not available')"


def _has(c: str) -> str:
    return f"(coalesce(lower(trim({c})), '') NOT IN {MISS})"


def _known(c: str) -> str:
    return f"(CASE WHEN {_has(c)} THEN {c} END)"


def _fold(c: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({c}, '')), '[^a-z0-9]+', ' ', 'g'))"


def _slug(c: str) -> str:
    x = f"regexp_replace(coalesce({c}, ''), '\\([^)]*\\)', '', 'g')"
    return f"replace({_fold(x)}, ' ', '_')"


def _phrase(t: str, p: str) -> str:
    return f"regexp_matches({t}, '(^|[^a-z0-9]){p}($|[^a-z0-9])')" if len(p) <= 4 and p.isalnum() else f"contains({t}, '{p}')"


def _score(t: str, terms: dict) -> str:
    return "(" + " + ".join(f"CASE WHEN {_phrase(t, p)} THEN {float(w)} ELSE 0.0 END" for p, w in terms.items()) + ")::DOUBLE"


def _year(c: str) -> str:
    return f"try_cast(nullif(regexp_extract(coalesce({c}, ''), '(?:^|[^0-9])((?:19|20)[0-9]{{2}})(?:$|[^0-9])', 1), '') AS INT)"


QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- scoring and filtering -------------------------------------------------------------------------------------------

_SCORED = f"""s AS (SELECT doc_id, lower(coalesce(text, '')) AS t, lang, source FROM documents),
c AS (SELECT doc_id, lang, source, {", ".join(f"{_score('t', w)} AS {n}_score" for n, w in TIERS.items())}, {_score("t", NEGATIVE)} AS penalty FROM s),
r AS (SELECT *, round(greatest(0.0, core_score + process_score + impact_score - penalty * CASE WHEN core_score > 0 THEN 0.35 ELSE 1.0 END), 3) AS relevance_score FROM c),
l AS (SELECT *, CASE WHEN core_score > 0 THEN 'core' WHEN relevance_score >= 3 THEN 'related' WHEN relevance_score > 0 THEN 'peripheral' ELSE 'none' END AS label FROM r)"""


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return scoring.score_documents(table(spark, d, "documents").select("doc_id", "text", "lang", "source"), "text", TIERS, NEGATIVE)


@query(f"WITH {_SCORED} SELECT doc_id, core_score, process_score, impact_score, penalty, relevance_score, label FROM l")
def lexicon_tier_score(spark, d):
    """Weighted lexicon score of every document."""
    return _scored(spark, d).select("doc_id", "core_score", "process_score", "impact_score", "penalty", "relevance_score", "label")


@query(f"WITH {_SCORED} SELECT label, count(*) AS n_docs, max(relevance_score) AS best FROM l GROUP BY label")
def relevance_labels(spark, d):
    """Documents per relevance label."""
    return _scored(spark, d).groupBy("label").agg(F.count("*").alias("n_docs"), F.max("relevance_score").alias("best"))


@query(f"""SELECT doc_id, list_aggregate(list_filter([{", ".join(f"CASE WHEN {_phrase("lower(coalesce(text, ''))", p)} THEN '{p}' END" for w in TIERS.values() for p in w)}], lambda x: x IS NOT NULL), 'string_agg', ', ') AS terms
FROM documents WHERE {_score("lower(coalesce(text, ''))", TIERS["core"])} > 0""")
def relevance_filter(spark, d):
    """Documents with a core term, with the terms found."""
    s = _scored(spark, d)
    return s.where("core_score > 0").select("doc_id", F.array_join("matched", ", ").alias("terms"))


@query(f"""SELECT doc_id, ({" + ".join(f"regexp_matches(lower(coalesce(text, '')), '{p}')::INT" for p in PATTERNS)})::INT AS n_patterns FROM documents""")
def pattern_bonus(spark, d):
    """How many quantity patterns each document shows."""
    return table(spark, d, "documents").select("doc_id", scoring.pattern_count(F.lower(F.coalesce("text", F.lit(""))), PATTERNS).alias("n_patterns"))


@query(f"""WITH {_SCORED}, y AS (SELECT *, row_number() OVER (PARTITION BY coalesce(lang, '') ORDER BY relevance_score DESC, doc_id) AS rank_no FROM l WHERE relevance_score > 0)
SELECT doc_id, coalesce(lang, '') AS branch, relevance_score, rank_no::INT AS rank_no FROM y WHERE rank_no <= 25""")
def rank_topn_per_branch(spark, d):
    """The 25 most relevant documents of each language."""
    s = _scored(spark, d).where("relevance_score > 0").select("doc_id", F.coalesce("lang", F.lit("")).alias("branch"), "relevance_score")
    return ranking.top_per_group(s, ["branch"], [F.desc("relevance_score"), F.col("doc_id")], 25)


@query(f"""WITH {_SCORED}, y AS (SELECT *, row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY relevance_score DESC, doc_id) AS rn FROM l WHERE relevance_score > 0)
SELECT doc_id, coalesce(source, '') AS branch, relevance_score FROM y WHERE rn <= 20 ORDER BY relevance_score DESC, doc_id LIMIT 50""")
def topn_branch_then_global(spark, d):
    """Twenty a source, then the best fifty of all (a top-k report)."""
    s = _scored(spark, d).where("relevance_score > 0").select("doc_id", F.coalesce("source", F.lit("")).alias("branch"), "relevance_score")
    t = ranking.top_per_group(s, ["branch"], [F.desc("relevance_score"), F.col("doc_id")], 20).drop("rank_no")
    return ranking.top_n(t, [F.desc("relevance_score"), F.col("doc_id")], 50)


@query(f"""WITH p AS (SELECT source_id, coalesce({_year("pub_year")}, {_year("doi")}) AS y, {_year("pub_year")} IS NULL AS inferred,
  (CASE WHEN {_phrase("lower(coalesce(title, ''))", "strength")} THEN 2.5 ELSE 0.0 END + CASE WHEN {_phrase("lower(coalesce(abstract_or_snippet, ''))", "silica fume")} THEN 1.5 ELSE 0.0 END) AS phrases
  FROM registered_sources)
SELECT source_id, (phrases + coalesce(CASE WHEN inferred THEN greatest(0.0, 10.0 - 0.4 * (2025 - y)) / 2 ELSE greatest(0.0, 10.0 - 0.4 * (2025 - y)) END, 0.0))::DOUBLE AS rank_score FROM p""")
def composite_rank(spark, d):
    """Title and abstract phrases plus a bonus for recent years."""
    r = table(spark, d, "registered_sources")
    y = S.publication_year("pub_year", "doi")
    phrases = F.when(S.phrase_in(F.lower(F.coalesce("title", F.lit(""))), "strength"), 2.5).otherwise(0.0) + F.when(S.phrase_in(F.lower(F.coalesce("abstract_or_snippet", F.lit(""))), "silica fume"), 1.5).otherwise(0.0)
    r = r.select("source_id", y.alias("y"), phrases.alias("p"))
    return r.select("source_id", (F.col("p") + scoring.recency_bonus(F.col("y.year"), 2025, F.col("y.year_source") == "doi")).alias("rank_score"))


# ---- joins ------------------------------------------------------------------------------------------------------------


@query("""SELECT DISTINCT source_id, record_id FROM cementitious c WHERE EXISTS (SELECT 1 FROM screening s WHERE s.is_relevant AND s.paper_id = c.source_id)""")
def screening_semi(spark, d):
    """Records of papers that were screened as relevant."""
    ok = table(spark, d, "screening").where("is_relevant").select(F.col("paper_id").alias("source_id")).distinct()
    return table(spark, d, "cementitious").select("source_id", "record_id").join(ok, "source_id", "left_semi").distinct()


@query("""SELECT DISTINCT paper_id FROM screening s WHERE is_relevant AND paper_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM cementitious c WHERE s.paper_id = c.source_id)""")
def screening_anti(spark, d):
    """Papers screened as relevant that no record comes from."""
    used = table(spark, d, "cementitious").select(F.col("source_id").alias("paper_id"))
    return table(spark, d, "screening").where("is_relevant AND paper_id IS NOT NULL").select("paper_id").join(used, "paper_id", "left_anti").distinct()


@query(f"""WITH t AS (SELECT source_id, min(title) FILTER ({_has("title")}) AS title, min(url) FILTER ({_has("url")}) AS url FROM registered_sources GROUP BY 1)
SELECT s.discovery_record_id, s.source_id, coalesce({_known("s.source_title")}, t.title) AS title, t.url FROM (SELECT DISTINCT discovery_record_id, source_id, source_title FROM scm_discovery) s LEFT JOIN t USING (source_id)""")
def late_materialize(spark, d):
    """Wide source columns joined to records late, own title first."""
    r = table(spark, d, "registered_sources").groupBy("source_id").agg(F.min(known("title")).alias("t"), F.min(known("url")).alias("url"))
    s = table(spark, d, "scm_discovery").select("discovery_record_id", "source_id", "source_title").distinct()
    return s.join(r, "source_id", "left").select("discovery_record_id", "source_id", F.coalesce(known("source_title"), "t").alias("title"), "url")


@query(f"""WITH a AS (SELECT DISTINCT discovery_record_id, {_fold(_known("project_name"))} AS project, {_fold(_known("company_or_organization"))} AS company FROM scm_discovery),
b AS (SELECT DISTINCT company_id, {_fold("p")} AS project, {_fold(_known("name"))} AS company FROM (SELECT company_id, name, unnest(associated_projects) AS p FROM company_intel)),
p AS (SELECT discovery_record_id, company_id, CASE WHEN a.company <> '' AND a.company = b.company THEN 'company' ELSE 'project' END AS rule FROM a JOIN b ON a.project = b.project AND a.project <> '')
SELECT discovery_record_id, company_id, min(rule) AS rule, max(CASE rule WHEN 'company' THEN 0.9 ELSE 0.8 END)::DOUBLE AS score FROM p GROUP BY 1, 2""")
def link_project_company(spark, d):
    """Links of discovery records and companies that name one project; surer where the company is the same."""
    a = table(spark, d, "scm_discovery").select("discovery_record_id", S.key_fold(known("project_name")).alias("project"), S.key_fold(known("company_or_organization")).alias("company"))
    b = table(spark, d, "company_intel").select("company_id", "name", F.explode("associated_projects").alias("p")).select("company_id", S.key_fold("p").alias("project"), S.key_fold(known("name")).alias("company"))
    both = lambda x: x.withColumn("both", F.when((F.col("company") != "") & (F.col("project") != ""), F.concat_ws("|", "project", "company")))
    return merging.link(both(a), both(b), [("project", "project", 0.8), ("company", "both", 0.9)], "discovery_record_id", "company_id", F.lit(False))


def _key(c: str) -> str:
    return f"(CASE WHEN {_has(c)} THEN replace(lower(trim({c})), 'ß', 'ss') END)"


_ORIGINS = f"""r AS (SELECT DISTINCT record_id, evidence_origin, {_key("project_name")} AS project, {_key("company_or_organization")} AS company, {_key("country")} AS country, {_key("taxonomy_level_3")} AS leaf, {_key("canonical_technology_name")} AS technology FROM cementitious),
w AS (SELECT DISTINCT coalesce(record_id, '') AS web_id, project, company, country, leaf, technology FROM r WHERE evidence_origin = 'Web'),
l AS (SELECT DISTINCT record_id AS literature_id, project, company, country, leaf, technology FROM r WHERE evidence_origin = 'Literature' AND coalesce(record_id, '') <> '')"""


def _origins(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    key = lambda c: F.regexp_replace(F.lower(F.trim(known(c))), "ß", "ss")
    cols = {"project": "project_name", "company": "company_or_organization", "country": "country", "leaf": "taxonomy_level_3", "technology": "canonical_technology_name"}
    c = table(spark, d, "cementitious").select("record_id", "evidence_origin", *[key(v).alias(n) for n, v in cols.items()])
    return tuple(c.where(F.col("evidence_origin") == o).select(F.col("record_id").alias(n), *cols) for o, n in (("Web", "web_id"), ("Literature", "literature_id")))


@query(f"""WITH {_ORIGINS},
p AS (SELECT DISTINCT web_id, 'project' AS rule, 0.8 AS score, literature_id, NULL::VARCHAR AS leaf, NULL::VARCHAR AS technology, NULL::BIGINT AS n_right FROM w JOIN l USING (project)
  WHERE NOT coalesce(w.company <> l.company, false) AND NOT coalesce(w.country <> l.country, false)),
n AS (SELECT leaf, technology, count(DISTINCT literature_id) AS n_right FROM l WHERE leaf IS NOT NULL AND technology IS NOT NULL GROUP BY 1, 2),
t AS (SELECT DISTINCT web_id, 'technology' AS rule, 0.6 AS score, NULL::VARCHAR AS literature_id, leaf, technology, n_right FROM w JOIN n USING (leaf, technology))
SELECT web_id, rule, score::DOUBLE AS score, literature_id, leaf, technology, n_right FROM (SELECT DISTINCT web_id FROM w) LEFT JOIN (SELECT * FROM p UNION ALL SELECT * FROM t) USING (web_id)""")
def literature_web_links(spark, d):
    """Each web record with the literature of its project (0.8; other company or country vetoes), the class of its leaf and technology (0.6), or neither."""
    web, literature = _origins(spark, d)
    veto = F.coalesce(F.col("company") != F.col("r_company"), F.lit(False)) | F.coalesce(F.col("country") != F.col("r_country"), F.lit(False))
    return merging.link_with_classes(web, literature, "project", ["leaf", "technology"], "web_id", "literature_id", veto, ("project", 0.8), ("technology", 0.6))


@query(f"""WITH {_ORIGINS}, m AS (SELECT leaf, technology, 'Web' AS evidence_origin, web_id AS record_id FROM w UNION SELECT leaf, technology, 'Literature', literature_id FROM l)
SELECT leaf, technology, evidence_origin, record_id FROM m WHERE EXISTS (SELECT 1 FROM w WHERE w.leaf = m.leaf AND w.technology = m.technology) AND EXISTS (SELECT 1 FROM l WHERE l.leaf = m.leaf AND l.technology = m.technology)""")
def literature_web_classes(spark, d):
    """Members of the classes of leaf and technology that literature_web_links names."""
    web, literature = _origins(spark, d)
    m = merging.class_members(web, literature, ["leaf", "technology"], "web_id", "literature_id")
    return m.select("leaf", "technology", F.when(F.col("origin") == "left", "Web").otherwise("Literature").alias("evidence_origin"), F.col("id").alias("record_id"))


@query(f"""WITH k AS (SELECT DISTINCT {_fold("canonical_name")} AS k, min(ref_id) OVER (PARTITION BY {_fold("canonical_name")}) AS ref_id FROM canonical_names),
n AS (SELECT {_fold("technology_name")} AS k, count(*) AS n FROM metric_intel WHERE {_has("technology_name")} GROUP BY 1)
SELECT n.k AS name_key, coalesce(k.ref_id, -1) AS ref_id, n FROM n LEFT JOIN k USING (k)""")
def crosswalk(spark, d):
    """Technology names of the metrics against the canonical list, by folded equality."""
    k = table(spark, d, "canonical_names").select(S.key_fold("canonical_name").alias("name_key"), "ref_id").groupBy("name_key").agg(F.min("ref_id").alias("ref_id"))
    n = table(spark, d, "metric_intel").where(present("technology_name")).groupBy(S.key_fold("technology_name").alias("name_key")).agg(F.count("*").alias("n"))
    return n.join(k, "name_key", "left").select("name_key", F.coalesce("ref_id", F.lit(-1).cast("bigint")).alias("ref_id"), "n")


@query("""SELECT DISTINCT r.r_name AS region, n.n_name AS nation, (SELECT count(*) FROM customer c WHERE c.c_nationkey = n.n_nationkey) AS n_customers, (SELECT count(*) FROM supplier s WHERE s.s_nationkey = n.n_nationkey) AS n_suppliers FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey""")
def retrieval_coverage(spark, d):
    """Fact tables counted per node and joined to the dimension, zeros kept."""
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n_customers"))
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n_suppliers"))
    j = taxonomy.with_zero_nodes(taxonomy.with_zero_nodes(n, c, "n_nationkey", "n_customers"), s, "n_nationkey", "n_suppliers")
    return j.select(F.col("r_name").alias("region"), F.col("n_name").alias("nation"), "n_customers", "n_suppliers")


# ---- aggregation --------------------------------------------------------------------------------------------------------


@query(f"""SELECT {_fold("raw_material_name")} AS name_key, count(*) AS n_rows, count(DISTINCT source_id) AS n_sources, arg_max(raw_material_name, [length(raw_material_name)::VARCHAR.lpad(9, '0'), raw_material_name]) AS longest
FROM scm_discovery WHERE {_has("raw_material_name")} GROUP BY 1""")
def candidate_aggregate(spark, d):
    """Names by folded key: rows, distinct sources, the longest spelling (ties: the larger)."""
    return records.candidates(table(spark, d, "scm_discovery"), "raw_material_name", "source_id")


@query(f"""WITH v AS (SELECT {_fold("raw_technology_name")} AS k, trim(raw_technology_name) AS alias, count(*) AS n FROM cementitious WHERE {_has("raw_technology_name")} GROUP BY 1, 2)
SELECT k AS name_key, alias, n, row_number() OVER (PARTITION BY k ORDER BY n DESC, alias)::INT AS rank_no FROM v QUALIFY rank_no <= 3""")
def topk_aliases(spark, d):
    """The three most frequent spellings of each folded name."""
    v = table(spark, d, "cementitious").where(present("raw_technology_name")).groupBy(S.key_fold("raw_technology_name").alias("name_key"), F.trim("raw_technology_name").alias("alias")).agg(F.count("*").alias("n"))
    return ranking.top_per_group(v, ["name_key"], [F.desc("n"), F.col("alias")], 3)


@query(f"""SELECT coalesce({_known("deployment_stage")}, 'N.A.') AS stage, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4)::DOUBLE AS pct FROM cementitious GROUP BY 1""")
def coverage_pct(spark, d):
    """Share of each deployment stage."""
    g = table(spark, d, "cementitious").groupBy(F.coalesce(known("deployment_stage"), F.lit("N.A.")).alias("stage")).agg(F.count("*").alias("n"))
    total = g.agg(F.sum("n").alias("t"))
    return g.crossJoin(F.broadcast(total)).select("stage", "n", F.round(100.0 * F.col("n") / F.col("t"), 4).alias("pct"))


@query(f"SELECT column_name, filled, total FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({_has(c)}) AS filled, count(*) AS total FROM cementitious" for c in FILLED) + ")")
def fill_rates(spark, d):
    """How often each of ten columns holds a value."""
    return quality.fill_rates(table(spark, d, "cementitious"), FILLED)


@query(f"""SELECT column_name, value, count(*) AS n FROM (SELECT 'deployment_stage' AS column_name, trim(deployment_stage) AS value FROM cementitious WHERE {_has("deployment_stage")} AND lower(trim(deployment_stage)) NOT IN {STAGES[:1] + STAGES[3:]}
UNION ALL SELECT 'study_type', trim(study_type) FROM cementitious WHERE {_has("study_type")} AND lower(trim(study_type)) NOT IN ('review', 'experimental')) GROUP BY ALL""")
def vocab_violations(spark, d):
    """Values outside two controlled vocabularies."""
    return quality.vocabulary_violations(table(spark, d, "cementitious"), {"deployment_stage": STAGES[:1] + STAGES[3:], "study_type": ("review", "experimental")})


@query(f"""SELECT coalesce({_known("category")}, 'N.A.') AS part, count(*) AS n_rows, count(DISTINCT CASE WHEN {_has("company_or_organization")} THEN lower(trim(company_or_organization)) END) AS distinct_company_or_organization,
count(DISTINCT CASE WHEN {_has("doi")} THEN lower(trim(doi)) END) AS distinct_doi, count(*) FILTER ({_has("project_name")}) AS filled_project_name, count(*) FILTER ({_has("country")}) AS filled_country FROM cementitious GROUP BY 1""")
def partition_stats(spark, d):
    """Row, distinct and fill counts per category."""
    c = table(spark, d, "cementitious").withColumn("part", F.coalesce(known("category"), F.lit("N.A.")))
    return quality.partition_stats(c, ["part"], ["company_or_organization", "doi"], ["project_name", "country"])


@query("SELECT record_id, count(*) AS n FROM cementitious GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(spark, d):
    """Ids delivered more than once."""
    return quality.duplicate_ids(table(spark, d, "cementitious"), "record_id")


@query("""WITH e AS (SELECT export_batch, max(merged_records) AS expected FROM scm_export_summary WHERE export_batch IS NOT NULL GROUP BY 1), o AS (SELECT export_batch, count(DISTINCT record_id) AS observed FROM cementitious WHERE export_batch IS NOT NULL GROUP BY 1)
SELECT export_batch, coalesce(expected, 0) AS expected, coalesce(observed, 0) AS observed FROM e FULL JOIN o USING (export_batch) WHERE coalesce(expected, 0) <> coalesce(observed, 0)""")
def count_reconciliation(spark, d):
    """Export batches whose logged counts differ from the records there are."""
    e = table(spark, d, "scm_export_summary").where("export_batch IS NOT NULL").groupBy("export_batch").agg(F.max("merged_records").alias("n"))
    o = table(spark, d, "cementitious").where("export_batch IS NOT NULL").groupBy("export_batch").agg(F.countDistinct("record_id").alias("n"))
    return quality.reconcile(e, o, ["export_batch"])


@query("""SELECT event_type, user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) = 1""")
def stage_peak(spark, d):
    """The event of the highest value of each type; ties: the smaller id."""
    return ranking.best_per_key(table(spark, d, "events").select("event_type", "user_id", "event_id", "value"), ["event_type"], [F.desc("value"), F.col("event_id")])


@query("""WITH x AS (SELECT DISTINCT shard_id, corpus_index FROM screening), y AS (SELECT *, corpus_index - row_number() OVER (PARTITION BY shard_id ORDER BY corpus_index) AS run FROM x)
SELECT shard_id, min(corpus_index) AS first_no, max(corpus_index) AS last_no, count(*) AS n FROM y GROUP BY shard_id, run""")
def gaps_islands(spark, d):
    """Runs of consecutive corpus positions in each shard."""
    return ranking.islands(table(spark, d, "screening"), ["shard_id"], "corpus_index")


@query("""SELECT (corpus_index // 1000)::BIGINT AS shard_no, count(*) AS n, min(corpus_index) AS lo, max(corpus_index) AS hi FROM (SELECT DISTINCT corpus_index FROM screening) GROUP BY 1""")
def shard_plan(spark, d):
    """Contiguous shards of a thousand positions."""
    s = table(spark, d, "screening").select("corpus_index").distinct()
    return s.groupBy(ranking.shard_no(F.col("corpus_index"), 1000).alias("shard_no")).agg(F.count("*").alias("n"), F.min("corpus_index").alias("lo"), F.max("corpus_index").alias("hi"))


@query(f"""SELECT CASE lower(trim(coalesce(screening_confidence, ''))) WHEN 'high' THEN 'High' WHEN 'medium' THEN 'Medium' WHEN 'med' THEN 'Medium' WHEN 'low' THEN 'Low' ELSE 'N.A.' END AS confidence_label, product_line, count(*) AS n, count(*) FILTER (is_relevant) AS n_relevant,
sum(round(1000 * CASE WHEN confidence IS NULL OR isnan(confidence) THEN 0.0 ELSE least(1.0, greatest(0.0, confidence)) END)::BIGINT)::BIGINT AS confidence_milli FROM screening GROUP BY 1, 2""")
def confidence_labels(spark, d):
    """Confidence words in one spelling, numbers clamped to 0-1."""
    s = table(spark, d, "screening")
    return s.groupBy(S.label_of("screening_confidence", CONFIDENCE, "N.A.").alias("confidence_label"), "product_line").agg(F.count("*").alias("n"), F.count_if("is_relevant").alias("n_relevant"), F.sum(F.round(1000 * S.clamp_confidence(F.col("confidence"))).cast("bigint")).alias("confidence_milli"))


# ---- deduplication and merging --------------------------------------------------------------------------------------------


@query("""SELECT screening_id, shard_id, corpus_index, screening_score FROM (SELECT DISTINCT screening_id, shard_id, corpus_index, screening_score FROM screening WHERE screening_score IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY shard_id, corpus_index ORDER BY screening_score DESC, screening_id) = 1""")
def best_per_key(spark, d):
    """The best screening of each paper and shard."""
    s = table(spark, d, "screening").where("screening_score IS NOT NULL").select("screening_id", "shard_id", "corpus_index", "screening_score").distinct()
    return ranking.best_per_key(s, ["shard_id", "corpus_index"], [F.desc("screening_score"), F.col("screening_id")])


def _part(columns: tuple[str, ...]) -> str:
    return f"coalesce({', '.join(f'lower(trim({_known(c)}))' for c in columns)}, '')"


_KEYS = " || '|' || ".join(_part(c) for c in EXACT.values())
_SKEYS = " || '|' || ".join(_part(c) for c in SEMANTIC.values())
_DUP = f"""WITH k AS (SELECT record_id, min(exact_key) AS exact_key, arg_min(semantic_key, exact_key) AS semantic_key FROM (SELECT record_id, sha1({_KEYS}) AS exact_key, sha1({_SKEYS})[1:16] AS semantic_key FROM cementitious) GROUP BY 1),
e AS (SELECT *, row_number() OVER (PARTITION BY exact_key ORDER BY record_id) AS rn, first_value(record_id) OVER (PARTITION BY exact_key ORDER BY record_id) AS f FROM k),
s AS (SELECT *, row_number() OVER (PARTITION BY semantic_key, rn = 1 ORDER BY record_id) AS srn, first_value(record_id) OVER (PARTITION BY semantic_key, rn = 1 ORDER BY record_id) AS sf FROM e),
m AS (SELECT record_id, exact_key, semantic_key, CASE WHEN rn > 1 THEN 'exact' WHEN srn > 1 THEN 'possible' ELSE 'unique' END AS dup_status, CASE WHEN rn > 1 THEN f WHEN srn > 1 THEN sf END AS dup_of FROM s)"""


def _marked(spark: SparkSession, d: str) -> DataFrame:
    part = lambda columns: F.coalesce(*[F.lower(F.trim(known(c))) for c in columns], F.lit(""))
    c = table(spark, d, "cementitious").select("record_id", F.sha1(F.concat_ws("|", *[part(c) for c in EXACT.values()])).alias("exact_key"), F.substring(F.sha1(F.concat_ws("|", *[part(c) for c in SEMANTIC.values()])), 1, 16).alias("semantic_key"))
    c = c.groupBy("record_id").agg(F.min(F.struct("exact_key", "semantic_key")).alias("k")).select("record_id", "k.*")  # a record delivered again is one
    return dedupe.mark_by_keys(c, "record_id")


@query(f"{_DUP} SELECT record_id, dup_status, dup_of FROM m")
def exact_dedupe(spark, d):
    """Exact duplicates by fifteen parts, possible ones by seven, each with the record it repeats."""
    return _marked(spark, d).select("record_id", "dup_status", "dup_of")


@query(f"{_DUP} SELECT dup_status, count(*) AS n, count(DISTINCT dup_of) AS n_kept FROM m GROUP BY 1")
def dedupe_audit(spark, d):
    """How many records each status has, and how many they repeat."""
    return _marked(spark, d).groupBy("dup_status").agg(F.count("*").alias("n"), F.countDistinct("dup_of").alias("n_kept"))


@query(f"""{_DUP} SELECT record_id, CASE dup_status WHEN 'exact' THEN exact_key[1:12] ELSE semantic_key END AS group_id, dup_status, CASE dup_status WHEN 'exact' THEN 'same technology, source, project and metrics' ELSE 'same technology, source, project and company' END AS reason, dup_of AS matched FROM m WHERE dup_status <> 'unique'""")
def duplicate_audit_rows(spark, d):
    """The audit trail of duplicates: group, reason, the record each repeats."""
    return dedupe.audit_rows(_marked(spark, d), "record_id", "record_id")


@query("""SELECT shard_id, corpus_index, screening_id, is_relevant FROM (SELECT DISTINCT shard_id, corpus_index, screening_id, is_relevant, confidence FROM screening) QUALIFY row_number() OVER (PARTITION BY shard_id, corpus_index ORDER BY (confidence IS NULL OR isnan(confidence))::INT, screening_id) = 1""")
def error_superseded(spark, d):
    """The first usable screening of a paper, or the first at all."""
    s = table(spark, d, "screening").select("shard_id", "corpus_index", "screening_id", "is_relevant", "confidence").distinct()
    s = s.withColumn("k", F.struct("shard_id", "corpus_index"))
    return dedupe.superseded(s, "k", F.col("confidence").isNull() | F.isnan("confidence"), "screening_id").select("shard_id", "corpus_index", "screening_id", "is_relevant")


_URL = r"""lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) || '://' || regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1)), '^www\.', '')
 || CASE WHEN regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]+([^?]*)', 1), '/+$', '') = '' THEN '/' ELSE regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]+([^?]*)', 1), '/+$', '') END
 || CASE WHEN q = '' THEN '' ELSE '?' || q END"""
_TRACK = "(" + ", ".join(f"'{t}'" for t in S.TRACKING) + ")"
_URLS = rf"""WITH b0 AS (SELECT web_source_id, source_type, authority_rank, CASE WHEN regexp_matches(trim(url), '(?i)^[a-z0-9-]+(?:\.[a-z0-9-]+)+(?:[/?#:].*)?$') THEN 'https://' || trim(url) ELSE url END AS url FROM (SELECT web_source_id, source_type, authority_rank, CASE WHEN web_source_id LIKE '%3' THEN regexp_replace(url, '^https?://', '') ELSE url END AS url FROM web_stages)),
b AS (SELECT *, regexp_replace(trim(url), '#.*$', '') AS u FROM b0),
q AS (SELECT *, coalesce(list_aggregate(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'), lambda p: p <> '' AND lower(split_part(p, '=', 1)) NOT IN {_TRACK}), 'string_agg', '&'), '') AS q FROM b),
n AS (SELECT web_source_id, source_type, authority_rank, CASE WHEN regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1) = '' THEN trim(url) ELSE {_URL} END AS url_key FROM q)"""


def _bare(w: DataFrame) -> DataFrame:
    return w.withColumn("url", F.when(F.col("web_source_id").endswith("3"), F.regexp_replace("url", "^https?://", "")).otherwise(F.col("url")))


@query(f"{_URLS} SELECT DISTINCT web_source_id, url_key FROM n")
def url_normalize(spark, d):
    """URLs without www., fragments, trailing slashes and tracking parameters, some of them without their scheme."""
    return _bare(table(spark, d, "web_stages")).select("web_source_id", S.url_key("url").alias("url_key")).distinct()


@query(f"""{_URLS}, k AS (SELECT url_key, count(DISTINCT web_source_id) AS n_origins, count(*) AS n_rows FROM n WHERE url_key IS NOT NULL GROUP BY 1),
f AS (SELECT url_key, web_source_id, authority_rank FROM n WHERE url_key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY url_key ORDER BY authority_rank NULLS FIRST, web_source_id) = 1)
SELECT f.url_key, web_source_id, authority_rank, n_origins, n_rows FROM f JOIN k USING (url_key)""")
def url_dedupe_provenance(spark, d):
    """One page per URL, by authority, with how many pages and rows led to it."""
    return dedupe.with_provenance(_keyed(spark, d), "url_key", "web_source_id", [F.asc_nulls_first("authority_rank"), F.col("web_source_id")])


def _keyed(spark: SparkSession, d: str) -> DataFrame:
    return _bare(table(spark, d, "web_stages")).select("web_source_id", "authority_rank", S.url_key("url").alias("url_key")).where("url_key IS NOT NULL")


@query(f"{_URLS} SELECT DISTINCT url_key, web_source_id FROM n WHERE url_key IS NOT NULL AND web_source_id IS NOT NULL")
def url_provenance(spark, d):
    """All pages that led to each URL, a row each."""
    return dedupe.provenance(_keyed(spark, d), "url_key", "web_source_id")


@query(rf"""SELECT regexp_replace(lower(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1)), '^www\.', '') AS host, coalesce({_known("source_type")}, 'other') AS source_type, count(*) AS n, count(DISTINCT web_source_id) AS n_sources FROM web_stages WHERE url IS NOT NULL GROUP BY 1, 2""")
def host_classify(spark, d):
    """Pages per host and source type."""
    w = table(spark, d, "web_stages").where("url IS NOT NULL")
    return w.groupBy(S.host_of("url").alias("host"), F.coalesce(known("source_type"), F.lit("other")).alias("source_type")).agg(F.count("*").alias("n"), F.countDistinct("web_source_id").alias("n_sources"))


@query(f"""WITH r AS (SELECT DISTINCT record_id, {_fold(_known("project_name"))} AS project, {", ".join(f"{_known(f)} AS {f}" for f in ("country", "company_or_organization", "project_year"))} FROM cementitious WHERE {_has("project_name")})
SELECT project, {", ".join(f"arg_min(trim({f}), record_id) FILTER ({f} IS NOT NULL) AS {f}, coalesce(count(DISTINCT lower(trim({f}))) > 1, false) AS {f}_conflict" for f in ("country", "company_or_organization", "project_year"))}, count(*) AS n_rows FROM r GROUP BY project""")
def entity_consolidate(spark, d):
    """Records of one project folded in order, with conflicts noted."""
    fields = ["country", "company_or_organization", "project_year"]
    r = table(spark, d, "cementitious").where(present("project_name")).select("record_id", S.key_fold("project_name").alias("project"), *[known(f).alias(f) for f in fields]).distinct()
    return merging.consolidate(r, "project", fields, "record_id")


@query(f"""WITH v AS (SELECT {_fold("company_or_organization")} AS company, trim(country) AS country, count(*) AS votes FROM cementitious WHERE {_has("company_or_organization")} AND {_has("country")} GROUP BY 1, 2)
SELECT company, country, votes FROM v QUALIFY row_number() OVER (PARTITION BY company ORDER BY votes DESC, country) = 1""")
def majority_vote(spark, d):
    """The country most records of a company name."""
    c = table(spark, d, "cementitious").where(present("company_or_organization")).withColumn("company", S.key_fold("company_or_organization"))
    return merging.majority(c, "company", "country")


@query(f"""WITH r AS (SELECT DISTINCT record_id, {_fold("project_name")} AS p, {_known("country")} AS country, {_known("project_year")} AS project_year FROM cementitious WHERE {_has("project_name")}),
d AS (SELECT p, arg_min(trim(country), record_id) FILTER (country IS NOT NULL) AS dc, arg_min(trim(project_year), record_id) FILTER (project_year IS NOT NULL) AS dy FROM r GROUP BY p)
SELECT record_id, coalesce(trim(country), dc) AS country, coalesce(trim(project_year), dy) AS project_year, ((country IS NULL AND dc IS NOT NULL)::INT + (project_year IS NULL AND dy IS NOT NULL)::INT)::INT AS filled FROM r JOIN d USING (p)""")
def sibling_fill(spark, d):
    """Gaps filled from other records of the same project."""
    r = table(spark, d, "cementitious").where(present("project_name")).select("record_id", S.key_fold("project_name").alias("p"), known("country").alias("country"), known("project_year").alias("project_year")).distinct()
    return merging.sibling_fill(r, [F.col("p")], ["country", "project_year"], "record_id").select("record_id", "country", "project_year", "filled")


# ---- taxonomy ---------------------------------------------------------------------------------------------------------------


def _path_sql(levels: list[str]) -> str:
    s = [_slug(_known(c)) for c in levels]
    cases = [f"WHEN {x} = '' THEN " + ("NULL" if i == 0 else " || '/' || ".join(s[:i])) for i, x in enumerate(s)]
    return "CASE " + " ".join(cases) + " ELSE " + " || '/' || ".join(s) + " END"


_LOST = "evidence_origin = 'Web' AND taxonomy_level_1 = 'L1-02'"
_TREE = f"""WITH p AS (SELECT {_path_sql(LEVELS)} AS path FROM cementitious), g AS (SELECT path, count(*) AS n FROM p WHERE path IS NOT NULL GROUP BY 1),
x AS (SELECT string_split(path, '/') AS parts, n FROM g), a AS (SELECT array_to_string(parts[1:i], '/') AS node, i, n FROM (SELECT parts, n, unnest(range(1, len(parts) + 1)) AS i FROM x))"""


def _paths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "cementitious").select(taxonomy.path_of(LEVELS).alias("path"))


@query(f"{_TREE} SELECT node, i::INT AS level, sum(n)::BIGINT AS n_rows FROM a GROUP BY 1, 2")
def tree_rollup(spark, d):
    """Rows on and below every node of the tree."""
    return taxonomy.rollup(_paths(spark, d), "path", [F.count("*").alias("n_rows")]).select("node", "level", "n_rows")


@query(f"{_TREE} SELECT DISTINCT node, CASE WHEN i > 1 THEN array_to_string(string_split(node, '/')[1:i - 1], '/') END AS parent, i::INT AS level FROM a")
def tree_closure(spark, d):
    """All nodes with their parents."""
    return taxonomy.nodes(_paths(spark, d), "path")


@query(f"""{_TREE}, nd AS (SELECT DISTINCT node FROM a), own AS (SELECT path AS node, n FROM g) SELECT node, coalesce(n, 0)::BIGINT AS n_own FROM nd LEFT JOIN own USING (node)""")
def zero_nodes(spark, d):
    """Rows of each node itself, nodes without any kept."""
    p = _paths(spark, d)
    own = p.where("path IS NOT NULL").groupBy(F.col("path").alias("node")).agg(F.count("*").alias("n_own"))
    return taxonomy.with_zero_nodes(taxonomy.nodes(p, "path").select("node"), own, "node", "n_own")


@query(f"""{_TREE}, t AS (SELECT node, i, sum(n) AS total FROM a GROUP BY 1, 2), kp AS (SELECT {_path_sql(LEVELS)} AS path FROM cementitious WHERE NOT coalesce({_LOST}, false)), kg AS (SELECT path, count(*) AS n FROM kp WHERE path IS NOT NULL GROUP BY 1),
kx AS (SELECT string_split(path, '/') AS parts, n FROM kg), ka AS (SELECT array_to_string(parts[1:i], '/') AS node, i, n FROM (SELECT parts, n, unnest(range(1, len(parts) + 1)) AS i FROM kx)), kt AS (SELECT node, i, sum(n) AS total FROM ka GROUP BY 1, 2),
c AS (SELECT array_to_string(string_split(node, '/')[1:i - 1], '/') AS node, sum(total) AS below FROM kt WHERE i > 1 GROUP BY 1)
SELECT t.node, total::BIGINT AS total, (coalesce(below, 0) + coalesce(own.n, 0))::BIGINT AS from_parts FROM t LEFT JOIN c USING (node) LEFT JOIN kg AS own ON own.path = t.node WHERE total <> coalesce(below, 0) + coalesce(own.n, 0)""")
def child_union_check(spark, d):
    """Nodes whose rows aren't their own and their children's, in an export that lost the web records of one branch."""
    c = table(spark, d, "cementitious")
    parts = c.where(~F.coalesce((F.col("evidence_origin") == "Web") & (F.col("taxonomy_level_1") == "L1-02"), F.lit(False))).select(taxonomy.path_of(LEVELS).alias("path"))
    return taxonomy.conservation_errors(_paths(spark, d), parts, "path")


@query("SELECT DISTINCT company_id, associated_technology FROM company_intel c WHERE associated_technology IS NOT NULL AND NOT EXISTS (SELECT 1 FROM canonical_names n WHERE n.canonical_name = c.associated_technology)")
def fk_errors(spark, d):
    """Companies whose technology isn't on the canonical list as written."""
    return taxonomy.foreign_keys(table(spark, d, "company_intel").select("company_id", "associated_technology"), "associated_technology", table(spark, d, "canonical_names"), "canonical_name").select("company_id", "associated_technology").distinct()


@query("""WITH o AS (SELECT DISTINCT coalesce(lower(trim(canonical_technology_name)), '') AS node, CASE WHEN lower(trim(evidence_origin)) = 'web' THEN 2 ELSE 1 END AS bit FROM cementitious)
SELECT CASE bit WHEN 1 THEN 'literature' WHEN 2 THEN 'web' ELSE 'both' END AS bucket, count(*) AS n_nodes FROM (SELECT node, sum(bit) AS bit FROM o GROUP BY node) GROUP BY bit""")
def origin_buckets(spark, d):
    """Technologies known from literature, the web, or both."""
    o = table(spark, d, "cementitious").select(F.coalesce(F.lower(F.trim("canonical_technology_name")), F.lit("")).alias("node"), F.when(F.lower(F.trim("evidence_origin")) == "web", 2).otherwise(1).alias("bit"))
    n = o.groupBy("node").agg(F.bit_or("bit").alias("bits"))
    return n.groupBy(F.when(F.col("bits") == 1, "literature").when(F.col("bits") == 2, "web").otherwise("both").alias("bucket")).agg(F.count("*").alias("n_nodes"))


# ---- reshaping and scalars ------------------------------------------------------------------------------------------------------


@query("""SELECT DISTINCT screening_id, material FROM (SELECT screening_id, unnest(from_json(mentioned_materials, '["VARCHAR"]')) AS material FROM screening WHERE json_valid(mentioned_materials)) WHERE material IS NOT NULL""")
def metrics_explode(spark, d):
    """One row per material of the JSON lists of screenings."""
    return reshape.json_list(table(spark, d, "screening").select("screening_id", "mentioned_materials"), "mentioned_materials", "material").select("screening_id", "material").distinct()


@query("""WITH r AS (SELECT DISTINCT source_id, authors FROM registered_sources), a AS (SELECT source_id, unnest(authors) AS author, unnest(range(0, len(authors))) AS pos FROM r)
SELECT r.source_id, a.pos::INT AS pos, a.author FROM r LEFT JOIN a ON a.source_id = r.source_id AND len(r.authors) > 0""")
def citations_expand(spark, d):
    """One row per author with position; sources without authors keep a row."""
    r = table(spark, d, "registered_sources").select("source_id", "authors").distinct()
    return reshape.explode_list(r, "authors", "author", "pos").select("source_id", "pos", "author")


@query("""SELECT DISTINCT company_id, associated_projects[1] AS project_1, associated_projects[2] AS project_2, associated_projects[3] AS project_3, associated_projects[4] AS project_4, coalesce(len(associated_projects), 0)::INT AS n_projects FROM company_intel""")
def flatten_components(spark, d):
    """The first four projects as columns."""
    c = reshape.list_head(table(spark, d, "company_intel"), "associated_projects", 4, "project")
    return c.select("company_id", "project_1", "project_2", "project_3", "project_4", F.coalesce(F.size("associated_projects"), F.lit(0)).alias("n_projects")).withColumn("n_projects", F.greatest("n_projects", F.lit(0))).distinct()


@query(f"""SELECT DISTINCT source_id, coalesce({_year("pub_year")}, {_year("doi")}) AS year, CASE WHEN {_year("pub_year")} IS NOT NULL THEN 'metadata' WHEN {_year("doi")} IS NOT NULL THEN 'doi' ELSE 'missing' END AS year_source FROM registered_sources""")
def year_normalize(spark, d):
    """Publication years: own, from the DOI, or missing."""
    return table(spark, d, "registered_sources").select("source_id", S.publication_year("pub_year", "doi").alias("y")).select("source_id", "y.year", "y.year_source").distinct()


@query(f"""SELECT DISTINCT source_id, CASE WHEN {_has("doi")} THEN 'doi:' || lower(trim(doi)) WHEN {_has("url")} THEN 'url:' || lower(trim(url)) WHEN {_has("title")} THEN 'title:' || lower(trim(title)) ELSE 'unknown' END AS paper_key, coalesce(trim({_known("title")}), 'N.A.') AS title,
array_to_string(string_split_regex(trim(coalesce(abstract_or_snippet, '')), '\\s+')[1:12], ' ') AS snippet FROM registered_sources""")
def paper_normalize(spark, d):
    """Sources with a key by precedence, a title and a short snippet."""
    r = table(spark, d, "registered_sources")
    return r.select("source_id", S.paper_key("doi", "url", "title").alias("paper_key"), S.or_sentinel("title").alias("title"), S.first_words("abstract_or_snippet", 12).alias("snippet")).distinct()


@query(f"""SELECT evidence_origin, {_slug("canonical_technology_name")} AS tech_slug, count(*) AS n FROM cementitious GROUP BY 1, 2""")
def slug_counts(spark, d):
    """Records per origin and technology slug."""
    return table(spark, d, "cementitious").groupBy("evidence_origin", S.slug("canonical_technology_name").alias("tech_slug")).agg(F.count("*").alias("n"))


@query("""SELECT event_type, (props->>'k')::INT AS k, count(*) AS n FROM events GROUP BY 1, 2""")
def json_field_counts(spark, d):
    """Events by a field of their JSON."""
    return table(spark, d, "events").groupBy("event_type", F.get_json_object("props", "$.k").cast("int").alias("k")).agg(F.count("*").alias("n"))


@query("""SELECT web_source_id, url FROM (SELECT DISTINCT web_source_id, url FROM web_stages) ORDER BY sha1('7:' || web_source_id), web_source_id LIMIT 100""")
def hash_sample(spark, d):
    """A sample of exactly 100 pages, the same each time (a sampling operator)."""
    return ranking.hash_sample(table(spark, d, "web_stages").select("web_source_id", "url").distinct(), "web_source_id", "7", 100)


@query(f"""WITH r AS (SELECT DISTINCT domain_host AS grp, web_source_id, authority_rank FROM web_stages), t AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY authority_rank NULLS FIRST, web_source_id) AS turn FROM r)
SELECT grp, web_source_id, turn::INT AS turn FROM t ORDER BY turn, grp NULLS FIRST LIMIT 500""")
def query_cap_round_robin(spark, d):
    """500 pages, one of each host before a second of any (a fair cap)."""
    r = table(spark, d, "web_stages").select(F.col("domain_host").alias("grp"), "web_source_id", "authority_rank").distinct()
    return ranking.round_robin_cap(r, "grp", [F.asc_nulls_first("authority_rank"), F.col("web_source_id")], 500).select("grp", "web_source_id", "turn")


@query(f"""WITH q(query_no, term) AS (VALUES (1, 'silica fume'), (2, 'kiln'), (3, 'emissions')), h AS (SELECT query_no, doc_id, (length(lower(coalesce(text, ''))) - length(replace(lower(coalesce(text, '')), term, ''))) // length(term) AS hits FROM q, documents),
k AS (SELECT * FROM h WHERE hits > 0 QUALIFY row_number() OVER (PARTITION BY query_no ORDER BY hits DESC, doc_id) <= 40)
SELECT doc_id, max(hits)::INT AS hits FROM k GROUP BY 1""")
def multi_query_topk(spark, d):
    """The 40 best documents of each query, the best score per document."""
    return lexicon.multi_query(table(spark, d, "documents"), "doc_id", "text", ["silica fume", "kiln", "emissions"], 40).select("doc_id", "hits")


@query(f"""SELECT record_id, (CASE WHEN contains(lower(coalesce(canonical_technology_name, '')), 'capture') THEN 10 ELSE 0 END + CASE WHEN contains(lower(coalesce(canonical_technology_name, '')), 'kiln') THEN 4 ELSE 0 END + CASE WHEN contains(lower(coalesce(company_or_organization, '')), 'carbon') THEN 6 ELSE 0 END + CASE WHEN contains(lower(coalesce(notes, '')), 'annex') THEN 4 ELSE 0 END)::INT AS score
FROM (SELECT DISTINCT record_id, canonical_technology_name, company_or_organization, notes FROM cementitious) WHERE score > 0""")
def field_search(spark, d):
    """Weighted search over fields."""
    terms = {"canonical_technology_name": [("capture", 10), ("kiln", 4)], "company_or_organization": [("carbon", 6)], "notes": [("annex", 4)]}
    c = table(spark, d, "cementitious").select("record_id", *terms).distinct()
    return lexicon.field_search(c, terms).select("record_id", F.col("score").cast("int").alias("score"))


@query(f"""SELECT category, evidence_origin, grouping(category, evidence_origin)::INT AS level, count(*) AS n FROM cementitious GROUP BY GROUPING SETS ((category, evidence_origin), (category), ())""")
def grouping_sets(spark, d):
    """Counts by category and origin, by category, and in all."""
    c = table(spark, d, "cementitious")
    return spark.sql("SELECT category, evidence_origin, CAST(grouping_id(category, evidence_origin) AS INT) AS level, count(*) AS n FROM {c} GROUP BY GROUPING SETS ((category, evidence_origin), (category), ())", c=c)


@query("""SELECT 'documents' AS origin, source AS place, count(*) AS n FROM documents GROUP BY source UNION ALL SELECT 'web_stages', domain_host, count(*) FROM web_stages GROUP BY domain_host""")
def union_origins(spark, d):
    """Rows of two origins under one schema, the origin stamped."""
    a = table(spark, d, "documents").groupBy(F.col("source").alias("place")).agg(F.count("*").alias("n")).withColumn("origin", F.lit("documents"))
    b = table(spark, d, "web_stages").groupBy(F.col("domain_host").alias("place")).agg(F.count("*").alias("n")).withColumn("origin", F.lit("web_stages"))
    return a.unionByName(b)


@query("""WITH a AS (SELECT DISTINCT paper_id FROM screening WHERE product_line = 'scm'), b AS (SELECT DISTINCT paper_id FROM screening WHERE product_line = 'cementitious'), x AS (SELECT paper_id, 1 AS bit FROM a UNION ALL SELECT paper_id, 2 FROM b)
SELECT CASE bit WHEN 1 THEN 'scm only' WHEN 2 THEN 'cementitious only' ELSE 'both' END AS side, count(*) AS n FROM (SELECT paper_id, sum(bit) AS bit FROM x GROUP BY 1) GROUP BY bit""")
def coverage_difference(spark, d):
    """Papers of one product line, the other, or both (set differences in one pass)."""
    s = table(spark, d, "screening").where("product_line IN ('scm', 'cementitious')").groupBy("paper_id").agg(F.bit_or(F.when(F.col("product_line") == "scm", 1).otherwise(2)).alias("bits"))
    return s.groupBy(F.when(F.col("bits") == 1, "scm only").when(F.col("bits") == 2, "cementitious only").otherwise("both").alias("side")).agg(F.count("*").alias("n"))


@query("""SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS n, sum(l_quantity::BIGINT)::BIGINT AS quantity, round(avg(l_discount), 6) AS avg_discount FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(spark, d):
    """A scan with pushed filters and a small aggregate."""
    li = table(spark, d, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return li.groupBy(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"), F.round(F.avg("l_discount"), 6).alias("avg_discount"))


@query("""SELECT n_name AS nation, p_type AS part_type, count(*) AS n_lines, count(DISTINCT o_orderkey) AS n_orders FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2""")
def project_technology_matrix(spark, d):
    """A star join: orders as projects, parts as technologies, suppliers as organisations."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    o, p = table(spark, d, "orders").select("o_orderkey"), table(spark, d, "part").select("p_partkey", "p_type")
    s, n = table(spark, d, "supplier").select("s_suppkey", "s_nationkey"), table(spark, d, "nation").select("n_nationkey", "n_name")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey)
    return j.groupBy(F.col("n_name").alias("nation"), F.col("p_type").alias("part_type")).agg(F.count("*").alias("n_lines"), F.countDistinct("o_orderkey").alias("n_orders"))
