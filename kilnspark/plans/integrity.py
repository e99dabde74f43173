"""Queries of integrity checks, reports and merges, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.text import known, present
from ..operators import dedupe, integrity, merging, records
from ..sources.tables import table
from .book import Book
from .reference import _fold, _has, _known

book = Book()
query = book.query
QUERIES, SQL = book.queries, book.sql

_ROW = ("record_id", "category", "subcategory", "evidence_origin", "project_name")


@query(f"""WITH m AS (SELECT {", ".join(_ROW)}, count(*) AS n FROM cementitious GROUP BY ALL), p AS (SELECT {", ".join(_ROW)}, count(*) AS n FROM (SELECT DISTINCT {", ".join(_ROW)} FROM cementitious WHERE evidence_origin = 'Web' UNION ALL SELECT {", ".join(_ROW)} FROM cementitious WHERE evidence_origin <> 'Web' AND coalesce(taxonomy_level_1, '') <> 'L1-03') GROUP BY ALL),
x AS (SELECT {", ".join(_ROW)}, n AS a, 0 AS b FROM m UNION ALL SELECT {", ".join(_ROW)}, 0, n FROM p) SELECT {", ".join(_ROW)}, sum(a)::BIGINT AS in_first, sum(b)::BIGINT AS in_second FROM x GROUP BY {", ".join(_ROW)} HAVING sum(a) <> sum(b)""")
def partition_multisets(spark, d):
    """Rows whose number differs between a table and an export that drops repeats on the web side and lacks one branch on the other."""
    c = table(spark, d, "cementitious")
    parts = c.where("evidence_origin = 'Web'").select(*_ROW).distinct().unionAll(c.where(F.col("evidence_origin") != "Web").where(F.coalesce("taxonomy_level_1", F.lit("")) != "L1-03").select(*_ROW))
    return integrity.multiset_difference(c, parts, _ROW)


@query("""SELECT DISTINCT web_source_id, lower(domain_host) AS part, regexp_replace(lower(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1)), '^w+\\.s', 's') AS own FROM web_stages WHERE url IS NOT NULL AND part IS DISTINCT FROM own""")
def leaked_pages(spark, d):
    """Pages filed under another host than their URL's (www. is dropped for hosts of one letter only)."""
    w = table(spark, d, "web_stages").where("url IS NOT NULL")
    own = F.regexp_replace(F.lower(F.regexp_extract(F.trim("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)), r"^w+\.s", "s")
    return integrity.leaked(w, "web_source_id", F.lower("domain_host"), own)


@query("SELECT source_id, count(DISTINCT source_type) AS parts FROM scm_discovery WHERE source_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT source_type) > 1")
def ids_in_several_parts(spark, d):
    """Sources filed under several types."""
    return integrity.in_several(table(spark, d, "scm_discovery"), "source_id", "source_type")


@query("""SELECT 'no record' AS side, paper_id AS key FROM (SELECT DISTINCT paper_id FROM screening WHERE paper_id IS NOT NULL EXCEPT SELECT source_id FROM cementitious) UNION ALL SELECT 'no screening', source_id FROM (SELECT DISTINCT source_id FROM cementitious WHERE source_id IS NOT NULL EXCEPT SELECT paper_id FROM screening)""")
def citation_alignment(spark, d):
    """Records without citation and citations without record, both ways."""
    return integrity.both_ways(table(spark, d, "screening"), "paper_id", table(spark, d, "cementitious"), "source_id", "no record", "no screening")


_CHECKS = {
    "record id missing": ("cementitious", "NOT " + _has("record_id")), "origin unknown": ("cementitious", "NOT (evidence_origin IN ('Web', 'Literature'))"), "confidence off scale": ("screening", "confidence < 0 OR confidence > 1"),
    "host missing": ("web_stages", "NOT " + _has("domain_host")), "authors missing": ("registered_sources", "coalesce(len(authors), 0) = 0"), "level without parent": ("cementitious", _has("taxonomy_level_4") + " AND NOT " + _has("taxonomy_level_3")),
}


@query(" UNION ALL ".join(f"SELECT '{n}' AS check_name, CASE WHEN count(*) FILTER ({c}) = 0 THEN 'pass' ELSE 'fail' END AS status, count(*) FILTER ({c}) AS failed FROM {t}" for n, (t, c) in _CHECKS.items()))
def named_checks(spark, d):
    """Named checks with status and the number of rows that fail."""
    t = lambda x: table(spark, d, x)
    return integrity.checks({
        "record id missing": (t("cementitious"), ~present("record_id")), "origin unknown": (t("cementitious"), ~F.col("evidence_origin").isin("Web", "Literature")), "confidence off scale": (t("screening"), (F.col("confidence") < 0) | (F.col("confidence") > 1)),
        "host missing": (t("web_stages"), ~present("domain_host")), "authors missing": (t("registered_sources"), F.coalesce(F.size("authors"), F.lit(0)) <= 0), "level without parent": (t("cementitious"), present("taxonomy_level_4") & ~present("taxonomy_level_3")),
    })


@query(f"""WITH a AS (SELECT count(*)::VARCHAR AS r, count(DISTINCT record_id)::VARCHAR AS d1, count(DISTINCT source_id)::VARCHAR AS d2, count(*) FILTER ({_has("project_name")})::VARCHAR AS f1, min(export_batch) AS l1, max(export_batch) AS g1 FROM cementitious)
SELECT 'rows' AS name, r AS value FROM a UNION ALL SELECT 'distinct record_id', d1 FROM a UNION ALL SELECT 'distinct source_id', d2 FROM a UNION ALL SELECT 'filled project_name', f1 FROM a UNION ALL SELECT 'least export_batch', l1 FROM a UNION ALL SELECT 'greatest export_batch', g1 FROM a""")
def run_manifest(spark, d):
    """A manifest of the records: rows, distinct ids, filled fields, first and last batch."""
    return integrity.manifest(table(spark, d, "cementitious"), ["record_id", "source_id"], ["project_name"], ["export_batch"])


_GROUPS = {"country": _known("country"), "stage": f"lower({_known('deployment_stage')})", "origin": "evidence_origin", "leaf": f"coalesce({_known('subcategory')}, 'none')", "year": _known("project_year")}


@query(" UNION ALL ".join(f"SELECT '{n}' AS grouping, {x}::VARCHAR AS value, count(*) AS n FROM cementitious GROUP BY ALL" for n, x in _GROUPS.items()))
def review_counts(spark, d):
    """Counts by five groupings with their missing keys, from one pass."""
    g = {"country": known("country"), "stage": F.lower(known("deployment_stage")), "origin": F.col("evidence_origin"), "leaf": F.coalesce(known("subcategory"), F.lit("none")), "year": known("project_year")}
    return integrity.counts_by(table(spark, d, "cementitious"), g)


@query(f"""SELECT coalesce({_known("taxonomy_level_1")}, 'N.A.') AS part, count(*) AS n_rows, count(*) FILTER (evidence_origin = 'Web') AS web, count(*) FILTER (evidence_origin = 'Literature') AS literature, count(*) FILTER ({_has("project_name")}) AS projects, count(*) FILTER ({_has("co2_reduction_value")}) AS with_reduction,
count(*) FILTER ({_has("compressive_strength_value")}) AS with_strength, count(*) FILTER (lower(extraction_confidence) = 'low') AS low_confidence, count(*) FILTER (lower(duplicate_status) LIKE '%duplicate%') AS duplicates, count(*) FILTER (NOT {_has("evidence_text")}) AS no_evidence,
count(DISTINCT source_id) AS sources, count(DISTINCT coalesce({_known("source_url")}, {_known("doi")})) AS links, count(DISTINCT lower({_known("company_or_organization")})) AS companies, count(DISTINCT {_known("project_year")}) AS years FROM cementitious GROUP BY 1""")
def partition_profile(spark, d):
    """Thirteen counts per branch: rows by condition and distinct values."""
    c = table(spark, d, "cementitious").withColumn("part", F.coalesce(known("taxonomy_level_1"), F.lit("N.A.")))
    flags = {
        "web": F.col("evidence_origin") == "Web", "literature": F.col("evidence_origin") == "Literature", "projects": present("project_name"), "with_reduction": present("co2_reduction_value"), "with_strength": present("compressive_strength_value"),
        "low_confidence": F.lower("extraction_confidence") == "low", "duplicates": F.lower("duplicate_status").contains("duplicate"), "no_evidence": ~present("evidence_text"),
    }
    return integrity.profile(c, ["part"], flags, {"sources": F.col("source_id"), "links": F.coalesce(known("source_url"), known("doi")), "companies": F.lower(known("company_or_organization")), "years": known("project_year")})


_NODE = f"nd AS (SELECT DISTINCT {_fold('canonical_name')} AS node FROM canonical_names WHERE list_name = 'technology')"
_T = _fold("canonical_technology_name")


@query(f"""WITH {_NODE}, l AS (SELECT {_T} AS node, count(*) AS n FROM cementitious WHERE evidence_origin = 'Literature' GROUP BY 1), w AS (SELECT {_T} AS node, count(*) AS n, count(DISTINCT source_url) AS u FROM cementitious WHERE evidence_origin = 'Web' GROUP BY 1), p AS (SELECT {_T} AS node, count(DISTINCT project_name) AS n FROM cementitious GROUP BY 1),
m AS (SELECT {_fold("technology_name")} AS node, count(*) AS n FROM metric_intel GROUP BY 1), c AS (SELECT {_fold("associated_technology")} AS node, count(*) AS n FROM company_intel GROUP BY 1)
SELECT nd.node, coalesce(l.n, 0) AS literature, coalesce(w.n, 0) AS web, coalesce(u, 0) AS urls, coalesce(p.n, 0) AS projects, coalesce(m.n, 0) AS metrics, coalesce(c.n, 0) AS companies, coalesce(l.n, 0) + coalesce(w.n, 0) + coalesce(u, 0) + coalesce(p.n, 0) + coalesce(m.n, 0) + coalesce(c.n, 0) = 0 AS uncovered
FROM nd LEFT JOIN l USING (node) LEFT JOIN w USING (node) LEFT JOIN p USING (node) LEFT JOIN m USING (node) LEFT JOIN c USING (node)""")
def six_fact_coverage(spark, d):
    """Technologies with six counted facts, zeros kept and flagged."""
    c = table(spark, d, "cementitious")
    tech, n = S.key_fold("canonical_technology_name"), F.count("*")
    nodes = table(spark, d, "canonical_names").where("list_name = 'technology'").select(S.key_fold("canonical_name").alias("node")).distinct()
    web = c.where("evidence_origin = 'Web'")
    return integrity.coverage(nodes, "node", {
        "literature": (c.where("evidence_origin = 'Literature'"), tech, n), "web": (web, tech, n), "urls": (web, tech, F.countDistinct("source_url")), "projects": (c, tech, F.countDistinct("project_name")),
        "metrics": (table(spark, d, "metric_intel"), S.key_fold("technology_name"), n), "companies": (table(spark, d, "company_intel"), S.key_fold("associated_technology"), n),
    })


@query(f"""WITH l AS (SELECT trim({_known("taxonomy_level_1")}) AS branch, trim({_known("taxonomy_level_4")}) AS leaf, count(*) FILTER (evidence_origin = 'Literature' AND extraction_confidence = 'High') AS a, count(*) FILTER (evidence_origin = 'Web' AND extraction_confidence = 'High') AS b FROM cementitious WHERE {_has("taxonomy_level_1")} AND {_has("taxonomy_level_4")} GROUP BY 1, 2)
SELECT branch, count(*) FILTER (a > 0 AND b = 0) AS first_only, count(*) FILTER (b > 0 AND a = 0) AS second_only, count(*) FILTER (a > 0 AND b > 0) AS both, count(*) FILTER (a = 0 AND b = 0) AS none, count(*) AS leaves, count(*) FILTER (a = 0 AND b = 0) > 0.2 * count(*) AS warn FROM l GROUP BY 1""")
def coverage_buckets(spark, d):
    """Leaves of each branch with sure evidence of literature, of the web, of both or none; a warning above a fifth without."""
    c = table(spark, d, "cementitious").where(known("taxonomy_level_1").isNotNull() & known("taxonomy_level_4").isNotNull())
    sure = F.col("extraction_confidence") == "High"
    leaves = c.groupBy(F.trim("taxonomy_level_1").alias("branch"), F.trim("taxonomy_level_4").alias("leaf")).agg(F.count_if((F.col("evidence_origin") == "Literature") & sure).alias("a"), F.count_if((F.col("evidence_origin") == "Web") & sure).alias("b"))
    return integrity.buckets(leaves, ["branch"], "a", "b")


@query("""SELECT 'host' AS grouping, lower(domain_host) AS value, count(*) AS n FROM web_stages GROUP BY ALL UNION ALL SELECT 'type', source_type, count(*) FROM web_stages GROUP BY ALL UNION ALL SELECT 'content', content_source, count(*) FROM web_stages GROUP BY ALL UNION ALL SELECT 'rank', authority_rank::VARCHAR, count(*) FROM web_stages GROUP BY ALL""")
def search_summary(spark, d):
    """Histograms of pages by host, type, content source and rank."""
    return integrity.counts_by(table(spark, d, "web_stages"), {"host": F.lower("domain_host"), "type": F.col("source_type"), "content": F.col("content_source"), "rank": F.col("authority_rank")})


_WANTED = ("click", "view", "purchase", "export", "merge")


@query(f"""WITH w AS (SELECT unnest({list(_WANTED)}) AS event_type) SELECT event_type, 'missing' AS problem FROM w WHERE event_type NOT IN (SELECT event_type FROM events) UNION ALL SELECT DISTINCT event_type, 'value below zero' FROM events WHERE value < 0 UNION ALL SELECT DISTINCT event_type, 'value above 400' FROM events WHERE value > 400 UNION ALL SELECT DISTINCT event_type, 'no value' FROM events WHERE value IS NULL""")
def required_stages(spark, d):
    """Stages that must be there and aren't, and stages whose rows break a rule."""
    v = F.col("value")
    return integrity.required(table(spark, d, "events"), "event_type", _WANTED, {"value below zero": v < 0, "value above 400": v > 400, "no value": v.isNull()})


@query(f"""WITH x AS (SELECT product_line, count(*) FILTER (is_relevant) AS relevant, count(*) AS rows FROM screening GROUP BY 1), w AS (SELECT DISTINCT product_line, trim(reason) AS w FROM screening WHERE {_has("reason")}), r AS (SELECT *, row_number() OVER (PARTITION BY product_line ORDER BY w) AS rn FROM w)
SELECT product_line, relevant::BIGINT AS relevant, rows::BIGINT AS n_rows, (SELECT count(*) FROM w WHERE w.product_line = x.product_line) AS n_warnings, coalesce((SELECT string_agg(w, ' | ' ORDER BY w) FROM r WHERE rn <= 20 AND r.product_line = x.product_line), '') AS warnings FROM x""")
def merged_counters(spark, d):
    """Counters summed and remarks gathered per product line."""
    s = table(spark, d, "screening").select("product_line", F.col("is_relevant").cast("int").alias("relevant"), F.lit(1).alias("n_rows"), "reason")
    return integrity.merge_counters(s, ["product_line"], ["relevant", "n_rows"], "reason", 20)


@query("""WITH m AS (SELECT (min(shard_id) + max(shard_id)) // 2 AS mid FROM screening), p AS (SELECT DISTINCT shard_id FROM screening), h AS (SELECT s.* FROM screening s, m WHERE shard_id <= mid)
SELECT 'rows' AS name, count(*) AS n FROM h UNION ALL SELECT 'relevant', count(*) FILTER (is_relevant) FROM h UNION ALL SELECT 'without confidence', count(*) FILTER (confidence IS NULL) FROM h UNION ALL SELECT 'screening_id twice', count(*) FROM (SELECT screening_id FROM h WHERE screening_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'shards missing', count(*) FROM p WHERE shard_id NOT IN (SELECT shard_id FROM h WHERE shard_id IS NOT NULL)""")
def merged_shards(spark, d):
    """What a merge must know of a half-done screening: rows, states, ids twice, shards still missing."""
    s = table(spark, d, "screening")
    mid = s.agg(F.expr("(min(shard_id) + max(shard_id)) div 2").alias("mid"))
    done = s.join(F.broadcast(mid), s.shard_id <= F.col("mid"), "left_semi")  # one row on the right
    return integrity.merge_shards(done, "shard_id", ["screening_id"], s.where("shard_id IS NOT NULL").select("shard_id"), {"relevant": F.col("is_relevant"), "without confidence": F.col("confidence").isNull()})


_CF = ("study_type", "functional_unit", "curing_conditions", "journal_or_site")


@query(f"""WITH r AS (SELECT record_id, lower(trim(coalesce(any_value(project), ''))) AS k0, lower(trim(coalesce(any_value(company), ''))) AS k1, lower(trim(coalesce(any_value(y), ''))) AS c0, lower(trim(coalesce(any_value(c), ''))) AS c1, lower(trim(coalesce(any_value(s), ''))) AS c2, {", ".join(f"trim(any_value({f})) AS {f}" for f in _CF)}
FROM (SELECT record_id, min({_known("project_name")}) AS project, min({_known("company_or_organization")}) AS company, min({_known("project_year")}) AS y, min({_known("country")}) AS c, min({_known("deployment_stage")}) AS s, {", ".join(f"min({_known(f)}) AS {f}" for f in _CF)} FROM cementitious GROUP BY 1) GROUP BY 1),
p AS (SELECT a.record_id, {", ".join(f"arg_min(b.{f}, b.record_id) FILTER (b.{f} IS NOT NULL) AS g_{f}" for f in _CF)} FROM r a JOIN r b ON a.k0 <> '' AND a.k0 = b.k0 AND a.k1 = b.k1 AND (a.c0 = '' OR b.c0 = '' OR a.c0 = b.c0) AND (a.c1 = '' OR b.c1 = '' OR a.c1 = b.c1) AND (a.c2 = '' OR b.c2 = '' OR a.c2 = b.c2) WHERE a.record_id <> b.record_id GROUP BY 1)
SELECT r.record_id, {", ".join(f"coalesce(r.{f}, g_{f}) AS {f}" for f in _CF)}, ({" + ".join(f"(r.{f} IS NULL AND g_{f} IS NOT NULL)::INT" for f in _CF)})::INT AS filled FROM r LEFT JOIN p USING (record_id)""")
def compatible_fill(spark, d):
    """Gaps filled from records of the same project and company that contradict neither year, country nor stage."""
    c = table(spark, d, "cementitious").groupBy("record_id").agg(*[F.min(known(x)).alias(x) for x in ("project_name", "company_or_organization", "project_year", "country", "deployment_stage", *_CF)])
    return merging.compatible_fill(c.withColumn("o", F.col("record_id")), ["project_name", "company_or_organization"], ["project_year", "country", "deployment_stage"], list(_CF), "o", "record_id")


_DONE = ("company_or_organization", "project_name", "deployment_stage", "country", "project_year", "study_type", "journal_or_site", "doi", "functional_unit", "curing_conditions", "processing_methods", "alternative_classification", "notes")


@query(f"""SELECT DISTINCT record_id, array_to_string(list_filter([{", ".join(f"CASE WHEN NOT {_has(f)} THEN '{f}' END" for f in _DONE)}], lambda x: x IS NOT NULL), ',') AS missing_fields, round(({" + ".join(f"{_has(f)}::INT" for f in _DONE)}) / 13.0, 4)::DOUBLE AS coverage_score, sha256(concat_ws('|', lower(coalesce(trim(canonical_technology_name), '')), lower(coalesce(trim(company_or_organization), ''))))[1:16] AS identity FROM cementitious""")
def finished_records(spark, d):
    """Records with what they lack, how complete they are, and an identity."""
    c = records.completeness(table(spark, d, "cementitious"), _DONE)
    return records.record_identity(c, ["canonical_technology_name", "company_or_organization"]).select("record_id", F.array_join("missing_fields", ",").alias("missing_fields"), "coverage_score", "identity").distinct()


@query("""WITH r AS (SELECT DISTINCT company_id, name, associated_technology, associated_projects FROM company_intel), u AS (SELECT associated_technology AS technology, company_id, unnest(associated_projects) AS p, unnest(range(0, len(associated_projects))) AS i FROM r WHERE associated_technology IS NOT NULL),
f AS (SELECT technology, trim(p) AS value, company_id, i FROM u WHERE trim(p) <> '' QUALIFY row_number() OVER (PARTITION BY technology, lower(trim(p)) ORDER BY company_id, i, trim(p)) = 1)
SELECT technology, (row_number() OVER (PARTITION BY technology ORDER BY company_id, i, value) - 1)::INT AS position, value FROM f""")
def united_lists(spark, d):
    """Project lists of all companies of a technology in one list without repeats, in order of first sight."""
    c = table(spark, d, "company_intel").where("associated_technology IS NOT NULL").select(F.col("associated_technology").alias("technology"), "company_id", "associated_projects").distinct()
    return records.union_in_order(c, "technology", "associated_projects", "company_id")


@query("""WITH r AS (SELECT DISTINCT company_id, associated_technology, associated_projects, company_role FROM company_intel WHERE associated_technology IS NOT NULL), u AS (SELECT associated_technology AS technology, company_id, company_role, unnest(associated_projects) AS p, unnest(range(0, len(associated_projects))) AS i FROM r),
f AS (SELECT technology, p, company_role, company_id, i FROM u WHERE trim(p) <> '' QUALIFY row_number() OVER (PARTITION BY technology, lower(trim(p)) ORDER BY company_id, i, p) = 1)
SELECT technology, (row_number() OVER (PARTITION BY technology ORDER BY company_id, i) - 1)::INT AS position, p AS name, company_role AS role FROM f""")
def united_items(spark, d):
    """Lists of named items united by name, the first of each kept."""
    c = table(spark, d, "company_intel").where("associated_technology IS NOT NULL").select(F.col("associated_technology").alias("technology"), "company_id", F.transform("associated_projects", lambda p: F.struct(p.alias("name"), F.col("company_role").alias("role"))).alias("items")).distinct()
    return records.union_of_items(c, "technology", "items", "name", "company_id").select("technology", "position", "item.name", "item.role")


@query("""SELECT project, coalesce(CASE max(CASE conf WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 WHEN 'Low' THEN 1 END) WHEN 3 THEN 'High' WHEN 2 THEN 'Medium' WHEN 1 THEN 'Low' END, 'Not Reported') AS confidence FROM (SELECT """ + _fold("project_name") + " AS project, extraction_confidence AS conf FROM cementitious WHERE " + _has("project_name") + ") GROUP BY 1")
def best_confidence(spark, d):
    """The surest confidence of each project's records."""
    c = table(spark, d, "cementitious").where(present("project_name")).select(S.key_fold("project_name").alias("project"), F.col("extraction_confidence").alias("confidence"))
    return records.best_label(c, "project", "confidence", {"High": 3, "Medium": 2, "Low": 1})


_FF = ("country", "company_or_organization", "project_year", "deployment_stage")


@query(f"""WITH r AS (SELECT record_id, min({_fold("project_name")}) AS k, {", ".join(f"min(trim({_known(f)})) AS {f}" for f in _FF)} FROM cementitious WHERE {_has("project_name")} GROUP BY 1), b AS (SELECT k, min(record_id) AS base FROM r GROUP BY 1),
l AS (SELECT k, record_id, base, field, value FROM (SELECT r.*, base FROM r JOIN b USING (k)) UNPIVOT (value FOR field IN ({", ".join(_FF)}))), v AS (SELECT k, field, value, min(record_id) AS seen, count(*) FILTER (record_id <> base) AS votes, min(record_id) FILTER (record_id <> base) AS voted FROM l GROUP BY 1, 2, 3),
g AS (SELECT k, field, arg_min(value, seen || value) AS kept, arg_min(votes, seen || value) AS kv, arg_min(value, lpad((1000000 - votes)::VARCHAR, 8, '0') || coalesce(voted, '')) FILTER (votes > 0) AS top, count(*) FILTER (votes > 0) AS options, sum(votes) AS al FROM v GROUP BY 1, 2)
SELECT k AS project, field, CASE WHEN options > 1 AND top <> kept THEN top ELSE kept END AS value, options > 1 AND top <> kept AS promoted, kv AS sources, (al - kv)::BIGINT AS conflicts FROM g""")
def folded_records(spark, d):
    """What a fold over a project's records gives per field: the first value, or what most later records agree on; with conflicts."""
    c = table(spark, d, "cementitious").where(present("project_name")).groupBy("record_id").agg(F.min(S.key_fold("project_name")).alias("project"), *[F.min(F.trim(known(f))).alias(f) for f in _FF])
    return records.fold(c.withColumn("source", F.col("record_id")), "project", _FF, "record_id", "source").select("project", "field", F.coalesce("value", F.lit(None).cast("string")).alias("value"), F.coalesce("promoted", F.lit(False)).alias("promoted"), "sources", "conflicts")


@query(f"""SELECT DISTINCT company, project, technology FROM (SELECT coalesce(trim({_known("company_or_organization")}), 'N.A.') AS company, coalesce(trim({_known("project_name")}), 'N.A.') AS project, coalesce(trim({_known("canonical_technology_name")}), trim({_known("raw_technology_name")}), 'N.A.') AS technology FROM cementitious WHERE {_has("company_or_organization")} OR {_has("project_name")})""")
def search_seeds(spark, d):
    """Distinct seeds of searches: company, project and technology, where one of the first two is known."""
    c = table(spark, d, "cementitious").where(present("company_or_organization") | present("project_name"))
    names = {"company": ["company_or_organization"], "project": ["project_name"], "technology": ["canonical_technology_name", "raw_technology_name"]}
    return records.map_columns(c, [], names).select(*[F.coalesce(n, F.lit("N.A.")).alias(n) for n in names]).distinct()


@query("""WITH f AS (SELECT web_source_id, lower(url) AS k, authority_rank FROM (SELECT DISTINCT web_source_id, url, authority_rank FROM web_stages WHERE coalesce(url, '') <> '') QUALIFY row_number() OVER (PARTITION BY lower(url) ORDER BY authority_rank NULLS LAST, web_source_id) = 1) SELECT web_source_id, authority_rank FROM f ORDER BY authority_rank NULLS LAST, web_source_id LIMIT 250""")
def capped_sources(spark, d):
    """The first page of each URL in order of authority, 250 in all (a cap that is the feature)."""
    w = table(spark, d, "web_stages").select("web_source_id", "url", "authority_rank").distinct()
    return dedupe.ordered_distinct(w, F.lower("url"), [F.asc_nulls_last("authority_rank"), F.col("web_source_id")], 250).select("web_source_id", "authority_rank")


@query(f"""WITH r AS (SELECT DISTINCT duplicate_group_id AS g, record_id FROM cementitious) SELECT g, record_id FROM r WHERE {_has("g")} QUALIFY row_number() OVER (PARTITION BY g ORDER BY record_id) = 1 UNION ALL SELECT g, record_id FROM r WHERE NOT {_has("g")}""")
def first_of_pending(spark, d):
    """The first record of each pending id; records without one all stay."""
    c = table(spark, d, "cementitious").select(F.col("duplicate_group_id").alias("g"), "record_id").distinct()
    return dedupe.keep_blank_ids(c, "g", [F.col("record_id")])
