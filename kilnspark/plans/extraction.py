"""Queries of extraction plug-ins and of small guards, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.text import known
from ..operators import extraction as X
from ..operators import ranking
from ..sources.tables import table
from .book import Book
from .reference import MISS, _known, _slug

book = Book()
query = book.query
QUERIES, SQL = book.queries, book.sql


def _percents(record: dict) -> list[dict]:
    """A deterministic extractor: shares named in a text; texts without any letter are an error."""
    import re

    t = record["evidence_text"] or ""
    if not re.search("[a-zA-Z]", t):
        raise ValueError("no text")
    return [{"share": m} for m in re.findall(r"([0-9]+) percent", t)]


@query("""WITH c AS (SELECT DISTINCT record_id, coalesce(evidence_text, '') AS t FROM cementitious), m AS (SELECT record_id, t, regexp_extract_all(t, '([0-9]+) percent', 1) AS s FROM c)
SELECT record_id, CASE WHEN len(s) > 0 THEN unnest(CASE WHEN len(s) > 0 THEN s ELSE [NULL] END) ELSE NULL END AS share, unnest(CASE WHEN len(s) > 0 THEN range(1, len(s) + 1) ELSE [0] END)::INT AS row_no, CASE WHEN NOT regexp_matches(t, '[a-zA-Z]') THEN 'ValueError: no text' END AS error FROM m""")
def extracted_rows(spark, d):
    """Rows made by a plug-in of each record; failures and empty results keep a row."""
    c = table(spark, d, "cementitious").select("record_id", "evidence_text").distinct()
    return X.extract(c, "record_id", _percents, "share string")


@query("""WITH c AS (SELECT DISTINCT record_id, coalesce(evidence_text, '') AS t FROM cementitious) SELECT record_id, length(t)::INT AS n_chars, ends_with(record_id, '3') AS from_cache FROM c""")
def cached_extraction(spark, d):
    """Results taken from a cache where they are there, built where they aren't."""
    c = table(spark, d, "cementitious").select("record_id", F.coalesce("evidence_text", F.lit("")).alias("t")).distinct()
    build = lambda x: x.select("cache_key", "record_id", F.length("t").alias("n_chars"))
    parts = [F.col("record_id"), F.lit("model-1"), F.lit("prompt-2")]
    cache = build(c.where(F.col("record_id").endswith("3")).withColumn("cache_key", F.sha2(F.concat_ws("|", *parts), 256)))
    return X.cached(c, parts, cache, build).drop("cache_key")


@query("""WITH cu AS (SELECT ref_id AS node, lower(canonical_name) AS term, 2.0 AS w FROM canonical_names UNION SELECT ref_id, lower(split_part(canonical_name, ' ', 1)), 2.0 FROM canonical_names WHERE length(split_part(canonical_name, ' ', 1)) > 3 UNION SELECT ref_id, 'school', -3.0 FROM canonical_names WHERE list_name = 'material'),
s AS (SELECT doc_id, node, sum(w) AS score FROM documents JOIN cu ON contains(lower(coalesce(text, '')), term) GROUP BY 1, 2) SELECT doc_id, node, score::DOUBLE AS score FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, node) = 1""")
def heuristic_classes(spark, d):
    """The node with most cues in each document, less its negative ones."""
    n = table(spark, d, "canonical_names")
    first = F.lower(F.substring_index("canonical_name", " ", 1))
    cues = n.select(F.col("ref_id").alias("node"), F.lower("canonical_name").alias("term")).union(n.where(F.length(first) > 3).select("ref_id", first)).distinct()
    return X.classify(table(spark, d, "documents"), "doc_id", "text", cues, n.where("list_name = 'material'").select(F.col("ref_id").alias("node"), F.lit("school").alias("term")))


@query(f"""WITH c AS (SELECT DISTINCT record_id, trim({_known("taxonomy_level_1")}) AS a, trim({_known("taxonomy_level_2")}) AS b, trim({_known("taxonomy_level_3")}) AS c FROM cementitious), p AS (SELECT record_id, list_distinct(list_filter([list_filter([a, b, c], lambda x: x IS NOT NULL), list_filter([a, b], lambda x: x IS NOT NULL), list_filter([a, b], lambda x: x IS NOT NULL)], lambda x: len(x) > 0)) AS ps FROM c)
SELECT record_id, unnest(list_sort(list_transform(ps, lambda x: array_to_string(x, ' > ')))) AS path FROM p""")
def answered_paths(spark, d):
    """Distinct label paths out of a model's answers in JSON."""
    lv = [F.coalesce(F.trim(known(f"taxonomy_level_{i}")), F.lit(" ")) for i in (1, 2, 3)]
    answer = F.to_json(F.struct(F.array(F.array(*lv), F.array(*lv[:2]), F.array(*lv[:2], F.lit(""))).alias("paths")))
    c = table(spark, d, "cementitious").select("record_id", answer.alias("j")).distinct()
    return c.select("record_id", F.explode(X.paths_of_answer(F.col("j"), 3)).alias("p")).select("record_id", F.array_join("p", " > ").alias("path"))


@query("""WITH c AS (SELECT DISTINCT company_id, name, company_role, associated_projects FROM company_intel) SELECT company_id, 1 AS record_no, unnest(CASE WHEN coalesce(len(associated_projects), 0) = 0 THEN [1] ELSE range(1, len(associated_projects) + 1) END)::INT AS item_no, unnest(CASE WHEN coalesce(len(associated_projects), 0) = 0 THEN [NULL] ELSE associated_projects END) AS project FROM c
UNION ALL SELECT company_id, 2, 1, company_role FROM c""")
def expanded_answers(spark, d):
    """Records in a model's answer and the items in each, numbered; records without items keep a row."""
    items = F.transform(F.coalesce("associated_projects", F.array().cast("array<string>")), lambda p: F.struct(p.alias("project")))
    answer = F.to_json(F.struct(F.array(F.struct(items.alias("items")), F.struct(F.array(F.struct(F.col("company_role").alias("project"))).alias("items"))).alias("records")))
    c = table(spark, d, "company_intel").select("company_id", "name", answer.alias("j")).distinct()
    return X.expand(c, ["company_id"], "j", "items", "project string")


@query(f"""SELECT DISTINCT canonical_technology_name AS name, CASE WHEN {_slug("canonical_technology_name")} = '' OR {_slug("canonical_technology_name")} IN ('con', 'nul') THEN '_unnamed' ELSE left({_slug("canonical_technology_name")}, 64) END || '.csv' AS file_name, coalesce(lower(trim(canonical_technology_name)), '') IN {MISS} AS missing FROM cementitious""")
def partition_names(spark, d):
    """Names that are safe as file names, and which are no names."""
    c = table(spark, d, "cementitious")
    return c.select(F.col("canonical_technology_name").alias("name"), S.safe_name("canonical_technology_name", ".csv").alias("file_name"), (~F.coalesce(~F.lower(F.trim("canonical_technology_name")).isin(*[m.strip("' ") for m in MISS.strip("()").split(",")]), F.lit(False))).alias("missing")).distinct()


_SORT = ("category", "subcategory", "taxonomy_level_1", "taxonomy_level_2", "taxonomy_level_3", "taxonomy_level_4", "canonical_technology_name", "company_or_organization", "project_year", "record_id")


@query(f"SELECT record_id, canonical_technology_name, project_year FROM (SELECT DISTINCT {', '.join(f"coalesce({c}, '') AS {c}" for c in _SORT)} FROM cementitious) ORDER BY {', '.join(_SORT)} LIMIT 1000")
def record_sort_topk(spark, d):
    """The first thousand records of a total order by ten keys (a top-k report)."""
    c = table(spark, d, "cementitious").select(*[F.coalesce(x, F.lit("")).alias(x) for x in _SORT]).distinct()
    return ranking.top_n(c, list(_SORT), 1000).select("record_id", "canonical_technology_name", "project_year")


@query("""SELECT source_id, title, kind, place FROM (SELECT source_id, coalesce(title, '') AS title, coalesce(source_type, '') AS kind, coalesce(doi, '') AS doi, row_number() OVER (ORDER BY coalesce(source_type, ''), coalesce(title, ''), coalesce(doi, ''), source_id) AS place FROM (SELECT DISTINCT source_id, title, source_type, doi FROM registered_sources)) WHERE place <= 500""")
def citation_sort_topk(spark, d):
    """The first five hundred citations in order of four keys, with their places (a top-k report)."""
    from pyspark.sql import Window as W

    order = ["kind", "title", "doi", "source_id"]
    c = table(spark, d, "registered_sources").select("source_id", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("source_type", F.lit("")).alias("kind"), F.coalesce("doi", F.lit("")).alias("doi")).distinct()
    return ranking.top_n(c, order, 500).withColumn("place", F.row_number().over(W.orderBy(*order)).cast("bigint")).select("source_id", "title", "kind", "place")


@query(r"""SELECT DISTINCT company_id, website_or_source AS url, CASE WHEN regexp_matches(trim(website_or_source), '(?i)^[a-z0-9-]+(?:\.[a-z0-9-]+)+(?:[/?#:].*)?$') OR regexp_matches(trim(website_or_source), '^[A-Za-z][A-Za-z0-9+.-]*://') THEN regexp_replace(lower(regexp_extract(regexp_replace(trim(website_or_source), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '^([^/?#:]+)', 1)), '^www\.', '') ELSE '' END AS host FROM company_intel WHERE website_or_source IS NOT NULL""")
def repaired_hosts(spark, d):
    """Hosts of URLs with and without a scheme."""
    return table(spark, d, "company_intel").where("website_or_source IS NOT NULL").select("company_id", F.col("website_or_source").alias("url"), S.any_host("website_or_source").alias("host")).distinct()


@query(f"""SELECT line, count(*) AS n, count(*) FILTER (category = 'Cementitious Materials') AS own FROM (SELECT 'cementitious' AS line, category FROM cementitious UNION ALL SELECT 'scm', CASE WHEN matched_seed_category = 'NA' THEN NULL ELSE matched_seed_category END FROM scm_discovery) GROUP BY 1""")
def isolated_lines(spark, d):
    """Product lines kept apart: rows of each and those that carry the other's category."""
    c = table(spark, d, "cementitious").select(F.lit("cementitious").alias("line"), "category")
    s = table(spark, d, "scm_discovery").select(F.lit("scm").alias("line"), F.when(F.col("matched_seed_category") != "NA", F.col("matched_seed_category")).alias("category"))
    return c.unionAll(s).groupBy("line").agg(F.count("*").alias("n"), F.count_if(F.col("category") == "Cementitious Materials").alias("own"))
