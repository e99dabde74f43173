"""Queries of composed flows: lookups with what they miss, slices of ranked lists, re-ranked hits, candidates as documents; and SQL."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.text import known, present
from ..operators import assignment, payloads, ranking, taxonomy
from ..sources.tables import table
from .book import Book
from .reference import _fold, _has, _known, _slug

book = Book()
query = book.query
QUERIES, SQL = book.queries, book.sql


@query("""WITH w AS (SELECT DISTINCT record_id FROM cementitious WHERE record_id LIKE '%00' UNION ALL SELECT 'cm_none') SELECT w.record_id, any_value(c.source_title) AS title, any_value(c.record_id) IS NULL AS lost FROM w LEFT JOIN (SELECT record_id, min(source_title) AS source_title FROM cementitious GROUP BY 1) c USING (record_id) GROUP BY 1""")
def point_lookups(spark, d):
    """Records by a list of ids, with the ids that aren't there."""
    c = table(spark, d, "cementitious")
    ids = c.where(F.col("record_id").endswith("00")).select("record_id").distinct().unionAll(spark.createDataFrame([("cm_none",)], "record_id string"))
    return payloads.planned(ids, c.groupBy("record_id").agg(F.min("source_title").alias("title")), "record_id")


_P = f"{_slug(_known('taxonomy_level_1'))} || '/' || {_slug(_known('taxonomy_level_2'))}"


@query(f"""WITH r AS (SELECT DISTINCT record_id, {_P} AS path FROM cementitious WHERE {_has("taxonomy_level_1")} AND {_has("taxonomy_level_2")}), n AS (SELECT unnest(['l1_01', 'l1_02/l2_05', 'l1_0']) AS node) SELECT node, count(record_id) AS n FROM n LEFT JOIN r ON path = node OR starts_with(path, node || '/') GROUP BY 1""")
def rows_below_nodes(spark, d):
    """Rows on or below given nodes; a node's name that only begins like another's matches nothing."""
    c = table(spark, d, "cementitious").where(present("taxonomy_level_1") & present("taxonomy_level_2")).select("record_id", taxonomy.path_of(["taxonomy_level_1", "taxonomy_level_2"]).alias("path")).distinct()
    below = c.select("record_id", F.explode(taxonomy.ancestors(F.col("path"))).alias("node"))
    nodes = spark.createDataFrame([("l1_01",), ("l1_02/l2_05",), ("l1_0",)], "node string")
    return taxonomy.with_zero_nodes(nodes, below.groupBy("node").agg(F.count("*").alias("n")), "node", "n")


@query(f"""WITH q AS (SELECT domain_host AS node, web_source_id AS query_id, page_title AS text FROM (SELECT DISTINCT domain_host, web_source_id, page_title FROM web_stages WHERE domain_host IS NOT NULL)), f AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY node ORDER BY query_id, text) = 1),
r AS (SELECT DISTINCT source_id, regexp_replace(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1)), '^www\\.', '') AS node FROM registered_sources) SELECT source_id, coalesce(f.query_id, 'none') AS query_id FROM r LEFT JOIN f USING (node)""")
def first_query_lookup(spark, d):
    """The first query of each node, looked up for sources, with a fallback."""
    q = table(spark, d, "web_stages").where("domain_host IS NOT NULL").select(F.col("domain_host").alias("node"), F.col("web_source_id").alias("query_id"), F.col("page_title").alias("text")).distinct()
    first = ranking.best_per_key(q, ["node"], [F.col("query_id"), F.col("text")]).select("node", "query_id")
    r = table(spark, d, "registered_sources").select("source_id", S.host_of(F.coalesce("url", F.lit(""))).alias("node")).distinct()
    return r.join(first, "node", "left").select("source_id", F.coalesce("query_id", F.lit("none")).alias("query_id"))


@query("""WITH a AS (SELECT DISTINCT corpus_index, paper_id, title, screening_score FROM screening WHERE screening_score IS NOT NULL), b AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY screening_score DESC, corpus_index, title) = 1), r AS (SELECT *, row_number() OVER (ORDER BY screening_score DESC, paper_id)::INT AS place FROM b),
t AS (SELECT source_id AS paper_id, count(*) AS records, min(evidence_text) AS evidence FROM cementitious GROUP BY 1) SELECT r.paper_id, place, coalesce(records, 0) AS records, evidence FROM r LEFT JOIN t USING (paper_id) WHERE place BETWEEN 101 AND 300""")
def batch_slice(spark, d):
    """A slice of a ranked list by place, wide text joined to it late (places 101 to 300 of a ranked list)."""
    a = table(spark, d, "screening").where("screening_score IS NOT NULL").select("corpus_index", "paper_id", "title", "screening_score").distinct()
    best = ranking.best_per_key(a, ["paper_id"], [F.desc("screening_score"), F.col("corpus_index"), F.asc_nulls_last("title")])
    top = ranking.top_n(best.select("paper_id", "screening_score"), [F.desc("screening_score"), F.col("paper_id")], 300)
    placed = top.withColumn("place", F.row_number().over(W.orderBy(F.desc("screening_score"), "paper_id"))).where("place > 100")
    t = table(spark, d, "cementitious").groupBy(F.col("source_id").alias("paper_id")).agg(F.count("*").alias("records"), F.min("evidence_text").alias("evidence"))
    return placed.join(t, "paper_id", "left").select("paper_id", "place", F.coalesce("records", F.lit(0).cast("bigint")).alias("records"), "evidence")


@query(r"""WITH w AS (SELECT DISTINCT web_source_id, url, page_title FROM web_stages), s AS (SELECT web_source_id, (CASE WHEN regexp_matches(lower(url), '^https?://(www\.)?styfomyne\.') THEN 3.0 WHEN lower(url) LIKE '%/p/%' THEN 1.0 ELSE 0.0 END + CASE WHEN contains(lower(page_title), 'fly ash') THEN 2.0 ELSE 0.0 END + CASE WHEN contains(lower(page_title), 'slag') THEN 1.5 ELSE 0.0 END)::DOUBLE AS score FROM w)
SELECT web_source_id, coalesce(score, 0.0)::DOUBLE AS score, place FROM (SELECT *, row_number() OVER (ORDER BY coalesce(score, 0.0) DESC, web_source_id)::INT AS place FROM s) WHERE place <= 150""")
def reranked_hits(spark, d):
    """Search hits ranked again by host and words in the title (the best 150, a top-k report)."""
    u, t = F.lower("url"), F.lower("page_title")
    score = F.when(u.rlike(r"^https?://(www\.)?styfomyne\."), 3.0).when(u.contains("/p/"), 1.0).otherwise(0.0) + F.when(t.contains("fly ash"), 2.0).otherwise(0.0) + F.when(t.contains("slag"), 1.5).otherwise(0.0)
    s = table(spark, d, "web_stages").select("web_source_id", "url", "page_title").distinct().select("web_source_id", score.alias("score"))
    order = [F.desc("score"), F.col("web_source_id")]
    return ranking.top_n(s, order, 150).withColumn("place", F.row_number().over(W.orderBy(*order)))


@query(f"""WITH s AS (SELECT {_fold("coalesce(" + _known("proposed_canonical_name") + ", raw_material_name)")} AS k, raw_material_name AS alias, source_id, source_type, raw_material_family AS fam FROM scm_discovery WHERE {_has("raw_material_name")}),
g AS (SELECT k, count(*) AS n, count(DISTINCT source_id) AS sources, count(DISTINCT CASE WHEN lower(source_type) IN ('web', 'internet', 'website') THEN source_id END) AS web FROM s GROUP BY 1), a AS (SELECT k, alias, count(*) AS c FROM s GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, alias) <= 10), al AS (SELECT k, to_json(list(alias ORDER BY c DESC, alias))::VARCHAR AS aliases FROM a GROUP BY 1),
f AS (SELECT k, arg_min(fam, lpad((1000000 - c)::VARCHAR, 9, '0') || fam) AS family FROM (SELECT k, fam, count(*) AS c FROM s WHERE {_has("fam")} GROUP BY 1, 2) GROUP BY 1) SELECT g.k AS name_key, n, sources, web, sources - web AS literature, aliases, coalesce(family, 'ungrouped') AS family FROM g JOIN al USING (k) LEFT JOIN f USING (k)""")
def discovered_categories(spark, d):
    """Names normalised, aggregated and grouped: counts by origin, the ten most frequent spellings as JSON, the most frequent family."""
    s = table(spark, d, "scm_discovery").where(present("raw_material_name")).select(S.key_fold(F.coalesce(known("proposed_canonical_name"), "raw_material_name")).alias("name_key"), F.col("raw_material_name").alias("alias"), "source_id", F.lower("source_type").isin("web", "internet", "website").alias("w"), F.col("raw_material_family").alias("fam"))
    g = s.groupBy("name_key").agg(F.count("*").alias("n"), F.countDistinct("source_id").alias("sources"), F.countDistinct(F.when(F.col("w"), F.col("source_id"))).alias("web"))
    top = ranking.top_per_group(s.groupBy("name_key", "alias").agg(F.count("*").alias("c")), ["name_key"], [F.desc("c"), F.col("alias")], 10, "rn").groupBy("name_key").agg(F.array_sort(F.collect_list(F.struct("rn", "alias"))).alias("a"))
    f = s.where(present("fam")).groupBy("name_key", "fam").agg(F.count("*").alias("c")).groupBy("name_key").agg(F.min(F.struct((-F.col("c")).alias("neg"), "fam"))["fam"].alias("family"))
    j = g.join(top, "name_key").join(f, "name_key", "left")
    return j.select("name_key", "n", "sources", "web", (F.col("sources") - F.col("web")).alias("literature"), F.to_json(F.col("a.alias")).alias("aliases"), F.coalesce("family", F.lit("ungrouped")).alias("family"))


@query("""WITH u AS (SELECT ref_id, canonical_name, unnest(list_concat([canonical_name, lower(canonical_name) || ' dust'], aliases, [lower(canonical_name)])) AS t, unnest(range(0, len(aliases) + 3)) AS i FROM canonical_names WHERE list_name = 'material'), f AS (SELECT * FROM u WHERE trim(t) <> '' QUALIFY row_number() OVER (PARTITION BY ref_id, lower(trim(t)) ORDER BY i) = 1)
SELECT '{"slug":' || to_json(trim(regexp_replace(lower(canonical_name), '[^a-z0-9]+', '_', 'g'), '_')) || ',"display_name":' || to_json(canonical_name) || ',"terms":' || to_json(list(trim(t) ORDER BY i)) || '}' AS json FROM f GROUP BY ref_id, canonical_name""")
def promotion_documents(spark, d):
    """Candidates as configuration documents, terms in order and each once."""
    n = table(spark, d, "canonical_names").where("list_name = 'material'")
    terms = assignment.distinct_terms(F.array(F.col("canonical_name"), F.concat(F.lower("canonical_name"), F.lit(" dust"))), F.coalesce("aliases", F.array().cast("array<string>")), F.array(F.lower("canonical_name")))
    return n.select(F.to_json(F.struct(F.regexp_replace(S.key_fold("canonical_name"), " ", "_").alias("slug"), F.col("canonical_name").alias("display_name"), terms.alias("terms"))).alias("json"))


@query("""WITH p AS (SELECT DISTINCT shard_id, corpus_index FROM screening WHERE shard_id IS NOT NULL), g AS (SELECT shard_id, count(*) AS n FROM p GROUP BY 1) SELECT shard_id, n, '0-' || (n - 1)::VARCHAR AS array_range, ceil(n / 100.0)::BIGINT AS batches FROM g""")
def array_ranges(spark, d):
    """Array ranges and batches of a hundred for each shard's papers."""
    g = table(spark, d, "screening").where("shard_id IS NOT NULL").select("shard_id", "corpus_index").distinct().groupBy("shard_id").agg(F.count("*").alias("n"))
    return g.select("shard_id", "n", F.concat(F.lit("0-"), (F.col("n") - 1).cast("string")).alias("array_range"), F.ceil(F.col("n") / 100).alias("batches"))
