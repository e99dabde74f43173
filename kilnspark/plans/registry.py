"""Queries of the citation registry, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import registry as G
from ..sources.tables import table
from .book import Book
from .reference import _fold

book = Book()
query = book.query
QUERIES, SQL = book.queries, book.sql

_SRC = """s AS (SELECT source_id, coalesce(min(source_type), 'paper') AS kind, min(title) AS title, min(url) AS url, min(doi) AS doi FROM registered_sources WHERE source_id IS NOT NULL GROUP BY 1),
g AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY source_id)::INT AS ordinal FROM s), reg AS (SELECT *, kind || '_' || CASE WHEN length(ordinal::VARCHAR) < 3 THEN lpad(ordinal::VARCHAR, 3, '0') ELSE ordinal::VARCHAR END AS stable_id FROM g)"""
_PAD = "CASE WHEN length({0}) < 3 THEN lpad({0}, 3, '0') ELSE {0} END"


def _num(x: str) -> str:
    return f"(try_cast({x} AS BIGINT)::VARCHAR)"


def _token_id(t: str) -> str:
    low = f"lower(trim({t}))"
    cases = f"WHEN regexp_matches({low}, '^(paper|web)_([0-9]{{3,}})$') THEN regexp_extract({low}, '^(paper|web)_', 1) || '_' || " + _PAD.format(_num(f"regexp_extract({low}, '_([0-9]+)$', 1)"))
    for p, kind in G.PATTERNS:
        cases += f" WHEN regexp_matches({low}, '{p}') THEN '{kind}_' || " + _PAD.format(_num(f"regexp_extract({low}, '{p}', 1)"))
    return f"(CASE {cases} END)"


_CIT = f"""t AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '{G._TOKEN}', 1)) AS token FROM documents), ci AS (SELECT doc_id, token, {_token_id("token")} AS stable_id FROM t),
cm AS (SELECT ci.*, reg.stable_id IS NOT NULL AS matched FROM ci LEFT JOIN reg USING (stable_id))"""


def _sources(spark, d):
    r = table(spark, d, "registered_sources").where("source_id IS NOT NULL").groupBy("source_id").agg(F.coalesce(F.min("source_type"), F.lit("paper")).alias("kind"), F.min("title").alias("title"), F.min("url").alias("url"), F.min("doi").alias("doi"))
    return G.register(r, "source_id", "kind")


@query(f"WITH {_SRC} SELECT source_id, kind, ordinal, stable_id FROM reg")
def stable_source_ids(spark, d):
    """Sources numbered per type, with their stable ids."""
    return _sources(spark, d).select("source_id", "kind", "ordinal", "stable_id")


@query(f"WITH {_SRC}, {_CIT} SELECT doc_id, token, stable_id, matched FROM cm")
def citation_tokens(spark, d):
    """Citation tokens of documents, the ids they mean, whether a source has them."""
    return G.citations(table(spark, d, "documents"), "doc_id", "text", _sources(spark, d))


@query(f"""WITH {_SRC}, t AS (SELECT DISTINCT 'Paper ' || (regexp_extract(discovery_record_id, '([0-9]+)$', 1)::BIGINT % 400)::VARCHAR AS token FROM scm_discovery UNION SELECT DISTINCT unnest(regexp_extract_all(coalesce(text, ''), '{G._TOKEN}', 1)) FROM documents)
SELECT token FROM t WHERE {_token_id("token")} NOT IN (SELECT stable_id FROM reg)""")
def unmatched_references(spark, d):
    """Citation tokens of documents and discovery records that no source answers to."""
    s = _sources(spark, d)
    n = (F.regexp_extract("discovery_record_id", "([0-9]+)$", 1).cast("bigint") % 400).cast("string")
    texts = table(spark, d, "scm_discovery").select(F.col("discovery_record_id").alias("k"), F.concat(F.lit("Paper "), n).alias("t")).distinct()
    texts = texts.unionAll(table(spark, d, "documents").select(F.col("doc_id").cast("string"), "text"))
    return G.unmatched(G.citations(texts, "k", "t", s), s.select("stable_id"))


@query(f"WITH {_SRC}, {_CIT} SELECT source_id, stable_id, EXISTS (SELECT 1 FROM cm WHERE cm.stable_id = reg.stable_id) AS used FROM reg")
def bibliography(spark, d):
    """Sources used by citations and sources only considered."""
    s = _sources(spark, d)
    return G.bibliography(s, G.citations(table(spark, d, "documents"), "doc_id", "text", s)).select("source_id", "stable_id", "used")


@query(f"""WITH {_SRC}, {_CIT}, p AS (SELECT doc_id, text, string_split(regexp_replace(text, '{G._TOKEN}', chr(1) || '\\1' || chr(1), 'g'), chr(1)) AS ps FROM documents),
u AS (SELECT doc_id, unnest(ps) AS p, unnest(range(0, len(ps))) AS i FROM p), v AS (SELECT u.doc_id, i, CASE WHEN i % 2 = 0 THEN p WHEN reg.stable_id IS NOT NULL THEN '[' || reg.stable_id || ']' ELSE 'Unmatched source reference' END AS x, (i % 2 = 1 AND reg.stable_id IS NULL)::INT AS lost FROM u LEFT JOIN reg ON i % 2 = 1 AND reg.stable_id = {_token_id("p")}),
w AS (SELECT doc_id, string_agg(x, '' ORDER BY i) AS x, sum(lost) AS lost FROM v GROUP BY 1) SELECT documents.doc_id, md5(w.x) AS digest, coalesce(lost, 0)::INT AS unmatched FROM documents LEFT JOIN w USING (doc_id)""")
def rewritten_citations(spark, d):
    """Texts with citations as stable ids, as digests, and how many have no source."""
    return G.rewrite(table(spark, d, "documents"), "doc_id", "text", _sources(spark, d)).select("doc_id", F.md5("text").alias("digest"), "unmatched")


@query(f"""WITH {_SRC}, r AS (SELECT DISTINCT discovery_record_id, source_id, source_title, CASE WHEN row_number() OVER (PARTITION BY discovery_record_id ORDER BY source_id) = 1 THEN 'paper_' || lpad((regexp_extract(discovery_record_id, '([0-9]+)$', 1)::BIGINT % 400)::VARCHAR, 3, '0') END AS cited FROM (SELECT DISTINCT discovery_record_id, source_id, source_title FROM scm_discovery))
SELECT discovery_record_id, cited, coalesce(reg.title, r.source_title) AS title, CASE WHEN cited IS NOT NULL AND reg.stable_id IS NULL THEN 'no source: ' || cited END AS warning FROM r LEFT JOIN reg ON reg.stable_id = r.cited""")
def evidence_overlay(spark, d):
    """Evidence with the registered title of the source it cites, and a warning where there is none."""
    r = table(spark, d, "scm_discovery").select("discovery_record_id", "source_id", F.col("source_title").alias("title")).distinct()
    from pyspark.sql import Window as W

    n = F.lpad((F.regexp_extract("discovery_record_id", "([0-9]+)$", 1).cast("bigint") % 400).cast("string"), 3, "0")
    r = r.withColumn("cited", F.when(F.row_number().over(W.partitionBy("discovery_record_id").orderBy("source_id")) == 1, F.concat(F.lit("paper_"), n)))
    return G.overlay(r, "cited", _sources(spark, d), ["title"]).select("discovery_record_id", "cited", "title", "warning")


@query(f"""WITH r AS (SELECT DISTINCT source_id, doi, url, title FROM registered_sources), s AS (SELECT source_id, title, {_fold("title")} AS k, regexp_replace(lower(trim(url)), '/+$', '') AS u, lower(trim(doi)) AS dd FROM r),
t AS (SELECT DISTINCT discovery_record_id AS record_id, 'See ' || coalesce(u, '') || ' and doi ' || coalesce(dd, '') || ', on ' || coalesce(s.title, '') AS x FROM scm_discovery JOIN s USING (source_id)), tk AS (SELECT *, {_fold("x")} AS k FROM t),
uu AS (SELECT record_id, unnest(list_transform(regexp_extract_all(lower(x), '(https?://[^\\s\"''<>)]+)', 1), lambda m: regexp_replace(m, '[.,;/]+$', ''))) AS m FROM t), du AS (SELECT record_id, unnest(list_transform(regexp_extract_all(lower(x), '\\b(10\\.[0-9]{{4,}}/[^\\s\"''<>;]+)', 1), lambda m: regexp_replace(m, '[.,;)]+$', ''))) AS m FROM t),
h AS (SELECT record_id, source_id, 1 AS r FROM uu JOIN s ON m = u AND u <> '' UNION ALL SELECT record_id, source_id, 2 FROM du JOIN s ON m = dd AND dd <> '' UNION ALL SELECT record_id, source_id, 3 FROM tk JOIN s ON s.k <> '' AND len(string_split(s.k, ' ')) >= 3 AND contains(' ' || tk.k || ' ', ' ' || s.k || ' '))
SELECT record_id, source_id, CASE r WHEN 1 THEN 'url' WHEN 2 THEN 'doi' ELSE 'title' END AS how FROM h QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY r, source_id) = 1""")
def sources_by_mention(spark, d):
    """The source that a record's text mentions by URL, DOI or title."""
    s = table(spark, d, "registered_sources").select("source_id", "title", "url", "doi").distinct()
    link = F.concat(F.lit("See "), F.coalesce(F.regexp_replace(F.lower(F.trim("url")), "/+$", ""), F.lit("")), F.lit(" and doi "), F.coalesce(F.lower(F.trim("doi")), F.lit("")), F.lit(", on "), F.coalesce("title", F.lit("")))
    c = table(spark, d, "scm_discovery").select(F.col("discovery_record_id").alias("record_id"), "source_id").join(s, "source_id").select("record_id", link.alias("x")).distinct()
    return G.by_mention(c, "record_id", "x", s, "source_id", "title", "url", "doi")


@query(r"""WITH r AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '\[([0-9]+)\]', 'paper_0\1', 'g') AS t FROM documents), x AS (SELECT doc_id, list_sort(list_distinct(list_transform(regexp_extract_all(lower(t), '\b((?:paper|web)_[0-9]{3,})\b', 1), lambda z: split_part(z, '_', 1) || '_' || CASE WHEN length((split_part(z, '_', 2)::BIGINT)::VARCHAR) < 3 THEN lpad((split_part(z, '_', 2)::BIGINT)::VARCHAR, 3, '0') ELSE (split_part(z, '_', 2)::BIGINT)::VARCHAR END))) AS ids FROM r) SELECT doc_id, array_to_string(ids, ',') AS ids FROM x WHERE len(ids) > 0""")
def cited_ids(spark, d):
    """The stable ids that stand anywhere in a record."""
    r = table(spark, d, "documents").select("doc_id", F.struct(F.regexp_replace(F.coalesce("text", F.lit("")), r"\[([0-9]+)\]", "paper_0$1").alias("t")).alias("r"))
    return r.select("doc_id", G.cited_ids(F.col("r")).alias("ids")).where("size(ids) > 0").select("doc_id", F.array_join("ids", ",").alias("ids"))
