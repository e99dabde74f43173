"""Queries of documents and payloads, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import normalise as N
from ..functions import scalars as S
from ..functions.text import known, present
from ..operators import documents as D
from ..operators import payloads as P
from ..operators import ranking
from ..sources.tables import table
from .book import Book
from .reference import _fold, _has, _known

book = Book()
query = book.query
QUERIES, SQL = book.queries, book.sql

STOP = ("the", "and", "for", "with", "was", "were", "that")


@query("""SELECT doc_id, left(array_to_string(list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '')[1:3], chr(10)), 400) AS preview FROM documents""")
def previews(spark, d):
    """The first three paragraphs of each document, 400 letters at most (the preview is the feature)."""
    return table(spark, d, "documents").select("doc_id", D.paragraphs(F.col("text"), 3, 400).alias("preview"))


@query("""WITH r AS (SELECT DISTINCT source_id, trim(coalesce(title, '')) AS a, trim(coalesce(abstract_or_snippet, '')) AS b FROM registered_sources) SELECT source_id, CASE WHEN b = '' OR contains(a, b) THEN a WHEN a = '' THEN b ELSE a || chr(10) || chr(10) || b END AS text FROM r""")
def full_texts(spark, d):
    """Titles with their bodies below, unless one is in the other."""
    return table(spark, d, "registered_sources").select("source_id", D.with_body(F.col("title"), F.col("abstract_or_snippet")).alias("text")).distinct()


@query("""SELECT DISTINCT source_id, array_to_string(list_filter(list_transform(coalesce(authors, []), lambda x: trim(x)), lambda x: x <> '')[1:20], '; ') AS authors, array_to_string(list_filter(list_transform(string_split_regex(coalesce(journal_or_venue, ''), '[,;]'), lambda x: trim(x)), lambda x: x <> '')[1:20], '; ') AS venues FROM registered_sources""")
def author_lists(spark, d):
    """Authors of arrays and of texts, trimmed, twenty at most."""
    return table(spark, d, "registered_sources").select("source_id", F.array_join(D.authors(F.col("authors")), "; ").alias("authors"), F.array_join(D.authors_of_text(F.col("journal_or_venue")), "; ").alias("venues")).distinct()


@query("""SELECT DISTINCT source_id, lower(concat_ws(' ', title, array_to_string(authors[1:50], ' '), pub_year, doi)) AS text FROM registered_sources""")
def searchable_texts(spark, d):
    """All fields of a source as one searchable text."""
    r = table(spark, d, "registered_sources")
    return r.select("source_id", D.flat_text(["title", "authors", "pub_year", "doi"], r.dtypes).alias("text")).distinct()


@query(f"""SELECT doc_id, array_to_string(list_filter(regexp_extract_all(lower(coalesce(text, '')), '([a-z0-9]+)', 1), lambda x: length(x) > 2 AND x NOT IN {STOP}), ' ') AS tokens FROM documents""")
def search_tokens(spark, d):
    """The tokens of each document without stop words, repeats kept."""
    return table(spark, d, "documents").select("doc_id", F.array_join(D.tokens(F.col("text"), STOP), " ").alias("tokens"))


@query(f"""WITH w AS (SELECT DISTINCT web_source_id, url, evidence_text, page_title FROM web_stages) SELECT web_source_id, coalesce(regexp_matches(lower(trim(url)), '^https?://[^/?#]+'), false) AS web_url, CASE WHEN {_has("evidence_text")} AND lower(trim(evidence_text)) <> 'unavailable' THEN md5(trim(evidence_text)) WHEN {_has("page_title")} THEN md5(trim(page_title)) ELSE md5('Unavailable') END AS digest,
CASE WHEN {_has("evidence_text")} AND lower(trim(evidence_text)) <> 'unavailable' THEN 'raw' WHEN {_has("page_title")} THEN 'snippet' ELSE 'none' END AS content_source FROM w""")
def page_contents(spark, d):
    """The first content a page has, where it came from, and whether its URL is one."""
    w = table(spark, d, "web_stages").select("web_source_id", "url", "evidence_text", "page_title").distinct()
    raw = F.when(F.lower(F.trim("evidence_text")) != "unavailable", F.col("evidence_text"))
    c = D.page_content([("raw", raw), ("snippet", F.col("page_title"))])
    return w.select("web_source_id", D.is_web_url(F.col("url")).alias("web_url"), c.alias("c")).select("web_source_id", "web_url", F.md5("c.text").alias("digest"), "c.content_source")


@query("""SELECT DISTINCT web_source_id, CASE WHEN trim(regexp_replace(coalesce(page_title, ''), '\\s+', ' ', 'g')) = '' THEN 'Only & body' ELSE trim(regexp_replace(page_title, '\\s+', ' ', 'g')) || chr(10) || 'Text of 3 < 4' END AS text FROM web_stages""")
def readable_pages(spark, d):
    """What HTML pages say: the main element without furniture, else the body."""
    w = table(spark, d, "web_stages").select("web_source_id", F.replace(F.replace(F.coalesce("page_title", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")).alias("t")).distinct()
    nav, foot = F.lit("<html><head><title>x</title><script>var a = '<p>no</p>';</script></head><body><nav><a>Home</a> <a>News</a></nav>"), F.lit("<footer>&copy; 2020</footer></body></html>")
    main = F.concat(F.lit("<main><h1>"), F.col("t"), F.lit("</h1><p>Text of&nbsp;3 &lt; <b>4</b></p><aside>More</aside></main>"))
    html = F.concat(nav, F.when(F.trim(F.col("t")) == "", F.lit("<div>Only &amp; body</div>")).otherwise(main), foot)
    return D.readable(w.select("web_source_id", html.alias("html")), "web_source_id", "html")


@query("""SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL ELSE '{"k":' || (props->>'k') || ',"event":"' || event_type || '"}' END AS json, CASE event_id % 4 WHEN 3 THEN CASE WHEN event_id % 8 = 3 THEN 'no object' ELSE 'not readable' END END AS problem FROM events""")
def json_answers(spark, d):
    """JSON objects out of answers: plain, fenced, with talk around them, broken, or none."""
    j = F.concat(F.lit('{"k": '), F.get_json_object("props", "$.k"), F.lit(', "event": "'), F.col("event_type"), F.lit('"}'))
    m = F.col("event_id") % 4
    raw = F.when(m == 0, j).when(m == 1, F.concat(F.lit("```json\n"), j, F.lit("\n```"))).when(m == 2, F.concat(F.lit("Here it is: "), j, F.lit(" - as {asked}"))).when(F.col("event_id") % 8 == 3, F.lit("sorry, none")).otherwise(F.lit('{"k": 4, "event"'))
    return D.json_answers(table(spark, d, "events").select("event_id", raw.alias("raw")), "event_id", "raw")


@query("""WITH c AS (SELECT DISTINCT company_id, name, company_role, notes, associated_projects FROM company_intel), u AS (SELECT company_id, name, company_role, notes, unnest(CASE WHEN coalesce(len(associated_projects), 0) = 0 THEN [NULL] ELSE associated_projects END) AS project, unnest(range(0, greatest(1, coalesce(len(associated_projects), 0)))) AS position FROM c)
SELECT company_id, name, position::INT AS position, project, CASE WHEN position = 0 THEN company_role ELSE 'N.A.' END AS company_role, CASE WHEN position = 0 THEN notes ELSE 'N.A.' END AS notes FROM u""")
def inherited_rows(spark, d):
    """One row per element; later rows keep the identity only."""
    c = table(spark, d, "company_intel").select("company_id", "name", "company_role", "notes", "associated_projects").distinct()
    return P.inherit(c, "associated_projects", "project", ["company_id", "name"], ["company_role", "notes"])


@query(f"""WITH r AS (SELECT DISTINCT source_id, title, pub_year, authors FROM registered_sources), u AS (SELECT source_id, title, pub_year, unnest(CASE WHEN coalesce(len(authors), 0) = 0 THEN [NULL] ELSE authors END) AS a FROM r)
SELECT source_id, coalesce(CASE WHEN {_has("a")} THEN trim(a) END, title) AS title, coalesce(CASE WHEN length(a) % 2 = 0 AND {_has("a")} THEN 'of ' || trim(a) END, pub_year) AS pub_year FROM u""")
def overridden_entries(spark, d):
    """Entries of a list that override their record's fields; records without a list keep a row."""
    r = table(spark, d, "registered_sources").select("source_id", "title", "pub_year", F.transform("authors", lambda a: F.struct(a.alias("name"), F.when((F.length(a) % 2 == 0) & present(a), F.concat(F.lit("of "), F.trim(a))).alias("year"))).alias("items"), F.col("authors").alias("__a")).distinct().drop("__a")
    return P.override(r, "items", {"title": "name", "pub_year": "year"}, ["source_id"])


@query(f"""WITH c AS (SELECT DISTINCT screening_id, title, CASE WHEN json_valid(mentioned_materials) THEN from_json(mentioned_materials, '["VARCHAR"]') END AS m FROM screening) SELECT screening_id, coalesce(len(m), 0) = 0 AS fallen, unnest(CASE WHEN coalesce(len(m), 0) = 0 THEN ['intent: ' || coalesce(title, '?')] ELSE m END) AS item FROM c""")
def payload_rows(spark, d):
    """One row per extracted item; a record without any gives a row of what was searched for."""
    s = table(spark, d, "screening").select("screening_id", "title", "mentioned_materials").distinct().withColumn("m", F.from_json("mentioned_materials", "array<string>"))
    return P.with_fallback(s, "m", "item", F.concat(F.lit("intent: "), F.coalesce("title", F.lit("?"))), ["screening_id"])


@query("""SELECT DISTINCT screening_id, CASE WHEN confidence IS NULL OR isnan(confidence) OR confidence < 0 OR confidence > 1 THEN NULL ELSE confidence END AS confidence, CASE WHEN confidence IS NULL OR isnan(confidence) OR confidence < 0 OR confidence > 1 THEN NULL ELSE title END AS title, CASE WHEN confidence IS NULL OR isnan(confidence) THEN 'no number' WHEN confidence < 0 OR confidence > 1 THEN 'off the scale' END AS error FROM screening""")
def error_rows(spark, d):
    """Failures kept as rows with a message."""
    c = F.col("confidence")
    off = (c < 0) | (c > 1)
    none = c.isNull() | F.isnan(c)
    return P.error_rows(table(spark, d, "screening"), "screening_id", none | off, F.when(none, "no number").otherwise("off the scale"), {"confidence": c, "title": F.col("title")}).distinct()


@query(f"""SELECT CASE WHEN NOT {_has("source_id")} THEN 'invalid' WHEN regexp_matches(lower(coalesce(raw_technology_name, '')), 'mineral|carbonat') THEN 'pending review' WHEN {_has("taxonomy_level_3")} THEN 'migrated' ELSE 'invalid' END AS status, evidence_origin, count(*) AS n, count(*) FILTER ({_has("project_name")}) AS with_project FROM cementitious GROUP BY 1, 2""")
def routed_records(spark, d):
    """Records routed three ways, none dropped, counted."""
    c = P.route(table(spark, d, "cementitious"), [("invalid", ~present("source_id")), ("pending review", F.lower(F.coalesce("raw_technology_name", F.lit(""))).rlike("mineral|carbonat")), ("migrated", present("taxonomy_level_3"))], "invalid")
    return c.groupBy("status", "evidence_origin").agg(F.count("*").alias("n"), F.count_if(present("project_name")).alias("with_project"))


@query("""SELECT DISTINCT coalesce(discovery_record_id, '') AS record_id, coalesce(source_id, '') AS source, coalesce(raw_material_name, '') AS raw_technology_name, coalesce(supporting_evidence, '') AS evidence_text, 'Discovery' AS evidence_origin, coalesce(lower(deployment_stage), '') AS deployment_stage FROM scm_discovery""")
def bridged_rows(spark, d):
    """Discovery rows in the schema of evidence rows."""
    return P.project(table(spark, d, "scm_discovery"), {"record_id": "discovery_record_id", "source": "source_id", "raw_technology_name": "raw_material_name", "evidence_text": "supporting_evidence", "evidence_origin": "=Discovery", "deployment_stage": F.lower("deployment_stage")}).distinct()


@query("""WITH c AS (SELECT DISTINCT record_id, list_filter([CASE WHEN taxonomy_level_1 IS NOT NULL THEN [taxonomy_level_1, taxonomy_level_2] END, CASE WHEN subcategory IS NOT NULL THEN [subcategory] END], lambda x: x IS NOT NULL) AS ps FROM cementitious WHERE record_id IS NOT NULL), u AS (SELECT record_id, unnest(ps) AS p, unnest(range(0, len(ps))) AS i FROM c)
SELECT CASE WHEN i = 0 THEN record_id ELSE record_id || '#' || i::VARCHAR END AS candidate_id, record_id, (i + 1)::INT AS path_no, coalesce(p[1], 'N.A.') AS level_1, coalesce(p[2], 'N.A.') AS level_2 FROM u""")
def records_per_path(spark, d):
    """A record per path of each source, levels padded, later ones numbered."""
    c = table(spark, d, "cementitious").where("record_id IS NOT NULL")
    ps = F.array_compact(F.array(F.when(F.col("taxonomy_level_1").isNotNull(), F.array("taxonomy_level_1", "taxonomy_level_2")), F.when(F.col("subcategory").isNotNull(), F.array("subcategory"))))
    return P.record_per_path(c.select("record_id", ps.alias("ps")).distinct(), ["record_id"], "ps", 2)


_QA = """q AS (SELECT l_orderkey AS g, l_linenumber AS place, 'part ' || (l_partkey % 7) AS question FROM lineitem), a AS (SELECT l_orderkey AS g, l_linenumber AS place, 'part ' || (l_suppkey % 7) AS question, 'answer ' || l_suppkey AS answer FROM lineitem WHERE l_linenumber <= 3),
qd AS (SELECT g, min(place) AS place, question FROM q GROUP BY 1, 3)"""


@query(f"""WITH {_QA}, f AS (SELECT g, question, arg_min(answer, lpad(place::VARCHAR, 9, '0') || answer) AS answer FROM a GROUP BY 1, 2), j AS (SELECT qd.*, f.answer FROM qd LEFT JOIN f USING (g, question)), lq AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY place, question) AS n FROM j WHERE answer IS NULL),
la AS (SELECT a.g, a.answer, row_number() OVER (PARTITION BY a.g ORDER BY a.place, a.answer) AS n FROM a WHERE NOT EXISTS (SELECT 1 FROM qd WHERE qd.g = a.g AND qd.question = a.question))
SELECT g, place, question, answer, 'text' AS how FROM j WHERE answer IS NOT NULL UNION ALL SELECT lq.g, lq.place, lq.question, coalesce(la.answer, 'Not answered'), CASE WHEN la.answer IS NULL THEN 'none' ELSE 'place' END FROM lq LEFT JOIN la ON la.g = lq.g AND la.n = lq.n""")
def answered_questions(spark, d):
    """Answers joined to questions by text, then by place, then a default."""
    li = table(spark, d, "lineitem")
    q = li.select(F.col("l_orderkey").alias("g"), F.col("l_linenumber").alias("place"), F.concat(F.lit("part "), (F.col("l_partkey") % 7).cast("string")).alias("question")).groupBy("g", "question").agg(F.min("place").alias("place"))
    a = li.where("l_linenumber <= 3").select(F.col("l_orderkey").alias("g"), F.col("l_linenumber").alias("place"), F.concat(F.lit("part "), (F.col("l_suppkey") % 7).cast("string")).alias("question"), F.concat(F.lit("answer "), F.col("l_suppkey").cast("string")).alias("answer"))
    return P.answers(q, a, "g")


@query(f"""WITH g AS (SELECT {_fold("raw_material_name")} AS k, raw_material_name AS nm FROM (SELECT DISTINCT raw_material_name FROM scm_discovery WHERE {_has("raw_material_name")})), t AS (SELECT {_fold("raw_material_name")} AS k, arg_max(raw_material_family, discovery_record_id || raw_material_family) AS fam FROM scm_discovery WHERE {_has("raw_material_family")} GROUP BY 1)
SELECT nm AS name, coalesce(fam, 'ungrouped') AS family FROM g LEFT JOIN t USING (k)""")
def grouping_lookup(spark, d):
    """The last grouping given to each name, or none."""
    s = table(spark, d, "scm_discovery")
    names = s.where(present("raw_material_name")).select(F.col("raw_material_name").alias("name")).distinct()
    return P.lookup_last(names, S.key_fold("name"), s.where(present("raw_material_family")).select("raw_material_name", "discovery_record_id", F.col("raw_material_family").alias("family")), S.key_fold("raw_material_name"), "discovery_record_id", "family", F.lit("ungrouped"))


@query("""WITH p AS (SELECT web_source_id, row_number() OVER (ORDER BY authority_rank NULLS FIRST, web_source_id)::INT AS place FROM (SELECT DISTINCT web_source_id, authority_rank FROM web_stages)), t AS (SELECT * FROM p WHERE place <= 300), c AS (SELECT DISTINCT web_source_id, page_title FROM web_stages WHERE evidence_text IS NOT NULL AND length(evidence_text) > 200)
SELECT t.web_source_id, place, c.page_title, c.web_source_id IS NULL AS lost FROM t LEFT JOIN c USING (web_source_id)""")
def planned_candidates(spark, d):
    """Candidates of a plan of 300 in its order, and those that are lost (a ranked plan)."""
    w = table(spark, d, "web_stages")
    top = ranking.top_n(w.select("web_source_id", "authority_rank").distinct(), [F.asc_nulls_first("authority_rank"), F.col("web_source_id")], 300)
    from pyspark.sql import Window as W

    plan = top.withColumn("place", F.row_number().over(W.orderBy(F.asc_nulls_first("authority_rank"), "web_source_id"))).drop("authority_rank")
    return P.planned(plan, w.where("evidence_text IS NOT NULL AND length(evidence_text) > 200").select("web_source_id", "page_title").distinct(), "web_source_id")


_LBL = ("Precast curing", "Nano seeding", "Geopolymer mixes", "No such branch")


@query(f"""WITH e AS (SELECT DISTINCT screening_id, is_relevant, confidence, unnest(list_distinct(list_transform(string_split(coalesce(matched_taxonomy_branches, ''), ';'), lambda x: trim(x)))) AS label FROM screening), w AS (SELECT unnest({list(_LBL)}) AS label, unnest(range(1, 5)) AS place),
g AS (SELECT label, count(*) AS n, round(avg(CASE WHEN is_relevant AND confidence >= 0 AND confidence <= 1 THEN confidence END), 6) AS mean FROM e GROUP BY 1) SELECT place::INT AS place, w.label, coalesce(n, 0) AS n, mean FROM w LEFT JOIN g USING (label)""")
def label_counts(spark, d):
    """Screenings per label in a fixed order, zeros kept, with the mean confidence of relevant ones."""
    s = table(spark, d, "screening").select("screening_id", "is_relevant", "confidence", "matched_taxonomy_branches").distinct()
    ok = F.col("is_relevant") & (F.col("confidence") >= 0) & (F.col("confidence") <= 1)
    return P.label_counts(s, F.transform(F.split(F.coalesce("matched_taxonomy_branches", F.lit("")), ";"), lambda x: F.trim(x)), _LBL, ok, F.col("confidence"))


@query("""WITH x AS (SELECT DISTINCT shard_id, corpus_index FROM screening WHERE is_relevant AND shard_id IS NOT NULL AND corpus_index IS NOT NULL), y AS (SELECT *, corpus_index - row_number() OVER (PARTITION BY shard_id ORDER BY corpus_index) AS run FROM x), r AS (SELECT shard_id, min(corpus_index) AS a, max(corpus_index) AS b FROM y GROUP BY shard_id, run)
SELECT shard_id, string_agg(CASE WHEN a = b THEN a::VARCHAR ELSE a::VARCHAR || '-' || b::VARCHAR END, ',' ORDER BY a) AS ranges FROM r GROUP BY 1""")
def id_ranges(spark, d):
    """Positions of relevant papers per shard as a short text of ranges."""
    s = table(spark, d, "screening").where("is_relevant AND shard_id IS NOT NULL").select("shard_id", "corpus_index")
    return P.id_ranges(s, ["shard_id"], "corpus_index")


@query(f"""WITH g AS (SELECT {_fold("raw_material_name")} AS k, count(*) AS n, count(DISTINCT source_id) AS sources, max(raw_material_name) AS name FROM scm_discovery WHERE {_has("raw_material_name")} GROUP BY 1) SELECT '{{"name":' || to_json(name) || ',"n":' || n || ',"sources":' || sources || '}}' AS json FROM g ORDER BY n DESC, k LIMIT 50""")
def prompt_rows(spark, d):
    """The fifty most frequent names as JSON for a model (a top-k report)."""
    g = table(spark, d, "scm_discovery").where(present("raw_material_name")).groupBy(S.key_fold("raw_material_name").alias("k")).agg(F.count("*").alias("n"), F.countDistinct("source_id").alias("sources"), F.max("raw_material_name").alias("name"))
    return ranking.top_n(g, [F.desc("n"), F.col("k")], 50).select(F.to_json(F.struct("name", "n", "sources")).alias("json"))


@query(f"""WITH r AS (SELECT DISTINCT metric_id, technology_name, metric_name, metric_value, unit FROM metric_intel), g AS (SELECT technology_name AS t, count(*) AS n, list(struct_pack(m := metric_name, v := metric_value) ORDER BY metric_id)[1:3] AS ms FROM r WHERE technology_name IS NOT NULL GROUP BY 1)
SELECT t AS technology, n, len(ms)::INT AS shown, coalesce(trim(ms[1].m), 'N.A.') AS first_metric, coalesce(round(ms[1].v)::BIGINT, -1) AS first_value FROM g""")
def nested_results(spark, d):
    """Nested results per technology: a count and the first three metrics, with defaults."""
    m = table(spark, d, "metric_intel").where("technology_name IS NOT NULL").select("metric_id", F.col("technology_name").alias("technology"), "metric_name", "metric_value", "unit").distinct()
    n = m.groupBy("technology").agg(F.count("*").alias("n"))
    top = ranking.top_per_group(m, ["technology"], [F.col("metric_id")], 3, "rn").groupBy("technology").agg(F.array_sort(F.collect_list(F.struct("rn", "metric_name", "metric_value"))).alias("ms"))
    one = F.try_element_at("ms", F.lit(1))
    return n.join(top, "technology").select("technology", "n", F.size("ms").alias("shown"), F.coalesce(F.trim(one["metric_name"]), F.lit("N.A.")).alias("first_metric"), F.coalesce(F.round(one["metric_value"]).cast("bigint"), F.lit(-1).cast("bigint")).alias("first_value"))


@query(f"""SELECT DISTINCT coalesce(trim({_known("record_id")}), '') AS record_id, coalesce(trim({_known("source_title")}), 'N.A.') AS title, CASE WHEN {_has("doi")} THEN 'https://doi.org/' || lower(trim(doi)) ELSE coalesce(trim({_known("source_url")}), '') END AS link, coalesce(nullif(regexp_extract(coalesce(publication_year, ''), '(?:^|[^0-9])((?:19|20)[0-9]{{2}})(?:$|[^0-9])', 1), ''), '') AS year FROM cementitious""")
def citation_rows(spark, d):
    """Citations projected from records, links from DOIs first."""
    link = F.when(present("doi"), F.concat(F.lit("https://doi.org/"), F.lower(F.trim("doi")))).otherwise(F.coalesce(F.trim(known("source_url")), F.lit("")))
    return table(spark, d, "cementitious").select(N.missing_to("record_id", "").alias("record_id"), N.missing_to("source_title", "N.A.").alias("title"), link.alias("link"), F.coalesce(S.year_in("publication_year").cast("string"), F.lit("")).alias("year")).distinct()
