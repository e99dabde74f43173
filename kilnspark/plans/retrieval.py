"""Queries of retrieval by lexicons, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import known, present
from ..operators import lexicon as L
from ..operators import ranking
from ..sources.tables import table
from .book import Book
from .reference import TIERS, _has, _known, _phrase, _year

book = Book()
query = book.query
QUERIES, SQL = book.queries, book.sql

SYNONYMS = {"pozzolan": 2.0, "cement replacement": 2.5, "binder": 0.5, "ash": 0.5}
CONTEXT = L.query_context("Fly ash in mortar for low emissions", SYNONYMS)
WIDE = L.merge_contexts(CONTEXT, L.query_context("silica fume mortar"), [("kiln", 2.0, "synonym"), ("binder", 1.5, "synonym")])
NEGATIVE = ("school", "road", "garage", "shoe")
QUANTITIES = ("[0-9]+ percent", "[0-9]+ mpa", "[0-9,]+ mj per tonne")
ORDER = {"core": ("fly ash", "silica fume", "calcined clay", "clinker"), "related": ("mortar", "grout", "kiln"), "side": ("sample", "test", "data")}
LABELS = {"ash": ("fly ash", "bottom ash", "biomass ash"), "clay": ("clay", "kaolin"), "slag": ("slag",), "energy": ("mj", "kiln"), "carbon": ("co2", "carbon")}


def _values(rows) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else f"{x}" for x in r) + ")" for r in rows) + ")"


@query("""SELECT place, phrase, weight::DOUBLE AS weight, source FROM (VALUES (1, 'cement replacement', 2.5, 'synonym'), (2, 'low emissions', 3.0, 'query'), (3, 'ash mortar', 3.0, 'query'), (4, 'mortar for', 3.0, 'query'), (5, 'emissions', 1.0, 'query'), (6, 'pozzolan', 2.0, 'synonym'), (7, 'fly ash', 3.0, 'query'), (8, 'for low', 3.0, 'query'), (9, 'binder', 0.5, 'synonym'), (10, 'mortar', 1.0, 'query'), (11, 'ash', 1.0, 'query'), (12, 'fly', 1.0, 'query'), (13, 'for', 1.0, 'query'), (14, 'low', 1.0, 'query')) AS t(place, phrase, weight, source)
UNION ALL SELECT 0, 'fly ash in mortar for low emissions', 5.0::DOUBLE, 'query'""")
def compiled_context(spark, d):
    """A query compiled to weighted phrases, longest first (the rows are worked out by hand)."""
    return spark.createDataFrame([(i, p, w, s) for i, (p, w, s) in enumerate(CONTEXT)], "place int, phrase string, weight double, source string")


_T = "lower(coalesce(text, ''))"


def _sum(ctx, t=_T, keep=lambda p, s: True, weighted=True) -> str:
    return "(" + " + ".join(f"CASE WHEN {_phrase(t, p)} THEN {float(w) if weighted else 1} ELSE 0 END" for p, w, s in ctx if keep(p, s)) + ")"


@query(f"""SELECT doc_id, round({_sum(WIDE)}, 3)::DOUBLE AS score, {_sum(WIDE, keep=lambda p, s: s == "query", weighted=False)}::INT AS query_hits, {_sum(WIDE, keep=lambda p, s: s == "synonym", weighted=False)}::INT AS synonym_hits, {_sum(WIDE, keep=lambda p, s: s == "query" and " " in p, weighted=False)} > 0 AS strong, {_sum(WIDE, weighted=False)} >= 2 AS moderate FROM documents""")
def phrase_scores(spark, d):
    """Documents scored by a context of several queries, by source, with strong and moderate matches; short terms as whole words."""
    return table(spark, d, "documents").select("doc_id", L.phrase_score(F.lower(F.coalesce("text", F.lit(""))), WIDE).alias("s")).select("doc_id", "s.*")


def _hits(t: str, terms) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {_phrase(t, x)} THEN '{x}' END" for x in terms) + "], lambda x: x IS NOT NULL)"


_REASON = f"""h AS (SELECT doc_id, {_T} AS t, {_hits(_T, ORDER["core"])} AS h0, {_hits(_T, ORDER["related"])} AS h1, {_hits(_T, ORDER["side"])} AS h2, {_hits(_T, NEGATIVE)} AS neg, regexp_matches({_T}, '{"|".join(f"(?:{q})" for q in QUANTITIES)}') AS q FROM documents)"""


@query(f"""WITH {_REASON} SELECT doc_id, CASE WHEN regexp_matches(t, '^ *$') THEN 'empty' WHEN len(h0) > 0 THEN 'core' WHEN len(h1) > 0 THEN CASE WHEN q THEN 'core' ELSE 'related' END WHEN len(h2) > 0 THEN 'side' WHEN len(neg) > 0 THEN 'off topic' ELSE 'none' END AS label,
CASE WHEN regexp_matches(t, '^ *$') THEN 'no text' WHEN len(h0) > 0 THEN 'core: ' || array_to_string(h0[1:3], ', ') WHEN len(h1) > 0 THEN 'related: ' || array_to_string(h1[1:3], ', ') || CASE WHEN q THEN ' with quantities' ELSE '' END WHEN len(h2) > 0 THEN 'side: ' || array_to_string(h2[1:3], ', ') WHEN len(neg) > 0 THEN 'only ' || array_to_string(neg[1:3], ', ') ELSE 'no term' END AS reason FROM h""")
def relevance_reasons(spark, d):
    """Labels of documents with the terms that decided."""
    return L.relevance_reason(table(spark, d, "documents").select("doc_id", "text"), "text", ORDER, NEGATIVE, QUANTITIES).select("doc_id", "label", "reason")


def _any(t: str, terms) -> str:
    return "(" + " OR ".join(_phrase(t, x) for x in terms) + ")"


@query(f"SELECT doc_id FROM documents WHERE NOT {_any(_T, NEGATIVE)} OR {_any(_T, ORDER['core'])}")
def negative_filter(spark, d):
    """Documents without off-topic terms, or on topic all the same."""
    return L.drop_negative(table(spark, d, "documents").select("doc_id", "text"), "text", NEGATIVE, ORDER["core"]).select("doc_id")


_LAB = f"""list_filter([{", ".join(f"CASE WHEN {_any(_T, ts)} THEN '{n}' END" for n, ts in LABELS.items())}], lambda x: x IS NOT NULL)"""


@query(f"SELECT doc_id, array_to_string(CASE WHEN {_any(_T, ('cement', 'concrete', 'mortar', 'binder'))} THEN {_LAB} ELSE [] END, ',') AS labels, array_to_string(CASE WHEN NOT {_any(_T, NEGATIVE)} THEN {_LAB} ELSE [] END, ',') AS strict FROM documents")
def label_screens(spark, d):
    """Several labels a document, where its context fits, and where nothing speaks against them."""
    t = F.lower(F.coalesce("text", F.lit("")))
    return table(spark, d, "documents").select("doc_id", F.array_join(L.labels(t, LABELS, ("cement", "concrete", "mortar", "binder")), ",").alias("labels"), F.array_join(L.labels(t, LABELS, (), NEGATIVE), ",").alias("strict"))


@query("""WITH t AS (SELECT DISTINCT shard_id, corpus_index, list_distinct(list_filter(list_transform(string_split(coalesce(matched_taxonomy_branches, ''), ';'), lambda x: regexp_replace(lower(trim(x)), '[^a-z0-9]+', '_', 'g')), lambda x: x IN ('precast_curing', 'nano_seeding', 'geopolymer_mixes', 'lightweight_blocks'))) AS b FROM screening)
SELECT shard_id, corpus_index, array_to_string(list_sort(b), ',') AS branches FROM t WHERE len(b) > 0""")
def allowed_branches(spark, d):
    """Branches in one spelling, those of a list of allowed ones, each once."""
    allowed = ["precast_curing", "nano_seeding", "geopolymer_mixes", "lightweight_blocks"]
    one = F.transform(F.split(F.coalesce("matched_taxonomy_branches", F.lit("")), ";"), lambda x: F.regexp_replace(F.lower(F.trim(x)), "[^a-z0-9]+", "_"))
    s = table(spark, d, "screening").select("shard_id", "corpus_index", F.array_distinct(F.filter(one, lambda x: x.isin(*allowed))).alias("b")).distinct()
    return s.where("size(b) > 0").select("shard_id", "corpus_index", F.array_join(F.array_sort("b"), ",").alias("branches")).distinct()


_TERMS = """tm AS (SELECT ref_id AS node, lower(canonical_name) AS term, 5.0 AS weight FROM canonical_names UNION ALL SELECT ref_id, lower(unnest(aliases)), 4.0 FROM canonical_names UNION ALL SELECT ref_id, lower(split_part(canonical_name, ' ', 1)), 2.0 FROM canonical_names WHERE length(split_part(canonical_name, ' ', 1)) > 4)"""
_NODE_SCORES = f"""{_TERMS}, ns AS (SELECT doc_id, node, round(sum(weight), 3)::DOUBLE AS score, count(*)::INT AS hits FROM (SELECT DISTINCT doc_id, node, term, weight FROM documents JOIN (SELECT DISTINCT * FROM tm) ON term <> '' AND contains({_T}, term)) GROUP BY 1, 2)"""


def _node_scores(spark, d):
    n = table(spark, d, "canonical_names")
    first = F.lower(F.substring_index("canonical_name", " ", 1))
    terms = n.select(F.col("ref_id").alias("node"), F.lower("canonical_name").alias("term"), F.lit(5.0).alias("weight")).unionAll(n.select("ref_id", F.explode(F.transform("aliases", lambda a: F.lower(a))), F.lit(4.0))).unionAll(n.where(F.length(first) > 4).select("ref_id", first, F.lit(2.0)))
    return L.node_scores(table(spark, d, "documents"), "doc_id", "text", terms)


@query(f"WITH {_NODE_SCORES} SELECT * FROM ns")
def node_scores(spark, d):
    """Each document scored against every node of the list by its terms."""
    return _node_scores(spark, d)


@query(f"WITH {_NODE_SCORES}, b AS (SELECT doc_id, list_name AS branch, max(score) AS score, count(*) AS nodes FROM ns JOIN canonical_names ON ref_id = node GROUP BY 1, 2) SELECT doc_id, branch, score, nodes, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, branch)::INT AS place FROM b")
def branch_matches(spark, d):
    """The branches a document's best nodes lie in, best first."""
    n = table(spark, d, "canonical_names").select(F.col("ref_id").alias("node"), F.col("list_name").alias("branch"))
    b = _node_scores(spark, d).join(n, "node").groupBy("doc_id", "branch").agg(F.max("score").alias("score"), F.count("*").alias("nodes"))
    return ranking.top_per_group(b, ["doc_id"], [F.desc("score"), F.col("branch")], 1000, "place")


_CAND = f"""c AS (SELECT DISTINCT screening_id, round(coalesce(screening_score, 0) + CASE lower(trim(screening_confidence)) WHEN 'high' THEN 3 WHEN 'medium' THEN 1.5 ELSE 0 END + CASE WHEN coalesce(matched_taxonomy_branches, '') LIKE '%;%' THEN 0.5 ELSE 0 END + {" + ".join(f"CASE WHEN contains(lower(coalesce(title, '')), '{t}') THEN {w} ELSE 0 END" for t, w in (("fly ash", 2), ("strength", 1)))}, 6)::DOUBLE AS candidate_score FROM screening WHERE is_relevant)"""


@query(f"WITH {_CAND} SELECT screening_id, candidate_score FROM c")
def candidate_scores(spark, d):
    """Candidates scored by screening, confidence, branches and cues in the title."""
    s = table(spark, d, "screening").where("is_relevant")
    bonus = F.when(F.lower(F.trim("screening_confidence")) == "high", 3.0).when(F.lower(F.trim("screening_confidence")) == "medium", 1.5).otherwise(0.0)
    several = F.when(F.coalesce("matched_taxonomy_branches", F.lit("")).contains(";"), 0.5).otherwise(0.0)
    title = F.lower(F.coalesce("title", F.lit("")))
    cues = F.when(title.contains("fly ash"), 2.0).otherwise(0.0) + F.when(title.contains("strength"), 1.0).otherwise(0.0)
    return s.select("screening_id", F.round(F.coalesce("screening_score", F.lit(0.0)) + bonus + several + cues, 6).alias("candidate_score")).distinct()


@query(f"""SELECT DISTINCT source_id, 'Title: ' || coalesce(trim({_known("title")}), 'N/A') || chr(10) || 'Abstract: ' || coalesce(trim({_known("abstract_or_snippet")}), 'N/A') AS labelled, lower(coalesce(title, '') || ' ' || coalesce(abstract_or_snippet, '')) AS plain FROM registered_sources""")
def screening_texts(spark, d):
    """Texts for screening: labelled with defaults, and plain in lower case."""
    r = table(spark, d, "registered_sources")
    label = F.format_string("Title: %s\nAbstract: %s", F.coalesce(F.trim(known("title")), F.lit("N/A")), F.coalesce(F.trim(known("abstract_or_snippet")), F.lit("N/A")))
    return r.select("source_id", label.alias("labelled"), F.lower(F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("abstract_or_snippet", F.lit("")))).alias("plain")).distinct()


_W = {"title": 12.0, "abstract_or_snippet": 4.0, "journal_or_venue": 3.0}
_TOK = ("fly", "ash", "strength", "mortar")


@query(f"""WITH r AS (SELECT DISTINCT source_id, title, abstract_or_snippet, journal_or_venue FROM registered_sources), s AS (SELECT source_id, ({" + ".join(f"CASE WHEN contains(lower(coalesce({f}, '')), '{t}') THEN {w} ELSE 0 END" for t in _TOK for f, w in _W.items())} + CASE WHEN {" AND ".join("(" + " OR ".join(f"contains(lower(coalesce({f}, '')), '{t}')" for f in _W) + ")" for t in _TOK)} THEN 1 ELSE 0 END)::DOUBLE AS score FROM r)
SELECT source_id, score FROM s WHERE score > 0 ORDER BY score DESC, source_id LIMIT 100""")
def token_search(spark, d):
    """A hundred sources that answer a search best, by weighted fields per token (a top-k report)."""
    r = table(spark, d, "registered_sources").select("source_id", *_W).distinct()
    s = L.token_search(r, "The strength of fly ash mortar", _W, stop=("the",)).select("source_id", "score")
    return ranking.top_n(s, [F.desc("score"), F.col("source_id")], 100)


_HOSTS = (("styfomyne.example", "Trade press"), ("jezykydel.example", "Company"), ("napezije.example", "Government"))
_PATHS = ((r"/news/|/n/", "News"), (r"/p/[a-m]", "Product page"))
_TITLES = ((r"fly ash|slag", "Material page"), (r"\bat\b", "Site page"))
_NAMES = {"news": "News", "blog": "Blog", "government": "Government", "press release": "Press release"}


@query(rf"""WITH w AS (SELECT DISTINCT web_source_id, url, page_title, source_type FROM web_stages), x AS (SELECT *, coalesce(regexp_replace(lower(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1)), '^www\.', ''), '') AS h, lower(coalesce(url, '')) AS u, lower(coalesce(page_title, '')) AS t, CASE lower(trim({_known("source_type")})) {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _NAMES.items())} END AS l FROM w),
y AS (SELECT web_source_id, CASE WHEN l IS NOT NULL THEN [l, 'label'] {" ".join(f"WHEN h = '{a}' OR ends_with(h, '.{a}') THEN ['{b}', 'host']" for a, b in sorted(_HOSTS, key=lambda x: -len(x[0])))} {" ".join(f"WHEN regexp_matches(regexp_replace(u, '^[a-z]+://[^/]*', ''), '{a}') THEN ['{b}', 'path']" for a, b in _PATHS)} {" ".join(f"WHEN regexp_matches(t, '{a}') THEN ['{b}', 'title']" for a, b in _TITLES)} WHEN regexp_matches(u, '\.pdf(?:$|[?#])') THEN ['Report', 'pdf'] ELSE ['Web page', 'default'] END AS r FROM x)
SELECT web_source_id, r[1] AS type, r[2] AS method FROM y""")
def source_types(spark, d):
    """The type of each page and how it was told: label, host, path, title, file."""
    w = table(spark, d, "web_stages").select("web_source_id", "url", "page_title", "source_type").distinct()
    return w.select("web_source_id", L.source_type(F.col("url"), F.col("page_title"), F.col("source_type"), _HOSTS, _PATHS, _TITLES, _NAMES).alias("s")).select("web_source_id", "s.*")


_REL = " + ".join(f"CASE WHEN {_phrase('plain', p)} THEN {float(w)} ELSE 0.0 END" for ts in TIERS.values() for p, w in ts.items())


@query(f"""WITH ok AS (SELECT DISTINCT 'src_' || lpad(corpus_index::VARCHAR, 10, '0') AS source_id FROM screening WHERE is_relevant AND contains(coalesce(matched_taxonomy_branches, ''), 'e')), r AS (SELECT DISTINCT source_id, lower(coalesce(title, '') || ' ' || coalesce(abstract_or_snippet, '')) AS plain, {_year("pub_year")} AS y FROM registered_sources WHERE source_id IN (SELECT source_id FROM ok)),
s AS (SELECT source_id, round({_REL} + {_sum(WIDE, "plain")}, 3)::DOUBLE AS relevance, coalesce(greatest(0.0, 10.0 - 0.4 * (2025 - y)), 0.0)::DOUBLE AS recent FROM r WHERE trim(plain) <> '' AND (NOT {_any("plain", NEGATIVE)} OR {_any("plain", ORDER["core"])}))
SELECT source_id, relevance, round(relevance + recent, 3)::DOUBLE AS rank_score FROM s WHERE relevance > 0 ORDER BY round(relevance + recent, 3) DESC, source_id LIMIT 200""")
def retrieval_chain(spark, d):
    """Screened sources, filtered by terms, scored, ranked with recency and cut to 200 (a ranked list)."""
    from ..functions.scalars import year_in
    from ..operators.scoring import lexicon_score, recency_bonus

    s = table(spark, d, "screening").where("is_relevant").where(F.coalesce("matched_taxonomy_branches", F.lit("")).contains("e"))
    ids = s.select(F.concat(F.lit("src_"), F.lpad(F.col("corpus_index").cast("string"), 10, "0")).alias("source_id"))
    r = table(spark, d, "registered_sources").select("source_id", F.lower(F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("abstract_or_snippet", F.lit("")))).alias("plain"), year_in("pub_year").alias("y")).distinct()
    r = L.drop_negative(L.within(r, "source_id", ids, "source_id").where("trim(plain) <> ''"), "plain", NEGATIVE, ORDER["core"])
    terms = {p: w for ts in TIERS.values() for p, w in ts.items()}
    r = r.withColumn("relevance", F.round(lexicon_score(F.col("plain"), terms) + L.phrase_score(F.col("plain"), WIDE)["score"], 3)).where("relevance > 0")
    r = r.select("source_id", "relevance", F.round(F.col("relevance") + recency_bonus(F.col("y"), 2025, F.lit(False)), 3).alias("rank_score"))
    return ranking.top_n(r, [F.desc("rank_score"), F.col("source_id")], 200)


_TPL = ("{company} {technology}", "{company} {project} news", "{project} commissioning {year}")


@query(f"""WITH c AS (SELECT DISTINCT record_id, trim({_known("company_or_organization")}) AS company, trim({_known("project_name")}) AS project, trim({_known("canonical_technology_name")}) AS technology, trim({_known("project_year")}) AS year FROM cementitious)
SELECT record_id, 1 AS template_no, trim(regexp_replace(company || ' ' || technology, '\\s+', ' ', 'g')) AS query FROM c WHERE company IS NOT NULL AND technology IS NOT NULL UNION ALL SELECT record_id, 2, trim(regexp_replace(company || ' ' || project || ' news', '\\s+', ' ', 'g')) FROM c WHERE company IS NOT NULL AND project IS NOT NULL UNION ALL SELECT record_id, 3, trim(regexp_replace(project || ' commissioning ' || year, '\\s+', ' ', 'g')) FROM c WHERE project IS NOT NULL AND year IS NOT NULL""")
def company_project_queries(spark, d):
    """Search queries from templates; those with a missing parameter are skipped."""
    cols = {"company": "company_or_organization", "project": "project_name", "technology": "canonical_technology_name", "year": "project_year"}
    c = table(spark, d, "cementitious").select("record_id", *[F.trim(known(v)).alias(k) for k, v in cols.items()]).distinct()
    return L.fill_templates(c, ["record_id"], _TPL, {k: F.col(k) for k in cols})


_QCR = {"no source": "NOT " + _has("source_id"), "no evidence": "NOT " + _has("evidence_text"), "value without unit": _has("compressive_strength_value") + " AND NOT " + _has("compressive_strength_unit"), "low confidence": "coalesce(lower(trim(extraction_confidence)) = 'low', false)", "no year": "NOT " + _has("project_year"), "no leaf": "NOT " + _has("taxonomy_level_3"), "marked": "coalesce(contains(lower(duplicate_status), 'duplicate'), false)"}


@query(f"""WITH q AS (SELECT DISTINCT record_id, list_filter([{", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _QCR.items())}], lambda x: x IS NOT NULL) AS r FROM cementitious) SELECT record_id, array_to_string(r, ', ') AS reasons, len(r)::INT AS n_reasons FROM q WHERE len(r) > 0""")
def review_rows(spark, d):
    """Records that need a look, with all reasons."""
    rules = {
        "no source": ~present("source_id"), "no evidence": ~present("evidence_text"), "value without unit": present("compressive_strength_value") & ~present("compressive_strength_unit"), "low confidence": F.lower(F.trim("extraction_confidence")) == "low",
        "no year": ~present("project_year"), "no leaf": ~present("taxonomy_level_3"), "marked": F.lower("duplicate_status").contains("duplicate"),
    }
    return L.qc_rows(table(spark, d, "cementitious"), "record_id", rules).distinct()
