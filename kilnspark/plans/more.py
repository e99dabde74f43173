"""Further queries of the evidence-mining operators: normalisers, spans, lookups, windows, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import normalise as N
from ..functions import scalars as S
from ..functions import spans as SP
from ..functions.text import known, present
from ..operators import matching, quality, ranking, records, taxonomy
from ..sources.tables import scratch, table
from ..streaming import incremental
from .reference import LEVELS, _fold, _has, _known, _path_sql, _year

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query(f"SELECT DISTINCT record_id, {', '.join(f"coalesce(trim({_known(c)}), 'N.A.') AS {c}" for c in ('project_name', 'country', 'doi'))} FROM cementitious")
def missing_sentinels(spark, d):
    """Three columns with one sentinel for what is missing."""
    return table(spark, d, "cementitious").select("record_id", *[S.or_sentinel(c).alias(c) for c in ("project_name", "country", "doi")]).distinct()


@query(f"""SELECT record_id, CASE WHEN regexp_matches(s, 'pilot') THEN 'Pilot' WHEN regexp_matches(s, 'demo') THEN 'Demonstration' WHEN regexp_matches(s, 'commerc|industrial') THEN 'Commercial' WHEN regexp_matches(s, '^lab') THEN 'Laboratory' ELSE 'N.A.' END AS stage, year
FROM (SELECT DISTINCT record_id, lower(trim(coalesce(deployment_stage, ''))) AS s, {_year("project_year")} AS year FROM cementitious)""")
def stage_and_year(spark, d):
    """Deployment stages in four words, project years as numbers."""
    stage = N.first_pattern(F.lower(F.trim(F.coalesce("deployment_stage", F.lit("")))), [("pilot", "Pilot"), ("demo", "Demonstration"), ("commerc|industrial", "Commercial"), ("^lab", "Laboratory")], "N.A.")
    return table(spark, d, "cementitious").select("record_id", stage.alias("stage"), S.year_in("project_year").alias("year")).distinct()


@query(r"""SELECT DISTINCT record_id, regexp_extract(v, '^[~+<> ]*(?:approx\. |ca\. |up to )?([0-9][0-9.,]*)', 1) AS number_part, trim(regexp_extract(v, '^[~+<> ]*(?:approx\. |ca\. |up to )?[0-9][0-9.,]*(?:e[+-][0-9]+)?[ ]?([^0-9 -].*)$', 1)) AS unit_part
FROM (SELECT record_id, replace(compressive_strength_value, chr(160), ' ') AS v FROM cementitious WHERE compressive_strength_value IS NOT NULL)""")
def metric_value_split(spark, d):
    """Values split into a number and a unit that trails it."""
    p = N.value_parts("compressive_strength_value")
    return table(spark, d, "cementitious").where("compressive_strength_value IS NOT NULL").select("record_id", p.alias("p")).select("record_id", "p.number_part", "p.unit_part").distinct()


_QC = {
    "no_source": f"NOT {_has('source_id')}", "no_evidence": f"NOT {_has('evidence_text')}", "no_title": f"NOT {_has('source_title')}", "no_technology": f"NOT {_has('raw_technology_name')}", "value_without_unit": f"{_has('compressive_strength_value')} AND NOT {_has('compressive_strength_unit')}",
    "low_confidence": "lower(trim(coalesce(extraction_confidence, ''))) = 'low'", "marked_duplicate": "lower(coalesce(duplicate_status, '')) LIKE '%duplicate%'",
}


@query("SELECT reason, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS reason FROM cementitious WHERE {v}" for k, v in _QC.items()) + ") GROUP BY reason")
def qc_reasons(spark, d):
    """Why records need a look, counted."""
    low = F.lower(F.trim(F.coalesce("extraction_confidence", F.lit("")))) == "low"
    tests = {
        "no_source": ~present("source_id"), "no_evidence": ~present("evidence_text"), "no_title": ~present("source_title"), "no_technology": ~present("raw_technology_name"), "value_without_unit": present("compressive_strength_value") & ~present("compressive_strength_unit"),
        "low_confidence": low, "marked_duplicate": F.lower(F.coalesce("duplicate_status", F.lit(""))).contains("duplicate"),
    }
    return records.warnings(table(spark, d, "cementitious"), "record_id", tests).groupBy(F.col("warning").alias("reason")).agg(F.count("*").alias("n"))


_TERMS = ("percent", "emissions", "replaced", "strength")


@query(f"""WITH s AS (SELECT DISTINCT record_id, evidence_text FROM cementitious), p AS (SELECT record_id, unnest(list_filter(list_transform(string_split(regexp_replace(coalesce(evidence_text, ''), '\\s+', ' ', 'g'), '. '), lambda x: trim(x)), lambda x: x <> '')) AS span, evidence_text FROM s),
q AS (SELECT record_id, span, {" + ".join(f"contains(lower(span), '{t}')::INT" for t in _TERMS)} AS score FROM p)
SELECT record_id, max(score)::INT AS score, min(span) AS span FROM (SELECT * FROM q WHERE score > 0 QUALIFY rank() OVER (PARTITION BY record_id ORDER BY score DESC) = 1) GROUP BY record_id""")
def evidence_span(spark, d):
    """The sentence that supports a record best (equal ones count once)."""
    c = table(spark, d, "cementitious").select("record_id", "evidence_text").distinct().select("record_id", SP.best_span(F.col("evidence_text"), _TERMS).alias("b")).where("b IS NOT NULL")
    return c.groupBy("record_id").agg(F.max("b.score").alias("score"), F.min("b.span").alias("span"))


@query(r"""WITH p AS (SELECT DISTINCT source_id, unnest(list_filter(list_transform(string_split(regexp_replace(coalesce(abstract_or_snippet, ''), '\s+', ' ', 'g'), '. '), lambda x: trim(x)), lambda x: x <> '')) AS span FROM registered_sources)
SELECT source_id, min(length(span))::INT AS n_chars FROM p WHERE regexp_matches(span, '(?i)[0-9] percent') GROUP BY source_id""")
def numeric_span(spark, d):
    """How long the shortest sentence with a percentage is."""
    r = table(spark, d, "registered_sources").select("source_id", SP.numeric_span(F.col("abstract_or_snippet"), "percent").alias("s")).where("s IS NOT NULL")
    return r.groupBy("source_id").agg(F.min(F.length("s")).alias("n_chars"))


@query(r"""SELECT doc_id, c::INT AS citation, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '\[([0-9]+)\]', 1)) AS c FROM documents) GROUP BY 1, 2""")
def citation_marks(spark, d):
    """Citations of each document."""
    return matching.citation_marks(table(spark, d, "documents"), "doc_id", "text")


@query(r"""WITH h AS (SELECT DISTINCT web_source_id, regexp_replace(lower(domain_host), '^www\.', '') AS host FROM web_stages)
SELECT web_source_id, host, CASE WHEN host IN ('styfomyne.example') THEN 1 WHEN host = 'example' OR host LIKE '%.example' THEN 7 END::INT AS authority FROM h""")
def host_suffix_match(spark, d):
    """Hosts ranked by the rule of their longest suffix."""
    rules = spark.createDataFrame([("styfomyne.example", 1), ("example", 7)], "suffix string, authority int")
    h = table(spark, d, "web_stages").select("web_source_id", F.regexp_replace(F.lower("domain_host"), r"^www\.", "").alias("host")).distinct()
    return matching.by_host_suffix(h, "host", rules, "suffix").select("web_source_id", "host", "authority")


@query(f"""WITH n AS (SELECT ref_id, {_fold("canonical_name")} AS k FROM canonical_names), t AS (SELECT DISTINCT metric_id, {_fold("technology_name")} AS t FROM metric_intel)
SELECT DISTINCT metric_id, ref_id FROM t JOIN n ON contains(' ' || t || ' ', ' ' || k || ' ')""")
def names_in_text(spark, d):
    """Canonical names that stand in the technology names of metrics."""
    return matching.contained_names(table(spark, d, "metric_intel").select("metric_id", "technology_name").distinct(), "metric_id", "technology_name", table(spark, d, "canonical_names"), "ref_id", "canonical_name")


@query("""SELECT date_trunc('hour', ts::TIMESTAMP) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def windowed_counts(spark, d):
    """Events per hour and type, counted by a stream with a watermark wide enough for the table's disorder."""
    folder = scratch(spark, "windows")
    schema = ", ".join(f"{n} {t}" for n, t in table(spark, d, "events").dtypes)
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = incremental.windowed_counts(stream, "ts", "1 hour", "400 days", ["event_type"])
    incremental.upsert(counts, ["window_start", "event_type"], f"{folder}/rows").awaitTermination()
    return incremental.snapshot(spark, f"{folder}/rows").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


@query("""SELECT event_type, user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY value DESC, event_id) = 1""")
def stream_ingest(spark, d):
    """The best event per user and type kept by a stream; the same as in one batch."""
    folder = scratch(spark, "snapshots")
    schema = ", ".join(f"{n} {t}" for n, t in table(spark, d, "events").dtypes)
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d).select("event_type", "user_id", "event_id", "value")
    incremental.keyed_snapshot(stream, ["event_type", "user_id"], [F.desc("value"), F.col("event_id")], folder).awaitTermination()
    return incremental.snapshot(spark, folder).select("event_type", "user_id", "event_id", "value")


@query("""SELECT paper_id FROM (SELECT paper_id FROM screening WHERE is_relevant INTERSECT SELECT paper_id FROM screening WHERE NOT is_relevant EXCEPT SELECT source_id FROM cementitious)""")
def set_operations(spark, d):
    """Papers screened as relevant once and not another time, without a record."""
    s = table(spark, d, "screening")
    both = s.where("is_relevant").select("paper_id").intersect(s.where("NOT is_relevant").select("paper_id"))
    return both.subtract(table(spark, d, "cementitious").select(F.col("source_id").alias("paper_id")))


@query(f"""SELECT column_name, lower(trim(value)) AS value, count(*) AS n FROM (SELECT * FROM (SELECT coalesce(deployment_stage, '') AS deployment_stage, coalesce(study_type, '') AS study_type, coalesce(country, '') AS country FROM cementitious) UNPIVOT (value FOR column_name IN (deployment_stage, study_type, country))) GROUP BY 1, 2""")
def unpivot_values(spark, d):
    """Values of three columns, counted in one long table."""
    cols = ["deployment_stage", "study_type", "country"]
    c = table(spark, d, "cementitious").select(*[F.coalesce(x, F.lit("")).alias(x) for x in cols])
    return c.unpivot([], cols, "column_name", "value").groupBy("column_name", F.lower(F.trim("value")).alias("value")).agg(F.count("*").alias("n"))


@query(f"""WITH c AS (SELECT DISTINCT record_id, source_id FROM cementitious), r AS (SELECT DISTINCT paper_id FROM screening)
SELECT 'records without screening' AS check_name, count(*) AS n FROM c WHERE source_id IS NOT NULL AND source_id NOT IN (SELECT paper_id FROM r WHERE paper_id IS NOT NULL) UNION ALL SELECT 'screenings without record', count(*) FROM r WHERE paper_id NOT IN (SELECT source_id FROM c WHERE source_id IS NOT NULL)
UNION ALL SELECT 'ids delivered again', count(*) FROM (SELECT record_id FROM cementitious GROUP BY 1 HAVING count(*) > 1)""")
def validation_report(spark, d):
    """Named integrity checks with the number of rows that fail."""
    raw = table(spark, d, "cementitious")
    c, r = raw.select("record_id", "source_id").distinct(), table(spark, d, "screening").select("paper_id").distinct()
    checks = {
        "records without screening": c.where("source_id IS NOT NULL").join(r, c.source_id == r.paper_id, "left_anti"),
        "screenings without record": r.where("paper_id IS NOT NULL").join(c, r.paper_id == c.source_id, "left_anti"),
        "ids delivered again": quality.duplicate_ids(raw, "record_id"),
    }
    out = None
    for name, bad in checks.items():
        one = bad.agg(F.count("*").alias("n")).select(F.lit(name).alias("check_name"), "n")
        out = one if out is None else out.unionAll(one)
    return out


@query("""WITH q AS (SELECT web_source_id, coalesce(source_type, '') AS q, row_number() OVER (PARTITION BY coalesce(source_type, '') ORDER BY authority_rank NULLS FIRST, web_source_id) AS rn FROM (SELECT DISTINCT web_source_id, source_type, authority_rank FROM web_stages))
SELECT web_source_id, q AS branch, ((rn - 1) // 25)::BIGINT AS shard_no FROM q WHERE rn <= 100""")
def extraction_plan(spark, d):
    """A hundred pages per source type, in shards of 25 (a ranked plan)."""
    w = table(spark, d, "web_stages").select("web_source_id", F.coalesce("source_type", F.lit("")).alias("branch"), "authority_rank").distinct()
    t = ranking.top_per_group(w, ["branch"], [F.asc_nulls_first("authority_rank"), F.col("web_source_id")], 100)
    return t.select("web_source_id", "branch", ranking.shard_no(F.col("rank_no") - 1, 25).alias("shard_no"))


@query(f"""SELECT DISTINCT record_id, sha256(concat_ws('|', {_fold("canonical_technology_name")}, {_fold("company_or_organization")}, {_fold("project_year")})) AS cache_key FROM cementitious""")
def cache_keys(spark, d):
    """Composite digests of records."""
    key = F.sha2(F.concat_ws("|", *[S.key_fold(c) for c in ("canonical_technology_name", "company_or_organization", "project_year")]), 256)
    return table(spark, d, "cementitious").select("record_id", key.alias("cache_key")).distinct()


@query(f"""SELECT DISTINCT discovery_record_id, coalesce({_known("proposed_canonical_name")}, {_known("raw_material_name")}, 'N.A.') AS material, CASE WHEN {_has("proposed_canonical_name")} THEN 'proposed' WHEN {_has("raw_material_name")} THEN 'raw' ELSE 'missing' END AS method FROM scm_discovery""")
def material_names(spark, d):
    """Material names by precedence, with the way they were found."""
    s = table(spark, d, "scm_discovery")
    return s.select("discovery_record_id", F.coalesce(known("proposed_canonical_name"), known("raw_material_name"), F.lit("N.A.")).alias("material"), F.when(present("proposed_canonical_name"), "proposed").when(present("raw_material_name"), "raw").otherwise("missing").alias("method")).distinct()


@query(r"""SELECT doc_kind, count(*) AS n, count(*) FILTER (text IS NULL OR regexp_matches(text, '^[ \t\r\n]*$')) AS n_blank, sum(coalesce(length(text), 0))::BIGINT AS n_chars, count(*) FILTER (n_chars IS DISTINCT FROM length(text)) AS n_off FROM documents GROUP BY 1""")
def corpus_profile(spark, d):
    """Counts, blanks, sizes and wrong sizes of the corpus by kind."""
    t = table(spark, d, "documents")
    return t.groupBy("doc_kind").agg(F.count("*").alias("n"), F.count_if(F.col("text").isNull() | F.col("text").rlike(r"^[ \t\r\n]*$")).alias("n_blank"), F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("bigint")).alias("n_chars"), F.count_if(~F.col("n_chars").eqNullSafe(F.length("text"))).alias("n_off"))


@query(f"""WITH r AS (SELECT DISTINCT record_id, ingested_at, {", ".join(f"{_has(c)} AS h_{c}" for c in ("source_id", "category", "raw_technology_name"))} FROM cementitious),
x AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY ingested_at) > 1 AS again FROM r)
SELECT CASE WHEN NOT {_has("record_id")} THEN 'missing' WHEN again OR NOT h_source_id OR NOT h_category OR NOT h_raw_technology_name THEN 'invalid' ELSE 'accepted' END AS status, count(*) AS n, count(*) FILTER (again) AS n_again FROM x GROUP BY 1""")
def validate_records(spark, d):
    """Records accepted, invalid or without an id."""
    required = ["source_id", "category", "raw_technology_name"]
    c = table(spark, d, "cementitious").select("record_id", "ingested_at", *[F.when(present(x), F.lit("x")).alias(x) for x in required]).distinct()
    v = quality.split_valid(c, "record_id", required, "ingested_at")
    return v.groupBy("status").agg(F.count("*").alias("n"), F.count_if(F.array_contains("problems", "duplicate id")).alias("n_again"))


_REQUIRED = ("source_title", "source_url", "publication_year", "retrieval_timestamp", "evidence_text")


@query("SELECT CASE " + " ".join(f"WHEN NOT {_has(c)} THEN '{c}'" for c in _REQUIRED) + " ELSE 'complete' END AS first_missing, count(*) AS n FROM cementitious GROUP BY 1")
def provenance_completeness(spark, d):
    """The first provenance field each record lacks."""
    first = F.coalesce(*[F.when(~present(c), F.lit(c)) for c in _REQUIRED], F.lit("complete"))
    return table(spark, d, "cementitious").groupBy(first.alias("first_missing")).agg(F.count("*").alias("n"))


@query(f"""SELECT {_fold("raw_material_name")} AS name_key, coalesce(trim({_known("raw_material_family")}), 'N.A.') AS family, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY {_fold("raw_material_name")}), 3)::DOUBLE AS pct FROM scm_discovery WHERE {_has("raw_material_name")} GROUP BY 1, 2""")
def name_histogram(spark, d):
    """Families of each material name, with their shares."""
    s = table(spark, d, "scm_discovery").where(present("raw_material_name"))
    g = s.groupBy(S.key_fold("raw_material_name").alias("name_key"), F.coalesce(F.trim(known("raw_material_family")), F.lit("N.A.")).alias("family")).agg(F.count("*").alias("n"))
    t = g.groupBy("name_key").agg(F.sum("n").alias("t"))
    return g.join(t, "name_key").select("name_key", "family", "n", F.round(100.0 * F.col("n") / F.col("t"), 3).alias("pct"))


_TEMPLATES = ("{name} pilot plant", "{name} emissions data", "suppliers of {name}")


@query("SELECT ref_id, t AS template_no, lower(replace(x, '{name}', canonical_name)) AS query_text FROM canonical_names, (VALUES " + ", ".join(f"({i}, '{t}')" for i, t in enumerate(_TEMPLATES, 1)) + ") AS v(t, x) WHERE list_name = 'technology' QUALIFY row_number() OVER (PARTITION BY query_text ORDER BY ref_id, t) = 1")
def query_templates(spark, d):
    """Search queries from templates, each text once."""
    n = table(spark, d, "canonical_names").where("list_name = 'technology'")
    texts = F.explode(F.array(*[F.struct(F.lit(i).alias("template_no"), F.lower(F.replace(F.lit(t), F.lit("{name}"), F.col("canonical_name"))).alias("query_text")) for i, t in enumerate(_TEMPLATES, 1)]))
    return ranking.best_per_key(n.select("ref_id", texts.alias("q")).select("ref_id", "q.*"), ["query_text"], [F.col("ref_id"), F.col("template_no")])


def _entities(x: str) -> str:
    for name, ch in (("nbsp|#160", " "), ("lt|#60", "<"), ("gt|#62", ">"), ("quot|#34", '"'), ("apos|#39", "''"), ("amp|#38", "&")):
        x = f"regexp_replace({x}, '(?i)&(?:{name});', '{ch}', 'g')"
    return x


_BARE_HTML = r"regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '(?s)<!--.*?-->', ' ', 'g'), '(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<noscript\b[^>]*>.*?</noscript\s*>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"


@query(rf"""SELECT doc_id, md5(trim(regexp_replace({_entities(_BARE_HTML)}, '[ \t\n\x0B\f\r]+', ' ', 'g'), ' ')) AS text_md5 FROM documents""")
def page_text(spark, d):
    """Texts without tags and entities, as digests."""
    return table(spark, d, "documents").select("doc_id", F.md5(S.html_text("text")).alias("text_md5"))


_NEAR = "len(list_filter(acc, lambda y: y = x[1] OR starts_with(y, x[1] || '/') OR starts_with(x[1], y || '/'))) > 0"


@query(f"""WITH p AS (SELECT source_id, {_path_sql(LEVELS)} AS path, CASE lower(trim(coalesce(taxonomy_confidence, ''))) WHEN 'high' THEN 3.0 WHEN 'medium' THEN 2.0 WHEN 'med' THEN 2.0 WHEN 'low' THEN 1.0 ELSE 0.0 END AS score FROM cementitious WHERE source_id IS NOT NULL), b AS (SELECT source_id, path, max(score) AS s FROM p WHERE path IS NOT NULL GROUP BY 1, 2),
m AS (SELECT *, max(s) OVER (PARTITION BY source_id) AS top FROM b), l AS (SELECT source_id, list([path] ORDER BY s DESC, path) AS ps FROM m WHERE s >= top - 2.0 GROUP BY 1)
SELECT source_id, list_reduce(ps, lambda acc, x: CASE WHEN len(acc) >= 3 OR {_NEAR} THEN acc ELSE list_concat(acc, x) END) AS paths FROM l""")
def greedy_paths(spark, d):
    """Up to three taxonomy paths per source, none the ancestor of another, none far below the best (an ordered fold)."""
    p = table(spark, d, "cementitious").select("source_id", taxonomy.path_of(LEVELS).alias("path"), S.label_of("taxonomy_confidence", {"high": "3", "medium": "2", "med": "2", "low": "1"}, "0").cast("double").alias("score"))
    return taxonomy.greedy_paths(p, "source_id", "path", "score")
