"""Queries that write to the shared folder and read back: sources, sinks, shards, exports, resuming; and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.text import known, present
from ..operators import integrity, payloads, taxonomy
from ..sources import files, sinks, store
from ..sources.tables import scratch, table
from ..streaming import incremental
from .book import Book
from .reference import _has, _known, _slug

book = Book()
query = book.query
QUERIES, SQL = book.queries, book.sql

_SCREEN = "screening_id bigint, shard_id bigint, paper_id string, is_relevant boolean, title string"
_COLS = ("screening_id", "shard_id", "paper_id", "is_relevant", "title")
_EMPTY = "CASE WHEN {0} <> '' THEN {0} END"


@query(f"SELECT screening_id, shard_id, {_EMPTY.format('paper_id')} AS paper_id, is_relevant, {_EMPTY.format('title')} AS title FROM screening UNION ALL SELECT count(*), -1, 'meta', NULL, 'screening_row' FROM screening")
def tagged_lines(spark, d):
    """Rows through tagged JSON lines and back, with what their meta document says of them."""
    path = scratch(spark, "tagged")
    sinks.write_tagged(table(spark, d, "screening").select(*_COLS), path, "screening_row")
    rows = files.read_jsonl(spark, f"{path}/rows.jsonl", f"type string, {_SCREEN}", ("type", "screening_row")).drop("type")
    meta = store.read_json(spark, f"{path}/meta.json")
    return rows.unionAll(spark.createDataFrame([(meta["rows"], -1, "meta", None, meta["of"])], _SCREEN))


@query("""SELECT record_id, coalesce(project_name, '') AS project_name, coalesce(notes, '') AS notes, '' AS extra, coalesce(evidence_text, '') AS evidence_text FROM cementitious""")
def csv_round_trip(spark, d):
    """Records through CSV and back: quotes, commas, line ends inside, a missing column added empty."""
    path = scratch(spark, "csv")
    sinks.write_csv(table(spark, d, "cementitious"), path, ["record_id", "project_name", "notes", "extra", "evidence_text"])
    back = files.read_csv(spark, path, required=["record_id"])
    return back.select(*[F.coalesce(c, F.lit("")).alias(c) for c in back.columns])


@query("""SELECT kind, source_id, pub_year FROM (SELECT DISTINCT source_id, CASE WHEN pub_year <> '' THEN pub_year END AS pub_year FROM registered_sources WHERE source_id IS NOT NULL), (VALUES ('csv'), ('json'), ('jsonl')) AS k(kind)""")
def records_by_format(spark, d):
    """The same records read as CSV, JSON document and JSON lines by the file's ending."""
    path = scratch(spark, "formats")
    r = table(spark, d, "registered_sources").where("source_id IS NOT NULL").select("source_id", F.when(F.col("pub_year") != "", F.col("pub_year")).alias("pub_year")).distinct()
    sinks.write_csv(r, f"{path}/a.csv")
    sinks.export_document(r.coalesce(1), f"{path}/a.json", False)
    sinks.write_jsonl(r, f"{path}/a.jsonl", ("type", "source"))
    schema = "source_id string, pub_year string"
    out = [files.read_records(spark, f"{path}/a.{k}", schema).select(F.lit(k).alias("kind"), "source_id", F.when(F.col("pub_year") != "", F.col("pub_year")).alias("pub_year")) for k in ("csv", "json", "jsonl")]
    return out[0].unionAll(out[1]).unionAll(out[2])


@query(f"""WITH r AS (SELECT DISTINCT discovery_record_id, raw_material_name, source_id FROM scm_discovery) SELECT coalesce(raw_material_name, '') AS material, coalesce(source_id, '') AS doi, discovery_record_id AS caption FROM r""")
def aliased_headers(spark, d):
    """CSV whose headers go by other names, whatever their case, with a byte-order mark in front."""
    path = scratch(spark, "aliases")
    r = table(spark, d, "scm_discovery").select("discovery_record_id", "raw_material_name", "source_id").distinct()
    sinks.write_csv(r.select(F.col("raw_material_name").alias("﻿MATERIAL NAME"), F.col("source_id").alias("Doi "), F.col("discovery_record_id").alias("Table Caption")), path)
    back = files.read_csv(spark, path, {"material": ["Material Name", "name"], "doi": ["DOI"], "caption": ["caption", "table caption"]}, required=["material"])
    return back.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("material", "doi", "caption")])


@query(f"""SELECT record_id, column_name, value FROM (SELECT DISTINCT record_id, coalesce(compressive_strength_value, '') AS compressive_strength_value, coalesce(co2_reduction_value, '') AS co2_reduction_value FROM cementitious) UNPIVOT (value FOR column_name IN (compressive_strength_value, co2_reduction_value)) WHERE value <> ''""")
def wide_columns(spark, d):
    """Columns found by what their names hold, as one long table."""
    c = table(spark, d, "cementitious")
    found = files.columns_like(c.columns, ["strengthvalue", "reductionvalue"])
    return c.select("record_id", *[F.coalesce(x, F.lit("")).alias(x) for x in found]).distinct().unpivot(["record_id"], found, "column_name", "value").where("value <> ''")


@query("""SELECT discovery_record_id AS id, source_id, NULL AS title FROM (SELECT DISTINCT discovery_record_id, source_id FROM scm_discovery WHERE source_id <> '') UNION ALL SELECT source_id, source_id, title FROM (SELECT source_id, min(title) AS title FROM registered_sources WHERE source_id <> '' AND title <> '' GROUP BY 1)""")
def mixed_tree(spark, d):
    """CSV and JSON lines below one folder as one table."""
    path = scratch(spark, "tree")
    a = table(spark, d, "scm_discovery").where("source_id <> ''").select(F.col("discovery_record_id").alias("id"), "source_id").distinct()
    b = table(spark, d, "registered_sources").where("source_id <> '' AND title <> ''").groupBy("source_id").agg(F.min("title").alias("title")).select(F.col("source_id").alias("id"), "source_id", "title")
    a.coalesce(1).write.option("header", True).csv(f"{path}/one/deep")
    b.coalesce(1).write.json(f"{path}/two")
    _rename(spark, f"{path}/two", ".json", ".jsonl")
    return files.read_tree(spark, path, "id string, source_id string, title string")


def _rename(spark, folder: str, old: str, new: str) -> None:
    jvm, p, fs = store._fs(spark, folder)
    for n in store.names(spark, folder):
        if n.endswith(old):
            fs.rename(jvm.org.apache.hadoop.fs.Path(p, n), jvm.org.apache.hadoop.fs.Path(p, n.removesuffix(old) + new))


@query("""SELECT (row_number() OVER (ORDER BY company_id) - 1)::BIGINT AS corpus_index, name AS title, to_json(associated_projects)::VARCHAR AS keywords, company_id::VARCHAR AS doi FROM (SELECT DISTINCT company_id, name, associated_projects FROM company_intel) QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY name) = 1""")
def pickled_corpus(spark, d):
    """A pickled corpus ingested once: other objects than records dropped, lists as JSON, with positions."""
    import json
    import pickle

    c = table(spark, d, "company_intel").select("company_id", "name", "associated_projects").distinct().groupBy("company_id").agg(F.min(F.struct("name", "associated_projects")).alias("x")).orderBy("company_id")
    records: list = [{"title": r[1][0], "keywords": list(r[1][1]) if r[1][1] is not None else None, "doi": r[0]} for r in c.toLocalIterator()]  # makes the file that is read; one record at a time
    path = scratch(spark, "pickle")
    blob = pickle.dumps([*records, "no record", 7], protocol=4)
    spark.createDataFrame([(bytearray(blob),)], "content binary").coalesce(1).write.parquet(f"{path}/one")
    jvm, p, fs = store._fs(spark, f"{path}/corpus.pkl")
    out = fs.create(p, True)
    out.write(bytearray(blob))
    out.close()
    back = files.ingest_pickle(spark, f"{path}/corpus.pkl", f"{path}/rows", ["title", "keywords", "doi"])
    assert json  # the reader writes lists as JSON
    return back.select("corpus_index", "title", F.regexp_replace("keywords", '", "', '","').alias("keywords"), "doi")


_SH = "SELECT DISTINCT corpus_index, paper_id, title FROM screening WHERE corpus_index IS NOT NULL QUALIFY row_number() OVER (PARTITION BY corpus_index ORDER BY paper_id, title) = 1"
_SH_SCHEMA = "corpus_index bigint, paper_id string, title string"


def _corpus(spark, d):
    return table(spark, d, "screening").where("corpus_index IS NOT NULL").groupBy("corpus_index").agg(F.min(F.struct("paper_id", "title")).alias("x")).select("corpus_index", "x.*")


@query(f"WITH s AS ({_SH}), g AS (SELECT (corpus_index // 1500)::BIGINT AS shard, min(corpus_index) AS first_no, max(corpus_index) AS last_no, count(*) AS n FROM s GROUP BY 1) SELECT *, n AS n_read FROM g")
def corpus_shards(spark, d):
    """Contiguous shards written with a manifest and read back."""
    path = scratch(spark, "shards")
    m = sinks.write_shards(_corpus(spark, d), path, "corpus_index", 1500, ["paper_id"])
    back = sinks.read_shards(spark, path, _SH_SCHEMA).groupBy("shard").agg(F.count("*").alias("n_read"))
    return m.drop("digest").join(back, "shard")


@query(f"WITH s AS ({_SH}), g AS (SELECT DISTINCT (corpus_index // 1500)::BIGINT AS shard FROM s) SELECT shard, CASE shard WHEN 1 THEN 'missing' ELSE 'rows' END AS problem FROM g WHERE shard IN (1, 2) UNION ALL SELECT shard, 'to run' FROM g WHERE shard IN (0, 1, 2)")
def shard_checks(spark, d):
    """Shards that aren't whole after one was lost and another written twice, and what is to be run again where the first isn't done either."""
    path = scratch(spark, "checks")
    m = sinks.write_shards(_corpus(spark, d), path, "corpus_index", 1500, ["paper_id"])
    store.delete(spark, f"{path}/shards/shard=1")
    sinks.read_shards(spark, path, _SH_SCHEMA, [2]).limit(1).drop("shard").write.json(f"{path}/shards/shard=2", mode="append")
    bad = sinks.check_shards(spark, path, _SH_SCHEMA, "corpus_index", ["paper_id"])
    done = m.select("shard").where("shard <> 0")
    again = sinks.missing_shards(m.select("shard"), bad.select("shard"), done)
    return bad.unionAll(again.select("shard", F.lit("to run").alias("problem")))


@query("SELECT * FROM (VALUES ('ash', 'Ashes', NULL, 1, 0), ('fly_ash', 'Fly ash', 'ash', 2, 2), ('rice_ash', 'rice_ash', 'ash', 2, 0), ('slag', 'Slags', NULL, 1, 1)) AS t(slug, display_name, parent, level, cues)")
def two_level_taxonomy(spark, d):
    """A taxonomy document of branches and leaves (rows worked out by hand)."""
    path = f"{scratch(spark, 'taxonomy')}/t.json"
    store.write_json(spark, path, {"branches": [{"slug": "ash", "display_name": "Ashes", "leaves": [{"slug": "fly_ash", "display_name": "Fly ash", "cues": ["pfa", "class f"]}, {"slug": "rice_ash"}]}, {"slug": "slag", "display_name": "Slags", "cues": ["ggbs"]}]})
    return files.read_two_levels(spark, path).withColumn("cues", F.size("cues"))


@query("SELECT * FROM (VALUES ('all', NULL, 0, 'Everything'), ('all/binders', 'all', 1, 'Binders'), ('all/binders/ash', 'all/binders', 2, 'Ash'), ('all/binders/clay', 'all/binders', 2, 'clay'), ('all/kilns', 'all', 1, 'Kilns')) AS t(node, parent, level, label)")
def nested_taxonomy(spark, d):
    """A tree document of several levels, as paths (rows worked out by hand)."""
    path = f"{scratch(spark, 'tree')}/t.json"
    store.write_json(spark, path, {"slug": "all", "label": "Everything", "children": [{"slug": "kilns", "label": "Kilns"}, {"slug": "binders", "label": "Binders", "children": [{"slug": "clay"}, {"slug": "ash", "label": "Ash", "aliases": ["pfa"]}]}]})
    return files.read_nested_tree(spark, path).drop("aliases")


@query("""SELECT DISTINCT raw_material_family, CASE lower(trim(raw_material_family)) WHEN 'glass' THEN 'Glass powder' WHEN 'filler' THEN 'Inert filler' ELSE raw_material_family END AS family FROM scm_discovery""")
def alias_file(spark, d):
    """Names by an alias file; a file that isn't there has none."""
    path = f"{scratch(spark, 'aliases')}/a.json"
    store.write_json(spark, path, {" Glass": "Glass powder", "FILLER ": "Inert filler", "empty": ""})
    m = {**files.read_aliases(spark, path), **files.read_aliases(spark, path + ".none")}
    of = F.element_at(F.create_map(*[F.lit(x) for kv in m.items() for x in kv]), F.lower(F.trim("raw_material_family")))
    return table(spark, d, "scm_discovery").select("raw_material_family", F.coalesce(of, "raw_material_family").alias("family")).distinct()


@query("""WITH t AS (SELECT event_type AS stage, (event_id % 8)::INT AS shard_id, max(value) AS peak FROM events WHERE value IS NOT NULL GROUP BY 1, 2) SELECT stage, shard_id, round(peak, 3) AS peak_mb, (CASE WHEN shard_id % 2 = 0 THEN 4.0 ELSE 2.0 END * 1024)::DOUBLE AS requested_mb, round(100 * peak / (CASE WHEN shard_id % 2 = 0 THEN 4.0 ELSE 2.0 END * 1024), 1) AS utilisation FROM t""")
def telemetry_rows(spark, d):
    """Telemetry documents with requests of their own or of their stage, and the utilisation."""
    path = scratch(spark, "telemetry")
    t = table(spark, d, "events").where("value IS NOT NULL").groupBy(F.col("event_type").alias("stage"), (F.col("event_id") % 8).cast("int").alias("shard_id")).agg(F.max("value").alias("peak_rss_mb"))
    t.withColumn("requested_mem_gb", F.when(F.col("shard_id") % 2 == 0, 4.0)).write.json(path)
    limits = {r[0]: 2.0 for r in t.select("stage").distinct().collect()}  # stages are configuration
    return files.telemetry(spark, path, limits, lines=True)


@query("""SELECT 'relevant' AS kind, paper_id AS value FROM (SELECT DISTINCT paper_id FROM screening WHERE is_relevant AND paper_id <> '') UNION ALL SELECT 'meta', count(*)::VARCHAR FROM screening""")
def screening_file(spark, d):
    """A screening file with meta and result rows split, and the relevant papers of it."""
    path = scratch(spark, "screening")
    s = table(spark, d, "screening").select(F.lit("result").alias("type"), "paper_id", "is_relevant", F.lit(None).cast("bigint").alias("n"))
    meta = s.agg(F.count("*").alias("n")).select(F.lit("meta").alias("type"), F.lit(None).cast("string").alias("paper_id"), F.lit(None).cast("boolean").alias("is_relevant"), "n")
    s.unionAll(meta).write.option("ignoreNullFields", False).json(path)
    m, rows = files.split_meta(files.read_jsonl(spark, path, "type string, paper_id string, is_relevant boolean, n bigint"))
    return rows.where("is_relevant AND paper_id <> ''").select(F.lit("relevant").alias("kind"), F.col("paper_id").alias("value")).distinct().unionAll(m.select(F.lit("meta"), F.col("n").cast("string")))


@query("""SELECT company_id, name, len(associated_projects)::INT AS n_projects FROM (SELECT DISTINCT company_id, name, associated_projects FROM company_intel WHERE name IS NOT NULL)""")
def document_database(spark, d):
    """Nested records written as one JSON document per task and read back."""
    path = f"{scratch(spark, 'database')}/db.json"
    sinks.export_document(table(spark, d, "company_intel").where("name IS NOT NULL").select("company_id", "name", "associated_projects").distinct(), path, False)
    back = files.read_documents(spark, path, "company_id bigint, name string, associated_projects array<string>")
    return back.select("company_id", "name", F.size("associated_projects").alias("n_projects"))


_PARTS = f"{_slug(_known('taxonomy_level_1'))}"


@query(f"""WITH k AS (SELECT DISTINCT {_PARTS} AS part FROM cementitious WHERE {_has("taxonomy_level_1")} AND taxonomy_level_1 <> 'L1-04' UNION SELECT 'no_such_branch'), r AS (SELECT {_PARTS} AS part FROM cementitious)
SELECT part, (SELECT count(*) FROM r WHERE r.part = k.part) AS n FROM k UNION ALL SELECT 'rejects', count(*) FROM r WHERE part NOT IN (SELECT part FROM k)""")
def exported_partitions(spark, d):
    """Records exported by branch: empty branches in the summary, rows of unknown branches to the rejects."""
    c = table(spark, d, "cementitious").select("record_id", S.slug(known("taxonomy_level_1")).alias("part"), "project_name")
    parts = c.where("part <> '' AND part <> 'l1_04'").select("part").union(spark.createDataFrame([("no_such_branch",)], "part string")).distinct()
    return sinks.export_partitions(c, scratch(spark, "partitions"), "part", parts)


@query(f"""WITH r AS (SELECT DISTINCT record_id, coalesce(trim({_known("taxonomy_level_1")}), 'unassigned') AS branch, coalesce(trim({_known("taxonomy_level_2")}), 'unassigned') AS leaf FROM cementitious) SELECT branch, leaf, count(*) AS n, 'same' AS against_master FROM r GROUP BY 1, 2""")
def user_export(spark, d):
    """A nested export by branch and leaf with unassigned rows apart, checked against the master as a multiset."""
    path = scratch(spark, "export")
    r = table(spark, d, "cementitious").select("record_id", F.coalesce(F.trim(known("taxonomy_level_1")), F.lit("unassigned")).alias("branch"), F.coalesce(F.trim(known("taxonomy_level_2")), F.lit("unassigned")).alias("leaf")).distinct()
    sinks.write_partitions(r, path, ["branch", "leaf"])
    back = spark.read.schema("record_id string, branch string, leaf string").parquet(path)
    off = integrity.multiset_difference(r, back, ["record_id", "branch", "leaf"]).agg(F.count("*").alias("off"))
    n = back.groupBy("branch", "leaf").agg(F.count("*").alias("n"))
    return n.crossJoin(F.broadcast(off)).select("branch", "leaf", "n", F.when(F.col("off") == 0, "same").otherwise("different").alias("against_master"))


@query("""WITH r AS (SELECT DISTINCT record_id, taxonomy_level_1 AS a, taxonomy_level_2 AS b FROM cementitious WHERE taxonomy_level_1 LIKE 'L1%' AND taxonomy_level_2 LIKE 'L2%'), p AS (SELECT record_id, lower(replace(a, '-', '_')) AS x, lower(replace(a, '-', '_')) || '/' || lower(replace(b, '-', '_')) AS y FROM r)
SELECT node, count(*) AS n FROM (SELECT x AS node FROM p UNION ALL SELECT y FROM p) GROUP BY 1""")
def hierarchical_export(spark, d):
    """Every row under each node of its path, written by node and counted back."""
    path = scratch(spark, "hierarchy")
    c = table(spark, d, "cementitious").where("taxonomy_level_1 LIKE 'L1%' AND taxonomy_level_2 LIKE 'L2%'").select("record_id", taxonomy.path_of(["taxonomy_level_1", "taxonomy_level_2"]).alias("p")).distinct()
    sinks.write_tree(c, path, "p")
    return spark.read.schema("record_id string, p string, node string").parquet(path).groupBy("node").agg(F.count("*").alias("n"))


@query("""WITH r AS (SELECT DISTINCT record_id, evidence_origin, project_name FROM cementitious) SELECT 'literature' AS part, count(*) FILTER (evidence_origin = 'Literature') AS n FROM r UNION ALL SELECT 'web', count(*) FILTER (evidence_origin = 'Web') FROM r UNION ALL SELECT 'merged', count(*) FROM r WHERE evidence_origin IN ('Literature', 'Web') UNION ALL SELECT 'merged again', count(*) FROM r WHERE evidence_origin IN ('Literature', 'Web')""")
def merged_exports(spark, d):
    """Both origins exported, merged, read again and merged again: the counters of each step."""
    path = scratch(spark, "merged")
    c = table(spark, d, "cementitious").select("record_id", "evidence_origin", "project_name").distinct()
    for o in ("Literature", "Web"):
        c.where(F.col("evidence_origin") == o).write.parquet(f"{path}/{o.lower()}")
    read = lambda: spark.read.parquet(f"{path}/literature").unionByName(spark.read.parquet(f"{path}/web"))
    read().write.parquet(f"{path}/merged")
    again = spark.read.parquet(f"{path}/merged").unionByName(read()).distinct()
    parts = {"literature": spark.read.parquet(f"{path}/literature"), "web": spark.read.parquet(f"{path}/web"), "merged": spark.read.parquet(f"{path}/merged"), "merged again": again}
    out = None
    for n, p in parts.items():
        one = p.agg(F.count("*").alias("n")).select(F.lit(n).alias("part"), "n")
        out = one if out is None else out.unionAll(one)
    return out


@query(f"SELECT record_id AS id, 'no source' AS warning FROM (SELECT DISTINCT record_id FROM cementitious WHERE NOT {_has('source_title')}) UNION ALL SELECT source_id, 'no year' FROM (SELECT DISTINCT source_id FROM registered_sources WHERE NOT {_has('pub_year')})")
def appended_warnings(spark, d):
    """Warnings of two runs appended to one log."""
    path = scratch(spark, "warnings")
    sinks.append_rows(table(spark, d, "cementitious").where(~present("source_title")).select(F.col("record_id").alias("id"), F.lit("no source").alias("warning")).distinct(), path)
    sinks.append_rows(table(spark, d, "registered_sources").where(~present("pub_year")).select(F.col("source_id").alias("id"), F.lit("no year").alias("warning")).distinct(), path)
    return files.read_jsonl(spark, path, "id string, warning string")


@query("""SELECT * FROM (VALUES (1, true, 'v1'), (2, false, 'v1'), (3, true, 'v2'), (4, true, 'v2'), (5, false, 'v2')) AS t(step, ran, version), (SELECT count(DISTINCT record_id) AS n FROM cementitious)""")
def resumed_stages(spark, d):
    """A stage run, resumed, run in another version, run again after its marker was lost, resumed: when it ran, and that its rows are the same."""
    path, out = scratch(spark, "stage"), []
    build = lambda: table(spark, d, "cementitious").select("record_id").distinct()
    for step, (version, lose) in enumerate([("v1", False), ("v1", False), ("v2", False), ("v2", True), ("v2", False)], 1):
        if lose:
            store.delete(spark, f"{path}/stage.json")
        rows, ran = sinks.run_stage(spark, path, version, build)
        out.append((step, ran, version, rows.count()))
    return spark.createDataFrame(out, "step int, ran boolean, version string, n bigint")


@query("SELECT shard_id, count(*) AS n FROM (SELECT DISTINCT shard_id, corpus_index, paper_id FROM screening WHERE is_relevant AND shard_id IS NOT NULL) GROUP BY 1")
def resumed_screening(spark, d):
    """Screening results appended by a stream that is stopped and started again: each row once, then counted per shard."""
    path = scratch(spark, "resume")
    s = table(spark, d, "screening").where("is_relevant AND shard_id IS NOT NULL").select("shard_id", "corpus_index", "paper_id").distinct()
    s.where("shard_id % 2 = 0").write.parquet(f"{path}/in")
    schema = ", ".join(f"{n} {t}" for n, t in s.dtypes)
    go = lambda: incremental.append(incremental.file_stream(spark, f"{path}/in", schema), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    go()
    s.where("shard_id % 2 <> 0").write.mode("append").parquet(f"{path}/in")
    go()
    return spark.read.schema(schema).parquet(f"{path}/out").groupBy("shard_id").agg(F.count("*").alias("n"))


@query("SELECT 'same' AS untouched, 'other' AS grown, true AS same_length")
def fingerprints(spark, d):
    """Fingerprints of a folder: the same for the same files, another one when rows are added."""
    path = scratch(spark, "print")
    one = table(spark, d, "region")
    one.coalesce(1).write.parquet(path)
    a, b = store.fingerprint(spark, path), store.fingerprint(spark, path)
    one.coalesce(1).write.mode("append").parquet(path)
    c = store.fingerprint(spark, path)
    return spark.createDataFrame([("same" if a == b else "other", "same" if a == c else "other", len(a) == len(c))], "untouched string, grown string, same_length boolean")


@query("""WITH r AS (SELECT DISTINCT discovery_record_id, source_id, evidence FROM (SELECT discovery_record_id, source_id, supporting_evidence AS evidence FROM scm_discovery)) SELECT source_id, count(*) AS n, count(*) FILTER (coalesce(lower(trim(evidence)), '') IN ('', 'n.a.', 'na', 'n/a', 'not reported', 'unknown', 'not available')) AS without FROM r GROUP BY 1""")
def first_file_there(spark, d):
    """The first of several masters that is there, read by its source."""
    path = scratch(spark, "masters")
    table(spark, d, "scm_discovery").select("discovery_record_id", "source_id", F.col("supporting_evidence").alias("evidence")).distinct().write.parquet(f"{path}/second")
    found = files.first_existing(spark, [f"{path}/first", f"{path}/second", f"{path}/third"])
    return spark.read.parquet(found).groupBy("source_id").agg(F.count("*").alias("n"), F.count_if(~present("evidence")).alias("without"))


@query("SELECT corpus_index, paper_id FROM (" + _SH + ") WHERE corpus_index >= 1000 AND corpus_index < 2500")
def position_slice(spark, d):
    """A slice of positions; the range reaches the scan of what was written in order."""
    path = scratch(spark, "slice")
    _corpus(spark, d).repartitionByRange("corpus_index").sortWithinPartitions("corpus_index").write.parquet(path)
    return files.position_slice(spark.read.parquet(path), "corpus_index", 1000, 2500).select("corpus_index", "paper_id")


@query(f"""SELECT evidence_origin, status, count(*) AS n FROM (SELECT DISTINCT record_id, evidence_origin, CASE WHEN NOT {_has("source_id")} OR NOT {_has("evidence_text")} THEN 'no evidence' WHEN {_has("duplicate_status")} AND lower(duplicate_status) LIKE '%duplicate%' THEN 'duplicate' WHEN lower(trim(coalesce(extraction_confidence, ''))) = 'low' THEN 'review' ELSE 'kept' END AS status FROM cementitious) GROUP BY 1, 2""")
def staged_pipeline(spark, d):
    """Normalised, routed and flagged records through stages that keep their tables, counted."""
    path = scratch(spark, "pipeline")
    low = F.lower(F.trim(F.coalesce("extraction_confidence", F.lit("")))) == "low"
    rules = [("no evidence", ~present("source_id") | ~present("evidence_text")), ("duplicate", present("duplicate_status") & F.lower("duplicate_status").contains("duplicate")), ("review", low)]
    one, _ = sinks.run_stage(spark, f"{path}/1", "1", lambda: table(spark, d, "cementitious").select("record_id", "evidence_origin", "source_id", "evidence_text", "duplicate_status", "extraction_confidence").distinct())
    two, _ = sinks.run_stage(spark, f"{path}/2", "1", lambda: payloads.route(one, rules, "kept").select("record_id", "evidence_origin", "status").distinct())
    return two.groupBy("evidence_origin", "status").agg(F.count("*").alias("n"))
