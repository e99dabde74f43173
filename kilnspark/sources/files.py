"""Readers of the pipeline's files: tagged JSON lines, all-string CSV with header aliases, JSON documents of records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str, tag: tuple[str, str] | None = None, strict: bool = True) -> DataFrame:
    """JSON lines by a schema; a malformed line is an error, or a row of NULLs if not ``strict``. ``tag`` keeps rows of one type."""
    df = spark.read.schema(schema).option("mode", "FAILFAST" if strict else "PERMISSIVE").json(path)
    return df.where(F.col(tag[0]) == tag[1]) if tag else df


def read_csv(spark: SparkSession, path: str | list[str], aliases: Mapping[str, Sequence[str]] | None = None, required: Sequence[str] = (), recursive: bool = False) -> DataFrame:
    """CSV with a header, all columns strings. ``aliases`` renames headers (any letter case, byte-order mark dropped) to the names
    given; a missing ``required`` column is an error."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("recursiveFileLookup", recursive).csv(path)
    df = df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])
    have = {c.lower(): c for c in df.columns}
    for target, names in (aliases or {}).items():
        source = next((have[n.lower()] for n in (target, *names) if n.lower() in have), None)
        if source and source != target:
            df = df.withColumnRenamed(source, target)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return df


def read_documents(spark: SparkSession, path: str, schema: str, records: str = "records") -> DataFrame:
    """JSON documents that hold a list of records; one row per record, documents without any give none."""
    doc = spark.read.schema(f"{records} array<struct<{schema}>>").option("multiLine", True).json(path)
    return doc.select(F.explode(records).alias("r")).select("r.*")


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str | None:
    """The first of several paths that exists, in any file system that Spark knows."""
    conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(conf).exists(path):
            return p
    return None


def position_slice(df: DataFrame, position: str, start: int, end: int) -> DataFrame:
    """Rows of positions from ``start`` up to ``end``; the filter reaches the scan."""
    return df.where((F.col(position) >= start) & (F.col(position) < end))


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, malformed ones as NULLs; no rows where the path isn't there."""
    from .store import exists

    return read_jsonl(spark, path, schema, strict=False) if exists(spark, path) else spark.createDataFrame([], schema)


def read_records(spark: SparkSession, path: str, schema: str, records: str = "records") -> DataFrame:
    """Records of a file by its ending: .csv, .jsonl (rows tagged 'meta' are left out) or .json (a list, or a document that holds one)."""
    columns = spark.createDataFrame([], schema).columns
    kind = path.rstrip("/").rpartition(".")[2].lower()
    if kind == "csv":
        df = read_csv(spark, path)
        return df.select(*[(F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c) for c in columns])
    if kind == "jsonl":
        df = spark.read.schema(f"type string, {schema}").json(path)
        return df.where(F.coalesce("type", F.lit("")) != "meta").select(*columns)
    if kind == "json":
        text = spark.read.text(path, wholetext=True).select(F.trim("value").alias("v"))
        inner = f"array<struct<{schema}>>"
        rows = F.when(F.col("v").startswith("["), F.from_json("v", inner)).otherwise(F.from_json("v", f"struct<{records}:{inner}>")[records])
        return text.select(F.explode(rows).alias("r")).select("r.*")
    raise ValueError(f"no reader for .{kind}")


def read_tree(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All CSV and JSON-lines files below a folder as one table; columns that a file lacks are NULL."""
    columns = spark.createDataFrame([], schema).columns
    options = {"recursiveFileLookup": True}
    csv = spark.read.options(**options, header=True, multiLine=True, escape='"', pathGlobFilter="*.csv").csv(folder)
    lines = spark.read.schema(schema).options(**options, pathGlobFilter="*.jsonl").json(folder)
    csv = csv.select(*[(F.col(c) if c in csv.columns else F.lit(None).cast("string")).alias(c) for c in columns])
    return csv.unionByName(lines)


def columns_like(columns: Sequence[str], hints: Sequence[str]) -> list[str]:
    """The columns whose name, letters and digits only, holds one of the hints."""
    plain = {c: "".join(ch for ch in c.lower() if ch.isalnum()) for c in columns}
    return [c for c in columns if any(h in plain[c] for h in hints)]


def split_meta(df: DataFrame, tag: str = "type", meta: str = "meta") -> tuple[DataFrame, DataFrame]:
    """The meta rows and the others of tagged rows."""
    is_meta = F.coalesce(F.col(tag), F.lit("")) == meta
    return df.where(is_meta), df.where(~is_meta)


def read_two_levels(spark: SparkSession, path: str) -> DataFrame:
    """(slug, display_name, parent, level, cues): a taxonomy document of branches with leaves ({branches: [{slug, display_name, cues, leaves: [...]}]});
    a configuration file, read on the driver. A slug that stands twice, or an entry without one, is an error."""
    from .store import read_json

    doc, rows, seen = read_json(spark, path), [], set()
    for b in doc["branches"]:
        for e, parent, level in [(b, None, 1), *((x, b.get("slug"), 2) for x in b.get("leaves", []))]:
            slug = e.get("slug")
            if not slug or slug in seen:
                raise ValueError(f"slug missing or used twice: {slug!r}")
            seen.add(slug)
            rows.append((slug, e.get("display_name", slug), parent, level, list(e.get("cues", []))))
    return spark.createDataFrame(rows, "slug string, display_name string, parent string, level int, cues array<string>")


def read_nested_tree(spark: SparkSession, path: str) -> DataFrame:
    """(node, parent, level, label, aliases): a tree document of any depth ({slug, label, aliases, children: [...]}), levels from 0, children in
    order of their slugs; a configuration file, read on the driver."""
    from .store import read_json

    rows, todo = [], [(read_json(spark, path), None, 0)]
    while todo:
        n, parent, level = todo.pop()
        node = n["slug"] if parent is None else f"{parent}/{n['slug']}"
        rows.append((node, parent, level, n.get("label", n["slug"]), list(n.get("aliases", []))))
        todo.extend((c, node, level + 1) for c in sorted(n.get("children", []), key=lambda c: c["slug"], reverse=True))
    return spark.createDataFrame(rows, "node string, parent string, level int, label string, aliases array<string>")


def read_aliases(spark: SparkSession, path: str) -> dict[str, str]:
    """A JSON object of texts as alias -> name, aliases trimmed and in lower case; {} where the file isn't there."""
    from .store import exists, read_json

    return {str(k).strip().lower(): str(v) for k, v in read_json(spark, path).items() if v} if exists(spark, path) else {}


def ingest_pickle(spark: SparkSession, path: str, out: str, columns: Sequence[str], rows_per_file: int = 50_000) -> DataFrame:
    """A pickled list (or dict) of records written as Parquet once, columns as texts (lists and dicts as JSON), with ``corpus_index``.

    A pickle is one object and can only be read whole, on the driver: this is the way in for such files, not a source of queries. Only
    plain data are built; instances of any class come out as their state's text, and no code of the file runs. Bytes of old pickles are read as
    Latin-1. Records that are no dicts are dropped; none left is an error.
    """
    import io
    import json
    import pickle

    class State:
        def __init__(self, *args):
            self.value = args[0] if args else ""

        def __setstate__(self, state):
            self.value = state

        def __str__(self):
            v = self.value
            return v.hex() if isinstance(v, bytes) else str(v)

    class Plain(pickle.Unpickler):
        def find_class(self, module, name):
            return State

    raw = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    for encoding in ("ASCII", "latin1", "bytes"):
        try:
            data = Plain(io.BytesIO(raw), encoding=encoding).load()
            break
        except UnicodeDecodeError:
            continue
    key = lambda r, c: r.get(c, r.get(c.encode()))
    text = lambda v: None if v is None else v.decode("latin1") if isinstance(v, bytes) else v if isinstance(v, str) else json.dumps(v, default=str, ensure_ascii=False) if isinstance(v, (list, dict)) else str(v)
    records = [r for r in (data.values() if isinstance(data, dict) else data) if isinstance(r, dict)]
    if not records:
        raise ValueError("no records")
    schema = "corpus_index bigint, " + ", ".join(f"`{c}` string" for c in columns)
    for at in range(0, len(records), rows_per_file):
        part = [(i, *(text(key(r, c)) for c in columns)) for i, r in enumerate(records[at : at + rows_per_file], at)]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append" if at else "overwrite").parquet(out)
    return spark.read.schema(schema).parquet(out)


def telemetry(spark: SparkSession, paths: str | Sequence[str], limits: Mapping[str, float], lines: bool = False) -> DataFrame:
    """(stage, shard_id, peak_mb, requested_mb, utilisation): telemetry documents that hold a peak; a request that is missing comes from ``limits`` of
    the stage; utilisation in percent, one place. A file holds one document, or one a line."""
    schema = "stage string, shard_id int, peak_rss_bytes bigint, peak_rss_mb double, requested_mem_gb double"
    t = spark.read.schema(schema).option("multiLine", not lines).json(paths if isinstance(paths, str) else list(paths))
    peak = F.coalesce("peak_rss_mb", F.col("peak_rss_bytes") / 1048576)
    of_stage = F.element_at(F.create_map(*[F.lit(x) for kv in limits.items() for x in kv]), F.col("stage"))
    asked = F.coalesce("requested_mem_gb", of_stage) * 1024
    return t.where(peak.isNotNull()).select("stage", "shard_id", F.round(peak, 3).alias("peak_mb"), asked.alias("requested_mb"), F.round(100 * peak / asked, 1).alias("utilisation"))
