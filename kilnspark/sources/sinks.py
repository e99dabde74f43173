"""Writers of the pipeline's files. Spark's committer makes each write all or nothing; _SUCCESS marks completion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, tag: tuple[str, str] | None = None, mode: str = "overwrite") -> None:
    """JSON lines; empty texts become null, nulls are written; ``tag`` adds a type column."""
    out = df.select(*[F.when(F.col(c) != "", F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])
    out = out.select(F.lit(tag[1]).alias(tag[0]), "*") if tag else out
    out.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, mode: str = "overwrite") -> None:
    """CSV with a header; columns that are missing are added empty, NULLs are written empty."""
    columns = list(columns or df.columns)
    have = set(df.columns)
    out = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in have else F.lit("").alias(c) for c in columns])
    out.write.mode(mode).options(header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)  # blanks are data


def write_partitions(df: DataFrame, path: str, keys: Sequence[str], max_rows: int = 1_000_000, mode: str = "overwrite") -> None:
    """Parquet by partition keys (slugs), clustered on them first so a task writes few files; a hot key is spread by size.

    AQE splits the rebalanced partitions, and ``max_rows`` bounds a file.
    """
    df.hint("rebalance", *[F.col(k) for k in keys]).write.mode(mode).partitionBy(*keys).option("maxRecordsPerFile", max_rows).parquet(path)


def write_tree(df: DataFrame, path: str, node_path: str, mode: str = "overwrite") -> None:
    """Every row under each node of its path (rollup by prefix), partitioned by node."""
    from ..operators.taxonomy import ancestors

    out = df.where(F.col(node_path).isNotNull()).withColumn("node", F.explode(ancestors(F.col(node_path))))
    write_partitions(out, path, ["node"], mode=mode)


def write_tagged(df: DataFrame, path: str, tag: str) -> None:
    """JSON lines of one type below ``path``, with a meta document (type, columns, rows) beside them; rows are counted while they are written."""
    from .store import write_json

    spark = df.sparkSession
    write_jsonl(df, f"{path}/rows.jsonl", ("type", tag))
    n = spark.read.text(f"{path}/rows.jsonl").count()
    write_json(spark, f"{path}/meta.json", {"type": "meta", "of": tag, "columns": df.columns, "rows": n})


def write_shards(df: DataFrame, path: str, position: str, size: int, required: Sequence[str]) -> DataFrame:
    """Contiguous shards of ``size`` positions as JSON lines (shard=n folders), and their manifest: (shard, first_no, last_no, n, digest).

    Rows are ranged by position first, so a task writes whole shards. The manifest is written as a table when all shards are; it tells what
    must be there.
    """
    shard = F.floor(F.col(position) / size).cast("bigint")
    d = df.withColumn("shard", shard)
    d.repartitionByRange(F.col(position)).sortWithinPartitions(position).write.mode("overwrite").partitionBy("shard").option("ignoreNullFields", False).json(f"{path}/shards")
    manifest = d.groupBy("shard").agg(F.min(position).alias("first_no"), F.max(position).alias("last_no"), F.count("*").alias("n"), F.bit_xor(F.xxhash64(*[F.col(c).cast("string") for c in (position, *required)])).alias("digest"))
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")
    return df.sparkSession.read.parquet(f"{path}/manifest")


def read_shards(spark: SparkSession, path: str, schema: str, shards: Sequence[int] | None = None) -> DataFrame:
    """Rows of the shards, or of some of them: the others' folders are not opened."""
    d = spark.read.schema(f"{schema}, shard bigint").option("mode", "FAILFAST").json(f"{path}/shards")
    return d if shards is None else d.where(F.col("shard").isin(*shards))


def check_shards(spark: SparkSession, path: str, schema: str, position: str, required: Sequence[str]) -> DataFrame:
    """(shard, problem): shards of the manifest that aren't whole: 'missing', 'rows' (another number), 'content' (another digest), 'required' (a
    required column is missing in a row). One scan and one join."""
    want = spark.read.parquet(f"{path}/manifest").select("shard", F.col("n").alias("want"), F.col("digest").alias("wanted"))
    lacks = F.lit(False)
    for c in required:
        lacks = lacks | F.col(c).isNull()
    have = read_shards(spark, path, schema).groupBy("shard").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(*[F.col(c).cast("string") for c in (position, *required)])).alias("digest"), F.count_if(lacks).alias("lacks"))
    j = want.join(have, "shard", "left")
    problem = F.when(F.col("n").isNull(), "missing").when(F.col("n") != F.col("want"), "rows").when(F.col("lacks") > 0, "required").when(F.col("digest") != F.col("wanted"), "content")
    return j.select("shard", problem.alias("problem")).where("problem IS NOT NULL")


def missing_shards(planned: DataFrame, invalid: DataFrame, done: DataFrame, shard: str = "shard") -> DataFrame:
    """Planned shards that aren't done, or are and aren't valid (anti-joins): what is to be run again."""
    ok = done.select(shard).distinct().join(invalid.select(shard), shard, "left_anti")
    return planned.select(shard).distinct().join(ok, shard, "left_anti")


def export_partitions(df: DataFrame, path: str, part: str, known_parts: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Rows by partition, those of unknown partitions to ``rejects``, and a summary (part, n) with every known partition, empty ones too.

    ``known_parts`` has the column ``part``. The summary is read back from what was written.
    """
    spark = df.sparkSession
    known_ = known_parts.select(part).distinct()
    good = df.join(known_, part, "left_semi")
    write_partitions(good, f"{path}/parts", [part], max_rows)
    df.join(known_, part, "left_anti").write.mode("overwrite").parquet(f"{path}/rejects")
    kind = df.schema[part].dataType.simpleString()
    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes if n != part) + f", `{part}` {kind}"
    n = spark.read.schema(schema).parquet(f"{path}/parts").groupBy(part).agg(F.count("*").alias("n"))
    rejects = spark.read.parquet(f"{path}/rejects").agg(F.count("*").alias("n")).select(F.lit("rejects").alias(part), "n")
    summary = known_.join(n, part, "left").select(F.col(part).cast("string").alias(part), F.coalesce("n", F.lit(0).cast("bigint")).alias("n")).unionAll(rejects)
    summary.coalesce(1).write.mode("overwrite").parquet(f"{path}/summary")
    return spark.read.parquet(f"{path}/summary")


def export_document(df: DataFrame, path: str, as_lines: bool) -> None:
    """Records as JSON lines, or as JSON documents {records: [...]} of one task each (:func:`~kilnspark.sources.files.read_records` reads both)."""
    if as_lines:
        df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
        return
    cols = df.columns
    body = df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("j"))

    def whole(batches):
        import pandas as pd

        first = True
        for b in batches:
            for x in b["j"]:
                yield pd.DataFrame({"line": [('{"records": [' if first else ",") + x]})
                first = False
        if not first:
            yield pd.DataFrame({"line": ["]}"]})

    body.mapInPandas(whole, "line string").write.mode("overwrite").text(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Rows added to a table of JSON lines; earlier ones stay."""
    df.write.mode("append").option("ignoreNullFields", False).json(path)


def run_stage(spark: SparkSession, path: str, version: str, build, force: bool = False) -> tuple[DataFrame, bool]:
    """(table, ran): the table of a stage, built by ``build()`` and written unless a whole one of this version is there already.

    A stage is complete if its marker names the version and the table's committer finished; anything less is built again.
    """
    from . import store

    marker, rows = f"{path}/stage.json", f"{path}/rows"
    done = store.exists(spark, marker) and store.exists(spark, f"{rows}/_SUCCESS") and store.read_json(spark, marker).get("version") == version
    if done and not force:
        return spark.read.parquet(rows), False
    build().write.mode("overwrite").parquet(rows)
    store.write_json(spark, marker, {"version": version})
    return spark.read.parquet(rows), True
