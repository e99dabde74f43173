"""Incremental ingest by Structured Streaming: keyed snapshots, windows with late data, resumable appends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ranking import best_per_key
from ..sources import store


def file_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100, fmt: str = "parquet") -> DataFrame:
    """A stream over the files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(path)


def upsert(stream: DataFrame, keys: Sequence[str], folder: str, buckets: int = 16) -> StreamingQuery:
    """Keeps the latest row per key of a stream in update mode (counts of windows that still change), as :func:`keyed_snapshot` keeps the best."""
    return keyed_snapshot(stream, keys, [F.desc("__batch")], folder, buckets, update=True)


def keyed_snapshot(stream: DataFrame, keys: Sequence[str], order: Sequence[Column], folder: str, buckets: int = 16, keep: int = 2, update: bool = False) -> StreamingQuery:
    """Keeps the best row per key under ``folder``, until all there is has been read.

    Keys are hashed into ``buckets``; a batch reads and writes again only the buckets its keys fall into, so its work grows with what it
    touches. Each batch writes its buckets as a version and then a manifest that names the version of every bucket; readers follow the last
    manifest. A batch that is run again gives the same files; the order must be total. Versions that none of the last ``keep``
    manifests names are removed.
    """
    spark = stream.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        batch = batch.withColumn("__batch", F.lit(number).cast("bigint")) if update else batch
        hashed = batch.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        fresh = best_per_key(hashed, keys, order).persist()
        try:
            touched = sorted(r[0] for r in fresh.select("bucket").distinct().collect())  # at most as many as there are buckets
            before = _manifest(spark, folder, number)
            at = {b: before[b] for b in touched if b in before}
            rows = fresh
            if at:
                old = spark.read.parquet(*[f"{folder}/v{v}/bucket={b}" for b, v in sorted(at.items())])  # the folder's column is worked out again
                rows = fresh.unionByName(old.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")))
            if touched:
                best_per_key(rows, keys, order).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/v{number}")
            store.write_json(spark, f"{folder}/manifests/{number}.json", {**{str(b): v for b, v in before.items()}, **{str(b): number for b in touched}})
        finally:
            fresh.unpersist()
        _sweep(spark, folder, keep)

    writer = stream.writeStream.outputMode("update") if update else stream.writeStream
    return writer.foreachBatch(merge).option("checkpointLocation", f"{folder}/_checkpoint").trigger(availableNow=True).start()


def _manifest(spark: SparkSession, folder: str, before: int | None = None) -> dict[int, int]:
    """bucket -> version of the last manifest (before a batch number)."""
    done = [int(n[:-5]) for n in store.names(spark, f"{folder}/manifests") if n[:-5].isdigit()]
    done = [n for n in done if before is None or n < before]
    return {int(b): v for b, v in store.read_json(spark, f"{folder}/manifests/{max(done)}.json").items()} if done else {}


def _sweep(spark: SparkSession, folder: str, keep: int) -> None:
    """Removes versions that none of the last ``keep`` manifests names."""
    done = sorted(int(n[:-5]) for n in store.names(spark, f"{folder}/manifests") if n[:-5].isdigit())
    named = {v for n in done[-keep:] for v in store.read_json(spark, f"{folder}/manifests/{n}.json").values()}
    for n in store.names(spark, folder):
        if n[:1] == "v" and n[1:].isdigit() and int(n[1:]) not in named and int(n[1:]) <= done[-1]:
            store.delete(spark, f"{folder}/{n}")


def snapshot(spark: SparkSession, folder: str) -> DataFrame | None:
    """The last complete snapshot; None if there is none."""
    at = _manifest(spark, folder)
    return spark.read.parquet(*[f"{folder}/v{v}/bucket={b}" for b, v in sorted(at.items())]) if at else None


def windowed_counts(stream: DataFrame, time: str, window: str, late: str, by: Sequence[str]) -> DataFrame:
    """Counts per window and columns; rows later than ``late`` behind the newest are dropped, as a watermark does."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window), *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("window_start"), *by, "n")


def append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends a stream's rows as Parquet, each once across restarts."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
