import pytest
from pyspark.sql import functions as F

from kilnspark.sources import files, sinks
from kilnspark.streaming import incremental


def test_jsonl_and_csv_round_trip(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, "a", ""), (2, 'say "x",\ny', None)], "id int, t string, e string")
    sinks.write_jsonl(df, f"{tmp_path}/j", ("type", "row"))
    assert rows(files.read_jsonl(spark, f"{tmp_path}/j", "type string, id int, t string, e string", ("type", "row")), "id", "t") == [(1, "a"), (2, 'say "x",\ny')]
    assert files.read_jsonl(spark, f"{tmp_path}/j", "type string, e string").where("e IS NOT NULL").count() == 0
    sinks.write_csv(df, f"{tmp_path}/c", ["id", "t", "extra"])
    back = files.read_csv(spark, f"{tmp_path}/c", {"name": ["T"]}, ["name"])
    assert back.columns == ["id", "name", "extra"] and back.count() == 2
    with pytest.raises(ValueError, match="missing"):
        files.read_csv(spark, f"{tmp_path}/c", required=["nope"])
    assert files.first_existing(spark, [f"{tmp_path}/nope", f"{tmp_path}/c"]) == f"{tmp_path}/c"


def test_malformed_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\nnot json\n')
    assert files.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a int", strict=False).where("a IS NOT NULL").count() == 1
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a int").collect()


def test_documents_and_trees(spark, rows, tmp_path):
    (tmp_path / "d.json").write_text('{"records": [{"a": 1}, {"a": 2}]}')
    assert rows(files.read_documents(spark, str(tmp_path / "d.json"), "a: int")) == [(1,), (2,)]
    df = spark.createDataFrame([("a/b", 1), ("a", 2), (None, 3)], "path string, id int")
    sinks.write_tree(df, f"{tmp_path}/tree", "path")
    assert rows(spark.read.parquet(f"{tmp_path}/tree").groupBy("node").count()) == [("a", 2), ("a/b", 1)]
    assert rows(files.position_slice(df, "id", 1, 3), "id") == [(1,), (2,)]


def test_keyed_snapshot_equals_batch(spark, rows, tmp_path):
    src = f"{tmp_path}/in"
    for i in range(3):
        spark.createDataFrame([("a", i, i), ("b", 5 - i, i), (f"k{i}", 1, i)], "k string, score int, id int").write.mode("append").parquet(src)
    stream = incremental.file_stream(spark, src, "k string, score int, id int", 1)
    order = [F.desc("score"), F.col("id")]
    incremental.keyed_snapshot(stream, ["k"], order, f"{tmp_path}/out").awaitTermination()
    want = [("a", 2, 2), ("b", 5, 0), ("k0", 1, 0), ("k1", 1, 1), ("k2", 1, 2)]
    assert rows(incremental.snapshot(spark, f"{tmp_path}/out")) == want
    incremental.keyed_snapshot(stream, ["k"], order, f"{tmp_path}/out").awaitTermination()  # nothing new, nothing changes
    assert rows(incremental.snapshot(spark, f"{tmp_path}/out")) == want
    assert incremental.snapshot(spark, f"{tmp_path}/none") is None


def test_append_and_windows(spark, tmp_path):
    src = f"{tmp_path}/in"
    spark.createDataFrame([("2024-01-01 00:10:00", "x"), ("2024-01-01 00:50:00", "x"), ("2024-01-01 01:10:00", "y")], "ts string, k string").select(F.to_timestamp("ts").alias("ts"), "k").write.parquet(src)
    stream = incremental.file_stream(spark, src, "ts timestamp, k string")
    incremental.append(stream, f"{tmp_path}/a", f"{tmp_path}/ac").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/a").count() == 3
    counts = incremental.windowed_counts(stream, "ts", "1 hour", "0 seconds", ["k"])
    q = counts.writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.n for r in spark.table("w").collect()) == [1, 2]
