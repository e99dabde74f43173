"""Files, shards, stages and snapshots: round trips, lost and changed pieces, resuming."""

import pickle

import pytest
from pyspark.sql import functions as F

from kilnspark.sources import files, sinks, store, tables
from kilnspark.streaming import incremental


class Id:
    def __init__(self, x):
        self.x = x

    def __getstate__(self):
        return self.x

    def __setstate__(self, x):
        self.x = x


def test_small_files(spark, tmp_path):
    p = f"{tmp_path}/a/b.json"
    store.write_json(spark, p, {"b": "ü", "a": 1})
    assert store.read_json(spark, p) == {"a": 1, "b": "ü"} and store.names(spark, f"{tmp_path}/a") == ["b.json"] and store.names(spark, f"{tmp_path}/none") == []
    store.write_text(spark, p, "x")
    assert store.read_text(spark, p) == "x"
    one = store.fingerprint(spark, f"{tmp_path}/a")
    store.write_text(spark, p, "y")
    assert store.fingerprint(spark, f"{tmp_path}/a") != one


def test_records_by_ending(spark, rows, tmp_path):
    (tmp_path / "a.json").write_text('[{"x": "1"}, {"x": null}]')
    (tmp_path / "b.json").write_text('{"records": [{"x": "2"}]}')
    (tmp_path / "c.jsonl").write_text('{"type": "meta", "x": "0"}\n{"type": "row", "x": "3"}\n{"x": "4"}\n')
    (tmp_path / "d.csv").write_text("y,x\n1, 5 \n")
    got = [rows(files.read_records(spark, str(tmp_path / n), "x string")) for n in ("a.json", "b.json", "c.jsonl", "d.csv")]
    assert got[:3] == [[(None,), ("1",)], [("2",)], [("3",), ("4",)]] and got[3][0][0].strip() == "5"
    assert files.read_or_empty(spark, str(tmp_path / "none"), "x string").count() == 0
    with pytest.raises(ValueError):
        files.read_records(spark, "a.xml", "x string")
    assert files.columns_like(["SiO2 (%)", "name", "Al2O3"], ["sio2", "al2o3"]) == ["SiO2 (%)", "Al2O3"]


def test_pickle(spark, rows, tmp_path):
    (tmp_path / "p.pkl").write_bytes(pickle.dumps([{"title": "a", "id": Id("x1"), "k": ["u", 1]}, "no", {"title": None}]))
    df = files.ingest_pickle(spark, str(tmp_path / "p.pkl"), f"{tmp_path}/out", ["title", "id", "k"], rows_per_file=1)
    assert rows(df) == [(0, "a", "x1", '["u", 1]'), (1, None, None, None)]
    (tmp_path / "q.pkl").write_bytes(pickle.dumps(["no"]))
    with pytest.raises(ValueError, match="no records"):
        files.ingest_pickle(spark, str(tmp_path / "q.pkl"), f"{tmp_path}/o2", ["title"])


def test_shards(spark, rows, tmp_path):
    df, schema = spark.range(25).selectExpr("id", "concat('p', id) AS p"), "id bigint, p string"
    m = sinks.write_shards(df, f"{tmp_path}/s", "id", 10, ["p"])
    assert rows(m, "shard", "first_no", "last_no", "n") == [(0, 0, 9, 10), (1, 10, 19, 10), (2, 20, 24, 5)]
    check = lambda: rows(sinks.check_shards(spark, f"{tmp_path}/s", schema, "id", ["p"]))
    assert check() == []
    store.delete(spark, f"{tmp_path}/s/shards/shard=0")
    spark.createDataFrame([(i, "other") for i in range(10, 20)], schema).write.json(f"{tmp_path}/s/shards/shard=1", mode="overwrite")
    spark.createDataFrame([(i, None) for i in range(20, 25)], schema).write.option("ignoreNullFields", False).json(f"{tmp_path}/s/shards/shard=2", mode="overwrite")
    assert check() == [(0, "missing"), (1, "content"), (2, "required")]
    bad = sinks.check_shards(spark, f"{tmp_path}/s", schema, "id", ["p"]).where("shard < 2").select("shard")
    assert rows(sinks.missing_shards(m.select("shard"), bad, m.where("shard > 0"))) == [(0,), (1,)]


def test_exports_and_stages(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "z")], "id int, part string")
    parts = spark.createDataFrame([("a",), ("b",)], "part string")
    assert rows(sinks.export_partitions(df, f"{tmp_path}/e", "part", parts)) == [("a", 2), ("b", 0), ("rejects", 1)]
    for as_lines in (True, False):
        sinks.export_document(df, f"{tmp_path}/{as_lines}.json", as_lines)
    assert rows(files.read_documents(spark, f"{tmp_path}/False.json", "id int, part string")) == rows(df)
    ran = []
    build = lambda: ran.append(1) or df
    for version, n in (("1", 1), ("1", 1), ("2", 2)):
        out, _ = sinks.run_stage(spark, f"{tmp_path}/st", version, build)
        assert rows(out) == rows(df) and len(ran) == n


def test_snapshots_touch_only_their_buckets(spark, rows, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    order = [F.desc("score"), F.col("id")]
    go = lambda: incremental.keyed_snapshot(incremental.file_stream(spark, src, "k string, score int, id int", 1), ["k"], order, out, buckets=8).awaitTermination()
    spark.createDataFrame([(f"k{i}", i, i) for i in range(40)], "k string, score int, id int").coalesce(1).write.parquet(src)
    go()
    first = incremental._manifest(spark, out)
    spark.createDataFrame([("k3", 99, 7), ("k3", 99, 5)], "k string, score int, id int").coalesce(1).write.mode("append").parquet(src)
    go()
    second = incremental._manifest(spark, out)
    assert len(first) > 1 and sum(first[b] != second[b] for b in first) == 1
    assert incremental.snapshot(spark, out).count() == 40 and rows(incremental.snapshot(spark, out).where("k = 'k3'"), "k", "score", "id") == [("k3", 99, 5)]


def test_the_shared_folder(spark):
    assert tables.scratch(spark, "x") != tables.scratch(spark, "x") and tables.scratch(spark, "x").startswith(tables.shared_folder(spark))
