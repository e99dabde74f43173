"""Small texts and markers in any file system that Spark knows, all or nothing; fingerprints of files."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    _, p, fs = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder in order; none if there is no such folder."""
    _, p, fs = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    _, p, fs = _fs(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, whole or not at all: written beside its place, then renamed onto it."""
    jvm, p, fs = _fs(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(beside, p):
        raise OSError(f"cannot rename onto {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    jvm, p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, payload: object) -> None:
    """A small JSON document, keys in order, whole or not at all."""
    write_text(spark, path, json.dumps(payload, indent=2, sort_keys=True, ensure_ascii=False) + "\n")


def read_json(spark: SparkSession, path: str) -> object:
    return json.loads(read_text(spark, path))


def fingerprint(spark: SparkSession, path: str, edge: int = 1 << 20) -> str:
    """A digest of a file or folder: names, sizes and, of each file, its first and last ``edge`` bytes; changed content is seen without reading
    all of it, changed times are not mistaken for it."""
    jvm, p, fs = _fs(spark, path)
    digest = hashlib.sha256()
    files = []
    found = fs.listFiles(p, True)
    while found.hasNext():
        files.append(found.next())
    for f in sorted(files, key=lambda f: f.getPath().toString()):
        name, size = f.getPath().getName(), f.getLen()
        if name.startswith((".", "_")):
            continue
        digest.update(f"{name}|{size}|".encode())
        stream = fs.open(f.getPath())
        try:
            digest.update(bytes(stream.readNBytes(min(size, edge))))
            if size > edge:
                stream.seek(max(edge, size - edge))
                digest.update(bytes(stream.readNBytes(edge)))
        finally:
            stream.close()
    return digest.hexdigest()
