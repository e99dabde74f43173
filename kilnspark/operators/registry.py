"""A registry of sources: stable ids, citation tokens in texts, what was cited, what wasn't, and what no source answers to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import key_fold
from ..sources.tables import checkpointed

#: How sources are cited: pattern with the number as its group, and the type of source meant. An id of its own form comes first.
PATTERNS = ((r"\b(?:paper|source)[ _-]?([0-9]+)\b", "paper"), (r"\[p?[ _-]?([0-9]+)\]", "paper"), (r"\bweb[ _-]?([0-9]+)\b", "web"), (r"\[web[ _-]?([0-9]+)\]", "web"))
_CUT = "\u0001"


def ordinals(df: DataFrame, group: str, order: Sequence[str], out: str = "ordinal") -> DataFrame:
    """Adds the place of each row in its group by ``order`` (unique), from 1, without sorting a group in one task.

    Rows are range-partitioned by group and order and written down once; each part counts on from the parts before it.
    """
    d = checkpointed(df.repartitionByRange(group, *order).withColumn("__part", F.spark_partition_id()))
    n = d.groupBy(group, "__part").agg(F.count("*").alias("__n"))
    before = n.withColumn("__before", F.coalesce(F.sum("__n").over(W.partitionBy(group).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    d = d.withColumn("__at", F.row_number().over(W.partitionBy(group, "__part").orderBy(*order)))
    return d.join(before, [group, "__part"]).withColumn(out, (F.col("__at") + F.col("__before")).cast("int")).drop("__part", "__at", "__before")


def stable_id(kind: Column, ordinal: Column) -> Column:
    """'paper_001': type and ordinal of three digits or more."""
    n = ordinal.cast("string")
    return F.concat(kind, F.lit("_"), F.when(F.length(n) < 3, F.lpad(n, 3, "0")).otherwise(n))


def register(df: DataFrame, key: str, kind: str) -> DataFrame:
    """Adds ``stable_id`` to sources (one row a key): numbered per type in order of their keys."""
    return ordinals(df, kind, [key]).withColumn("stable_id", stable_id(F.col(kind), F.col("ordinal")))


def token_id(token: Column) -> Column:
    """The stable id that a citation token means; NULL if none."""
    t = F.lower(F.trim(token))
    out = F.lit(None).cast("string")
    for p, kind in reversed(PATTERNS):
        n = F.regexp_extract(t, p, 1)
        out = F.when(n != "", stable_id(F.lit(kind), n.try_cast("bigint"))).otherwise(out)
    own = F.regexp_extract(t, r"^(paper|web)_([0-9]{3,})$", 1)
    return F.when(own != "", stable_id(own, F.regexp_extract(t, r"^(paper|web)_([0-9]{3,})$", 2).try_cast("bigint"))).otherwise(out)


_TOKEN = r"(?i)(\[(?:p|web)?[ _-]?[0-9]+\]|\b(?:paper|source|web)[ _-]?[0-9]+\b)"


def tokens(text: Column) -> Column:
    """The citation tokens of a text in order, as written."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_TOKEN), F.lit(1))


def cited_ids(record: Column) -> Column:
    """The distinct stable ids that stand anywhere in a record (a struct, array or text), in order of the alphabet."""
    text = F.lower(F.to_json(F.struct(record.alias("r"))))
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"\b((?:paper|web)_[0-9]{3,})\b"), F.lit(1)), token_id)))


def citations(df: DataFrame, key: str, text: str, sources: DataFrame) -> DataFrame:
    """(key, token, stable_id, matched): each distinct citation token of a text, the id it means and whether a source has it."""
    t = df.select(key, F.explode(F.array_distinct(tokens(F.col(text)))).alias("token")).withColumn("stable_id", token_id(F.col("token")))
    return t.join(sources.select("stable_id", F.lit(True).alias("__m")), "stable_id", "left").select(key, "token", "stable_id", F.coalesce("__m", F.lit(False)).alias("matched"))


def unmatched(cited: DataFrame, sources: DataFrame) -> DataFrame:
    """Citation tokens without a source, each once (an anti-join)."""
    return cited.where("stable_id IS NOT NULL").join(sources, "stable_id", "left_anti").select("token").distinct()


def rewrite(df: DataFrame, key: str, text: str, sources: DataFrame, marker: str = "Unmatched source reference") -> DataFrame:
    """(key, text, unmatched): texts with each citation token as '[stable id]' where a source has that id, and ``marker`` elsewhere; how many
    went unmatched. Texts without tokens stay as they are; NULL gives NULL and 0.

    Only ids that a text cites and sources have come back to it, a set bounded by the text.
    """
    d = df.select(key, text)
    has = citations(d, key, text, sources).where("matched").groupBy(key).agg(F.collect_set("stable_id").alias("__ids"))
    j = d.join(has, key, "left").withColumn("__ids", F.coalesce("__ids", F.array().cast("array<string>")))
    pieces = F.split(F.regexp_replace(text, _TOKEN, f"{_CUT}$1{_CUT}"), _CUT)  # tokens stand at odd places
    done = F.transform(pieces, lambda p, i: F.when(i % 2 == 0, p).when(F.array_contains(F.col("__ids"), token_id(p)), F.concat(F.lit("["), token_id(p), F.lit("]"))).otherwise(marker))
    lost = F.size(F.filter(pieces, lambda p, i: (i % 2 == 1) & ~F.coalesce(F.array_contains(F.col("__ids"), token_id(p)), F.lit(False))))
    return j.select(key, F.array_join(done, "").alias(text), F.when(F.col(text).isNull(), 0).otherwise(lost).alias("unmatched"))


def bibliography(sources: DataFrame, cited: DataFrame) -> DataFrame:
    """``sources`` with ``used``: whether any citation names them."""
    c = cited.select("stable_id").where("stable_id IS NOT NULL").distinct().withColumn("__u", F.lit(True))
    return sources.join(c, "stable_id", "left").withColumn("used", F.coalesce("__u", F.lit(False))).drop("__u")


def overlay(df: DataFrame, id_column: str, sources: DataFrame, columns: Sequence[str], warning: str = "warning") -> DataFrame:
    """Rows with the registered values of ``columns`` laid over their own where the id has a source; ``warning`` names ids without one."""
    s = sources.select(F.col("stable_id").alias("__id"), *[F.col(c).alias(f"__{c}") for c in columns])
    j = df.join(s, df[id_column] == s["__id"], "left")
    j = j.withColumns({c: F.coalesce(F.col(f"__{c}"), F.col(c)) for c in columns})
    return j.withColumn(warning, F.when(F.col(id_column).isNotNull() & F.col("__id").isNull(), F.concat(F.lit("no source: "), F.col(id_column)))).drop("__id", *[f"__{c}" for c in columns])


def by_mention(texts: DataFrame, key: str, text: str, sources: DataFrame, source_key: str, title: str, url: str, doi: str) -> DataFrame:
    """(key, source_key, how): the first source (by key) that a text mentions by URL, DOI or whole title, in this order of trust.

    URLs and DOIs are cut out of the text and met by equality; titles meet runs of as many words as they have. No text is compared with
    every source.
    """
    from .matching import contained_names

    urls = texts.select(key, F.explode(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(https?://[^\s\"'<>)]+)"), F.lit(1))).alias("m")).withColumn("m", F.regexp_replace("m", "[.,;/]+$", ""))
    dois = texts.select(key, F.explode(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"\b(10\.[0-9]{4,}/[^\s\"'<>;]+)"), F.lit(1))).alias("m")).withColumn("m", F.regexp_replace("m", "[.,;)]+$", ""))
    s = sources.select(source_key, F.regexp_replace(F.lower(F.trim(url)), "/+$", "").alias("u"), F.lower(F.trim(doi)).alias("d"), title)
    hit = urls.join(s.where("u <> ''"), F.col("m") == F.col("u")).select(key, source_key, F.lit(1).alias("r"))
    hit = hit.unionAll(dois.join(s.where("d <> ''"), F.col("m") == F.col("d")).select(key, source_key, F.lit(2).alias("r")))
    long = s.where(F.size(F.split(key_fold(title), " ")) >= 3)
    hit = hit.unionAll(contained_names(texts, key, text, long, source_key, title).select(key, source_key, F.lit(3).alias("r")))
    best = hit.groupBy(key).agg(F.min(F.struct("r", source_key)).alias("b"))
    return best.select(key, F.col(f"b.{source_key}").alias(source_key), F.element_at(F.array(*[F.lit(x) for x in ("url", "doi", "title")]), F.col("b.r")).alias("how"))
