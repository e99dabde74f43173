"""Rows from nested payloads and back: inherited identities, fallbacks, error rows, routing, answers to questions, documents for readers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import known, present


def inherit(df: DataFrame, items: str, item: str, identity: Sequence[str], own: Sequence[str], default: str = "N.A.") -> DataFrame:
    """One row per element of the array column ``items`` with its ``position`` from 0: the first keeps all fields, later ones the ``identity``
    fields, with ``default`` for the others; a record without elements keeps one row, element NULL."""
    d = df.select(*identity, *own, F.posexplode_outer(items).alias("position", item)).withColumn("position", F.coalesce("position", F.lit(0)))
    return d.withColumns({c: F.when(F.col("position") == 0, F.col(c)).otherwise(default) for c in own})


def override(df: DataFrame, items: str, fields: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """One row per struct of the array column ``items`` (one row for none), each of ``fields`` (name -> member) from the struct where it holds a
    value, else from the record."""
    d = df.select(*keep, *[F.col(f).alias(f"__{f}") for f in fields], F.explode_outer(items).alias("__i"))
    return d.select(*keep, *[F.coalesce(F.trim(known(F.col(f"__i.{m}"))), F.col(f"__{f}")).alias(f) for f, m in fields.items()])


def with_fallback(df: DataFrame, items: str, item: str, fallback: Column, keep: Sequence[str]) -> DataFrame:
    """One row per element of ``items``; a record without any gives one row of ``fallback``; ``fallen`` tells which."""
    none = F.coalesce(F.size(items), F.lit(0)) <= 0
    return df.select(*keep, none.alias("fallen"), F.explode(F.when(none, F.array(fallback)).otherwise(F.col(items))).alias(item))


def error_rows(df: DataFrame, key: str, failed: Column, message: Column, values: Mapping[str, Column]) -> DataFrame:
    """(key, values, error): failures as rows, their values NULL and the message in ``error``; others with NULL there."""
    bad = F.coalesce(failed, F.lit(False))
    return df.select(key, *[F.when(~bad, c).alias(n) for n, c in values.items()], F.when(bad, message).alias("error"))


def route(df: DataFrame, rules: Sequence[tuple[str, Column]], default: str, out: str = "status") -> DataFrame:
    """Rows with the name of the first rule that holds, so that each goes one way and none is dropped."""
    r = F.lit(default)
    for n, c in reversed(list(rules)):
        r = F.when(F.coalesce(c, F.lit(False)), n).otherwise(r)
    return df.withColumn(out, r)


def project(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """A schema from another one: name -> column, or text that stands for a literal when it starts with '='; NULLs become ''."""
    def one(c):
        return c if isinstance(c, Column) else F.lit(c[1:]) if c.startswith("=") else F.col(c).cast("string")

    return df.select(*[F.coalesce(one(c), F.lit("")).alias(n) for n, c in columns.items()])


def record_per_path(df: DataFrame, keys: Sequence[str], paths: str, levels: int, default: str = "N.A.") -> DataFrame:
    """One row per path (array of labels) of each record, with ``path_no`` from 1 and padded level columns; the ids of later rows get '#n'."""
    d = df.select(*keys, F.posexplode(paths).alias("__p", "__l"))
    first = keys[0]
    ids = F.when(F.col("__p") == 0, F.col(first)).otherwise(F.concat(F.col(first), F.lit("#"), F.col("__p").cast("string")))
    return d.select(ids.alias("candidate_id"), *keys, (F.col("__p") + 1).alias("path_no"), *[F.coalesce(F.try_element_at("__l", F.lit(i + 1)), F.lit(default)).alias(f"level_{i + 1}") for i in range(levels)])


def answers(questions: DataFrame, given: DataFrame, by: str, default: str = "Not answered") -> DataFrame:
    """(by, place, question, answer, how): each question (by, place, question) with the first answer (by, place, question, answer) of the same
    text ('text'); questions left over take answers left over in order ('place'); the rest the default ('none')."""
    first = given.groupBy(by, "question").agg(F.min(F.struct("place", "answer")).alias("a"))
    j = questions.join(first, [by, "question"], "left")
    left_q = j.where("a IS NULL").withColumn("__n", F.row_number().over(W.partitionBy(by).orderBy("place", "question")))
    left_a = given.join(questions.select(by, "question"), [by, "question"], "left_anti").withColumn("__n", F.row_number().over(W.partitionBy(by).orderBy("place", "answer"))).select(by, "__n", F.col("answer").alias("__a"))
    gaps = left_q.join(left_a, [by, "__n"], "left").select(by, "place", "question", F.coalesce("__a", F.lit(default)).alias("answer"), F.when(F.col("__a").isNotNull(), "place").otherwise("none").alias("how"))
    return j.where("a IS NOT NULL").select(by, "place", "question", F.col("a.answer").alias("answer"), F.lit("text").alias("how")).unionAll(gaps)


def lookup_last(df: DataFrame, key: Column, table: DataFrame, table_key: Column, order: str, value: str, default: Column) -> DataFrame:
    """Rows with ``value`` of the last row by ``order`` of the same key, ``default`` where there is none."""
    t = table.groupBy(table_key.alias("__k")).agg(F.max(F.struct(order, value))[value].alias(f"__{value}"))
    return df.withColumn("__key", key).join(t, F.col("__key") == F.col("__k"), "left").withColumn(value, F.coalesce(F.col(f"__{value}"), default)).drop("__key", "__k", f"__{value}")


def planned(plan: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """Candidates in the plan with the plan's columns; planned keys without a candidate have ``lost`` TRUE."""
    c = candidates.withColumn("__c", F.lit(True))
    return plan.join(c, key, "left").withColumn("lost", F.col("__c").isNull()).drop("__c")


def label_counts(df: DataFrame, labels: Column, order: Sequence[str], flag: Column, value: Column) -> DataFrame:
    """(label, n, mean): rows of each label of an array, zeros kept, in the order given by ``place``, and the mean value of flagged rows."""
    wanted = df.sparkSession.createDataFrame([(i, x) for i, x in enumerate(order, 1)], "place int, label string")
    d = df.select(F.explode(F.array_distinct(labels)).alias("label"), F.when(flag, value).alias("v"))
    g = d.groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg("v"), 6).alias("mean"))
    return wanted.join(g, "label", "left").select("place", "label", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"), "mean")


def id_ranges(df: DataFrame, group: Sequence[str], number: str, most_runs: int = 10_000) -> DataFrame:
    """(group, ranges): the numbers of each group as '3,7,11-14', of its first ``most_runs`` runs at most, and how many more there are ('+n')."""
    from .ranking import islands, top_per_group

    r = islands(df, group, number)
    n = r.groupBy(*group).agg(F.count("*").alias("n"))
    text = F.when(F.col("first_no") == F.col("last_no"), F.col("first_no").cast("string")).otherwise(F.concat(F.col("first_no").cast("string"), F.lit("-"), F.col("last_no").cast("string")))
    first = top_per_group(r.withColumn("t", text), list(group), [F.col("first_no")], most_runs, "rn").groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("rn", "t"))).alias("a"))
    more = F.greatest(F.col("n") - most_runs, F.lit(0))
    return first.join(n, list(group)).select(*group, F.concat(F.array_join(F.col("a.t"), ","), F.when(more > 0, F.concat(F.lit(",+"), more.cast("string"))).otherwise("")).alias("ranges"))


def has_all(columns: Sequence[str]) -> Column:
    """Whether all columns hold a value."""
    out = F.lit(True)
    for c in columns:
        out = out & present(c)
    return out
