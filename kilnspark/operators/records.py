"""Records of many fields: normalising whole rows, legacy columns, warnings by rule, identity and completeness, ordered folds."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import normalise as N
from ..functions.scalars import key_fold
from ..functions.text import known, present


def normalise(df: DataFrame, keys: Sequence[str], spec: Mapping[str, Column]) -> DataFrame:
    """``keys`` and the columns of ``spec``; a normaliser that tells what it corrected (struct value, corrected) adds to ``corrected``."""
    out = df.select(*keys, *[c.alias(n) for n, c in spec.items()])
    told = [n for n, t in out.dtypes if t.startswith("struct<value") and n in spec]
    count = sum((F.coalesce(F.col(f"{n}.corrected"), F.lit(False)).cast("int") for n in told), F.lit(0))
    return out.select(*keys, *[F.col(f"{n}.value").alias(n) if n in told else F.col(n) for n in spec], count.alias("corrected"))


def map_columns(df: DataFrame, keys: Sequence[str], names: Mapping[str, Sequence[str]]) -> DataFrame:
    """``keys`` and each new column as the first of its old ones that holds a value, trimmed; old columns that are not there are skipped."""
    have = set(df.columns)
    return df.select(*keys, *[F.coalesce(*[F.trim(known(s)) for s in old if s in have], F.lit(None).cast("string")).alias(n) for n, old in names.items()])


def duplicate_columns(headers: Sequence[str]) -> dict[str, list[str]]:
    """name -> headers that mean one column: equal but for case, or but for a number behind a dot or underscore."""
    groups: dict[str, list[str]] = {}
    for h in headers:
        groups.setdefault(re.sub(r"[._][0-9]+$", "", h.strip().lower()), []).append(h)
    return {k: v for k, v in groups.items() if len(v) > 1}


def warnings(df: DataFrame, key: str, rules: Mapping[str, Column]) -> DataFrame:
    """(key, warning): one row per record and rule that holds; NULL holds not."""
    return df.select(key, F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))).alias("warning"))


def metric_fields(df: DataFrame, dimensions: Sequence[str], aliases: Mapping[str, str], patterns: Sequence[tuple[str, str]], names: Sequence[tuple[str, str]], defaults: Mapping[str, str]) -> DataFrame:
    """Adds ``dimension``, ``unit``, ``name`` and ``energy_impact`` to metrics (metric_name, metric_value, unit, notes).

    A name that is there stays; else the first of ``names`` that name or remark match, else the default of the dimension; none without a
    value. The impact is the value, as a whole number, and the unit of energy metrics.
    """
    d = df.withColumn("dimension", N.vocabulary("metric_name", dimensions, aliases, patterns, words=False, default="Other")["value"]).withColumn("unit", N.concise("unit", 4))
    blob = F.lower(F.concat_ws(" ", F.coalesce("metric_name", F.lit("")), F.coalesce("notes", F.lit(""))))
    default = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in defaults.items() for x in kv]), F.col("dimension")), F.lit("N.A."))
    own = N.concise("metric_name")
    name = F.when(own != "N.A.", own).when(F.col("metric_value").isNull(), "N.A.").otherwise(N.first_pattern(blob, names, default))
    whole = F.concat(F.round("metric_value").cast("long").cast("string"), F.when(F.col("unit") == "N.A.", "").otherwise(F.concat(F.lit(" "), F.col("unit"))))
    return d.withColumn("name", name).withColumn("energy_impact", F.when(F.col("metric_value").isNull() | (F.col("dimension") != "Energy"), "N.A.").otherwise(F.left(whole, F.lit(60))))


def material_names(df: DataFrame, raw: str, proposed: str, overrides: Mapping[str, str]) -> DataFrame:
    """Adds ``material``, ``method`` and ``confidence``: an override of the folded raw name, the proposed name, or the raw one lightly canonical."""
    k = key_fold(raw)
    over = F.element_at(F.create_map(*[F.lit(x) for kv in overrides.items() for x in kv]), k) if overrides else F.lit(None).cast("string")
    d = df.withColumn("__over", over)
    case = lambda a, b, c, z: F.when(F.col("__over").isNotNull(), a).when(present(proposed), b).when(present(raw), c).otherwise(z)
    return d.withColumns({"material": case(F.col("__over"), F.trim(proposed), N.acronym_case(raw), F.lit("NA")), "method": case(F.lit("override"), F.lit("proposed"), F.lit("light"), F.lit("missing")), "confidence": case(F.lit("High"), F.lit("Medium"), F.lit("Low"), F.lit("NA"))}).drop("__over")


def completeness(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Adds ``missing_fields`` (in order) and ``coverage_score`` (share of fields with a value, four places)."""
    has = [present(f) for f in fields]
    missing = F.array_compact(F.array(*[F.when(~h, F.lit(f)) for f, h in zip(fields, has)]))
    return df.withColumns({"missing_fields": missing, "coverage_score": F.round(sum((h.cast("int") for h in has), F.lit(0)) / len(fields), 4)})


def record_identity(df: DataFrame, parts: Sequence[str], out: str = "identity", digits: int = 16) -> DataFrame:
    """Adds the first ``digits`` of the SHA-256 of the parts, in lower case, joined by '|'; NULLs count as ''."""
    return df.withColumn(out, F.substring(F.sha2(F.concat_ws("|", *[F.lower(F.coalesce(F.trim(p), F.lit(""))) for p in parts]), 256), 1, digits))


def union_in_order(df: DataFrame, key: str, values: str, order: str) -> DataFrame:
    """(key, position, value): the distinct texts of the array column ``values`` over all rows of a key, without regard to case and outer
    blanks, in order of first sight (by ``order``, then place in the array), in their first spelling; positions from 0.

    One row per text: the first place of each is a partial aggregation, so no group is collected. NULL and blank texts are none.
    """
    one = df.select(key, order, F.posexplode(values).alias("__at", "__v")).withColumn("__v", F.trim("__v")).where("__v <> ''")
    first = one.groupBy(key, F.lower("__v").alias("__k")).agg(F.min(F.struct(order, "__at", "__v")).alias("f"))
    place = F.row_number().over(W.partitionBy(key).orderBy(f"f.{order}", "f.__at", "f.__v"))
    return first.select(key, (place - 1).alias("position"), F.col("f.__v").alias("value"))


def union_of_items(df: DataFrame, key: str, items: str, item_key: str, order: str) -> DataFrame:
    """(key, position, item): the structs of the array column ``items`` over all rows of a key, one per ``item_key`` (any case, trimmed), the
    first by ``order`` and place; items without that key are none."""
    one = df.select(key, order, F.posexplode(items).alias("__at", "__v")).withColumn("__k", F.lower(F.trim(F.col(f"__v.{item_key}")))).where("__k <> ''")
    first = one.groupBy(key, "__k").agg(F.min(F.struct(F.col(order), F.col("__at"), F.col("__v"))).alias("f"))
    place = F.row_number().over(W.partitionBy(key).orderBy(f"f.{order}", "f.__at"))
    return first.select(key, (place - 1).alias("position"), F.col("f.__v").alias("item"))


def best_label(df: DataFrame, key: str, label: str, ranks: Mapping[str, int], default: str = "Not Reported") -> DataFrame:
    """(key, label): the label of highest rank per key; ``default`` where none is known."""
    rank = F.element_at(F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv]), F.col(label))
    best = df.groupBy(key).agg(F.max(F.when(rank.isNotNull(), F.struct(rank.alias("r"), F.col(label).alias("v"))))["v"].alias("v"))
    return best.select(key, F.coalesce("v", F.lit(default)).alias(label))


def fold(df: DataFrame, key: str, fields: Sequence[str], order: str, source: str) -> DataFrame:
    """Per key and field: what a fold over its records in ``order`` (unique) gives, one row each.

    (key, field, value, promoted, sources, conflicts): the first record is the base; a later one fills what is missing. If later records
    hold two values or more, the most frequent among them wins (``promoted``; ties: the one seen first). ``sources`` counts the later
    records that gave or agree with the kept value, ``conflicts`` those that differ. Fields without any value are left out.

    Two aggregations with partial sums on (key, field, value); nothing is collected by key.
    """
    firsts = df.groupBy(key).agg(F.min(order).alias("__base"))
    long = df.select(key, order, source, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.trim(known(f)).alias("value")) for f in fields])).alias("x")).select(key, order, source, "x.field", "x.value").where("value IS NOT NULL")
    d = long.join(firsts, key)
    later = F.col(order) != F.col("__base")
    v = d.groupBy(key, "field", "value").agg(F.min(order).alias("seen"), F.count_if(later).alias("votes"), F.min(F.when(later, F.col(order))).alias("voted"))
    g = v.groupBy(key, "field").agg(
        F.min(F.struct("seen", "value", "votes")).alias("kept"),
        F.max(F.when(F.col("votes") > 0, F.struct("votes", (-F.col("voted").cast("long")).alias("early"), "value"))).alias("top") if dict(df.dtypes)[order] in ("bigint", "int") else F.min(F.when(F.col("votes") > 0, F.struct((-F.col("votes")).alias("neg"), F.col("voted").alias("early"), "value"))).alias("top"),
        F.count_if(F.col("votes") > 0).alias("options"), F.sum("votes").alias("all"),
    )
    promoted = (F.col("options") > 1) & (F.col("top.value") != F.col("kept.value"))
    return g.select(key, "field", F.when(promoted, F.col("top.value")).otherwise(F.col("kept.value")).alias("value"), promoted.alias("promoted"), F.col("kept.votes").alias("sources"), (F.col("all") - F.col("kept.votes")).alias("conflicts"))


def candidates(df: DataFrame, name: str, source: str) -> DataFrame:
    """(name_key, n_rows, n_sources, longest): names by their folded key, with rows, distinct sources and the longest spelling (ties: the larger);
    missing names are none."""
    d = df.where(present(name))
    return d.groupBy(key_fold(name).alias("name_key")).agg(F.count("*").alias("n_rows"), F.countDistinct(source).alias("n_sources"), F.max(F.struct(F.length(name).alias("l"), F.col(name).alias("v")))["v"].alias("longest"))
