"""Consolidating records of one thing: ordered folds, votes, fills from siblings, links between origins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import known, present


def consolidate(df: DataFrame, key: str, fields: Sequence[str], order: str) -> DataFrame:
    """One row per key: per field the first known value by ``order``, ``<field>_conflict`` whether others differ, and ``n_rows``.

    Uses min over (order, value) structs, so the aggregation is partial in the map tasks and no group is collected.
    """
    aggs = [F.count("*").alias("n_rows")]
    for f in fields:
        v = F.trim(known(f))
        aggs += [F.min(F.when(v.isNotNull(), F.struct(F.col(order), v.alias("v"))))["v"].alias(f), (F.min(F.lower(v)) != F.max(F.lower(v))).alias(f"{f}_conflict")]
    return df.groupBy(key).agg(*aggs).select(key, *fields, *[F.coalesce(F.col(f"{f}_conflict"), F.lit(False)).alias(f"{f}_conflict") for f in fields], "n_rows")


def majority(df: DataFrame, key: str, field: str) -> DataFrame:
    """(key, field, votes): the most frequent known value; ties go to the smaller value."""
    votes = df.where(present(field)).select(key, F.trim(field).alias(field)).groupBy(key, field).agg(F.count("*").alias("votes"))
    w = W.partitionBy(key).orderBy(F.desc("votes"), field)
    return votes.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def sibling_fill(df: DataFrame, context: Sequence[Column], fields: Sequence[str], order: str, marker: str = "filled") -> DataFrame:
    """Missing fields take the first known value by ``order`` among rows of the same context; ``filled`` counts them.

    The donors are one row per context from a partial aggregation; rows with a missing context part keep their gaps.
    """
    ctx = [f"__c{i}" for i in range(len(context))]
    d = df.withColumns({n: c for n, c in zip(ctx, context)})
    donors = d.where(" AND ".join(f"{n} IS NOT NULL" for n in ctx)).groupBy(*ctx).agg(*[F.min(F.when(present(f), F.struct(F.col(order), F.trim(f).alias("v"))))["v"].alias(f"__d_{f}") for f in fields])
    j = d.join(donors, ctx, "left")
    n = sum((((~present(f)) & F.col(f"__d_{f}").isNotNull()).cast("int") for f in fields), F.lit(0))
    j = j.withColumn(marker, n)
    for f in fields:
        j = j.withColumn(f, F.coalesce(F.trim(known(f)), F.col(f"__d_{f}")))
    return j.drop(*ctx, *[f"__d_{f}" for f in fields])


def link(left: DataFrame, right: DataFrame, rules: Sequence[tuple[str, str, float]], left_id: str, right_id: str, veto: Column, block: int = 10_000) -> DataFrame:
    """(left_id, right_id, rule, score): rows of both sides that share a rule's key, the best rule of each pair; ``veto`` drops pairs.

    ``rules`` are (name, key column on both sides, score); a NULL or '' key never links. Columns of the right side carry the
    prefix r_. Repeated rows are dropped on both sides before the join, so they link once. A key that many rows of both sides share is spread:
    the left side goes to one of ceil(rows of the key / ``block``) salts, the right side to all of them.
    """
    left, right = left.distinct(), right.distinct()
    r = right.select([F.col(c).alias(f"r_{c}") for c in right.columns])
    out = None
    for name, key, score in rules:
        keyed = left.where((F.col(key).isNotNull()) & (F.col(key) != ""))
        hot = keyed.groupBy(F.col(key).alias("__k")).agg(F.ceil(F.count("*") / block).cast("int").alias("__n")).where("__n > 1")
        a = keyed.join(hot, F.col(key) == F.col("__k"), "left").withColumn("__salt", F.pmod(F.xxhash64(left_id), F.coalesce("__n", F.lit(1))).cast("int")).drop("__k", "__n")
        b = r.join(hot, F.col(f"r_{key}") == F.col("__k"), "left").withColumn("__rsalt", F.explode(F.sequence(F.lit(0), F.coalesce("__n", F.lit(1)) - 1))).drop("__k", "__n")
        p = a.join(b, (F.col(key) == F.col(f"r_{key}")) & (F.col("__salt") == F.col("__rsalt")))
        p = p.where(~F.coalesce(veto, F.lit(False))).select(left_id, f"r_{right_id}", F.lit(name).alias("rule"), F.lit(score).alias("score"))
        out = p if out is None else out.unionAll(p)
    best = out.groupBy(left_id, f"r_{right_id}").agg(F.max(F.struct("score", "rule")).alias("b"))
    return best.select(left_id, F.col(f"r_{right_id}").alias(right_id), F.col("b.rule").alias("rule"), F.col("b.score").alias("score"))


def link_with_classes(left: DataFrame, right: DataFrame, pair_key: str, class_key: Sequence[str], left_id: str, right_id: str, veto: Column, pair: tuple[str, float], shared: tuple[str, float]) -> DataFrame:
    """(left_id, rule, score, right_id, *class_key, n_right): what each left row is linked with; a left row without a link gives one row of NULLs.

    ``pair`` (rule, score): one row per pair of equal ``pair_key`` unless ``veto`` holds; columns of the right side carry the prefix r_. ``shared``
    (rule, score): rows of equal ``class_key`` link all with all, so such a class comes out as its key and the number of right ids in it;
    :func:`class_members` has the ids. A pair under both rules stands in both. NULL keys never link; right rows without an id link nothing,
    left rows without one count as one of id ''. Repeated rows link once.
    """
    left = left.withColumn(left_id, F.coalesce(left_id, F.lit(""))).distinct()
    right = right.where(F.coalesce(F.col(right_id), F.lit("")) != "").distinct()
    r = right.select([F.col(c).alias(f"r_{c}") for c in right.columns])
    types = dict(left.dtypes)
    none = [F.lit(None).cast(types[c]).alias(c) for c in class_key]
    pairs = left.join(r, F.col(pair_key) == F.col(f"r_{pair_key}")).where(~F.coalesce(veto, F.lit(False)))
    pairs = pairs.select(left_id, F.lit(pair[0]).alias("rule"), F.lit(pair[1]).alias("score"), F.col(f"r_{right_id}").alias(right_id), *none, F.lit(None).cast("bigint").alias("n_right")).distinct()
    sizes = right.where(" AND ".join(f"`{c}` IS NOT NULL" for c in class_key)).groupBy(*class_key).agg(F.countDistinct(right_id).alias("n_right"))
    classes = left.select(left_id, *class_key).distinct().join(sizes, list(class_key))
    classes = classes.select(left_id, F.lit(shared[0]).alias("rule"), F.lit(shared[1]).alias("score"), F.lit(None).cast(dict(right.dtypes)[right_id]).alias(right_id), *class_key, "n_right")
    return left.select(left_id).distinct().join(pairs.unionAll(classes), left_id, "left")


def class_members(left: DataFrame, right: DataFrame, class_key: Sequence[str], left_id: str, right_id: str) -> DataFrame:
    """(*class_key, origin, id): the 'left' and 'right' ids of each class that has both; NULL keys and right rows without an id are in none."""
    whole = " AND ".join(f"`{c}` IS NOT NULL" for c in class_key)
    a = left.where(whole).select(*class_key, F.lit("left").alias("origin"), F.coalesce(left_id, F.lit("")).alias("id"))
    b = right.where(whole).where(F.coalesce(F.col(right_id), F.lit("")) != "").select(*class_key, F.lit("right").alias("origin"), F.col(right_id).alias("id"))
    both = a.select(*class_key).distinct().join(b.select(*class_key).distinct(), list(class_key))
    return a.unionAll(b).distinct().join(both, list(class_key), "left_semi")


def compatible_fill(df: DataFrame, key: Sequence[str], constraints: Sequence[str], fields: Sequence[str], order: str, id_column: str) -> DataFrame:
    """(id_column, fields, filled): missing fields from the first other row by ``order`` (unique) of the same key that holds them and does not
    contradict the row's ``constraints`` (a missing one agrees with any); ``filled`` counts them.

    Rows whose first key part is missing keep their gaps; other missing parts match each other. Filled values are not constraints for
    later fills. No row meets another: donors are aggregated under every choice of constraint values and wild cards, and a row looks under
    the 2^n keys that agree with it, so a hot key costs 2^n rows a task.
    """
    from itertools import product

    norm = lambda c: F.lower(F.trim(F.coalesce(known(c), F.lit(""))))
    d = df.select(id_column, order, *[norm(k).alias(f"__k{i}") for i, k in enumerate(key)], *[norm(c).alias(f"__c{i}") for i, c in enumerate(constraints)], *[F.trim(known(f)).alias(f) for f in fields])
    ks = [f"__k{i}" for i in range(len(key))]
    keyed = d.where("__k0 <> ''")
    wild = F.explode(F.array(*[F.struct(*[(F.lit("*") if w else F.col(f"__c{i}")).alias(f"__w{i}") for i, w in enumerate(ws)]) for ws in product((False, True), repeat=len(constraints))]))
    ws = [f"__w{i}" for i in range(len(constraints))]
    # NULL stands for no donor; a row's own values never fill its own gaps, so it needs no exclusion
    donors = keyed.select(*ks, order, *fields, wild.alias("__x")).select(*ks, "__x.*", order, *fields).groupBy(*ks, *ws).agg(*[F.min(F.when(F.col(f).isNotNull(), F.struct(F.col(order).alias("o"), F.col(f).alias("v")))).alias(f"__d_{f}") for f in fields])
    look = F.explode(F.array_distinct(F.array(*[F.struct(*[F.when(F.col(f"__c{i}") == "", "*").otherwise(F.col(f"__c{i}") if own else F.lit("")).alias(f"__w{i}") for i, own in enumerate(pick)]) for pick in product((True, False), repeat=len(constraints))])))
    gaps = keyed.where(" OR ".join(f"`{f}` IS NULL" for f in fields))
    got = gaps.select(id_column, *ks, look.alias("__x")).select(id_column, *ks, "__x.*").join(donors, [*ks, *ws]).groupBy(id_column).agg(*[F.min(f"__d_{f}")["v"].alias(f"__g_{f}") for f in fields])
    j = d.join(got, id_column, "left")
    n = sum(((F.col(f).isNull() & F.col(f"__g_{f}").isNotNull()).cast("int") for f in fields), F.lit(0))
    return j.select(id_column, *[F.coalesce(f, f"__g_{f}").alias(f) for f in fields], n.alias("filled"))
