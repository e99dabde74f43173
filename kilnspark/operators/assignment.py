"""Assigning records to a tree: lookups by label, slug and alias, loose children, padded paths, checks of assignments and of the tree itself.

A tree is a table (node, parent, level, label, aliases): node is the path of slugs, parent the path above it (NULL for a root).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import key_fold, slug
from ..functions.text import known, present

NA = "N.A."


def tree_of(df: DataFrame, levels: Sequence[str], aliases: str | None = None) -> DataFrame:
    """The tree that rows' label columns make: one row a node, its label (the least of several spellings) and its aliases, if a column has them."""
    labels = [F.trim(known(c)) for c in levels]
    rows = None
    for i in range(len(levels)):
        whole = labels[0].isNotNull()
        for x in labels[1 : i + 1]:
            whole = whole & x.isNotNull()
        path = F.array_join(F.array(*[slug(x) for x in labels[: i + 1]]), "/")
        up = F.array_join(F.array(*[slug(x) for x in labels[:i]]), "/") if i else F.lit(None).cast("string")
        alias = F.col(aliases) if aliases and i == len(levels) - 1 else F.array().cast("array<string>")
        one = df.where(whole).select(path.alias("node"), up.alias("parent"), F.lit(i + 1).alias("level"), labels[i].alias("label"), alias.alias("aliases"))
        rows = one if rows is None else rows.unionAll(one)
    return rows.groupBy("node", "parent", "level").agg(F.min("label").alias("label"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("aliases")))).alias("aliases"))


def ordered(tree: DataFrame) -> DataFrame:
    """Nodes with their place by level, then path, from 1. The tree is configuration, so one sort is enough."""
    return tree.withColumn("place", F.row_number().over(W.orderBy("level", "node")))


def children(tree: DataFrame) -> DataFrame:
    """(parent, place, node, label): the children of each node in order of their paths, places from 1."""
    return tree.where("parent IS NOT NULL").select("parent", F.row_number().over(W.partitionBy("parent").orderBy("node")).alias("place"), "node", "label")


def roles(tree: DataFrame, leaf_level: int) -> DataFrame:
    """Adds ``role``: 'leaf' at ``leaf_level``, 'end' one above it without children, 'parent' with, 'branch' further up; and whether the node is
    searched (leaf or end)."""
    has = tree.where("parent IS NOT NULL").select(F.col("parent").alias("node"), F.lit(True).alias("__has")).distinct()
    j = tree.join(has, "node", "left")
    role = F.when(F.col("level") == leaf_level, "leaf").when(F.col("level") == leaf_level - 1, F.when(F.col("__has"), "parent").otherwise("end")).otherwise("branch")
    return j.withColumn("role", role).withColumn("searched", F.col("role").isin("leaf", "end")).drop("__has")


def keys_of(tree: DataFrame) -> DataFrame:
    """(parent, key, node): each node under the folded forms of its label, its slug and its aliases; the first node by path of equal ones."""
    own = F.element_at(F.split("node", "/"), -1)
    k = tree.select("parent", "node", F.explode(F.array_distinct(F.concat(F.array(key_fold("label"), key_fold(F.regexp_replace(own, "_", " "))), F.transform("aliases", lambda a: key_fold(a))))).alias("key"))
    return k.where("key <> ''").groupBy("parent", "key").agg(F.min("node").alias("node"))


def find_child(df: DataFrame, parent: str, text: str, tree: DataFrame, out: str = "child") -> DataFrame:
    """Adds ``out``: the child of the node ``parent`` that a text names by label, slug or alias, whatever the case and marks; NULL if none."""
    k = keys_of(tree).select(F.col("parent").alias("__p"), F.col("key").alias("__k"), F.col("node").alias(out))
    return df.join(k, (df[parent] == F.col("__p")) & (key_fold(text) == F.col("__k")), "left").drop("__p", "__k")


def match_child(df: DataFrame, key: str, parent: str, text: str, tree: DataFrame, out: str = "child") -> DataFrame:
    """(key, out): for rows with a known text, the child it names, else the first child by path one of whose forms holds the text or is held by it.

    Rows meet only the children of their own node, whose number the tree bounds; distinct (parent, text) pairs are matched once.
    """
    want = df.where(present(text) & F.col(parent).isNotNull()).select(F.col(parent).alias("parent"), F.lower(F.trim(text)).alias("__t")).distinct()
    exact = find_child(want, "parent", "__t", tree, "__exact")
    forms = tree.where("parent IS NOT NULL").select(F.col("parent").alias("__p"), "node", F.explode(F.concat(F.array(F.lower("label"), F.element_at(F.split("node", "/"), -1)), F.transform("aliases", lambda a: F.lower(a)))).alias("f"))
    loose = exact.where("__exact IS NULL").join(forms, F.col("parent") == F.col("__p")).where(F.contains("__t", F.col("f")) | F.contains("f", F.col("__t"))).groupBy("parent", "__t").agg(F.min("node").alias("__loose"))
    m = exact.join(loose, ["parent", "__t"], "left").select(F.col("parent").alias("__mp"), F.col("__t").alias("__mt"), F.coalesce("__exact", "__loose").alias(out))
    return df.join(m, (F.col(parent) == F.col("__mp")) & (F.lower(F.trim(text)) == F.col("__mt"))).select(key, out)


def apply_path(df: DataFrame, key: str, leaf: str, variant: str, mapping: DataFrame, tree: DataFrame) -> DataFrame:
    """(key, level_2, level_3, level_4): labels of each row from its leaf's ``mapping`` (leaf, level_2, level_3, node); level 4 is the child of the
    mapped node that the row's variant names, exactly or loosely; what is unknown is 'N.A.'."""
    j = df.select(key, F.col(leaf).alias("__l"), F.col(variant).alias("__v")).join(mapping.select(F.col("leaf").alias("__l"), "level_2", "level_3", "node"), "__l", "left")
    child = match_child(j, key, "node", "__v", tree, "__c").join(tree.select(F.col("node").alias("__c"), F.col("label").alias("__label")), "__c").groupBy(key).agg(F.min("__label").alias("level_4"))
    return j.join(child, key, "left").select(key, *[F.coalesce(c, F.lit(NA)).alias(c) for c in ("level_2", "level_3", "level_4")])


def reverse_path(nodes: DataFrame, mapping: DataFrame) -> DataFrame:
    """(node, leaf): the leaf that maps onto each node (node, level_3, level_4): the first mapping (leaf, level_3, level_4, place) of the same
    level 4, else the last one of the same level 3."""
    n, m = nodes.select("node", F.col("level_3").alias("__3"), F.col("level_4").alias("__4")), mapping.select("leaf", "level_3", "level_4", "place")
    four = n.join(m, (F.col("__4") == F.col("level_4")) & present("__4") & (F.col("__3") == F.col("level_3"))).select("node", "leaf", F.lit(0).alias("r"), F.col("place").alias("o"))
    three = n.join(m, F.col("__3") == F.col("level_3")).select("node", "leaf", F.lit(1).alias("r"), (-F.col("place")).alias("o"))
    return four.unionAll(three).groupBy("node").agg(F.min(F.struct("r", "o", "leaf"))["leaf"].alias("leaf"))


def resolve(df: DataFrame, column: str, dimension: DataFrame, slug_column: str, label: str, out: str) -> DataFrame:
    """Adds ``out``: the label of the dimension row whose slug or label a text names, whatever the case; the text itself if none does."""
    k = dimension.select(F.explode(F.array(key_fold(F.regexp_replace(slug_column, "_", " ")), key_fold(label))).alias("__k"), F.col(label).alias("__label")).where("__k <> ''").groupBy("__k").agg(F.min("__label").alias("__label"))
    return df.join(k, key_fold(F.regexp_replace(column, "_", " ")) == F.col("__k"), "left").withColumn(out, F.coalesce("__label", column)).drop("__k", "__label")


def assignment_errors(df: DataFrame, key: str, parent: str, child: str, tree: DataFrame, parent_level: int) -> DataFrame:
    """(key, errors): what is wrong with a row's (parent, child) labels: 'unknown parent', 'unknown child', 'child of another parent'; rows
    without errors are left out. Missing children are none."""
    top = tree.where(F.col("level") == parent_level).select(F.lower("label").alias("__p")).distinct().withColumn("__pk", F.lit(True))
    low = tree.where(F.col("level") == parent_level + 1)
    any_ = low.select(F.lower("label").alias("__c")).distinct().withColumn("__ck", F.lit(True))
    up = tree.select(F.col("node").alias("__n"), F.lower("label").alias("__up"))
    pairs = low.join(up, low["parent"] == F.col("__n")).select(F.col("__up").alias("__p2"), F.lower("label").alias("__c2")).distinct().withColumn("__ok", F.lit(True))
    d = df.select(key, F.lower(F.trim(known(parent))).alias("a"), F.lower(F.trim(known(child))).alias("b")).distinct()
    j = d.join(top, d.a == F.col("__p"), "left").join(any_, d.b == F.col("__c"), "left").join(pairs, (d.a == F.col("__p2")) & (d.b == F.col("__c2")), "left")
    errors = F.array_compact(F.array(F.when(F.col("__pk").isNull(), F.lit("unknown parent")), F.when(F.col("b").isNotNull() & F.col("__ck").isNull(), F.lit("unknown child")), F.when(F.col("__pk") & F.col("__ck") & F.col("__ok").isNull(), F.lit("child of another parent"))))
    return j.select(key, F.array_join(errors, "; ").alias("errors")).where("errors <> ''")


def tree_errors(tree: DataFrame, leaf_level: int) -> DataFrame:
    """(error, node): what is wrong with a tree: parents that are missing or not one level up, paths twice, equal sibling slugs, leaves with
    children, more than one root."""
    up = tree.select(F.col("node").alias("__n"), F.col("level").alias("__l")).distinct()
    j = tree.where("parent IS NOT NULL").join(up, tree["parent"] == F.col("__n"), "left")
    own = F.element_at(F.split("node", "/"), -1)
    bad = [
        j.where("__n IS NULL").select(F.lit("parent missing").alias("error"), "node"),
        j.where("__l <> level - 1").select(F.lit("parent not one level up").alias("error"), "node"),
        j.where(F.col("__l") >= leaf_level).select(F.lit("leaf with children").alias("error"), F.col("parent").alias("node")),
        tree.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("path twice").alias("error"), "node"),
        tree.groupBy("parent", own.alias("s")).agg(F.countDistinct("node").alias("n"), F.min("node").alias("node")).where("n > 1").select(F.lit("equal sibling slugs").alias("error"), "node"),
        tree.where("parent IS NULL").agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n > 1").select(F.lit("several roots").alias("error"), "node"),
    ]
    out = bad[0]
    for b in bad[1:]:
        out = out.unionAll(b)
    return out.distinct()


def backfill(df: DataFrame, on: Sequence[str], lookup: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with ``columns`` filled from ``lookup`` (one row per ``on``) where they are missing; never overwritten."""
    look = lookup.select(*on, *[F.col(c).alias(f"__{c}") for c in columns])
    j = df.join(look, list(on), "left")
    return j.withColumns({c: F.coalesce(F.trim(known(c)), F.col(f"__{c}")) for c in columns}).drop(*[f"__{c}" for c in columns])


def stamp(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows with each column of ``pairs`` (column, newer) taken from the newer one where that holds a value."""
    return df.withColumns({a: F.coalesce(F.trim(known(b)), F.col(a)) for a, b in pairs})


def scope(tree: DataFrame, branches: Sequence[str] = (), leaves: Sequence[str] = ()) -> DataFrame:
    """(parent, node): the leaves selected by their own slugs, or by their parents' where no leaf is named, or all; parents come with their leaves."""
    low = tree.where("parent IS NOT NULL").select("parent", "node", F.element_at(F.split("node", "/"), -1).alias("__s"), F.element_at(F.split("parent", "/"), -1).alias("__p"))
    picked: Column = F.col("__s").isin(*leaves) if leaves else F.col("__p").isin(*branches) if branches else F.lit(True)
    return low.where(picked).select("parent", "node")


def distinct_terms(*lists: Column) -> Column:
    """The texts of several arrays in order, each once without regard to case, blanks left out."""
    every = F.filter(F.transform(F.concat(*lists), lambda x: F.trim(x)), lambda x: x != "")
    return F.aggregate(every, F.array().cast("array<string>"), lambda a, x: F.when(F.exists(a, lambda y: F.lower(y) == F.lower(x)), a).otherwise(F.array_append(a, x)))
