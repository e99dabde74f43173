"""Top N items within every group, by a window of row_number and a rank filter.

Spark turns ``row_number() <= n`` over a window into a group limit that runs before and after the
shuffle, so at most N rows of a group leave each map task, however hot the group is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import BLANK, NO_DATA


def labels(cell: Column | str, unknown: str = "unknown") -> Column:
    """The labels of a cell: parts between semicolons, trimmed, lower case, runs of inner blanks as one underscore.

    Empty parts and no-data markers are no labels; a cell without labels gives ``[unknown]``. A label counts once per cell.
    """
    cell = F.col(cell) if isinstance(cell, str) else cell
    parts = F.transform(
        F.split(F.coalesce(cell, F.lit("")), ";"),
        lambda x: F.regexp_replace(F.lower(F.regexp_replace(x, rf"^{BLANK}+|{BLANK}+$", "")), rf"{BLANK}+", "_"),
    )
    none = [m.replace(" ", "_") for m in NO_DATA]
    kept = F.array_distinct(F.filter(parts, lambda x: ~x.isin(*none)))
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(F.lit(unknown)))


def top_n(df: DataFrame, group: Sequence[str], score: str, item: str, n: int = 5) -> DataFrame:
    """(group columns, item, score): the ``n`` items of the highest score per group.

    * An item counts once per group, at its highest score there; ties go to the smaller item.
    * Rows with a NULL item or a NULL or NaN score are no candidates; a NULL group column is a group of its own.
    * Groups of fewer than ``n`` items give all of them; an empty table gives an empty one; ``n`` < 1 gives none.
    * Extra columns are left out, so their names cannot clash.

    Plan: a hash aggregation on (group, item) - no hot key, since an item is one key - then the window. Its group limit
    prunes each map task's rows to N a group before the second shuffle, so a hot group moves N rows a task.
    """
    keys = [F.col(f"`{c}`") for c in group]
    one = df.where(F.col(f"`{item}`").isNotNull() & F.col(f"`{score}`").isNotNull() & ~F.isnan(F.col(f"`{score}`").cast("double")))
    g = [f"__g{i}" for i in range(len(group))]
    best = one.select(*[k.alias(a) for k, a in zip(keys, g)], F.col(f"`{item}`").alias("__item"), F.col(f"`{score}`").alias("__score"))
    best = best.groupBy(*g, "__item").agg(F.max("__score").alias("__score"))
    ranked = df.sparkSession.sql(
        f"""SELECT * FROM (
              SELECT *, row_number() OVER (PARTITION BY {", ".join(g)} ORDER BY __score DESC, __item) AS __rank FROM {{best}}
            ) WHERE __rank <= {int(n)}""",
        best=best,
    )
    return ranked.select(*[F.col(a).alias(c) for a, c in zip(g, group)], F.col("__item").alias(item), F.col("__score").alias(score), F.col("__rank").alias("rank_no"))


def best_papers(screening: DataFrame, n: int = 5) -> DataFrame:
    """(shard_id, branch, corpus_index, confidence, rank_no) of the screening table: the best ``n`` papers a shard and branch.

    Only confidences from 0 to 1 count. Rows without a shard are no cases.
    """
    rows = screening.where("shard_id IS NOT NULL AND confidence >= 0 AND confidence <= 1").select(
        "shard_id", "corpus_index", "confidence", F.explode(labels("matched_taxonomy_branches")).alias("branch")
    )
    return top_n(rows, ["shard_id", "branch"], "confidence", "corpus_index", n)
