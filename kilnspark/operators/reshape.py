"""One row to many and back: arrays, JSON lists, fixed columns of list heads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_list(df: DataFrame, column: str, item: str, position: str, keep_empty: bool = True) -> DataFrame:
    """One row per element with its position from 0; without elements one row of NULLs, or none."""
    f = F.posexplode_outer if keep_empty else F.posexplode
    return df.select("*", f(column).alias(position, item))


def json_list(df: DataFrame, column: str, item: str) -> DataFrame:
    """One row per text of a JSON list in a text column; NULL, malformed and empty lists give none."""
    return df.withColumn(item, F.explode(F.from_json(column, "array<string>"))).where(F.col(item).isNotNull())


def list_head(df: DataFrame, column: str, n: int, prefix: str) -> DataFrame:
    """The first ``n`` elements as columns ``prefix_1`` ..., NULL where there are fewer."""
    return df.withColumns({f"{prefix}_{i}": F.try_element_at(F.col(column), F.lit(i)) for i in range(1, n + 1)})


def first_of(df: DataFrame, target: str, sources: Sequence[str]) -> DataFrame:
    """``target`` as the first of several legacy columns that holds a value."""
    from ..functions.text import known

    return df.withColumn(target, F.coalesce(*[F.trim(known(s)) for s in sources]))
