"""Best representative of each duplicate group, with gaps filled by whole bundles of fields.

The survivor is the most trusted record (most fields present, then latest, then smallest id). What it lacks is filled bundle
by bundle: fields that depend on each other (a journal on its DOI, a company on its project) come from as few donors as
possible, chosen by branch and bound; among equally few, the most trusted. A donor to a bundle has the survivor's value of the
bundle's first field, or none. All of that happens on presence patterns: records of a group with the same pattern and first field of
a bundle are exchangeable but for their trust, so the best of each is enough, and a group of millions shrinks in the map tasks already.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import known, present, squeeze

#: Bundles of dependent fields: the first of each names what the others depend on.
BUNDLES = {
    "project": ("project_name", "company_or_organization", "country", "project_year", "deployment_stage"),
    "publication": ("doi", "journal_or_site"),
    "method": ("study_type", "functional_unit", "curing_conditions"),
}


def moment(c: Column | str) -> Column:
    """Microseconds since 1970 of a time in ISO form, '2 Jan 2022 05:06', or epoch seconds or milliseconds; NULL if unreadable.

    Times without a zone are UTC, whatever the session's zone.
    """
    s = squeeze(c)
    zoned = s.rlike(r"(?:Z|[+-][0-9]{2}:?[0-9]{2})$") & s.contains(":")
    iso = F.when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.when(zoned, s).when(F.length(s) <= 10, F.concat(s, F.lit(" 00:00:00+00:00"))).otherwise(F.concat(s, F.lit("+00:00"))))
    worded = F.when(s.rlike(r"^[0-9]{1,2} [A-Za-z]{3} [0-9]{4} [0-9]{2}:[0-9]{2}$"), F.concat(F.initcap(s), F.lit(" +00:00")))
    dotted = F.when(s.rlike(r"^[0-9]{2}\.[0-9]{2}\.[0-9]{4}$"), F.concat(s, F.lit(" 00:00 +00:00")))
    return F.coalesce(
        F.unix_micros(iso.try_cast("timestamp")),
        F.when(s.rlike("^[0-9]{9,10}$"), s.try_cast("long") * 1_000_000),
        F.when(s.rlike("^[0-9]{12,13}$"), s.try_cast("long") * 1_000),
        F.unix_micros(F.try_to_timestamp(worded, F.lit("d MMM yyyy HH:mm xxx"))),
        F.unix_micros(F.try_to_timestamp(dotted, F.lit("dd.MM.yyyy HH:mm xxx"))),
    )


def choose(lacking: int, candidates: Sequence[tuple[int, int]]) -> list[int]:
    """The donors that cover ``lacking`` (bits), as far as any candidate can: fewest first, so that bundles stay whole, then the
    highest summed trust, which is the smallest sum of ranks.

    ``candidates`` are (bits present, trust rank; 0 is most trusted). Returns their ranks. Branch and bound: the branch is on
    the donors of one bit that is still open; a branch ends where the donors it needs at least, or at equal number its ranks, can't
    beat the best so far.
    """
    best_of: dict[int, int] = {}
    for bits, rank in candidates:
        b = bits & lacking
        if b and rank < best_of.get(b, 1 << 62):
            best_of[b] = rank
    options = sorted(best_of.items(), key=lambda x: (-x[0].bit_count(), x[1]))
    goal = 0
    for b, _ in options:
        goal |= b
    best: tuple[int, int, list[int]] | None = None

    def go(open_: int, taken: list[int]) -> None:
        nonlocal best
        if not open_:
            found = (len(taken), sum(taken), sorted(taken))
            if best is None or found < best:
                best = found
            return
        widest = max((b & open_).bit_count() for b, _ in options)
        least = len(taken) + -(-open_.bit_count() // widest)
        if best is not None and (least > best[0] or least == best[0] and sum(taken) > best[1]):
            return
        low = open_ & -open_
        for b, r in options:
            if b & low:
                go(open_ & ~b, [*taken, r])

    go(goal, [])
    return best[2] if best else []


def consistent(lacking: int, own: str | None, candidates: Sequence[tuple[int, int, str | None]]) -> list[int]:
    """The donors of a bundle that agree on its first field: with ``own``, the survivor's, or, where it has none, with each other.

    ``candidates`` are (bits present, trust rank, first field or None). Among the values the donors may agree on, the one that covers most
    of ``lacking`` wins, then the fewest donors, then the most trusted.
    """
    best = None
    for value in [own] if own is not None else [None, *dict.fromkeys(d for *_, d in candidates if d is not None)]:
        fit = [(b, r) for b, r, d in candidates if d is None or d == value]
        taken = choose(lacking, fit)
        bits = 0
        for b, r in fit:
            bits |= b if r in taken else 0
        found = (-(bits & lacking).bit_count(), len(taken), taken)
        best = found if best is None else min(best, found)
    return best[2]


def survivors(df: DataFrame, group: str = "duplicate_group_id", key: str = "record_id", when: str = "retrieval_timestamp", bundles: Mapping[str, Sequence[str]] = BUNDLES) -> DataFrame:
    """One row per group of two or more distinct keys: group, key of the survivor, filled, donors, and the fields after filling.

    * The survivor has the most present fields; ties go to the later ``when`` (unreadable or missing is earliest), then to the
      smaller key. Equal rows delivered again change nothing; a key delivered with other values counts with its best row.
    * ``filled`` counts the fields missing in the survivor and present in another member. Each gets a value, unless all members that have
      one contradict the bundle's first field (trimmed, any case); such a field is counted but stays NULL.
    * ``donors`` are the keys that gave values, per bundle in order. NULL, blank and no-data values are missing and come out NULL.
    * Rows whose group or key is missing are in no group; an empty table gives an empty one; other columns are left out.

    Plan: one aggregation on (group, presence pattern, first fields of the bundles) - partial in the map tasks, so a hot group leaves at
    most 2^k rows a task for each combination of first fields - then one on the group over those few rows. Only groups with two keys
    reach Python.
    """
    fields = [f for b in bundles.values() for f in b]
    if len(fields) > 16:
        raise ValueError("at most 16 fields")
    mask = sum((F.when(present(f"`{f}`"), F.lit(1 << i)).otherwise(0) for i, f in enumerate(fields)), F.lit(0))
    rows = df.where(present(f"`{group}`") & F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{group}`").alias("g"), F.col(f"`{key}`").alias("k"), mask.alias("mask"),
        (-F.coalesce(moment(F.col(f"`{when}`")), F.lit(-(1 << 62)))).alias("back"), *[known(F.col(f"`{f}`")).alias(f"v{i}") for i, f in enumerate(fields)],
    )
    values = F.struct("back", "k", *[f"v{i}" for i in range(len(fields))])
    spans, at = [], 0
    for b in bundles.values():
        spans.append((at, len(b)))
        at += len(b)
    rows = rows.withColumns({f"first{n}": F.lower(squeeze(f"v{at}")) for n, (at, _) in enumerate(spans)})
    firsts = [f"first{n}" for n in range(len(spans))]
    patterns = rows.groupBy("g", "mask", *firsts).agg(F.min(values).alias("best"), F.min("k").alias("lo"), F.max("k").alias("hi"))
    groups = patterns.groupBy("g").agg(F.collect_list(F.struct((-F.bit_count("mask")).alias("few"), F.col("best.back").alias("back"), F.col("best.k").alias("k"), "mask", F.array(*[F.col(f"best.v{i}") for i in range(len(fields))]).alias("v"), F.array(*firsts).alias("firsts"))).alias("rows"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    groups = groups.where("lo <> hi").select("g", F.array_sort("rows").alias("rows"))
    # What one record holds needs no choice: only groups with gaps that others can fill go to Python.
    top = groups.select("g", "rows", F.col("rows")[0].alias("s"), F.aggregate("rows", F.lit(0), lambda a, x: a.bitwiseOR(x["mask"])).alias("any"))
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out: list[tuple] = []
            for g, rows_ in zip(b["g"], b["rows"]):
                s = rows_[0]
                v, donors = list(s["v"]), []
                any_ = 0
                for x in rows_:
                    any_ |= int(x["mask"])
                for n, (at, size) in enumerate(spans):
                    bits = (1 << at + size) - (1 << at)
                    for r in consistent(bits & ~int(s["mask"]), s["firsts"][n], [(int(x["mask"]) & bits, i, x["firsts"][n]) for i, x in enumerate(rows_)]):
                        donors.append(rows_[r]["k"])
                        for i, x in enumerate(rows_[r]["v"]):
                            if bits >> i & 1 and v[i] is None:
                                v[i] = x
                out.append((g, s["k"], (any_ & ~int(s["mask"])).bit_count(), donors, *v))
            yield pd.DataFrame(out, columns=["g", "k", "filled", "donors", *(f"v{i}" for i in range(len(fields)))])

    schema = f"g string, k {kind}, filled bigint, donors array<{kind}>, " + ", ".join(f"v{i} string" for i in range(len(fields)))
    gaps = top.where("any <> s.mask").select("g", "rows").mapInPandas(run, schema)
    whole = top.where("any = s.mask").select("g", F.col("s.k").alias("k"), F.lit(0).cast("long").alias("filled"), F.array().cast(f"array<{kind}>").alias("donors"), *[F.col("s.v")[i].alias(f"v{i}") for i in range(len(fields))])
    return gaps.unionAll(whole).select(F.col("g").alias(group), F.col("k").alias(key), F.col("filled").alias("complementary_fields_filled"), "donors", *[F.col(f"v{i}").alias(f) for i, f in enumerate(fields)])
