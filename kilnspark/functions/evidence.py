"""Evidence alignment: which passage of a source supports a record's label and numbers; numbers without support are cleared."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import present

_CUT = "\u0001"


def plain(text: Column) -> Column:
    """No-break blanks as blanks, full-width percent as percent, blanks squeezed; '' for NULL."""
    t = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit(" "), F.lit(" ")), F.lit("％"), F.lit("%"))
    return F.regexp_replace(t, r"\s+", " ")


def passages(text: Column, most: int = 600) -> Column:
    """Candidate passages in order: sentences (a mark, blanks, then a capital, digit or quote), in windows of ``most`` letters, half
    overlapping, where they are longer; then every two neighbouring sentences of 41 to 2 x ``most`` letters."""
    t = plain(text)
    parts = F.filter(F.transform(F.split(F.regexp_replace(t, r"([.!?]) ([A-Z0-9\"'])", f"$1{_CUT}$2"), _CUT), lambda x: F.trim(x)), lambda x: x != "")
    step = max(80, most // 2)
    windows = lambda p: F.filter(F.transform(F.sequence(F.lit(0), F.length(p) - 1, F.lit(step)), lambda i: F.trim(F.substr(p, i + 1, F.lit(most)))), lambda x: x != "")
    whole = F.flatten(F.transform(parts, lambda p: F.when(F.length(p) <= most, F.array(p)).otherwise(windows(p))))
    s = F.filter(F.transform(F.split(F.regexp_replace(t, "([.!?]) ", f"$1{_CUT}"), _CUT), lambda x: F.trim(x)), lambda x: x != "")
    two = F.when(F.size(s) > 1, F.zip_with(F.slice(s, F.lit(1), F.size(s) - 1), F.slice(s, F.lit(2), F.size(s) - 1), lambda a, b: F.concat(a, F.lit(" "), b))).otherwise(F.array().cast("array<string>"))
    return F.concat(whole, F.filter(two, lambda p: (F.length(p) > 40) & (F.length(p) <= 2 * most)))


def holds(low: Column, term: Column) -> Column:
    """Whether a lower-case passage holds a term: as a whole word up to three letters, else anywhere."""
    edge = F.regexp_like(low, F.concat(F.lit("(?:^|[^a-z0-9])"), term, F.lit("(?:$|[^a-z0-9])")))
    return F.contains(low, term) & ((F.length(term) > 3) | edge)


def supported(passage: Column, terms: Column) -> Column:
    """Whether a passage holds one of the terms (an array in lower case); TRUE where there are none to hold."""
    low = F.lower(plain(passage))
    return F.coalesce(F.size(terms) == 0, F.lit(True)) | F.exists(terms, lambda t: holds(low, t))


def support_score(passage: Column, terms: Column, generic: Sequence[str] = ()) -> Column:
    """5 a short term, 3 and an eighth of its length (4 at most) a longer one; -1 for generic words alone; 8 less a 120th of the length for
    brevity, if there is any support."""
    low = F.lower(plain(passage))
    s = F.aggregate(terms, F.lit(0), lambda a, t: a + F.when(holds(low, t), F.when(F.length(t) <= 3, 5).otherwise(3 + F.least(F.lit(4), F.floor(F.length(t) / 8).cast("int")))).otherwise(0))
    chatter = F.exists(F.array(*[F.lit(g) for g in generic]), lambda g: F.contains(low, g)) if generic else F.lit(False)
    brief = F.greatest(F.lit(0), 8 - F.floor(F.length(passage) / 120).cast("int"))
    return F.transform(F.array(s), lambda x: F.when(x > 0, x + brief).when(chatter, x - 1).otherwise(x))[0]


def best_passage(candidates: Column, terms: Column, generic: Sequence[str] = ()) -> Column:
    """The candidate of highest score above 0, the first of equals; '' if none supports."""
    scored = F.transform(candidates, lambda x, i: F.struct(support_score(x, terms, generic).alias("s"), (-i).alias("back"), x.alias("x")))
    return F.coalesce(F.array_max(F.filter(scored, lambda x: x["s"] > 0))["x"], F.lit(""))


def number_forms(value: Column) -> Column:
    """Ways to write the numbers of a value: plain, with percent signs and words, with a decimal comma; distinct, in lower case."""
    n = F.regexp_extract_all(F.coalesce(value, F.lit("")), F.lit(r"(-?[0-9]+(?:\.[0-9]+)?)"), F.lit(1))
    forms = lambda x: F.array(x, F.concat(x, F.lit("%")), F.concat(x, F.lit(" %")), F.concat(x, F.lit(" percent")), F.concat(x, F.lit(" per cent")), F.replace(x, F.lit("."), F.lit(",")), F.concat(F.replace(x, F.lit("."), F.lit(",")), F.lit("%")))
    return F.array_distinct(F.flatten(F.transform(n, forms)))


def supports_number(passage: Column, value: Column, unit: Column, context: Column) -> Column:
    """Whether a passage holds one of the value's forms, its unit (percent signs apart) and one context term of three letters or more
    (if any is given)."""
    low = F.lower(plain(passage))
    u = F.lower(F.trim(F.coalesce(unit, F.lit(""))))
    ctx = F.filter(context, lambda t: F.length(F.trim(t)) >= 3)
    return F.exists(number_forms(value), lambda f: F.contains(low, f)) & ((u == "") | u.isin("%", "percent", "pct", "percentage") | F.contains(low, u)) & ((F.size(ctx) == 0) | F.exists(ctx, lambda t: F.contains(low, F.lower(t))))


def best_numeric(candidates: Column, value: Column, unit: Column, context: Column) -> Column:
    """The shortest candidate that supports the number, the first of equals; '' if none does."""
    ok = F.filter(F.transform(candidates, lambda x, i: F.struct(F.length(x).alias("n"), i.alias("i"), x.alias("x"))), lambda x: supports_number(x["x"], value, unit, context))
    return F.coalesce(F.array_min(ok)["x"], F.lit(""))


def align(df: DataFrame, key: str, text: str, evidence: str, slug: str, terms: Mapping[str, Sequence[str]], numbers: Sequence[tuple[str, str | None, Sequence[str]]], generic: Sequence[str] = ()) -> DataFrame:
    """(key, evidence, method, supported, cleared, and the number columns): records with their evidence aligned to ``text``.

    The label first: evidence that holds a term of the record's ``slug`` stays ('existing'); else the best passage is taken ('searched');
    without any the label is 'unsupported', and 'unchanged' where the slug has no terms. Then each of ``numbers`` (value column, unit
    column or None, context terms) in order: a number that the evidence supports stays; else the shortest passage that supports it becomes
    the evidence if it supports the label too, or one of 900 letters that does both; a number without a passage is cleared (NULL) and named
    in ``cleared``. One pass over each row; NULL texts support nothing.
    """
    t = F.create_map(*[x for k, v in terms.items() for x in (F.lit(k), F.array(*[F.lit(w.lower()) for w in v]))])
    none = F.array().cast("array<string>")
    d = df.withColumns({"__t": F.coalesce(F.element_at(t, F.col(slug)), none), "__e": F.trim(F.coalesce(evidence, F.lit(""))), "__c": passages(F.col(text)), "__w": passages(F.col(text), 900)})
    own = (F.col("__e") != "") & supported(F.col("__e"), F.col("__t"))
    with_own = F.when(F.col("__e") != "", F.concat(F.array("__e"), "__c")).otherwise(F.col("__c"))
    d = d.withColumn("__own", own).withColumn("__best", F.when((F.size("__t") > 0) & ~F.col("__own"), best_passage(with_own, F.col("__t"), generic)).otherwise(""))
    method = F.when(F.size("__t") == 0, "unchanged").when(F.col("__own"), "existing").when(F.col("__best") != "", "searched").otherwise("unsupported")
    d = d.withColumn("method", method).withColumn("__e", F.when(F.col("method") == "searched", F.col("__best")).otherwise(F.col("__e"))).withColumn("cleared", none)
    for value, unit, context in numbers:
        v, u, ctx = F.trim(F.col(value)), F.col(unit) if unit else F.lit(None).cast("string"), F.array(*[F.lit(x) for x in context]) if context else none
        d = d.withColumn("__has", present(value) & F.col(value).rlike("[0-9]"))
        d = d.withColumn("__ok", F.col("__has") & (F.col("__e") != "") & supports_number(F.col("__e"), v, u, ctx))
        d = d.withColumn("__n", F.when(F.col("__has") & ~F.col("__ok"), best_numeric(F.when(F.col("__e") != "", F.concat(F.array("__e"), "__c")).otherwise(F.col("__c")), v, u, ctx)).otherwise(""))
        both = F.coalesce(F.get(F.filter("__w", lambda x: supported(x, F.col("__t")) & supports_number(x, v, u, ctx)), F.lit(0)), F.lit(""))
        fits = (F.size("__t") == 0) | supported(F.col("__n"), F.col("__t"))
        d = d.withColumn("__n2", F.when((F.col("__n") != "") & ~fits, both).otherwise(F.col("__n")))
        d = d.withColumn("__e", F.when(F.col("__n2") != "", F.col("__n2")).otherwise(F.col("__e")))
        gone = F.col("__has") & ~F.col("__ok") & (F.col("__n2") == "")
        d = d.withColumn("cleared", F.when(gone, F.array_append("cleared", F.lit(value))).otherwise(F.col("cleared"))).withColumn(value, F.when(F.col("__has") & ~gone, v))
    return d.select(key, F.col("__e").alias("evidence"), "method", (F.col("method") != "unsupported").alias("supported"), F.array_join("cleared", ", ").alias("cleared"), *[n for n, _, _ in numbers])
