"""Normalisers of records' fields: sentinels, vocabularies, short texts, numbers, lists; as expressions, with what they corrected."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import year_in
from .text import NO_DATA, known, present


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_to(c: Column | str, sentinel: str, tokens: Sequence[str] = NO_DATA) -> Column:
    """The trimmed value; ``sentinel`` for NULL, blanks and any of ``tokens`` (trimmed, any letter case)."""
    t = F.trim(_c(c))
    return F.when(t.isNull() | (t == "") | F.lower(t).isin(*tokens), F.lit(sentinel)).otherwise(t)


def list_text(c: Column, sentinel: str = "NA") -> Column:
    """An array as JSON text, ``sentinel`` for NULL and empty ones."""
    return F.when(F.coalesce(F.size(c), F.lit(0)) > 0, F.to_json(c)).otherwise(sentinel)


def word_in(c: Column, word: str) -> Column:
    """Whether a word stands in a lower-case text between characters that are no letters, digits or underscores."""
    return c.contains(word.lower()) & c.rlike(rf"(?:^|[^a-z0-9_]){word.lower()}(?:$|[^a-z0-9_])")


def vocabulary(c: Column | str, allowed: Sequence[str], aliases: Mapping[str, str] | None = None, patterns: Sequence[tuple[str, str]] = (), veto: str | None = None, words: bool = True, default: str = "N.A.") -> Column:
    """struct(value, corrected): a value of ``allowed``, found in this order: exactly; nothing if ``veto`` matches (a plan is no fact); by
    ``aliases`` in lower case; by the first of ``patterns``; by the first allowed word in the text; else ``default``.

    Missing values give ``default``. ``corrected`` tells whether a value that was there came out changed.
    """
    t = F.trim(known(c))
    low = F.lower(t)
    out = F.lit(default)
    if words:
        for a in reversed(allowed):
            out = F.when(word_in(low, a), a).otherwise(out)
    for p, a in reversed(list(patterns)):
        out = F.when(low.rlike(p), a).otherwise(out)
    if aliases:
        m = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
        out = F.coalesce(F.element_at(m, low), out)
    if veto:
        out = F.when(low.rlike(veto), default).otherwise(out)
    out = F.when(t.isNull(), default).when(t.isin(*allowed), t).otherwise(out)
    return F.transform(F.array(out), lambda v: F.struct(v.alias("value"), (t.isNotNull() & (v != t)).alias("corrected")))[0]


def concise(c: Column | str, words: int = 12, default: str = "N.A.") -> Column:
    """Blanks squeezed, the text before the first '. ' or '; ', at most ``words`` words."""
    s = F.trim(F.regexp_replace(known(c), r"\s+", " "))
    s = F.trim(F.split(s, r"[.;] ", 2)[0])
    return F.coalesce(F.when(s != "", F.array_join(F.slice(F.split(s, " "), 1, words), " ")), F.lit(default))


def concise_list(c: Column | str, chars: int = 120, default: str = "N.A.") -> Column:
    """Blanks squeezed; longer than ``chars``, it is cut there and then at its last comma."""
    s = F.trim(F.regexp_replace(known(c), r"\s+", " "))
    cut = F.left(s, F.lit(chars))
    return F.coalesce(F.when(F.length(s) > chars, F.when(cut.contains(","), F.regexp_replace(cut, ",[^,]*$", "")).otherwise(cut)).otherwise(s), F.lit(default))


def concise_number(c: Column | str, chars: int = 40, default: str = "N.A.") -> Column:
    """The first signed decimal of a text, else its first ``chars`` characters."""
    s = F.trim(known(c))
    n = F.regexp_extract(s, r"([-+]?[0-9]+(?:\.[0-9]+)?)", 1)
    return F.coalesce(F.when(n != "", n).otherwise(F.left(s, F.lit(chars))), F.lit(default))


def split_unit(value: Column | str, unit: Column | str, units: Sequence[str], default: str = "N.A.") -> Column:
    """struct(value, unit): the unit column, of four words at most, or the unit of ``units`` at the value's end, cut off there."""
    v, u = F.trim(F.regexp_replace(known(value), r"\s+", " ")), concise(unit, 4, default)
    tail = rf"(?i) ({'|'.join(units)})$"
    found = F.regexp_extract(v, tail, 1)
    own = F.struct(F.coalesce(F.left(v, F.lit(60)), F.lit(default)).alias("value"), F.when(v.isNull() & ~present(unit), default).otherwise(u).alias("unit"))
    cut = F.struct(F.left(F.trim(F.regexp_replace(v, tail, "")), F.lit(60)).alias("value"), found.alias("unit"))
    return F.when((u == default) & (found != ""), cut).otherwise(own)


def first_pattern(text: Column, patterns: Sequence[tuple[str, str]], default: Column | str) -> Column:
    """The name of the first pattern that a text (lower case) matches, else ``default``."""
    out = F.lit(default) if isinstance(default, str) else default
    for p, name in reversed(list(patterns)):
        out = F.when(text.rlike(p), name).otherwise(out)
    return out


def number_in(c: Column | str) -> Column:
    """The first decimal of a text after thousands commas are removed; NULL if none."""
    n = F.regexp_extract(F.replace(F.coalesce(_c(c).cast("string"), F.lit("")), F.lit(","), F.lit("")), r"(-?[0-9]+(?:\.[0-9]+)?)", 1)
    return F.when(n != "", n.try_cast("double"))


def integer_in(c: Column | str) -> Column:
    """The first integer of a text after thousands commas are removed; NULL if none or too large."""
    n = F.regexp_extract(F.replace(F.coalesce(_c(c).cast("string"), F.lit("")), F.lit(","), F.lit("")), r"(-?[0-9]+)", 1)
    return F.when(n != "", n.try_cast("bigint"))


def three_way(c: Column | str, default: str = "NA") -> Column:
    """'true', 'false' or ``default`` of true/yes/1 and false/no/0 in any letter case."""
    t = F.lower(F.trim(_c(c).cast("string")))
    return F.when(t.isin("true", "yes", "1"), "true").when(t.isin("false", "no", "0"), "false").otherwise(default)


def encode_list(c: Column | str, default: str = "NA") -> Column:
    """A JSON list as it is, a text of parts between commas as a JSON list, ``default`` where nothing is left."""
    t = F.trim(known(c))
    parts = F.filter(F.transform(F.split(t, ","), lambda x: F.trim(x)), lambda x: x != "")
    listed = F.from_json(t, "array<string>")
    encoded = F.when(t.startswith("["), F.coalesce(F.to_json(listed), t)).when(F.size(parts) > 0, F.to_json(parts))
    return F.coalesce(encoded, F.lit(default))


def decode_list(c: Column | str) -> Column:
    """The parts of a JSON list or of a text with commas; an empty array for missing values and lists that can't be read."""
    t = F.trim(known(c))
    parts = F.filter(F.transform(F.split(t, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(F.when(t.startswith("["), F.from_json(t, "array<string>")).otherwise(parts), F.array().cast("array<string>"))


def text_list(c: Column | str) -> Column:
    """The parts of a text between semicolons, or between commas where it has none; missing parts go."""
    t = F.trim(F.coalesce(_c(c), F.lit("")))
    parts = F.when(t.contains(";"), F.split(t, ";")).otherwise(F.split(t, ","))
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: present(x))


def category(c: Column | str, allowed: Sequence[str], aliases: Mapping[str, str], default: str = "Other") -> Column:
    """A value of ``allowed``: exactly, by alias, without regard to case, or the first one that holds or is held by the text."""
    t = F.trim(known(c))
    low = F.lower(t)
    out = F.lit(default)
    for a in reversed(allowed):
        out = F.when(low.contains(a.lower()) | F.lit(a.lower()).contains(low), a).otherwise(out)
    for a in reversed(allowed):
        out = F.when(low == a.lower(), a).otherwise(out)
    for k, a in reversed(aliases.items()):
        out = F.when(low == k, a).otherwise(out)
    return F.when(t.isNull(), default).when(t.isin(*allowed), t).otherwise(out)


def acronym_case(c: Column | str, letters: int = 6) -> Column:
    """Acronyms of up to ``letters`` capitals stay, of others the first letter is made a capital; blanks squeezed."""
    t = F.trim(F.regexp_replace(F.coalesce(_c(c), F.lit("")), r"\s+", " "))
    short = (F.length(t) <= letters) & (t == F.upper(t))
    return F.when(short, t).otherwise(F.concat(F.upper(F.left(t, F.lit(1))), F.substring(t, 2, 1_000_000)))


def pad_levels(labels: Column, levels: int, default: str = "N.A.") -> list[Column]:
    """The first ``levels`` labels of an array as columns level_0 ..., ``default`` where there are fewer."""
    return [F.coalesce(F.try_element_at(labels, F.lit(i + 1)), F.lit(default)).alias(f"level_{i}") for i in range(levels)]


def year_of(columns: Sequence[Column | str], doi: Column | str, default: str = "Not Reported") -> Column:
    """struct(year, year_source): the first of several year columns, else a year in the DOI (as a part of its own, then anywhere behind a
    letter or mark), else ``default`` and 'not_reported'; years are texts."""
    own = F.coalesce(*[year_in(_c(x).cast("string")) for x in columns])
    d = F.lower(F.coalesce(_c(doi), F.lit("")))
    part = F.regexp_extract(d, r"[./-]((?:19|20)[0-9]{2})(?:[./-]|$)", 1)
    loose = F.regexp_extract(d, r"[a-z._/-]((?:19|20)[0-9]{2})(?:[^0-9]|$)", 1)
    inferred = F.when(part != "", part).when(loose != "", loose)
    return F.struct(F.coalesce(own.cast("string"), inferred, F.lit(default)).alias("year"), F.when(own.isNotNull(), "metadata").when(inferred.isNotNull(), "doi_inferred").otherwise("not_reported").alias("year_source"))


def value_parts(c: Column | str) -> Column:
    """struct(number_part, unit_part): the number in front of a value, behind signs and words of approximation, and what trails it; '' for
    what isn't there."""
    v = F.replace(_c(c), F.lit("\u00a0"), F.lit(" "))
    lead = r"^[~+<> ]*(?:approx\. |ca\. |up to )?"
    return F.struct(F.regexp_extract(v, lead + r"([0-9][0-9.,]*)", 1).alias("number_part"), F.trim(F.regexp_extract(v, lead + r"[0-9][0-9.,]*(?:e[+-][0-9]+)?[ ]?([^0-9 -].*)$", 1)).alias("unit_part"))
