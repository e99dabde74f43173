"""Scalar column functions of the evidence pipeline: years, URLs, slugs, keys, confidences, phrases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import known, present

#: Query parameters that only track where a visit came from.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id", "gclid", "fbclid", "mc_cid", "mc_eid", "ref", "ref_src", "source")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_sentinel(c: Column | str, sentinel: str = "N.A.") -> Column:
    """The trimmed value, or the sentinel where it is missing."""
    return F.coalesce(F.trim(known(c)), F.lit(sentinel))


def key_fold(c: Column | str) -> Column:
    """Lower case, anything but letters and digits as single blanks, trimmed; '' for NULL."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(_c(c), F.lit(""))), "[^a-z0-9]+", " "))


def slug(c: Column | str) -> Column:
    """Parentheses dropped, folded, snake case; '' for NULL."""
    return F.regexp_replace(key_fold(F.regexp_replace(F.coalesce(_c(c), F.lit("")), r"\([^)]*\)", "")), " ", "_")


def year_in(c: Column | str) -> Column:
    """The first whole-word year 1900-2099 in a text, NULL if none."""
    y = F.regexp_extract(F.coalesce(_c(c), F.lit("")), r"(?:^|[^0-9])((?:19|20)[0-9]{2})(?:$|[^0-9])", 1)
    return F.when(y != "", y.cast("int"))


def publication_year(year: Column | str, doi: Column | str) -> Column:
    """struct(year, year_source): the year column, else a year inside the DOI, else NULL and 'missing'."""
    own, inferred = year_in(year), year_in(doi)
    return F.struct(F.coalesce(own, inferred).alias("year"), F.when(own.isNotNull(), "metadata").when(inferred.isNotNull(), "doi").otherwise("missing").alias("year_source"))


def clamp_confidence(c: Column) -> Column:
    """A number between 0 and 1; 0 for NULL, NaN and what is no number."""
    v = c.try_cast("double")
    return F.when(v.isNull() | F.isnan(v), 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), v)))


def label_of(c: Column | str, labels: Mapping[str, str], default: str) -> Column:
    """The label of a value by its lower-case form."""
    m = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.coalesce(F.element_at(m, F.lower(F.trim(F.coalesce(_c(c), F.lit(""))))), F.lit(default))


def host_of(url: Column | str) -> Column:
    """Host in lower case without www.; NULL for what is no URL."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.trim(_c(url)), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)), r"^www\.", "")


def url_key(url: Column | str, tracking: Sequence[str] = TRACKING) -> Column:
    """Scheme and host in lower case, no www., fragment, trailing slash or tracking parameters; the order of others stays; a bare host gets the
    path '/'. A host without a scheme is taken as https.

    NULL and malformed URLs give the trimmed text itself.
    """
    u = F.trim(_c(url))
    u = F.when(u.rlike(r"(?i)^[a-z0-9-]+(?:\.[a-z0-9-]+)+(?:[/?#:].*)?$"), F.concat(F.lit("https://"), u)).otherwise(u)
    bare = F.regexp_replace(u, "#.*$", "")
    scheme = F.lower(F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    path = F.regexp_replace(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]+([^?]*)", 1), "/+$", "")
    path = F.when(path == "", "/").otherwise(path)
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(F.substring_index(p, "=", 1)).isin(*tracking)), "&")
    full = F.concat(scheme, F.lit("://"), host_of(u), path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))
    return F.when(host_of(u) == "", u).otherwise(full)


def any_host(url: Column | str) -> Column:
    """The host in lower case without www. and port of a URL with or without its scheme; '' for what is neither, NULL for NULL."""
    u = F.trim(_c(url))
    bare = F.regexp_replace(u, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    is_url = u.rlike("^[A-Za-z][A-Za-z0-9+.-]*://") | u.rlike(r"(?i)^[a-z0-9-]+(?:\.[a-z0-9-]+)+(?:[/?#:].*)?$")
    return F.when(is_url, F.regexp_replace(F.lower(F.regexp_extract(bare, "^([^/?#:]+)", 1)), r"^www\.", "")).when(u.isNotNull(), "")


def safe_name(c: Column | str, suffix: str = "", most: int = 64) -> Column:
    """A slug that is safe as a file name in any file system: no separators or dots, no reserved names, at most ``most`` letters; '_unnamed' for
    what leaves nothing."""
    s = slug(c)
    return F.concat(F.when((s == "") | s.isin("con", "nul"), "_unnamed").otherwise(F.left(s, F.lit(most))), F.lit(suffix))


def phrase_in(text: Column, phrase: str) -> Column:
    """Whether a phrase stands in a lower-case text: whole word for phrases of up to four letters or digits, else anywhere."""
    if len(phrase) <= 4 and phrase.isalnum():
        return text.contains(phrase) & text.rlike(rf"(?:^|[^a-z0-9]){phrase}(?:$|[^a-z0-9])")  # the regex only where it can match
    return text.contains(phrase)


def paper_key(doi: Column | str, url: Column | str, title: Column | str) -> Column:
    """doi: > url: > title: > unknown, by what is there first."""
    return F.when(present(doi), F.concat(F.lit("doi:"), F.lower(F.trim(_c(doi))))).when(present(url), F.concat(F.lit("url:"), F.lower(F.trim(_c(url))))).when(present(title), F.concat(F.lit("title:"), F.lower(F.trim(_c(title))))).otherwise("unknown")


def digest(*parts: Column | str) -> Column:
    """sha1 over the folded parts; NULLs count as ''."""
    return F.sha1(F.concat_ws("|", *[key_fold(p) for p in parts]))


def first_words(c: Column | str, n: int) -> Column:
    """The first n words."""
    return F.array_join(F.slice(F.split(F.trim(F.coalesce(_c(c), F.lit(""))), r"\s+"), 1, n), " ")


def html_text(c: Column | str) -> Column:
    """Text of HTML: comments and the elements script, style and noscript go, tags become blanks, blanks are squeezed.

    Entities are decoded: the named ones of markup and blanks, in any letter case, and decimal ones of ASCII; what is written as an entity of
    an entity stays one. (:func:`~kilnspark.operators.documents.readable` parses pages by elements.)
    """
    s = F.regexp_replace(F.coalesce(_c(c), F.lit("")), r"(?s)<!--.*?-->", " ")
    s = F.regexp_replace(s, r"(?is)<(script|style|noscript)\b[^>]*>.*?</\1\s*>", " ")
    s = F.regexp_replace(s, r"(?s)<[^>]*>", " ")
    for name, x in (("nbsp|#160", " "), ("lt|#60", "<"), ("gt|#62", ">"), ("quot|#34", '"'), ("apos|#39", "'"), ("amp|#38", "&")):
        s = F.regexp_replace(s, f"(?i)&(?:{name});", x)
    return F.trim(F.regexp_replace(s, r"\s+", " "))
