"""Documents as read: texts from paragraphs and pages, authors, tokens, JSON out of a model's answer."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import host_of
from ..functions.text import present


def paragraphs(text: Column, most: int, chars: int) -> Column:
    """The first ``most`` non-blank lines, trimmed and joined by line ends, cut at ``chars`` letters (a preview, not what others work on)."""
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.left(F.array_join(F.slice(lines, 1, most), "\n"), F.lit(chars))


def with_body(abstract: Column, body: Column) -> Column:
    """The abstract and the body below it, unless one is missing or the body stands in the abstract."""
    a, b = F.trim(F.coalesce(abstract, F.lit(""))), F.trim(F.coalesce(body, F.lit("")))
    return F.when((b == "") | F.contains(a, b), a).when(a == "", b).otherwise(F.concat(a, F.lit("\n\n"), b))


def authors(c: Column, most: int = 20) -> Column:
    """The first ``most`` authors of an array, trimmed, blanks left out; NULL gives an empty array."""
    return F.slice(F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != ""), 1, most)


def authors_of_text(c: Column) -> Column:
    """Authors named in a text between commas or semicolons."""
    return authors(F.split(F.coalesce(c, F.lit("")), "[,;]"))


def flat_text(columns: Sequence[str], types: Sequence[tuple[str, str]], most: int = 50) -> Column:
    """All columns as one text in lower case; arrays with their first ``most`` elements, structs and maps as JSON, NULLs left out."""
    kind = dict(types)
    one = [F.array_join(F.slice(F.col(c).cast("array<string>"), 1, most), " ") if kind[c].startswith("array") else F.to_json(c) if kind[c].startswith(("struct", "map")) else F.col(c).cast("string") for c in columns]
    return F.lower(F.concat_ws(" ", *one))


def tokens(text: Column, stop: Sequence[str]) -> Column:
    """Runs of letters and digits of more than two characters in lower case, in order and with repeats, without ``stop`` words."""
    t = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([a-z0-9]+)"), F.lit(1))
    return F.filter(t, lambda x: (F.length(x) > 2) & ~x.isin(*stop))


def is_web_url(url: Column) -> Column:
    """Whether a text is an http or https URL with a host."""
    return F.coalesce(F.lower(F.trim(url)).rlike("^https?://") & (host_of(url) != ""), F.lit(False))


def page_content(candidates: Sequence[tuple[str, Column]], nothing: str = "Unavailable") -> Column:
    """struct(text, content_source): the first candidate (label, text) that holds a value, trimmed; ``nothing`` and 'none' without any."""
    out = F.struct(F.lit(nothing).alias("text"), F.lit("none").alias("content_source"))
    for label, c in reversed(list(candidates)):
        out = F.when(present(c), F.struct(F.trim(c).alias("text"), F.lit(label).alias("content_source"))).otherwise(out)
    return out


def readable(df: DataFrame, key: str, html: str, noise: Sequence[str] = ("script", "style", "noscript", "nav", "footer", "header", "aside", "form", "iframe", "svg")) -> DataFrame:
    """(key, text): what a page says: the text of its main, article or role=main element, else of its body, else of all, without ``noise``
    elements; entities decoded, blanks squeezed, blocks on lines of their own. NULL gives ''. Whole pages are read, by a real parser,
    in Arrow batches."""
    from html.parser import HTMLParser

    block = {"p", "div", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "br", "section", "article", "main", "table", "ul", "ol"}
    void = {"br", "img", "hr", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}

    class Reader(HTMLParser):
        def __init__(self) -> None:
            super().__init__(convert_charrefs=True)
            self.open: list[tuple[str, bool, bool, bool]] = []  # tag, opens noise, opens main, opens body
            self.text: dict[str, list[str]] = {"main": [], "body": [], "all": []}

        def handle_starttag(self, tag, attrs):
            if tag in block:
                self.put("\n")
            if tag not in void:
                self.open.append((tag, tag in noise, tag in ("main", "article") or ("role", "main") in attrs, tag == "body"))

        def handle_endtag(self, tag):
            if tag in block:
                self.put("\n")
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == tag:
                    del self.open[i:]
                    break

        def handle_data(self, data):
            self.put(data)

        def put(self, s: str) -> None:
            if any(o[1] for o in self.open):
                return
            self.text["all"].append(s)
            if any(o[2] for o in self.open):
                self.text["main"].append(s)
            if any(o[3] for o in self.open):
                self.text["body"].append(s)

    def text_of(page: str | None) -> str:
        r = Reader()
        r.feed(page or "")
        r.close()
        for part in ("main", "body", "all"):
            lines = [" ".join(x.split()) for x in "".join(r.text[part]).split("\n")]
            if s := "\n".join(x for x in lines if x):
                return s
        return ""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({key: b[key], "text": [text_of(x) for x in b[html]]})

    return df.select(key, html).mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, text string")


def json_answers(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, json, problem): the JSON object of a model's answer: all of it, without a code fence, or from its first brace on; NULL and what is
    wrong where there is none. An object is written again without blanks, keys in their order."""
    import json

    def one(s: str | None) -> tuple[str | None, str | None]:
        t = (s or "").strip()
        if t.startswith("```"):
            t = t.removeprefix("```").removeprefix("json").strip().removesuffix("```").strip()
        at = t.find("{")
        if at < 0:
            return None, "no object"
        try:
            found, _ = json.JSONDecoder().raw_decode(t, at)
        except ValueError:
            return None, "not readable"
        return json.dumps(found, ensure_ascii=False, separators=(",", ":")), None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [one(x) for x in b[text]]
            yield pd.DataFrame({key: b[key], "json": [x[0] for x in out], "problem": [x[1] for x in out]})

    return df.select(key, text).mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, json string, problem string")
