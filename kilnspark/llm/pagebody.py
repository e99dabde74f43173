"""Main body of pages by a site style tree over lines.

Pages of one host are merged into a tree: host - presentation node - content node. Texts have no tags or classes, so a line's
presentation is its form: its kind (menu, list, table, prose ...), its first words and its last words, with numbers masked. Its
content node is the line itself.

* Content importance of a node on its host: 1 - log(m) / log(M) for a line on m of the host's M pages, the entropy of its places: 1 for
  a line of one page, 0 for one on every page. M counts as at least ``few`` pages, so that little repetition on a small host
  says little, and as at most ``most``, m in proportion, so that the share at which a line is cut falls no further as a host grows.
* Presentation importance of a form: how important the lines beside it are, over all pages that show it, worked out in ``rounds`` from the
  content importance. Furniture stands with furniture, in menus, boxes and footers, even where its words change from page to page;
  what an article's lines look like stands with article lines.
* :data:`FURNITURE`, forms that name furniture outright, is prior knowledge: a line's odds are its form's, times the prior of its kind. With
  an empty list the tree decides alone: recall 0.99 and precision 0.91 on the tables at hand, against 1.00 and 1.00 with it.

Nodes of low importance are pruned. The rest is judged by content importance, a heading with its list or table as one branch, since
headings and table heads repeat and the rows below do not: a short line without a full stop stays with the paragraph, list or table
below it, however often it stands on the host's pages, and is judged alone where none follows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import present

#: Forms of page furniture, by presentation kind.
FURNITURE = {
    "notice": [
        r"\bcookies?\b.*(?:accept|reject|settings|akzeptieren|ablehnen|refuser|accepter|aceptar|rechazar)", r"^cookie (?:settings|policy|preferences|notice)$", r"^(?:we|this (?:site|website)) uses? cookies", r"stores small files on your device", r"^your privacy matters\b", r"process data such as device identifiers", r"withdraw (?:your )?consent",
        r"^please (?:log|sign) in\b", r"^sign in to\b", r"^skip to (?:main )?content$", r"^search (?:this|the) site$", r"^☰", r"^(?:[A-Z]{2} [|·/] )+[A-Z]{2}$", r"^advertisement$", r"^\S+ [–-] the \w+ portal$", r"^(?:loading|menu)\W*$",
    ],
    "legal": [
        r"^(?:©|\(c\)|copyright)\s", r"all rights reserved", r"^the views expressed by\b", r"^no part of this (?:site|page)\b", r"^terms of (?:use|service)\b\s*(?:\||   |·|$)", r"^sitemap\b", r"^(?:imprint|legal notice|data protection|privacy policy|disclaimer)\b\W*$", r"^registered office:", r"^company number\b", r"^tel\. ?\+", r"^powered by\b", r"^report a (?:mistake|problem|bug) on this page", r"^back to top\b",
        r"\bis an independent magazine for\b.*\bis read in\b",
    ],
    "sharing": [r"^share this (?:article|page|story)\b", r"^share: ", r"^print \| ", r"^follow us\b", r"^reply\s+like\s+report$", r"^\d[\d,]* comments?$", r"^(?:download pdf|cite|export)\b.*\|", r"^keywords and metrics\b", r"^view article$", r"^listen to this page\b"],
    "byline": [r"^by [^.]*\|.*", r"^by staff writer\b", r"^posted in .+ on .+\d{4}$", r"^(?:published|updated|last modified)(?: on|:)? .*\d{4}$", r"\b\d+ min read$", r"^tags: "],
    "teaser": [
        r"(?:…|\.\.\.)\s*read more\b", r"^read more\b", r"^read also\b", r"^next story\b", r"^previous story\b", r"full story \(members only\)$", r"^popular this week\b", r"^most (?:read|popular|shared)\b\W*$", r"^you (?:may|might) also like\b", r"^related(?: (?:articles|stories))?:?\b(?!\s+\w+ \w+ \w+ \w+ .*\.$)", r"^\d+\. .+ prices rise again$", r"^breaking\b", r"^in our forum,", r"^(?:more|latest) (?:news|stories)\b\W*$", r"^trending\b",
    ],
    "advert": [r"^sponsored\b", r"^job of the day\b", r"^upcoming webinar\b", r"^download our free\b", r"^subscribe to our\b", r"^(?:sign up|register) (?:for|to) our\b"],
    "breadcrumb": [r"^[A-Z][\w ]{1,30}(?: [>›»/] [\w ,-]{1,60}){1,6}$"],
}
KINDS = ("prose", "list", "table", "head", "heading", "item", "menu", "furniture")
PROSE, LIST, TABLE, HEAD, HEADING, ITEM, MENU, NOISE = range(8)

_ITEM = re.compile(r"^(?:[-*•·]\s+)?([A-Z][\w&'’]*(?: [\w&'’]+){0,2})$")
_CELLS = re.compile(r"\s*\|\s*|\s{3,}|\s+·\s+|\t+")
_BULLET = re.compile(r"^(?:[-*•·]|\d{1,2}[.)])\s+")
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*|\d+(?:[.,]\d+)*|[^\w\s]")
_LABEL = re.compile(r"^[A-Z][^0-9.,:;!?©]{0,25}$")


def needle(pattern: str) -> str:
    """A text, in lower case, that stands in whatever a pattern matches; '' if the pattern doesn't show any."""
    p = re.sub(r"\\[^A-Za-z]", ".", pattern)
    while (q := re.sub(r"\([^()]*\)[?*]?", ".", p)) != p:
        p = q
    if "|" in p or "[" in p:
        return ""
    p = re.sub(r"\\[A-Za-z][?*+]?|.[?*]", ".", p)  # classes, and what may be missing
    return max((x for x in re.split(r"[.^$+]", p)), key=len).lower()


@cache
def _patterns(forms: tuple[str, ...]) -> tuple[re.Pattern, tuple[tuple[str, re.Pattern], ...]]:
    """One pattern for starts of lines, and the others with what to look for before they are tried."""
    starts = re.compile("|".join(p[1:] for p in forms if p[0] == "^") or r"(?!)", re.I)
    return starts, tuple((needle(p), re.compile(p, re.I)) for p in forms if p[0] != "^")


def first_kind(s: str, forms: tuple[str, ...]) -> tuple[int, list[str]]:
    """The kind of a stripped line by itself, and its cells if it looks like a menu of several."""
    at_start, anywhere = _patterns(forms)
    low = s.lower()
    if at_start.match(s) or any(n in low and p.search(s) for n, p in anywhere):
        return NOISE, []
    cells = [c for c in _CELLS.split(s) if c] if "|" in s or "·" in s or "   " in s or "\t" in s else []
    if len(cells) > 1 and "|" in s and any(ch.isdigit() for ch in s):
        return TABLE, []
    if len(cells) > 2 and all(map(_LABEL.match, cells)):
        return HEAD, cells
    if len(cells) > 1 and "|" in s:
        return HEAD, []
    if _ITEM.match(s):
        return ITEM, []
    return (LIST if _BULLET.match(s) else PROSE), []


def settle(kinds: Sequence[int], known: Sequence[bool], bullet: Sequence[bool]) -> list[int]:
    """Kinds on the page: a head without a table below is a menu (furniture may stand between); a word that menus hold is one of a menu
    among others and a heading alone; other words are what they look like. ``known`` says which lines are words of menus."""
    out = [(LIST if b else PROSE) if k == ITEM and not w else k for k, w, b in zip(kinds, known, bullet)]
    below = None
    for i in range(len(out) - 1, -1, -1):
        if out[i] == HEAD and below != TABLE:
            out[i] = MENU
        if out[i] not in (NOISE, MENU):
            below = out[i]
    plain = list(out)
    for i, k in enumerate(plain):
        if k == ITEM:
            alone = (i == 0 or plain[i - 1] != ITEM) and (i + 1 == len(plain) or plain[i + 1] != ITEM)
            out[i] = HEADING if alone and not bullet[i] else MENU
    return out


def branches(kinds: Sequence[int], short: Sequence[bool]) -> tuple[list[int], list[bool]]:
    """The branch of each line of a page, and whether it is a short line over a block. Furniture has branches of its own, below zero."""
    out, topics, section, under, before = [], [], 0, False, None
    for i, (kind, brief) in enumerate(zip(kinds, short)):
        topic = kind == PROSE and brief
        if kind >= MENU:
            out.append(-i - 1)
        else:
            opens = kind in (HEADING, PROSE) or kind in (HEAD, LIST) and before not in (HEADING, kind)  # furniture may stand between
            section += opens and not (under and not topic and kind != HEADING)
            out.append(section)
            under, before = topic, kind
        topics.append(topic)
    return out, topics


def shapes(s: str) -> tuple[str, str, str]:
    """The form of a line: its first word and marks, its first two words, its last two; numbers are masked."""
    w = ["0" if x[0].isdigit() else x for x in _WORD.findall(s)] or [""]
    return w[0] + "|" + "".join(x for x in w if not x[:1].isalnum())[:6], " ".join(w[:2]), " ".join(w[-2:])


class Tree:
    """Presentation importance of forms: sorted 64-bit keys and the mean importance of what stands beside them."""

    def __init__(self, covered: float):
        #: log odds of a kind before its form is looked at: furniture of the list, menus, structured lines, and prose, which the list did
        #: not name although it names the share ``covered`` of all furniture
        plain = -np.log(1 - covered)
        self.prior = np.array([plain, plain + 1.5, plain + 1.5, plain + 1.5, plain + 1.5, 0.0, -3.0, -8.0])
        self.keys, self.mean, self.scale = np.empty(0, "int64"), np.empty(0), 1.0

    def learn(self, keys: np.ndarray, total: np.ndarray, n: np.ndarray) -> None:
        """Takes one round's sums; three unseen lines' worth of doubt is added to every form."""
        x = total / np.maximum(n, 1)
        self.scale = float((n * x * x).sum() / max((n * x).sum(), 1e-9)) or 1.0
        order = np.argsort(keys)
        self.keys, self.mean = keys[order], ((total + 3 * self.scale * 0.83) / (n + 3))[order]

    def belief(self, kinds: np.ndarray, forms: np.ndarray) -> np.ndarray:
        """How likely each line is content by kind and form; ``forms`` has a column for each of the three keys."""
        odds = self.prior[kinds]
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, forms), len(self.keys) - 1)
            known = self.keys[at] == forms
            mean = np.where(known, self.mean[at], self.scale * 0.83).mean(axis=1)
            z = np.clip(0.6 * mean / self.scale, 0.15, 0.95)  # a form alone does not outweigh a list that covers most furniture
            odds = odds + 2 * np.log(z / (1 - z))
        return 1 / (1 + np.exp(-odds))


def _flat(pages: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """Pages' arrays end to end: start of each page, line numbers, kinds, importance, forms, briefness."""
    size = pages["line_no"].map(len).to_numpy()
    start = np.concatenate([[0], np.cumsum(size)])
    cat = lambda c, t: np.concatenate(pages[c].to_numpy()).astype(t) if len(pages) else np.empty(0, t)
    kinds = cat("kind", "int64")
    known, bullet = cat("known", "bool"), cat("bullet", "bool")
    for a, b in zip(start, start[1:]):
        kinds[a:b] = settle(kinds[a:b].tolist(), known[a:b].tolist(), bullet[a:b].tolist())
    forms = np.stack([cat(f"form{i}", "int64") for i in range(3)], axis=1)
    forms[:, :2] ^= np.where(kinds < MENU, kinds, 0)[:, None]  # the first words of a list or heading are not those of prose
    return start, cat("line_no", "int32"), kinds, cat("importance", "float64"), forms, cat("short", "bool")


def main_body(
    pages: DataFrame, key: str, text: str, host: str, low: float = 0.3, least_belief: float = 0.2, few: int = 8, most: int = 1000, rounds: int = 2, share: float = 2e-5, forms: Mapping[str, Sequence[str]] = FURNITURE, covered: float = 0.9,
) -> DataFrame:
    """(row_key, line_no): the non-blank lines of each text that belong to its main body; lines end at \\n, count from 1.

    NULL, blank and no-data texts give no rows; neither do 'None' and 'Unavailable' alone (markers within 200 letters, blanks included). A text delivered twice under one key counts once (one
    delivery, the smallest text, is taken if they differ). A NULL host is a host of its own. Very long texts are read whole.

    A line is pruned if it is content with a likelihood below ``least_belief``; a branch, if its lines' mean content importance is below
    ``low``; a short line over it only if its own importance is below ``low`` too. ``forms`` may be empty, ``covered`` is then taken as 0.

    Plan: one shuffle of pages by key for deliveries; lines are read in Python once, as hashes; counting (host, line) is a partial
    aggregation, so a hot host's notice leaves one row a task, and lines that repeat are joined back by equality. Lines
    then return to their pages as arrays. Each round sums the importance beside every form, in the map tasks first; forms of
    at least ``share`` of all lines come to the driver, so at most 3 / ``share`` of them; rarer ones say nothing about a line.
    """
    from ..sources.tables import checkpointed

    patterns = tuple(p for ps in forms.values() for p in ps)
    p = pages.select(F.col(f"`{key}`").cast("string").alias("row_key"), F.coalesce(F.col(f"`{host}`"), F.lit("")).alias("host"), F.col(f"`{text}`").alias("text"))
    short = (F.length("text") <= 200) & (~present("text") | F.lower(F.trim("text")).isin("none", "unavailable"))  # markers are short; only those are looked at
    p = p.where(F.col("row_key").isNotNull() & F.col("text").isNotNull() & ~short)
    p = p.groupBy("row_key").agg(F.min(F.struct("text", "host")).alias("p")).select("row_key", "p.host", "p.text")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        digest = lambda x: xxhash.xxh64_intdigest(x) - (1 << 63)

        @cache
        def look(s: str) -> tuple:
            """What a line alone tells; furniture repeats, so most lines of a batch have been seen."""
            kind, cells = first_kind(s, patterns)
            bare = _ITEM.match(s)[1] if kind == ITEM else s
            return kind, cells if len(cells) > 3 else (), digest(bare), s[-1] not in ".!?…" and len(s) <= 120, bare != s, *map(digest, shapes(s))

        for b in batches:
            out: list[list] = [[] for _ in range(11)]
            add = [x.append for x in out]
            for k, h, t in zip(b["row_key"], b["host"], b["text"]):
                seen: set[int] = set()
                menus: set[str] = set()
                for n, line in enumerate(t.split("\n"), 1):
                    if not (s := line.strip()):
                        continue
                    kind, cells, code, short, bullet, f0, f1, f2 = look(s)
                    menus.update(cells)
                    for put, x in zip(add, (k, h, n, kind, code, code not in seen, short, bullet, f0, f1, f2)):
                        put(x)
                    seen.add(code)
                if menus:
                    for n, code in [(0, digest(c)) for c in menus] + [(1, 0)]:
                        for put, x in zip(add, (None, h, n, MENU, code, True, False, False, 0, 0, 0)):
                            put(x)
            look.cache_clear()
            types = [object, object, "int32", "int8", "int64", "int32", bool, bool, "int64", "int64", "int64"]
            names = ["row_key", "host", "line_no", "kind", "line", "first", "short", "bullet", "form0", "form1", "form2"]
            yield pd.DataFrame({n: x if t is object else np.array(x, t) for n, x, t in zip(names, out, types)})

    lines = checkpointed(p.mapInPandas(read, "row_key string, host string, line_no int, kind tinyint, line long, first int, short boolean, bullet boolean, form0 long, form1 long, form2 long"))
    of_page = F.col("row_key").isNotNull()
    size = lines.where(of_page).groupBy("host").agg(F.countDistinct("row_key").alias("of"))
    words = lines.where(~of_page & (F.col("line_no") == 0)).groupBy("host", "line").agg(F.count("*").alias("n"))
    menus = lines.where(~of_page & (F.col("line_no") == 1)).groupBy("host").agg(F.count("*").alias("menus"))
    on_host = words.join(menus, "host").where("n >= 2 AND n >= 0.004 * menus").select("host", "line", F.lit(0).cast("long").alias("m"), F.lit(True).alias("known"))
    anywhere = menu_words(words, menus)
    repeats = lines.where(of_page).groupBy("host", "line").agg(F.sum("first").alias("m")).where("m > 1").withColumn("known", F.lit(False))
    nodes = repeats.unionByName(on_host).groupBy("host", "line").agg(F.max("m").alias("m"), F.max("known").alias("known")).join(size, "host")
    within = F.least(F.greatest("of", F.lit(few)), F.lit(most))
    content = 1 - F.log(F.greatest(F.lit(1.0), F.col("m") * within / F.greatest("of", F.lit(few)))) / F.log(within)
    weighed = lines.where(of_page).join(nodes.select("host", "line", content.alias("importance"), "known"), ["host", "line"], "left")
    known = F.coalesce("known", F.lit(False)) | F.col("line").isin(anywhere) if anywhere else F.coalesce("known", F.lit(False))
    row = F.struct("line_no", "kind", F.coalesce("importance", F.lit(1.0)).cast("float").alias("importance"), known.alias("known"), "short", "bullet", "form0", "form1", "form2")
    whole = weighed.groupBy("row_key").agg(F.array_sort(F.collect_list(row)).alias("lines"))
    whole = checkpointed(whole.select("row_key", *[F.col(f"lines.{c}").alias(c) for c in ("line_no", "kind", "importance", "known", "short", "bullet", "form0", "form1", "form2")]))

    tree = Tree(covered if patterns else 0.0)
    all_lines = whole.agg(F.sum(F.size("line_no"))).first()[0] or 0
    for _ in range(rounds):

        def beside(batches: Iterator[pd.DataFrame], tree: Tree = tree) -> Iterator[pd.DataFrame]:
            for b in batches:
                start, _, kinds, importance, codes, _ = _flat(b)
                if not len(kinds):
                    continue
                s = importance * tree.belief(kinds, codes)
                first, last = np.zeros(len(s), bool), np.zeros(len(s), bool)
                first[start[:-1]], last[start[1:] - 1] = True, True
                above, below = np.where(first, np.nan, np.roll(s, 1)), np.where(last, np.nan, np.roll(s, -1))
                near = np.where(first, below, np.where(last, above, (above + below) / 2))
                near = np.where(first & last, np.nan, near)  # a line alone on its page has nothing beside it
                use = ~np.isnan(near)
                form, at = np.unique(codes[use].ravel(), return_inverse=True)
                x = np.repeat(near[use], 3)
                yield pd.DataFrame({"form": form, "total": np.bincount(at.ravel(), x, len(form)), "n": np.bincount(at.ravel(), minlength=len(form))})

        sums = whole.mapInPandas(beside, "form long, total double, n long").groupBy("form").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        found = sums.where(F.col("n") >= share * all_lines).toPandas()  # at most 3 / share rows
        step = Tree(covered if patterns else 0.0)
        step.learn(found["form"].to_numpy("int64"), found["total"].to_numpy("float64"), found["n"].to_numpy("float64"))
        tree = step

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            start, number, kinds, importance, codes, short = _flat(b)
            content = tree.belief(kinds, codes) >= least_belief
            keys, kept = [], []
            for k, a, z in zip(b["row_key"], start, start[1:]):
                branch, topic = branches(kinds[a:z].tolist(), short[a:z].tolist())
                block: dict[int, list[float]] = {}
                over: dict[int, float] = {}
                left = [i for i in range(z - a) if content[a + i]]
                for i in left:
                    if topic[i]:
                        over[branch[i]] = max(over.get(branch[i], 0.0), importance[a + i])
                    else:
                        block.setdefault(branch[i], []).append(importance[a + i])
                for i in left:
                    mean = sum(x) / len(x) if (x := block.get(branch[i])) else None
                    if (mean if mean is not None else over[branch[i]]) >= low or topic[i] and over[branch[i]] >= low:
                        keys.append(k), kept.append(number[a + i])
            yield pd.DataFrame({"row_key": keys, "line_no": np.array(kept, "int32")})

    return whole.mapInPandas(keep, "row_key string, line_no int")


def menu_words(words: DataFrame, menus: DataFrame, share: float = 0.004) -> list[int]:
    """Hashes of the words in at least ``share`` of all pages with menus of four words or more, for hosts too small to show theirs.

    ``words`` counts (host, line) words by pages, ``menus`` the pages of a host that have a menu. At most the mean number of
    words a menu / ``share`` come back.
    """
    total = menus.agg(F.sum("menus").alias("total"))
    often = words.groupBy("line").agg(F.sum("n").alias("n")).crossJoin(F.broadcast(total)).where(F.col("n") >= F.greatest(F.lit(1.0), share * F.col("total")))  # one row on the right
    return [r[0] for r in often.select("line").collect()]


def page_bodies(web: DataFrame, sources: DataFrame) -> DataFrame:
    """(origin, row_key, line_no) of web_stages.evidence_text and registered_sources.abstract_or_snippet."""
    s = sources.withColumn("__host", F.lower(F.expr("try_parse_url(url, 'HOST')")))
    both = web.select(F.concat(F.lit("web_stages\u0001"), F.col("web_source_id")).alias("id"), F.regexp_replace(F.lower("domain_host"), r"^www\.", "").alias("host"), F.col("evidence_text").alias("text")).unionAll(
        s.select(F.concat(F.lit("registered_sources\u0001"), F.col("source_id")), F.regexp_replace("__host", r"^www\.", ""), F.col("abstract_or_snippet"))
    )
    found = main_body(both, "id", "text", "host")
    return found.select(F.split("row_key", "\u0001")[0].alias("origin"), F.split("row_key", "\u0001")[1].alias("row_key"), "line_no")
