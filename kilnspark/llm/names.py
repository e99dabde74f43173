"""Variant spellings of organisations' names.

Each distinct spelling is read into tokens: generic words (trades, legal forms, titles) in their full form, and proper words. A
symmetric-delete index on the tokens finds those within a small edit distance. Each name looks for others by its rarest token, counted
with all its near spellings, so a typo in a common word looks by another one; the tokens of each candidate pair are then aligned
by an optimal assignment in which words may stand in another order, a word may meet its abbreviation and a given name its
initial or nickname. Linked spellings form components; a component is an organisation.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Mapping
from functools import cache, reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import present, squeeze
from ..sources.tables import checkpointed

#: Generic words of organisations' names and their shortened forms.
WORDS = {
    "engineering": "eng engrg engr engineers engineer engg", "materials": "mat matl matls material mats", "products": "prod prods product", "industries": "ind inds industry indus", "services": "svc svcs serv service srvcs", "manufacturing": "mfg manuf manufacturers manufacture",
    "recovery": "recov rec recvry", "systems": "sys system syst", "development": "dev devt developments devel developers", "technologies": "tech techn technology techs technol", "solutions": "soln solns solution sol", "processing": "proc processors processor process", "international": "intl int internat", "building": "bldg bldgs buildings build",
    "environmental": "env environ environm envir envtl environment", "cement": "cem cmt", "concrete": "concr conc", "carbon": "carb", "mineral": "min minerals minl", "aggregates": "agg aggr aggregate aggs", "pozzolan": "pozz", "binder": "bind binders bndr", "precast": "prec", "clinker": "clink", "clay": "clays", "kiln": "kilns", "slag": "slags", "ash": "", "low": "",
    "university": "univ uni", "national": "nat natl", "research": "res", "institute": "inst", "nri": "", "consulting": "consult consultancy consultants consultant",
}

#: Legal forms, written together, and the form they stand for.
LEGAL = {
    "ltd": "ltd", "limited": "ltd", "ptyltd": "pty", "ptylimited": "pty", "inc": "inc", "incorporated": "inc", "corp": "corp", "corporation": "corp", "co": "co", "company": "co", "llc": "llc", "gmbh": "gmbh", "ag": "ag", "bv": "bv", "sa": "sa", "plc": "plc", "kg": "kg", "nv": "nv", "spa": "spa", "srl": "srl", "ab": "ab", "oy": "oy", "as": "as",
}

#: Nicknames and the given names they stand for.
NICKNAMES = {
    "mike": "michael", "tom": "thomas", "liz": "elizabeth", "beth": "elizabeth", "joe": "joseph", "toni": "antonio", "tony": "antonio", "hannes": "johannes", "hans": "johannes", "alex": "alexander", "kate": "katherine", "kathy": "katherine", "kath": "katherine", "bill": "william", "will": "william", "wm": "william", "bob": "robert", "rob": "robert",
    "chris": "christina", "tina": "christina", "meg": "margaret", "maggie": "margaret", "peggy": "margaret", "max": "maximilian", "sam": "samuel", "ben": "benjamin", "dave": "david", "steve": "stephen", "jim": "james", "dan": "daniel", "nick": "nicholas", "ed": "edward", "greta": "margaret", "sepp": "joseph",
}
GIVEN = set(NICKNAMES.values())

_FILL = {"the", "of", "for", "and", "dr", "prof", "mr", "mrs", "ms", "dept", "department", "civil"}


def plain(name: str) -> str:
    """Lower case without accents, ß as ss, whatever Unicode form it came in."""
    s = unicodedata.normalize("NFKD", name.replace("ß", "ss"))
    return "".join(c for c in s if not unicodedata.combining(c)).lower().replace("ø", "o").replace("æ", "ae")


class Words:
    """A list of generic words with their shortened forms; an empty one makes every word a proper one."""

    def __init__(self, words: Mapping[str, str]):
        self.words = words
        self.full = {a: w for w, short in words.items() for a in (w, *short.split())}
        self.generic = cache(self.generic)

    def generic(self, token: str) -> str | None:
        """The full generic word that a token is, shortens by rule (its first four letters or more) or by the table; else None."""
        if (w := self.full.get(token)) or len(token) < 4:
            return w
        return next((w for w in self.words if w.startswith(token)), None)

    def mistyped(self, token: str) -> str | None:
        """The generic word of five letters or more that a token is but for one edit; else None."""
        return next((w for w in self.words if len(w) > 4 and len(token) > 4 and near(token, w, 1)), None)


_WORDS = Words(WORDS)


def read_name(name: str, words: Words = _WORDS) -> tuple[str, str, str, str]:
    """(trade, proper, given, legal) of a spelling.

    ``trade`` is the full generic words in order of the alphabet, mistyped ones among them if a proper word is left without them;
    ``proper`` the proper words in the order typed, ``given`` a person's given name or initial, ``legal`` the legal form; each may be ''.
    Acronyms before a name in parentheses, places behind a dash and departments are left out.
    """
    generic = words.generic
    s = plain(name).replace("&", " and ").replace("'", "").replace("’", "")
    if m := re.match(r"^\s*(\S+)\s+\((.+)\)\s*$", s):
        if re.fullmatch(r"[a-z]{2,6}", m[1]):
            s = m[2]
    elif m := re.match(r"^\s*nri\s+(.+?)\s*\((.+)\)\s*$", s):
        s = f"{m[1]} {m[2]}"
    s = re.sub(r",?\s*\bdept\b.*$", "", s)
    head, dash, tail = s.rpartition(" - ")
    if dash:
        rest = [generic(t) for t in re.findall(r"[^\W_]+", tail)]
        s = f"{head} {tail}" if any(rest) else head
    s = re.sub(r"\b([a-z])\.\s?([a-z])\.(?:\s?([a-z])\.)?(?:\s?([a-z])\.)?(?=\W|$)", lambda m: "".join(x for x in m.groups() if x) if "".join(x for x in m.groups() if x) in LEGAL else m[0], s)
    s = re.sub(r"\bg\.?m\.?b\.?h\b\.?", "gmbh", s)
    tokens = [t for t in re.findall(r"[^\W_]+", s) if t not in _FILL]
    legal = ""
    known = [generic(t) for t in tokens]
    while len(tokens) > 1:  # legal forms stand at the end, 'pty ltd' in two words
        if len(tokens) > 2 and tokens[-2] + tokens[-1] in LEGAL:
            legal, tokens, known = LEGAL[tokens[-2] + tokens[-1]], tokens[:-2], known[:-2]
        elif tokens[-1] in LEGAL:
            legal, tokens, known = LEGAL[tokens[-1]], tokens[:-1], known[:-1]
        else:
            break
    if known.count(None) > 1:
        meant = [k or words.mistyped(t) for t, k in zip(tokens, known)]
        known = meant if None in meant else known
    trade = sorted({k for k in known if k and k != "nri"})
    if "nri" in known:
        trade = sorted({*trade, "national", "research", "institute"})
    proper = [t for t, k in zip(tokens, known) if not k]
    given = ""
    if trade == ["consulting"]:
        found = [i for i, t in enumerate(proper) if t in GIVEN or t in NICKNAMES] or [i for i, t in enumerate(proper) if len(t) == 1]
        if found and len(proper) > 1:
            given = NICKNAMES.get(proper[found[0]], proper[found[0]])
            proper = [t for i, t in enumerate(proper) if i != found[0]]
    if not proper:  # nothing but generic words: the name is its own proper part
        return "", " ".join(tokens), "", legal
    return " ".join(trade), " ".join(proper), given, legal


def near(a: str, b: str, most: int) -> bool:
    """Whether b comes from a by at most ``most`` (1 or 2) insertions, deletions, substitutions or swaps of neighbours."""
    if abs(len(a) - len(b)) > most:
        return False
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if before and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return False
        before, last = last, row
    return last[-1] <= most


def shortens(a: str, b: str) -> bool:
    """Whether the shorter word abbreviates the longer: same first letter, all its letters in order; an initial does."""
    if len(a) > len(b):
        a, b = b, a
    it = iter(b)
    return a[:1] == b[:1] and all(c in it for c in a)


def one_stem(a: str, b: str) -> bool:
    """Whether two words begin alike with five letters or more and end otherwise in four at most, as 'consulting' and 'consultancy' do."""
    n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return n >= 5 and max(len(a), len(b)) - n <= 4


def aligned(a: list[str], b: list[str], most: int) -> float:
    """The best total of an assignment of a's tokens to b's, as a share of the longer list: 1 for equal, less for an abbreviation,
    initial, nickname, typo or another ending. Exact over all assignments, by dynamic programming over the set of b's tokens used."""

    def score(x: str, y: str) -> float:
        if x == y:
            return 1.0
        if min(len(x), len(y)) > 3 and near(x, y, most) or NICKNAMES.get(x, x) == NICKNAMES.get(y, y):
            return 0.9
        return 0.8 if shortens(x, y) else 0.7 if one_stem(x, y) else 0.0

    best = {0: 0.0}
    for x in a:
        step = dict(best)
        for used, total in best.items():
            for j, y in enumerate(b):
                if not used >> j & 1 and (s := score(x, y)):
                    step[used | 1 << j] = max(step.get(used | 1 << j, 0.0), total + s)
        best = step
    return max(best.values()) / max(len(a), len(b), 1)


def read_names(names: DataFrame, column: str = "name", words: Mapping[str, str] = WORDS) -> DataFrame:
    """(name, trade, proper, given, legal) of each row's spelling."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Words(words)
        for b in batches:
            yield pd.DataFrame([(n, *read_name(n, known)) for n in b["name"]], columns=["name", "trade", "proper", "given", "legal"])

    return names.select(F.col(f"`{column}`").alias("name")).mapInPandas(run, "name string, trade string, proper string, given string, legal string")


def near_tokens(tokens: DataFrame, most: int = 1, least: int = 5) -> DataFrame:
    """(trade, t, u): tokens of one trade, (trade, t) rows, within ``most`` edits of each other, each with itself as well.

    Symmetric deletes: every token stands under itself and itself less one letter (twice, for ``most`` = 2); tokens that share
    one meet. A bucket holds distinct strings that differ from one string by one letter, so its size is bounded by the alphabet, not
    by rows. Tokens of fewer than ``least`` letters meet only themselves: an edit makes another word of them.
    """
    drop = "transform(sequence(1, length({0})), i -> concat(left({0}, i - 1), substr({0}, i + 1)))"
    once = drop.format("t")
    stubs = f"array_append({once}, t)" if most == 1 else f"array_append(array_union({once}, flatten(transform({once}, s -> {drop.format('s')}))), t)"
    idx = spread(tokens.where(F.length("t") >= least)).selectExpr("trade", "t", f"explode(array_distinct({stubs})) AS stub")
    pairs = idx.join(idx.withColumnRenamed("t", "u"), ["trade", "stub"]).where("t < u").select("trade", "t", "u").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            yield p[[near(t, u, most) for t, u in zip(p["t"], p["u"])]]

    found = spread(pairs).mapInPandas(run, "trade string, t string, u string")
    return tokens.select("trade", "t", F.col("t").alias("u")).unionAll(found).unionAll(found.select("trade", F.col("u").alias("t"), F.col("t").alias("u")))


def spread(df: DataFrame) -> DataFrame:
    """As many partitions as the session has cores, however few bytes there are: what follows is work, not data."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def near_keys(keys: DataFrame, most: int = 1) -> DataFrame:
    """(a, b): ids of keys (id, trade, proper, given, legal) of the same trade whose tokens agree but for order, small edits and shortening.

    A key looks for others that hold its rarest token or a near one, rarest by the number of keys with the token or a near one; and, if
    it has several proper words, for those with all of them written together, and for those that share one of its two rarest
    tokens and the initials of the others, as abbreviations do. Legal forms and given names must not contradict; missing ones
    agree with any. Every proper word must have a partner.
    """
    words = F.split("proper", " ")
    several = F.size(words) > 1
    joined = F.regexp_replace("proper", " ", "")
    me = F.struct("id", "proper", "given", "legal")  # travels with its tokens, so that pairs need no look-up afterwards
    tok = keys.select(me.alias("me"), "trade", F.explode(F.array_distinct(F.when(several, F.array_append(words, joined)).otherwise(words))).alias("t"), several.alias("several"), joined.alias("joined"))
    vocabulary = tok.groupBy("trade", "t").agg(F.count("*").alias("df"))
    beside = checkpointed(near_tokens(vocabulary.select("trade", "t"), most))
    weight = beside.join(vocabulary.withColumnRenamed("t", "u"), ["trade", "u"]).groupBy("trade", "t").agg(F.sum("df").alias("df"))
    whole = F.col("several") & (F.col("t") == F.col("joined"))
    order = F.row_number().over(W.partitionBy("me.id").orderBy("whole", "df", "t"))
    ranked = checkpointed(tok.join(weight, ["trade", "t"]).withColumn("whole", whole).withColumn("rank", order).select("me", "trade", "t", "several", "whole", "rank"))
    looks = ranked.where("rank = 1 OR whole").select(F.col("me").alias("x"), "trade", "t")
    met = looks.join(beside, ["trade", "t"]).select("x", "trade", "u").join(ranked.select(F.col("me").alias("y"), "trade", F.col("t").alias("u")), ["trade", "u"]).select("x", "y")
    begun = ranked.where("several AND NOT whole AND rank <= 2")
    rest = F.array_remove(F.split("me.proper", " "), F.col("t"))
    begun = begun.select("me", "trade", "t", F.array_join(F.array_sort(F.transform(rest, lambda w: F.left(w, F.lit(1)))), "").alias("initials"))
    same = begun.withColumnRenamed("me", "x").join(begun.withColumnRenamed("me", "y"), ["trade", "t", "initials"]).select("x", "y")
    agree = "(x.legal = y.legal OR x.legal = '' OR y.legal = '') AND (left(x.given, 1) = left(y.given, 1) OR x.given = '' OR y.given = '')"
    pairs = met.where(f"x.id <> y.id AND {agree}").unionAll(same.where(f"x.id < y.id AND {agree}")).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    pairs = pairs.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.col("x.proper").alias("pa"), F.col("y.proper").alias("pb"), F.col("x.given").alias("ga"), F.col("y.given").alias("gb"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            yield p.loc[[same_name(*x, most) for x in zip(p["pa"], p["pb"], p["ga"], p["gb"])], ["a", "b"]]

    return spread(pairs).mapInPandas(run, "a long, b long")


def same_name(a: str, b: str, given_a: str = "", given_b: str = "", most: int = 1) -> bool:
    """Whether two proper parts mean one name: written together they are within ``most`` edits, or every word has a partner and one at
    least is the same but for edits; given names must agree where both stand."""
    if given_a and given_b and not aligned([given_a], [given_b], most):
        return False
    x, y = a.split(), b.split()
    if near("".join(x), "".join(y), most):
        return True
    if len(x) != len(y) or len(x) == 1:
        return False
    if not any(len(t) > 3 and near(t, u, most if min(len(t), len(u)) > 4 else 0) for t in x for u in y):
        return False
    return aligned(x, y, most) >= 0.8 and all(aligned([t], [u], most) for t, u in partners(x, y, most))


def partners(a: list[str], b: list[str], most: int) -> list[tuple[str, str]]:
    """The pairs of the best assignment, found by taking out each token in turn; a token without a partner is paired with ''."""
    if not a:
        return []
    rest = [b[:j] + b[j + 1 :] for j in range(len(b))]
    j = max(range(len(b)), key=lambda j: aligned(a[:1], [b[j]], most) + aligned(a[1:], rest[j], most) * len(a[1:]))
    return [(a[0], b[j] if aligned(a[:1], [b[j]], most) else ""), *partners(a[1:], rest[j], most)]


def components(ids: DataFrame, links: DataFrame) -> DataFrame:
    """(id, label): the smallest id that each id is linked with, directly or not.

    Each round takes the smallest label among neighbours and then that label's own label, so paths shrink by half; it ends when nothing changes.
    Only ids with a link take part; the others are their own label. Labels are written to the checkpoint folder each round, so lost executors
    cost no more than a round.
    """
    both = checkpointed(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpointed(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("label")))
    while True:
        seen = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("other"))
        step = labels.join(seen, labels["id"] == seen["a"]).select("id", F.least("label", "other").alias("label"), F.col("label").alias("was"))
        up = labels.select(F.col("id").alias("p"), F.col("label").alias("pl"))
        step = checkpointed(step.join(up, step["label"] == up["p"]).select("id", F.least("label", "pl").alias("label"), "was"))
        changed = not step.where("label <> was").isEmpty()
        labels = step.select("id", "label")
        if not changed:
            return ids.select("id").join(labels, "id", "left").select("id", F.coalesce("label", "id").alias("label"))


def link_names(columns: list[tuple[DataFrame, str]], most: int = 1, words: Mapping[str, str] = WORDS) -> DataFrame:
    """(name, organisation): each distinct spelling, stripped of outer blanks, and the organisation (a number) it means.

    Missing values are no names. Spellings that differ in case, accents or blanks stay different spellings of one organisation.
    An empty table gives an empty one. Spellings of the same key need no comparison, so many spellings of one organisation
    cost one key each, and a name in a third of all rows costs one row after the first aggregation.
    """
    names = reduce(DataFrame.unionAll, [d.select(squeeze(c).alias("name")).where(present(c)).distinct() for d, c in columns]).distinct()
    read = checkpointed(read_names(spread(names), words=words))
    parts = ["trade", "proper", "given", "legal"]
    keys = checkpointed(read.select(*parts).distinct().withColumn("id", F.monotonically_increasing_id()))
    labels = components(keys, near_keys(keys, most))
    org = keys.join(labels, "id").select(*parts, F.col("label").alias("organisation"))
    return read.join(org, parts).select("name", "organisation")


def name_pairs(linked: DataFrame, block: int = 1000) -> DataFrame:
    """(name_a, name_b): all pairs of spellings within an organisation, name_a first by code point.

    An organisation of many spellings is spread over several keys: its left side goes to one of ceil(n / block) salts, its right
    side to all of them.
    """
    size = linked.groupBy("organisation").agg(F.count("*").alias("n")).where("n > 1").select("organisation", F.ceil(F.col("n") / block).cast("int").alias("salts"))
    s = linked.join(size, "organisation")
    a = s.select("organisation", F.col("name").alias("name_a"), F.pmod(F.xxhash64("name"), F.col("salts")).cast("int").alias("salt"))
    b = s.select("organisation", F.col("name").alias("name_b"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    return a.join(b, ["organisation", "salt"]).where("name_a < name_b").select("name_a", "name_b")
