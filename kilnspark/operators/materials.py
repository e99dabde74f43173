"""Material and technology names against a taxonomy: clean names, sample codes and artefacts, a lexicon of terms, a decision cascade."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import checkpointed

#: Ranks of a lexicon's kinds of terms: a lower one decides first.
KINDS = {"display": 0, "variant": 1, "synonym": 2, "cue": 3}


def compatible(df: DataFrame, column: str) -> DataFrame:
    """``column`` in Unicode compatibility form (NFKC). Only rows with letters beyond ASCII go through Python, in Arrow batches."""
    kind = df.schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import unicodedata

        for b in batches:
            b[column] = [unicodedata.normalize("NFKC", x) for x in b[column]]
            yield b

    far = F.coalesce(F.col(column).rlike(r"[^\x00-\x7F]"), F.lit(False))
    return df.where(~far).unionAll(df.where(far).mapInPandas(run, kind))


def clean_name(c: Column) -> Column:
    """A compatible name with plain dashes and quotes, no quotes around, no blanks around slashes and dashes, no sample code in parentheses
    at its end, no marks around."""
    t = F.translate(F.regexp_replace(F.coalesce(c, F.lit("")), "[​]", ""), " –—′’", " --''")
    t = F.regexp_replace(F.trim(t), "^[\"'`]+|[\"'`]+$", "")
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"\s+", " "), r"\s*/\s*", "/"), r"\s*-\s*", "-")
    t = F.regexp_replace(t, r"\s*\((?:[SMVCFRPT]?[0-9]+[a-zA-Z]?|[Mm]ix\s*[0-9]+)\)\s*$", "")
    return F.regexp_replace(t, "^[ ,;:]+|[ ,;:]+$", "")


def match_key(clean: Column) -> Column:
    """The key names are compared by: lower case, '&' as and, other marks than dots and pluses as blanks."""
    t = F.replace(F.lower(clean), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[^\p{L}\p{N}_\s.+]", " "), r"\s+", " "))


def is_sample_code(clean: Column, keywords: Sequence[str]) -> Column:
    """Whether a clean name of up to 24 letters is the label of a sample or mix ('Mix 4', 'S12a', '1027A'); not if it names a material."""
    low = F.lower(clean)
    code = low.rlike(r"^(?:mix|sample|specimen|batch|series)[\s_-]*[a-z]?[0-9]+[a-z]?$|^[a-z][0-9]{1,3}[a-z]?$|^[0-9]{2,4}[a-z]$|^[mscvfr][\s_-]*[0-9]+[a-z]?$")
    names = F.lit(False)
    for k in keywords:
        names = names | low.contains(k)
    return (clean != "") & (F.length(clean) <= 24) & code & ~names


def is_artefact(clean: Column, words: Sequence[str], spared: Sequence[str]) -> Column:
    """Whether a clean name is a heading, a figure's or table's label, a citation or authors' names rather than a material; names that hold
    one of ``spared`` are no authors."""
    low = F.lower(clean)
    author = clean.rlike(r"^[A-Z][a-z]+(?:\s+[A-Z]\.?)?(?:\s+(?:and|&)\s+[A-Z][a-z]+)+(?:\s+et\s+al\.?)?$|^[A-Z][a-z]+(?:\s+[A-Z]\.?)*\s+et\s+al\.?$")
    for s in spared:
        author = author & ~low.contains(s)
    cited = low.rlike(r"doi\s*:|https?://|et\s+al\.|vol\.|pp\.|\([0-9]{4}\)")
    return (clean == "") | low.isin(*words) | low.rlike("^(?:table|fig|figure) ") | cited | author


def lexicon(reference: DataFrame, leaf: str, parent: Column, terms: Mapping[str, Column]) -> DataFrame:
    """(key, kind, leaf, parent, variant): the terms of each leaf, ``terms`` being kind -> array column; keys of two letters or more, cues of
    four; ``variant`` is the term itself for variants."""
    rows = None
    for kind, c in terms.items():
        one = reference.select(F.col(leaf).alias("leaf"), parent.alias("parent"), F.explode(c).alias("term"))
        one = one.where(F.length("term") >= (4 if kind == "cue" else 2)).select(match_key(clean_name(F.col("term"))).alias("key"), F.lit(kind).alias("kind"), "leaf", "parent", F.when(F.lit(kind) == "variant", F.col("term")).otherwise("").alias("variant"))
        rows = one if rows is None else rows.unionAll(one)
    return rows.where(F.length("key") >= 2).distinct()


def _rank() -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv]), F.col("kind"))


def lexicon_hits(names: DataFrame, lex: DataFrame, most_terms: int = 20_000) -> DataFrame:
    """(key, how, kind, leaf, parent, variant) for the distinct keys of ``names`` that hit: by an equal term ('exact'), else by the longest
    term of four letters or more that the key holds or is held by ('partial'; cues of eight). Terms of several leaves give 'ambiguous'
    with NULLs.

    Equal terms meet in an equi-join. For the rest the lexicon, which is configuration and bounded by ``most_terms`` (more raise ValueError),
    travels to the tasks: an automaton finds terms in keys, a table of the terms' parts finds keys in terms.
    """
    keys = names.select("key").where("key <> ''").distinct()
    same = keys.join(lex, "key").groupBy("key").agg(F.min(F.struct(_rank().alias("r"), "kind", "leaf", "parent", "variant")).alias("b"), F.countDistinct("leaf").alias("leaves"))
    pick = lambda df, how: df.select("key", F.when(F.col("leaves") > 1, "ambiguous").otherwise(how).alias("how"), *[F.when(F.col("leaves") == 1, F.col(f"b.{c}")).alias(c) for c in ("kind", "leaf", "parent", "variant")])
    exact = pick(same, "exact")
    rows = lex.where("length(key) >= 4 AND (kind <> 'cue' OR length(key) >= 8)").select("key").distinct().limit(most_terms + 1).collect()  # configuration, checked here
    if len(rows) > most_terms:
        raise ValueError(f"the lexicon has more than {most_terms} terms")
    terms = sorted(r[0] for r in rows)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        auto = ahocorasick.Automaton()
        for t in terms:
            auto.add_word(t, t)
        if terms:
            auto.make_automaton()
        for b in batches:
            out: list[tuple[str, str]] = []
            for k in b["key"]:
                best: set[str] = set()
                size = 0
                found = {t for _, t in auto.iter(k)} if terms else set()
                found.update(t for t in terms if len(t) >= max(len(k), size) and k in t)
                for t in found:
                    if len(t) > size:
                        best, size = {t}, len(t)
                    elif len(t) == size:
                        best.add(t)
                out.extend((k, t) for t in best)
            yield pd.DataFrame(out, columns=["key", "term"])

    rest = keys.join(exact.select("key"), "key", "left_anti").mapInPandas(run, "key string, term string")
    held = rest.join(lex.withColumnRenamed("key", "term").where("kind <> 'cue' OR length(term) >= 8"), "term")
    partial = held.groupBy("key").agg(F.min(F.struct("term", _rank().alias("r"), "kind", "leaf", "parent", "variant")).alias("b"), F.countDistinct("leaf").alias("leaves"))
    return exact.unionAll(pick(partial, "partial"))


def resolve_abbreviations(names: DataFrame, senses: DataFrame, hits: DataFrame) -> DataFrame:
    """(key, sense, how, leaf, parent): abbreviations among ``names`` (key, context) with the one sense (key, sense, sense_key) that
    the context holds; 'ambiguous' with NULLs where it holds none or several, or the sense hits nothing. ``hits`` are lexicon hits of sense keys."""
    met = names.join(senses, "key").withColumn("in", F.contains(F.col("context"), F.col("sense")))
    one = met.groupBy("key", "context").agg(F.count_if("in").alias("n"), F.min(F.when(F.col("in"), F.struct("sense", "sense_key"))).alias("s"))
    h = hits.where("leaf IS NOT NULL").select(F.col("key").alias("sense_key"), "leaf", "parent")
    j = one.select("key", "context", "n", "s.sense", F.col("s.sense_key").alias("sense_key")).join(h, "sense_key", "left")
    ok = (F.col("n") == 1) & F.col("leaf").isNotNull()
    return j.select("key", "context", F.when(ok, F.col("sense")).alias("sense"), F.when(ok, "context").otherwise("ambiguous").alias("how"), F.when(ok, F.col("leaf")).alias("leaf"), F.when(ok, F.col("parent")).alias("parent"))


def map_names(names: DataFrame, lex: DataFrame, senses: DataFrame, artefacts: Sequence[str], keywords: Sequence[str]) -> DataFrame:
    """Adds ``clean``, ``key``, ``status``, ``confidence``, ``rationale``, ``leaf``, ``parent``, ``variant`` and ``review`` to ``names``
    (name, context; distinct).

    In this order: artefacts and sample codes ('artefact', 'sample_id'); abbreviations by context ('ambiguous' in either case, since they
    need a look); equal terms ('mapped', High), longest contained terms ('mapped', Medium, to be reviewed), terms of several leaves
    ('ambiguous', Low); then the one leaf whose term of five letters or more stands in the context ('ambiguous', Low); else 'unresolved'.
    NULL names are artefacts. Every row is kept.
    """
    d = compatible(names.withColumn("__n", F.coalesce("name", F.lit(""))), "__n").withColumn("clean", clean_name(F.col("__n"))).drop("__n").withColumn("key", match_key(F.col("clean")))
    d = d.withColumn("__skip", F.when(is_artefact(F.col("clean"), artefacts, keywords), "artefact").when(is_sample_code(F.col("clean"), keywords), "sample_id"))
    d = checkpointed(d)  # distinct names, read four times below
    look = d.where("__skip IS NULL")
    abbr = look.join(senses.select("key").distinct(), "key", "left_semi").select("key", "context").distinct()
    hits = checkpointed(lexicon_hits(look.select("key").unionAll(senses.select(F.col("sense_key").alias("key"))), lex))
    a = resolve_abbreviations(abbr, senses, hits).select("key", "context", F.col("how").alias("a_how"), F.col("sense").alias("a_sense"), F.col("leaf").alias("a_leaf"), F.col("parent").alias("a_parent"))
    d = d.join(hits.select("key", F.col("how").alias("h_how"), F.col("kind").alias("h_kind"), F.col("leaf").alias("h_leaf"), F.col("parent").alias("h_parent"), F.col("variant").alias("h_variant")), "key", "left").join(a, ["key", "context"], "left")
    soft = d.where("__skip IS NULL AND a_how IS NULL AND h_how IS NULL").select("context").distinct()
    s = soft_matches(soft, lex).select("context", F.col("leaves").alias("s_leaves"), F.col("leaf").alias("s_leaf"), F.col("parent").alias("s_parent"))
    d = d.join(s, "context", "left")
    skip, abbrv, hit, vague = F.col("__skip").isNotNull(), F.col("a_how").isNotNull(), F.col("h_how").isNotNull(), F.col("s_leaves") > 0
    clear = F.col("h_leaf").isNotNull()
    case = lambda *v: F.when(skip, v[0]).when(abbrv, v[1]).when(hit, v[2]).when(vague, v[3]).otherwise(v[4])
    return d.select(
        *[c for c in names.columns], "clean", "key",
        case(F.col("__skip"), F.lit("ambiguous"), F.when(clear, "mapped").otherwise("ambiguous"), F.lit("ambiguous"), F.lit("unresolved")).alias("status"),
        case(F.lit("Artefact"), F.when(F.col("a_leaf").isNotNull(), "Medium").otherwise("Low"), F.when(~clear, "Low").when(F.col("h_how") == "exact", "High").otherwise("Medium"), F.lit("Low"), F.lit("Unresolved")).alias("confidence"),
        case(F.lit("no material"), F.concat(F.lit("abbreviation:"), F.coalesce("a_sense", F.lit("?"))), F.concat(F.col("h_how"), F.lit(":"), F.coalesce("h_kind", F.lit("several leaves"))), F.when(F.col("s_leaves") == 1, "context:one leaf").otherwise("context:several leaves"), F.lit("no match")).alias("rationale"),
        case(F.lit(None), F.col("a_leaf"), F.col("h_leaf"), F.when(F.col("s_leaves") == 1, F.col("s_leaf")), F.lit(None)).alias("leaf"),
        case(F.lit(None), F.col("a_parent"), F.col("h_parent"), F.when(F.col("s_leaves") == 1, F.col("s_parent")), F.lit(None)).alias("parent"),
        F.when(~skip & ~abbrv & hit, F.col("h_variant")).otherwise("").alias("variant"),
        (skip | abbrv | ~hit | ~clear | (F.col("h_how") != "exact")).alias("review"),
    )


def soft_matches(contexts: DataFrame, lex: DataFrame, most_terms: int = 20_000) -> DataFrame:
    """(context, leaves, leaf, parent): how many leaves have a name or synonym of five letters or more in the context (in lower case), and
    the one of least name. The lexicon travels to the tasks as an automaton; its size is checked."""
    rows = lex.where("kind IN ('display', 'synonym') AND length(key) >= 5").select("key", "leaf", "parent").distinct().limit(most_terms + 1).collect()  # configuration, checked here
    if len(rows) > most_terms:
        raise ValueError(f"the lexicon has more than {most_terms} terms")
    of: dict[str, list[tuple]] = {}
    for k, leaf, parent in rows:
        of.setdefault(k, []).append((leaf, parent))
    kind = lex.schema["leaf"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        auto = ahocorasick.Automaton()
        for t in of:
            auto.add_word(t, t)
        if of:
            auto.make_automaton()
        for b in batches:
            out = []
            for c in b["context"]:
                found = {x for _, t in auto.iter(c) for x in of[t]} if of and c else set()
                if found:
                    out.append((c, len({x[0] for x in found}), *min(found)))
            yield pd.DataFrame(out, columns=["context", "leaves", "leaf", "parent"])

    return contexts.mapInPandas(run, f"context string, leaves int, leaf {kind}, parent string")


def name_statistics(df: DataFrame, name: str, source: str, group: str, caption: str, order: str, captions: int = 8) -> DataFrame:
    """(key, longest, n_rows, n_sources, top_group, captions): each name's longest spelling (ties: the first by ``order``), rows, distinct
    sources, most frequent group (ties: the smaller) and its first distinct captions joined by ' | '.

    Aggregated by (key, group) and (key, caption) first, so a hot name leaves a row per group or caption.
    """
    key = match_key(clean_name(F.col(name)))
    d = df.select(key.alias("key"), F.col(name).alias("__n"), F.col(source).alias("__s"), F.trim(F.coalesce(F.col(group), F.lit(""))).alias("__g"), F.trim(F.coalesce(F.col(caption), F.lit(""))).alias("__c"), F.col(order).alias("__o")).where("key <> ''")
    base = d.groupBy("key").agg(F.max(F.struct(F.length("__n").alias("l"), F.col("__n"))).alias("b"), F.count("*").alias("n_rows"), F.countDistinct("__s").alias("n_sources"))
    g = d.where("__g <> ''").groupBy("key", "__g").agg(F.count("*").alias("n")).groupBy("key").agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col("__g").alias("g"))).alias("t"))
    c = d.where("__c <> ''").groupBy("key", "__c").agg(F.min("__o").alias("o"))
    from pyspark.sql import Window as W

    c = c.withColumn("rn", F.row_number().over(W.partitionBy("key").orderBy("o", "__c"))).where(F.col("rn") <= captions)
    c = c.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rn", "__c"))).alias("cs")).select("key", F.array_join(F.col("cs.__c"), " | ").alias("captions"))
    j = base.join(g, "key", "left").join(c, "key", "left")
    return j.select("key", F.col("b.__n").alias("longest"), "n_rows", "n_sources", F.coalesce("t.g", F.lit("")).alias("top_group"), F.coalesce("captions", F.lit("")).alias("captions"))
