"""Queries of evidence alignment, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import evidence as E
from ..sources.tables import table
from .book import Book
from .reference import _has

book = Book()
query = book.query
QUERIES, SQL = book.queries, book.sql

TERMS = {"L1-01": ("fly ash", "slag", "ash", "binder"), "L1-02": ("curing", "mortar", "co2", "specimens"), "L1-03": ("limestone", "calcined", "kiln"), "L1-04": ("mixed", "demoulded", "cement")}
GENERIC = ("carbon", "emissions", "reduction")
NUMBERS = (("cement_replacement_percentage", None, ("percent", "replace", "%")), ("testing_age_days", None, ("day", "age")))

_PLAIN = "regexp_replace(replace(replace(coalesce({0}, ''), chr(160), ' '), '％', '%'), '\\s+', ' ', 'g')"


def _passages(t: str, most: int = 600) -> str:
    p = _PLAIN.format(t)
    parts = f"list_filter(list_transform(string_split(regexp_replace({p}, '([.!?]) ([A-Z0-9\"''])', '\\1' || chr(1) || '\\2', 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '')"
    whole = f"flatten(list_transform({parts}, lambda p: CASE WHEN length(p) <= {most} THEN [p] ELSE list_filter(list_transform(range(0, length(p), {max(80, most // 2)}), lambda i: trim(substr(p, i + 1, {most}))), lambda x: x <> '') END))"
    s = f"list_filter(list_transform(string_split(regexp_replace({p}, '([.!?]) ', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '')"
    two = f"list_filter(list_transform(range(1, len({s})), lambda i: {s}[i] || ' ' || {s}[i + 1]), lambda p: length(p) > 40 AND length(p) <= {2 * most})"
    return f"list_concat({whole}, coalesce({two}, []))"


_LOW = "lower(" + _PLAIN.format("{0}") + ")"


def _holds(low: str, t: str) -> str:
    return f"(contains({low}, {t}) AND (length({t}) > 3 OR regexp_matches({low}, '(?:^|[^a-z0-9])' || {t} || '(?:$|[^a-z0-9])')))"


_TERM_CASE = "CASE taxonomy_level_1 " + " ".join(f"WHEN '{k}' THEN [{', '.join(repr(w) for w in v)}]" for k, v in TERMS.items()) + " ELSE []::VARCHAR[] END"
_ANY = lambda low, ts: f"(len({ts}) = 0 OR len(list_filter({ts}, lambda t: {_holds(low, 't')})) > 0)"


@query(f"""SELECT DISTINCT record_id, len(s)::INT AS n_passages, md5(array_to_string(s, '|')) AS digest FROM (SELECT record_id, {_passages("evidence_text")} AS s FROM (SELECT DISTINCT record_id, evidence_text FROM cementitious))""")
def evidence_passages(spark, d):
    """Candidate passages of each record's evidence: sentences, windows of long ones, pairs."""
    c = table(spark, d, "cementitious").select("record_id", "evidence_text").distinct().select("record_id", E.passages(F.col("evidence_text")).alias("s"))
    return c.select("record_id", F.size("s").alias("n_passages"), F.md5(F.array_join("s", "|")).alias("digest")).distinct()


def _score(x: str, ts: str = "ts") -> str:
    low = _LOW.format(x)
    s = f"coalesce(list_sum(list_transform({ts}, lambda t: CASE WHEN {_holds(low, 't')} THEN CASE WHEN length(t) <= 3 THEN 5 ELSE 3 + least(4, length(t) // 8) END ELSE 0 END)), 0)"
    chatter = " OR ".join(f"contains({low}, '{g}')" for g in GENERIC)
    return f"(CASE WHEN {s} > 0 THEN {s} + greatest(0, 8 - length({x}) // 120) WHEN {chatter} THEN {s} - 1 ELSE {s} END)"


@query(f"""WITH r AS (SELECT DISTINCT record_id, taxonomy_level_1, evidence_text, {_TERM_CASE} AS ts FROM cementitious WHERE taxonomy_level_1 IN ('L1-01', 'L1-02', 'L1-03', 'L1-04')),
p AS (SELECT record_id, ts, unnest(s) AS x, unnest(range(0, len(s))) AS i FROM (SELECT record_id, ts, {_passages("evidence_text")} AS s FROM r)), q AS (SELECT record_id, x, i, {_score("x")} AS score FROM p)
SELECT record_id, score::INT AS score, x AS passage FROM q WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY score DESC, i) = 1""")
def taxonomy_passages(spark, d):
    """The passage that supports a record's branch best, with its score."""
    terms = F.create_map(*[x for k, v in TERMS.items() for x in (F.lit(k), F.array(*[F.lit(w) for w in v]))])
    c = table(spark, d, "cementitious").where(F.col("taxonomy_level_1").isin(*TERMS)).select("record_id", "taxonomy_level_1", "evidence_text").distinct()
    c = c.select("record_id", F.element_at(terms, F.col("taxonomy_level_1")).alias("ts"), E.passages(F.col("evidence_text")).alias("s"))
    c = c.withColumn("passage", E.best_passage(F.col("s"), F.col("ts"), GENERIC)).where("passage <> ''")
    return c.select("record_id", E.support_score(F.col("passage"), F.col("ts"), GENERIC).alias("score"), "passage").distinct()


_FORMS = "flatten(list_transform(regexp_extract_all({0}, '-?[0-9]+(?:\\.[0-9]+)?'), lambda n: [n, n || '%', n || ' %', n || ' percent', n || ' per cent', replace(n, '.', ','), replace(n, '.', ',') || '%']))"


def _number(x: str, v: str, ctx) -> str:
    low = _LOW.format(x)
    return f"(len(list_filter({_FORMS.format(f'coalesce({v}, chr(2))')}, lambda f: contains({low}, f))) > 0 AND ({' OR '.join(f'contains({low}, {c!r})' for c in ctx if len(c) >= 3)}))"


@query(f"""WITH r AS (SELECT DISTINCT record_id, trim(cement_replacement_percentage) AS v, evidence_text FROM cementitious WHERE {_has("cement_replacement_percentage")}),
p AS (SELECT record_id, v, unnest(s) AS x, unnest(range(0, len(s))) AS i FROM (SELECT record_id, v, {_passages("evidence_text")} AS s FROM r))
SELECT record_id, v AS share, x AS passage FROM p WHERE {_number("x", "v", NUMBERS[0][2])} QUALIFY row_number() OVER (PARTITION BY record_id, v ORDER BY length(x), i) = 1""")
def numeric_passages(spark, d):
    """The shortest passage that supports the replaced share."""
    c = table(spark, d, "cementitious").where(F.col("cement_replacement_percentage").rlike("[0-9]")).select("record_id", F.trim("cement_replacement_percentage").alias("share"), "evidence_text").distinct()
    ctx = F.array(*[F.lit(x) for x in NUMBERS[0][2]])
    return c.select("record_id", "share", E.best_numeric(E.passages(F.col("evidence_text")), F.col("share"), F.lit(None).cast("string"), ctx).alias("passage")).where("passage <> ''")


def _pick(order: str, cond: str, x: str, cands: str) -> str:
    return f"coalesce((list_sort(list_filter(list_transform(range(1, len({cands}) + 1), lambda j: {{'o': {order.format(c=f'{cands}[j]')}, 'j': j}}), lambda z: {cond.format(c=f'{cands}[z.j]', o='z.o')})))[1].j, 0)"


def _align_sql() -> str:
    steps = f"""r AS (SELECT DISTINCT record_id, coalesce(taxonomy_level_1, '') AS slug, trim(coalesce(source_title, '')) AS e, evidence_text AS t, {_TERM_CASE} AS ts, {", ".join(f"CASE WHEN {_has(v)} AND regexp_matches({v}, '[0-9]') THEN trim({v}) END AS n{i}" for i, (v, _, _) in enumerate(NUMBERS))} FROM cementitious),
c AS (SELECT *, {_passages("t")} AS cs, {_passages("t", 900)} AS ws FROM r),
o AS (SELECT *, e <> '' AND {_ANY(_LOW.format("e"), "ts")} AS own, CASE WHEN e <> '' THEN list_concat([e], cs) ELSE cs END AS es FROM c),
b AS (SELECT *, CASE WHEN len(ts) > 0 AND NOT own THEN {_pick("-" + _score("{c}"), "{o} < 0", "", "es")} ELSE 0 END AS bj FROM o),
m0 AS (SELECT record_id, ts, cs, ws, {", ".join(f"n{i}" for i in range(len(NUMBERS)))}, CASE WHEN len(ts) = 0 THEN 'unchanged' WHEN own THEN 'existing' WHEN bj > 0 THEN 'searched' ELSE 'unsupported' END AS method, CASE WHEN bj > 0 THEN es[bj] ELSE e END AS e, []::VARCHAR[] AS cleared FROM b)"""
    for i, (v, _, ctx) in enumerate(NUMBERS):
        n = f"n{i}"
        steps += f""",
a{i} AS (SELECT *, {n} IS NOT NULL AND e <> '' AND {_number("e", n, ctx)} AS ok, CASE WHEN e <> '' THEN list_concat([e], cs) ELSE cs END AS es FROM m{i}),
k{i} AS (SELECT *, CASE WHEN {n} IS NOT NULL AND NOT ok THEN {_pick("length({c})", _number("{c}", n, ctx), "", "es")} ELSE 0 END AS j FROM a{i}),
f{i} AS (SELECT *, CASE WHEN j > 0 THEN es[j] ELSE '' END AS p FROM k{i}),
g{i} AS (SELECT *, CASE WHEN p <> '' AND NOT {_ANY(_LOW.format("p"), "ts")} THEN coalesce(list_filter(ws, lambda x: {_ANY(_LOW.format("x"), "ts")} AND {_number("x", n, ctx)})[1], '') ELSE p END AS q FROM f{i}),
m{i + 1} AS (SELECT record_id, ts, cs, ws, method, CASE WHEN q <> '' THEN q ELSE e END AS e, CASE WHEN {n} IS NOT NULL AND NOT ok AND q = '' THEN list_append(cleared, '{v}') ELSE cleared END AS cleared,
  {", ".join((f"CASE WHEN ok OR q <> '' THEN {n} END AS {n}" if k == i else f"n{k}") for k in range(len(NUMBERS)))} FROM g{i})"""
    last = len(NUMBERS)
    return f"WITH {steps} SELECT DISTINCT record_id, e AS evidence, method, method <> 'unsupported' AS supported, array_to_string(cleared, ', ') AS cleared, {', '.join(f'n{i} AS {v}' for i, (v, _, _) in enumerate(NUMBERS))} FROM m{last}"


@query(_align_sql())
def aligned_evidence(spark, d):
    """Records with evidence aligned to their source text, numbers without support cleared."""
    cols = ["record_id", "taxonomy_level_1", "source_title", "evidence_text", *[v for v, _, _ in NUMBERS]]
    c = table(spark, d, "cementitious").select(*cols).distinct()
    return E.align(c, "record_id", "evidence_text", "source_title", "taxonomy_level_1", TERMS, NUMBERS, GENERIC).distinct()
