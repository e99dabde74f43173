"""Free-entered values onto a canonical list: a partition-based pigeonhole join in SQL.

A reference string that may be met with k edits is cut into k + 1 segments; one of them must then stand unchanged in the
typed string, at most a few places off. So typed strings meet references by equality of (length, segment number, substring)
and only those candidates are verified with the built-in ``levenshtein``. The reference list is turned into the ways its
entries get written (abbreviated words, words turned around) beforehand, which is bounded by the list, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.text import NO_DATA
from ..sources.tables import checkpointed

#: Trade abbreviations of words in reference names.
ABBREVIATIONS = {
    "capture": "capt", "calcined": "calc", "calcination": "calc", "calciner": "calc", "limestone": "lmst", "pulverised": "pulv", "electric": "elec", "retrofit": "retrof", "recycled": "recyc", "beneficiation": "benef", "concrete": "concr", "generation": "gen", "residue": "res", "granulated": "gran",
    "ground": "grd", "pressure": "press", "incinerator": "incin", "optimisation": "optim", "municipal": "munic", "carbonated": "carbn", "carbonation": "carbn", "powder": "pwd", "waste": "wst", "fibre": "fiber",
}

#: Words put before a name that don't belong to it.
LEADING = ("our own", "locally sourced", "imported", "fresh", "improved")

_S = "[\\\\s\\\\u00a0]"
#: SQL of the form in which strings are compared: lower case without accents, only letters and digits, with one letter for
#: sounds that spellings disagree on (z as s, y as i, ph as f).
FORM = "replace(translate(regexp_replace(translate(lower({0}), 'àáâãäåçèéêëìíîïñòóôõöøùúûüýÿ', 'aaaaaaceeeeiiiinoooooouuuuyy'), '[^a-z0-9]', ''), 'zy', 'si'), 'ph', 'f')"
#: SQL that takes off list marks, leading words, a remark in parentheses at the end and loose marks.
BARE = (
    "regexp_replace(regexp_replace(regexp_replace({0}, '^" + _S + "*(?:[-*•]" + _S + "+|[0-9]{1,2}[.)]" + _S + "+)?', ''), "
    "'^(?i:" + "|".join(LEADING) + ")" + _S + "+', ''), '" + _S + "*(?:\\\\([^()]*\\\\))?[" + "\\\\s\\\\u00a0?*.]*$', '')"
)
#: SQL of the edits allowed for a reference of length n.
EDITS = "CASE WHEN {0} <= 5 THEN 0 WHEN {0} <= 8 THEN 1 WHEN {0} <= 13 THEN 2 ELSE 3 END"


def variants(reference: DataFrame) -> DataFrame:
    """(list_name, ref_id, form, edits): the written forms of each entry - every choice of abbreviations, every rotation of the words, with and without a plural s.

    A form that belongs to two entries goes to the smaller ``ref_id``. Entries without a name and aliases give what they have.
    """
    pairs = ", ".join(f"'{w}', '{a}'" for w, a in ABBREVIATIONS.items())
    return reference.sparkSession.sql(
        f"""
        WITH n AS (SELECT list_name, ref_id, explode(filter(array_append(coalesce(aliases, array()), canonical_name), x -> x IS NOT NULL)) AS name FROM {{ref}}),
        w AS (SELECT list_name, ref_id, filter(split(regexp_replace(lower(name), '[^a-z0-9 -]', ''), ' +'), x -> x <> '') AS words FROM n),
        a AS (SELECT list_name, ref_id, explode(aggregate(words, array(''), (acc, x) -> flatten(transform(acc, p ->
                transform(coalesce(array(x, map({pairs})[x]), array(x)), o -> trim(concat(p, ' ', coalesce(o, x)))))))) AS name FROM w),
        s AS (SELECT DISTINCT list_name, ref_id, split(name, ' ') AS words FROM a),
        r AS (SELECT list_name, ref_id, explode(transform(sequence(0, size(words) - 1), i ->
                concat(array_join(slice(words, i + 1, size(words)), ''), array_join(slice(words, 1, i), '')))) AS one FROM s),
        p AS (SELECT list_name, ref_id, explode(array(one, concat(one, 's'))) AS v FROM r)
        SELECT list_name, min(ref_id) AS ref_id, form, {EDITS.replace("{0}", "length(form)")} AS edits
        FROM (SELECT list_name, ref_id, {FORM.replace("{0}", "v")} AS form FROM p) WHERE form <> '' GROUP BY list_name, form""",
        ref=reference,
    )


def match_keys(keys: DataFrame, forms: DataFrame) -> DataFrame:
    """(list_name, form, ref_id, distance) for the distinct typed forms that mean an entry: the nearest, ties to the smaller id."""
    return keys.sparkSession.sql(
        """
        WITH ref AS (
          SELECT list_name, ref_id, form AS rform, length(form) AS len, edits, i,
                 substr(form, i * div(length(form), edits + 1) + 1, if(i = edits, length(form) - i * div(length(form), edits + 1), div(length(form), edits + 1))) AS seg
          FROM (SELECT *, explode(sequence(0, edits)) AS i FROM {forms})),
        lens AS (SELECT *, explode(sequence(greatest(1, length(form) - 3), length(form) + 3)) AS len FROM {keys}),
        cut AS (SELECT *, length(form) - len AS off, CASE WHEN len <= 5 THEN 0 WHEN len <= 8 THEN 1 WHEN len <= 13 THEN 2 ELSE 3 END AS edits FROM lens),
        part AS (SELECT *, explode(sequence(0, edits)) AS i FROM cut WHERE abs(off) <= edits),
        place AS (SELECT list_name, form, len, i,
                 i * div(len, edits + 1) + 1 AS p, if(i = edits, len - i * div(len, edits + 1), div(len, edits + 1)) AS n,
                 greatest(-i, off - (edits - i)) AS lo, least(i, off + edits - i) AS hi FROM part),
        probe AS (SELECT list_name, form, len, i, explode(transform(sequence(lo, hi), d -> substr(form, p + d, n))) AS seg
                  FROM place WHERE lo <= hi AND p + lo >= 1),
        cand AS (SELECT DISTINCT p.list_name, p.form, r.rform, r.ref_id, r.edits
                 FROM probe p JOIN ref r ON p.list_name = r.list_name AND p.len = r.len AND p.i = r.i AND p.seg = r.seg),
        ok AS (SELECT list_name, form, ref_id, levenshtein(form, rform, edits) AS distance FROM cand)
        SELECT list_name, form, best.ref_id AS ref_id, best.distance AS distance
        FROM (SELECT list_name, form, min(struct(distance, ref_id)) AS best FROM ok WHERE distance >= 0 GROUP BY list_name, form)""",
        keys=keys,
        forms=forms,
    )


def typed(names: DataFrame, raw: str = "raw_name") -> DataFrame:
    """``names`` with ``form``, the string that is compared; rows whose name is missing are left out."""
    missing = ", ".join(f"'{m}'" for m in NO_DATA)
    r = f"`{raw}`"
    bare = BARE.replace("{0}", r)
    return names.selectExpr("*", FORM.replace('{0}', bare) + ' AS form').where(f"coalesce(regexp_replace(lower({r}), '^{_S}+|{_S}+$', ''), '') NOT IN ({missing})")


def map_to_canonical(names: DataFrame, reference: DataFrame) -> DataFrame:
    """``names`` (list_name, raw_name and any others) with ``ref_id`` and ``distance``; -1 and NULL where the list has no such entry.

    Rows whose raw name is NULL, blank or a no-data marker are left out; all others are kept, repeated ones too. A name of
    signs alone ('?') has no entry. Ties in distance go to the smaller ``ref_id``. An empty list leaves all names unmatched.
    Edits allowed: none up to 5 letters, then 1 up to 8, 2 up to 13, 3 beyond. Each distinct form is looked up once; those
    without an entry are the anti-join of the forms with the matched ones.
    """
    t = typed(names)
    keys = checkpointed(t.select("list_name", "form").distinct())  # both are read twice; they are small beside the rows
    hits = checkpointed(match_keys(keys.where("form <> ''"), variants(reference)))
    none = keys.join(hits, ["list_name", "form"], "left_anti").selectExpr("list_name", "form", "-1L AS ref_id", "CAST(NULL AS INT) AS distance")
    return t.join(hits.unionByName(none), ["list_name", "form"]).drop("form")


def unmatched(names: DataFrame, reference: DataFrame) -> DataFrame:
    """(list_name, raw_name, n): the names without an entry and how often each was typed, by an anti-join with the matched forms."""
    t = typed(names)
    hits = match_keys(t.where("form <> ''").select("list_name", "form").distinct(), variants(reference))
    return t.join(hits, ["list_name", "form"], "left_anti").groupBy("list_name", "raw_name").count().withColumnRenamed("count", "n")


def raw_names(scm: DataFrame, cementitious: DataFrame) -> DataFrame:
    """(origin, row_key, list_name, raw_name): material names of scm_discovery and technology names of cementitious; rows delivered again count once."""
    names = scm.selectExpr("'scm_discovery' AS origin", "discovery_record_id AS row_key", "'material' AS list_name", "raw_material_name AS raw_name").unionAll(
        cementitious.selectExpr("'cementitious'", "record_id", "'technology'", "raw_technology_name")
    )
    return names.where("row_key IS NOT NULL").distinct()


def canonical_names(scm: DataFrame, cementitious: DataFrame, reference: DataFrame) -> DataFrame:
    """(origin, row_key, ref_id): the names of both tables on their lists; one row per record."""
    return map_to_canonical(raw_names(scm, cementitious), reference).select("origin", "row_key", "ref_id").distinct()
