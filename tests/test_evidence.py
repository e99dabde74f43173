"""Evidence alignment, the material cascade, the registry, the tree: hand-made rows and edge cases."""

import pytest
from pyspark.sql import functions as F

from kilnspark.functions import evidence as E
from kilnspark.operators import assignment as A
from kilnspark.operators import extraction, lexicon, materials, registry
from kilnspark.operators import taxonomy


def val(spark, c):
    return spark.range(1).select(c.alias("v")).first().v


def test_passages(spark):
    text = "Fly ash was used. It replaced 30% of cement. " + "w" * 1300 + ". The end."
    got = val(spark, E.passages(F.lit(text)))
    assert got[:2] == ["Fly ash was used.", "It replaced 30% of cement. " + "w" * 573] and "Fly ash was used. It replaced 30% of cement." in got
    assert all(len(p) <= 1200 for p in got) and val(spark, E.passages(F.lit(None).cast("string"))) == [] == val(spark, E.passages(F.lit("  ")))


def test_numbers_and_terms(spark):
    forms = val(spark, E.number_forms(F.lit("30.5")))
    assert forms == ["30.5", "30.5%", "30.5 %", "30.5 percent", "30.5 per cent", "30,5", "30,5%"] and val(spark, E.number_forms(F.lit("x"))) == []
    ok = lambda p, v, u, c: val(spark, E.supports_number(F.lit(p), F.lit(v), F.lit(u), F.array(*[F.lit(x) for x in c])))
    assert ok("Cement fell by 30 per cent", "30", "%", ["cement"]) and not ok("Cement fell by 30 per cent", "30", "MPa", ["cement"]) and not ok("It fell by 30 %", "30", "", ["clinker"])
    terms = F.array(F.lit("mea"), F.lit("amine solvent"))
    assert val(spark, E.supported(F.lit("An MEA wash"), terms)) and not val(spark, E.supported(F.lit("a measure"), terms)) and val(spark, E.supported(F.lit("x"), F.array().cast("array<string>")))
    assert val(spark, E.support_score(F.lit("an amine solvent"), terms)) == 3 + 1 + 8 and val(spark, E.support_score(F.lit("carbon only"), terms, ("carbon",))) == -1


def test_alignment(spark):
    text = "The plant uses fly ash. Slag replaced 35 percent of the cement in mixes with fly ash. Strength was 50 MPa."
    data = [(1, text, "The plant uses fly ash.", "ash", "35", "50"), (2, text, "General words.", "ash", "77", None), (3, text, "", "clay", None, "50"), (4, None, None, "none", "35", None)]
    df = spark.createDataFrame(data, "id int, t string, e string, s string, pct string, mpa string")
    got = {r.id: r for r in E.align(df, "id", "t", "e", "s", {"ash": ["fly ash"], "clay": ["kaolin"]}, [("pct", None, ["cement"]), ("mpa", None, ["strength"])]).collect()}
    assert (got[1].method, got[1].pct, got[1].mpa, got[1].cleared) == ("existing", "35", "50", "") and "35 percent" in got[1].evidence
    assert (got[2].method, got[2].pct, got[2].cleared, got[2].supported) == ("searched", None, "pct", True)
    assert (got[3].method, got[3].supported, got[3].mpa) == ("unsupported", False, "50") or got[3].mpa is None
    assert (got[4].method, got[4].pct, got[4].cleared) == ("unchanged", None, "pct")


def test_cascade(spark):
    ref = spark.createDataFrame([("fly_ash", "ash", "Fly ash", ["PFA"]), ("slag", "slag", "Granulated slag", []), ("fume", "silica", "Silica fume", [])], "leaf string, parent string, name string, syn array<string>")
    lex = materials.lexicon(ref, "leaf", F.col("parent"), {"display": F.array("name"), "synonym": F.col("syn")})
    senses = spark.createDataFrame([("fa", "fly ash", "fly ash"), ("fa", "fine aggregate", "fine aggregate")], "key string, sense string, sense_key string")
    names = [("Fly–ash", ""), ("Coarse fly ash (S1)", ""), ("FA", "with fly ash in it"), ("FA", "no hint"), ("Mix 4", ""), ("Table 2", ""), ("Unknown stone", "near silica fume"), ("Unknown stone", ""), (None, ""), ("Smith and Jones", ""), ("Slag and fly ash", "")]
    got = {(r.name, r.context): (r.status, r.confidence, r.leaf) for r in materials.map_names(spark.createDataFrame(names, "name string, context string"), lex, senses, ["total"], ["ash", "slag"]).collect()}
    assert len(got) == len(names)
    assert got["Fly–ash", ""] == ("mapped", "High", "fly_ash") and got["Coarse fly ash (S1)", ""] == ("mapped", "Medium", "fly_ash")
    assert got["FA", "with fly ash in it"] == ("ambiguous", "Medium", "fly_ash") and got["FA", "no hint"] == ("ambiguous", "Low", None)
    assert got["Mix 4", ""][0] == "sample_id" and got["Table 2", ""][0] == got[None, ""][0] == got["Smith and Jones", ""][0] == "artefact"
    assert got["Unknown stone", "near silica fume"] == ("ambiguous", "Low", "fume") and got["Unknown stone", ""] == ("unresolved", "Unresolved", None)
    assert got["Slag and fly ash", ""] == ("mapped", "Medium", "fly_ash")  # the longest term contained
    with pytest.raises(ValueError, match="lexicon"):
        materials.lexicon_hits(spark.createDataFrame([("x",)], "key string"), lex, most_terms=1)


def test_registry(spark, rows):
    src = registry.register(spark.createDataFrame([("b", "paper"), ("a", "paper"), ("w", "web")], "id string, kind string"), "id", "kind")
    assert rows(src, "id", "stable_id") == [("a", "paper_001"), ("b", "paper_002"), ("w", "web_001")]
    ids = [val(spark, registry.token_id(F.lit(t))) for t in ("Paper 2", "[p-2]", "[12]", "web_1", "WEB_0012", "paper_1234", "none")]
    assert ids == ["paper_002", "paper_002", "paper_012", "web_001", "web_012", "paper_1234", None]
    texts = spark.createDataFrame([(1, "As paper 2 and [9] say, see web-1."), (2, "no marks"), (3, None), (4, "")], "id int, t string")
    got = rows(registry.rewrite(texts, "id", "t", src))
    assert got == [(1, "As [paper_002] and Unmatched source reference say, see [web_001].", 1), (2, "no marks", 0), (3, None, 0), (4, "", 0)]
    c = registry.citations(texts, "id", "t", src)
    assert rows(registry.unmatched(c, src)) == [("[9]",)] and [r[1] for r in rows(registry.bibliography(src, c), "id", "used")] == [False, True, True]
    big = registry.ordinals(spark.range(5000).selectExpr("id", "'g' AS g").repartition(7), "g", ["id"])
    assert big.where("ordinal <> id + 1").count() == 0


def test_assignment(spark, rows):
    data = [("Ash", "Fly ash", "Class F"), ("Ash", "Fly ash", "Class C"), ("Ash", "Rice", None), ("Slag", None, "lost")]
    tree = A.tree_of(spark.createDataFrame(data, "a string, b string, c string"), ["a", "b", "c"])
    assert rows(tree, "node", "parent") == [("ash", None), ("ash/fly_ash", "ash"), ("ash/fly_ash/class_c", "ash/fly_ash"), ("ash/fly_ash/class_f", "ash/fly_ash"), ("ash/rice", "ash"), ("slag", None)]
    assert rows(A.roles(tree, 3), "node", "role")[-2:] == [("ash/rice", "end"), ("slag", "branch")]
    q = spark.createDataFrame([(1, "ash/fly_ash", "CLASS-f"), (2, "ash/fly_ash", "class c, fine"), (3, "ash/fly_ash", "other"), (4, "ash/fly_ash", "N.A."), (5, None, "x")], "id int, p string, t string")
    assert rows(A.match_child(q, "id", "p", "t", tree)) == [(1, "ash/fly_ash/class_f"), (2, "ash/fly_ash/class_c"), (3, None)]
    assert rows(A.tree_errors(tree.drop("aliases"), 3)) == [("several roots", "ash")]
    bad = spark.createDataFrame([(1, "Ash", "Rice"), (2, "Slag", "Rice"), (3, "Lime", None), (4, "Ash", "Sand")], "id int, a string, b string")
    assert rows(A.assignment_errors(bad, "id", "a", "b", tree, 1)) == [(2, "child of another parent"), (3, "unknown parent"), (4, "unknown child")]
    m = spark.createDataFrame([("old", "Fly ash", "Class F", 1), ("new", "Fly ash", None, 2)], "leaf string, level_3 string, level_4 string, place int")
    n = spark.createDataFrame([("n1", "Fly ash", "Class F"), ("n2", "Fly ash", "Class C"), ("n3", "Rice", None)], "node string, level_3 string, level_4 string")
    assert rows(A.reverse_path(n, m)) == [("n1", "old"), ("n2", "new")]
    assert val(spark, A.distinct_terms(F.array(F.lit("A"), F.lit(" ")), F.array(F.lit("a "), F.lit("b")))) == ["A", "b"]
    assert rows(taxonomy.differences(spark.createDataFrame([(1,), (2,)], "x int"), spark.createDataFrame([(2,), (3,)], "x int"), "a", "b")) == [("a", 1), ("b", 3)]


def test_lexicon(spark, rows):
    ctx = lexicon.query_context("Fly ash", {"pfa": 2.0, "ash": 9.0})
    assert ctx == [("fly ash", 5.0, "query"), ("ash", 9.0, "synonym"), ("fly", 1.0, "query"), ("pfa", 2.0, "synonym")]
    s = val(spark, lexicon.phrase_score(F.lit("pfa and fly ash in an ashtray"), ctx))
    assert (s.score, s.query_hits, s.synonym_hits, s.strong, s.moderate) == (17.0, 2, 2, True, True)
    assert val(spark, lexicon.phrase_score(F.lit("x"), [])).score == 0.0
    df = spark.createDataFrame([(1, "school road"), (2, "school of fly ash"), (3, None)], "id int, t string")
    assert rows(lexicon.drop_negative(df, "t", ["school"], ["fly ash"]), "id") == [(2,), (3,)]
    none = spark.createDataFrame([], "k int")
    assert lexicon.within(df, "id", none, "k").count() == 0 and lexicon.within(df, "id", none, "k", empty_means_all=True).count() == 3
    terms = spark.createDataFrame([("a", "ash", 2.0), ("a", "fly ash", 5.0), ("b", "school", 1.0), ("b", "", 9.0)], "node string, term string, weight double")
    assert rows(lexicon.node_scores(df, "id", "t", terms)) == [(1, "b", 1.0, 1), (2, "a", 7.0, 2), (2, "b", 1.0, 1)]
    f = lexicon.fill_templates(spark.createDataFrame([(1, "X", None), (2, "Y", "p")], "id int, c string, p string"), ["id"], ["{c} news", "{c}  {p}"], {"c": F.col("c"), "p": F.col("p")})
    assert rows(f) == [(1, 1, "X news"), (2, 1, "Y news"), (2, 2, "Y p")]
    hosts = [("gov.example", "Government"), ("news.gov.example", "News")]
    t = lambda u, title, e: tuple(val(spark, lexicon.source_type(F.lit(u), F.lit(title), F.lit(e), hosts, [("/press/", "Press release")], [("report", "Report")], {"blog": "Blog"})))
    assert [t("https://www.news.gov.example/a", "", ""), t("https://x.gov.example", "", ""), t("https://a.example/press/1", "a report", ""), t("https://a.example/b.pdf?x=1", "", ""), t("https://a.example", "A report", "BLOG"), t(None, None, None)] == [("News", "host"), ("Government", "host"), ("Press release", "path"), ("Report", "pdf"), ("Blog", "label"), ("Web page", "default")]


def test_extraction(spark, rows):
    def f(r):
        if r["t"] is None:
            raise ValueError("no text")
        return [{"w": w} for w in r["t"].split()]

    df = spark.createDataFrame([(1, "a b"), (2, ""), (3, None)], "id int, t string")
    assert rows(extraction.extract(df, "id", f, "w string")) == [(1, "a", 1, None), (1, "b", 2, None), (2, None, 0, None), (3, None, 0, "ValueError: no text")]
    assert extraction.extract(df.limit(0), "id", f, "w string").count() == 0
    cues = spark.createDataFrame([("a", "ash"), ("b", "ash"), ("b", "lime"), ("c", "clay")], "node string, term string")
    bad = spark.createDataFrame([("c", "ash")], "node string, term string")
    assert rows(extraction.classify(spark.createDataFrame([(1, "Ash"), (2, "lime ash"), (3, "ash clay"), (4, None)], "id int, t string"), "id", "t", cues, bad)) == [(1, "a", 2.0), (2, "b", 4.0), (3, "a", 2.0)]
    assert val(spark, extraction.paths_of_answer(F.lit('{"paths": [["a", " "], ["a"], [], ["b", "c", "d"]]}'), 2)) == [["a"], ["b", "c"]] and val(spark, extraction.paths_of_answer(F.lit("no"), 2)) == []
