import pytest
from pyspark.sql import functions as F

from kilnspark.functions import scalars as S
from kilnspark.operators import dedupe, merging, quality, ranking, reshape, scoring, taxonomy


def test_scalars(spark):
    one = spark.range(1).select(
        S.url_key(F.lit("HTTPS://www.Host.example/a/b/?utm_source=x&id=7&ref=2#top")).alias("url"), S.url_key(F.lit("not a url")).alias("bad"), S.slug(F.lit("Wet Ash (pilot) Washing")).alias("slug"), S.slug(F.lit(None).cast("string")).alias("none"),
        S.year_in(F.lit("in 2017, 12018")).alias("year"), S.publication_year(F.lit("Not Reported"), F.lit("10.1/x.2011.3")).alias("y"), S.paper_key(F.lit("n/a"), F.lit("U"), F.lit("t")).alias("key"),
        S.phrase_in(F.lit("the ashtray"), "ash").alias("inside"), S.phrase_in(F.lit("fly ash."), "ash").alias("word"), S.clamp_confidence(F.lit("1.7")).alias("hi"), S.clamp_confidence(F.lit("x")).alias("no"), S.html_text(F.lit("<p>a<script>b</script> &amp; c</p>")).alias("html"),
    ).first()
    assert (one.url, one.bad, one.slug, one.none, one.year) == ("https://host.example/a/b?id=7", "not a url", "wet_ash_washing", "", 2017)
    assert (one.y.year, one.y.year_source, one.key, one.inside, one.word, one.hi, one.no, one.html) == (2011, "doi", "url:u", False, True, 1.0, 0.0, "a & c")


def test_scoring(spark):
    df = spark.createDataFrame([(1, "Fly ash on the road"), (2, None), (3, "the road")], "id int, text string")
    r = {x.id: x for x in scoring.score_documents(df, "text", {"core": {"fly ash": 4}}, {"road": 2}).collect()}
    assert (r[1].relevance_score, r[1].label, r[1].matched) == (3.3, "core", ["fly ash"])
    assert (r[2].relevance_score, r[2].label, r[3].relevance_score) == (0.0, "none", 0.0)


def test_ranking(spark, rows):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 9), ("b", 4, 1)], "g string, id int, s int")
    assert rows(ranking.top_per_group(df, ["g"], [F.desc("s"), F.col("id")], 2), "g", "id", "rank_no") == [("a", 1, 2), ("a", 3, 1), ("b", 4, 1)]
    assert rows(ranking.best_per_key(df, ["g"], [F.desc("s"), F.col("id")]), "id") == [(3,), (4,)]
    assert rows(ranking.round_robin_cap(df, "g", [F.col("id")], 3), "id") == [(1,), (2,), (4,)]
    assert rows(ranking.islands(df.unionAll(df), ["g"], "id")) == [("a", 1, 3, 3), ("b", 4, 4, 1)]
    for block in (1, 2, 3, 7):
        n = spark.createDataFrame([("a", i) for i in (1, 2, 3, 5, 6, 9, 13, 14, 15, 16, -2, -1, 0)] + [("b", 5), ("b", None)], "g string, id int")
        assert rows(ranking.islands(n, ["g"], "id", block)) == [("a", -2, 3, 6), ("a", 5, 6, 2), ("a", 9, 9, 1), ("a", 13, 16, 4), ("b", 5, 5, 1)], block
    assert rows(ranking.hash_sample(df, "id", "s", 2)) == rows(ranking.hash_sample(df.repartition(3), "id", "s", 2))
    assert ranking.top_n(df.limit(0), [F.col("id")], 5).count() == 0


def test_plan_prunes_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("g"), "id")
    plan = ranking.top_per_group(df, ["g"], [F.col("id")], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_dedupe(spark, rows):
    df = spark.createDataFrame([(1, "A", "x"), (2, "a ", "x"), (3, "a", "y"), (4, None, None), (5, None, None)], "id int, n string, v string")
    assert [(r[0], r[1], r[2]) for r in rows(dedupe.mark_duplicates(df, ["n", "v"], ["n"], "id"), "id", "dup_status", "dup_of")] == [(1, "unique", None), (2, "exact", 1), (3, "possible", 1), (4, "unique", None), (5, "exact", 4)]
    assert rows(dedupe.superseded(df, "n", F.col("v") == "x", "id"), "id") == [(1,), (2,), (3,), (4,)]


def test_merging(spark, rows):
    df = spark.createDataFrame([(1, "p", None, "X"), (2, "p", "N.A.", "y"), (3, "p", "b", "x"), (4, None, None, None)], "id int, k string, a string, b string")
    assert rows(merging.consolidate(df.where("k = 'p'"), "k", ["a", "b"], "id")) == [("p", "b", "X", False, True, 3)]
    assert rows(merging.majority(df.where("k IS NOT NULL"), "k", "b")) == [("p", "X", 1)]
    f = {r.id: (r.a, r.filled) for r in merging.sibling_fill(df, [F.col("k")], ["a"], "id").collect()}
    assert f == {1: ("b", 1), 2: ("b", 1), 3: ("b", 0), 4: (None, 0)}
    a = spark.createDataFrame([("l1", "p", "c1"), ("l2", "", "c1"), ("l1", "p", "c1")], "id string, k string, c string")
    b = spark.createDataFrame([("r1", "p", "c2"), ("r2", "p", ""), ("r3", None, "c1")], "rid string, k string, c string")
    veto = (F.col("c") != "") & (F.col("r_c") != "") & (F.col("c") != F.col("r_c"))
    assert rows(merging.link(a, b, [("project", "k", 0.8)], "id", "rid", veto)) == [("l1", "r2", "project", 0.8)]


def test_taxonomy(spark, rows):
    df = spark.createDataFrame([("A b", "C"), ("A b", "N.A."), (None, "C"), ("D", "e")], "l0 string, l1 string")
    p = df.select(taxonomy.path_of(["l0", "l1"]).alias("path"))
    assert sorted(str(r.path) for r in p.collect()) == ["None", "a_b", "a_b/c", "d/e"]
    assert rows(taxonomy.rollup(p, "path", [F.count("*").alias("n")]), "node", "n") == [("a_b", 2), ("a_b/c", 1), ("d", 1), ("d/e", 1)]
    assert rows(taxonomy.nodes(p, "path").where("parent IS NOT NULL"), "node", "parent") == [("a_b/c", "a_b"), ("d/e", "d")]


def test_quality_and_reshape(spark, rows):
    df = spark.createDataFrame([("a", "Pilot", "[\"x\", \"y\"]", ["1", "2"]), ("a", "odd", "bad", []), (None, "N/A", None, None)], "k string, s string, j string, l array<string>")
    assert rows(quality.fill_rates(df, ["k", "s"])) == [("k", 2, 3), ("s", 2, 3)]
    assert rows(quality.fill_rates(df.limit(0), ["k"])) == [("k", 0, 0)]
    assert rows(quality.vocabulary_violations(df, {"s": ("pilot",)})) == [("s", "odd", 1)]
    assert rows(quality.duplicate_ids(df, "k")) == [("a", 2)]
    assert rows(reshape.json_list(df, "j", "m"), "m") == [("x",), ("y",)]
    assert rows(reshape.list_head(df, "l", 3, "c").where("k = 'a'"), "c_1", "c_3") == [(None, None), ("1", None)]
    assert reshape.explode_list(df, "l", "x", "pos").count() == 4
    e = spark.createDataFrame([("a", 2), ("b", 1)], "k string, n int")
    assert rows(quality.reconcile(e, e.where("k = 'a'"), ["k"])) == [("b", 1, 0)]


@pytest.mark.parametrize("unit", ["fold"])
def test_text(spark, unit):
    from kilnspark.functions import text as T

    r = spark.createDataFrame([(" N.A. ",), (" unknown",), ("x",), (None,)], "c string").select(T.present("c").alias("p"), T.fold("c").alias("f"), T.squeeze("c").alias("s")).collect()
    assert [x.p for x in r] == [False, False, True, False] and r[1].s == "unknown"


def test_spans_and_matching(spark, rows):
    from kilnspark.functions import spans
    from kilnspark.operators import matching

    df = spark.createDataFrame([(1, "No hit. It rose 5 percent here today. Up 7 percent [3][3]"), (2, None), (3, "")], "id int, t string")
    r = {x.id: x for x in df.select("id", spans.best_span(F.col("t"), ["percent", "rose"]).alias("b"), spans.numeric_span(F.col("t"), "percent").alias("n")).collect()}
    assert (r[1].b.score, r[1].b.span, r[1].n) == (2, "It rose 5 percent here today", "Up 7 percent [3][3]") and r[2].b is None and r[3].n is None
    assert rows(matching.citation_marks(df, "id", "t")) == [(1, 3, 2)]
    h = spark.createDataFrame([("a.b.example",), ("xb.example",), ("b.example",), (None,)], "host string")
    rules = spark.createDataFrame([("b.example", 1), ("example", 7)], "suffix string, rank int")
    assert rows(matching.by_host_suffix(h, "host", rules, "suffix"), "host", "rank") == [(None, None), ("a.b.example", 1), ("b.example", 1), ("xb.example", 7)]
    n = spark.createDataFrame([(9, "Fly ash"), (8, ""), (7, "ash")], "ref int, name string")
    t = spark.createDataFrame([(1, "wet FLY-ash mix"), (2, "flying ashes"), (3, None)], "id int, t string")
    assert rows(matching.contained_names(t, "id", "t", n, "ref", "name")) == [(1, 7), (1, 9)]
    assert matching.contained_names(t, "id", "t", n.limit(0), "ref", "name").count() == 0


def test_greedy_paths_and_validation(spark, rows):
    df = spark.createDataFrame([("k", "a", 3.0), ("k", "a/b", 3.0), ("k", "c", 3.0), ("k", "d/e", 2.0), ("k", "f", 0.5), ("k", None, 9.0), (None, "a", 1.0), ("k", "a", 1.0)], "k string, p string, s double")
    assert rows(taxonomy.greedy_paths(df, "k", "p", "s")) == [("k", ["a", "c", "d/e"])]
    v = spark.createDataFrame([("1", "x", 1), ("1", "x", 2), ("2", "N.A.", 1), (None, "x", 1)], "id string, r string, o int")
    assert [(r[0], r[1]) for r in rows(quality.split_valid(v, "id", ["r"], "o"), "id", "status")] == [(None, "missing"), ("1", "accepted"), ("1", "invalid"), ("2", "invalid")]


def test_literature_web_links(spark, rows, tmp_path):
    """The reference's pairs, from links and classes expanded: both rules, both vetoes, every web row kept."""
    from kilnspark.plans import reference

    cols = "record_id, evidence_origin, project_name, company_or_organization, country, taxonomy_level_3, canonical_technology_name".split(", ")
    data = [
        ("l1", "Literature", "Quay Wall", "Rope AG", "Kalbar", "L3", "Kiln"), ("l2", "Literature", "quay wall ", "N.A.", None, "L4", "n/a"), ("l3", "Literature", None, None, None, "L3", "KILN"), ("l4", "Literature", "Quay-Wall", None, None, "L3", "Kiln-"), (None, "Literature", "Quay Wall", None, None, "L3", "Kiln"),
        ("w1", "Web", "QUAY WALL", "rope ag", "kalbar", "L3", "kiln"), ("w2", "Web", "Quay Wall", "Rope AG", "Tane", "L9", None), ("w3", "Web", "Quay Wall", "Wire AG", None, "L3", "Kiln"), ("w4", "Web", "N.A.", None, None, "L4", "Kiln"), ("w5", "Web", None, None, None, None, "Kiln"),
    ]
    spark.createDataFrame(data + data[:6], ", ".join(f"{c} string" for c in cols)).write.parquet(f"{tmp_path}/cementitious.parquet")
    links = rows(reference.QUERIES["literature_web_links"](spark, str(tmp_path)))
    members = rows(reference.QUERIES["literature_web_classes"](spark, str(tmp_path)))
    assert members == [("l3", "kiln", "Literature", "l1"), ("l3", "kiln", "Literature", "l3"), ("l3", "kiln", "Web", "w1"), ("l3", "kiln", "Web", "w3")]
    pairs = {(w, r): s for w, rule, s, r, *_ in links if rule == "project"}
    for w, rule, s, _, leaf, tech, n in links:
        if rule == "technology":
            found = [i for a, b, o, i in members if (a, b, o) == (leaf, tech, "Literature")]
            assert len(found) == n
            pairs = {(w, i): s for i in found} | pairs
    assert pairs == {("w1", "l1"): 0.8, ("w1", "l2"): 0.8, ("w1", "l3"): 0.6, ("w2", "l2"): 0.8, ("w3", "l2"): 0.8, ("w3", "l1"): 0.6, ("w3", "l3"): 0.6}
    assert [r for r in links if r[1] is None] == [(w, *[None] * 6) for w in ("w4", "w5")]
