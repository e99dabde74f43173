"""Whole operators on small tables: nulls, blanks, long texts, ties, repeated rows, empty tables, clashing names."""

from kilnspark.llm import bpe, canonical, grouptop, leakage, level, names, pagebody, survivor


def test_top_n(spark, rows):
    df = spark.createDataFrame([("a", 1, 0.5, "x"), ("a", 1, 0.9, "x"), ("a", 2, 0.9, "x"), ("a", 3, 0.1, "x"), ("a", None, 1.0, "x"), ("a", 4, None, "x"), ("a", 5, float("nan"), "x"), (None, 6, 0.2, "x")], "g string, id int, s double, rank_no string")
    assert rows(grouptop.top_n(df, ["g"], "s", "id", 2)) == [(None, 6, 0.2, 1), ("a", 1, 0.9, 1), ("a", 2, 0.9, 2)]
    assert grouptop.top_n(df.limit(0), ["g"], "s", "id", 2).count() == 0
    assert "WindowGroupLimit" in grouptop.top_n(df, ["g"], "s", "id", 2)._jdf.queryExecution().executedPlan().toString()


def test_best_papers(spark, rows):
    df = spark.createDataFrame([(1, 10, 0.5, " Ash  reuse; ASH_reuse ;"), (1, 11, 1.5, "Ash reuse"), (1, 12, 0.5, None), (1, 13, 0.4, " N/A; "), (None, 14, 0.5, "x"), (1, 10, 0.7, "ash reuse")], "shard_id long, corpus_index long, confidence double, matched_taxonomy_branches string")
    assert rows(grouptop.best_papers(df)) == [(1, "ash_reuse", 10, 0.7, 1), (1, "unknown", 12, 0.5, 1), (1, "unknown", 13, 0.4, 2)]


FIELDS = [f for b in survivor.BUNDLES.values() for f in b]


def _record(g, k, t, **v):
    return {"duplicate_group_id": g, "record_id": k, "retrieval_timestamp": t, **{f: v.get(f) for f in FIELDS}}


def test_survivors(spark, rows):
    data = [
        _record("g1", "r1", "2022-01-01 00:00:00", doi="d", country="N.A."), _record("g1", "r2", "1641081600", doi="d", country=" "), _record("g1", "r3", None, project_name="p", country="c"), _record("g1", "r3", None, project_name="p", country="c"),
        _record("g2", "r4", "x", doi="d"), _record("g2", "r4", "x", doi="d"), _record(None, "r5", None), _record("n/a", "r6", None), _record("n/a", "r7", None), _record("g3", "b", "02 Jan 2022 00:00"), _record("g3", "a", "2022-01-02T02:00:00+02:00"),
    ]
    schema = "duplicate_group_id string, record_id string, retrieval_timestamp string, " + ", ".join(f"{f} string" for f in FIELDS) + ", g string"
    df = spark.createDataFrame([{**r, "g": "clash"} for r in data], schema)
    got = survivor.survivors(df)
    assert rows(got, "duplicate_group_id", "record_id", "complementary_fields_filled") == [("g1", "r3", 1), ("g3", "a", 0)]
    one = got.where("duplicate_group_id = 'g1'").first()
    assert (one.doi, one.project_name, one.country, one.donors) == ("d", "p", "c", ["r2"])  # r2 is later than r1
    assert survivor.survivors(df.limit(0)).count() == 0


def test_survivors_take_no_field_of_another_project(spark, rows):
    method = {"study_type": "s", "functional_unit": "u", "curing_conditions": "c"}
    data = [
        _record("g1", "a", "2022-01-01", project_name="A", doi="d", journal_or_site="j", **method), _record("g1", "b", "2022-01-03", project_name="B", country="x", deployment_stage="y"), _record("g1", "c", "2022-01-02", project_name=" a ", country="z"),
        _record("g1", "d", "2021-01-01", project_name="A", country="older"), _record("g1", "e", None, project_year="2001"),
        _record("g2", "a", None, doi="d", journal_or_site="j", **method), _record("g2", "b", None, project_name="B", country="x"), _record("g2", "c", None, project_name="C", country="y", project_year="2002"), _record("g2", "d", None, deployment_stage="y"),
    ]
    df = spark.createDataFrame(data, "duplicate_group_id string, record_id string, retrieval_timestamp string, " + ", ".join(f"{f} string" for f in FIELDS))
    got = rows(survivor.survivors(df), "duplicate_group_id", "record_id", "complementary_fields_filled", "donors", "project_name", "country", "project_year", "deployment_stage")
    assert got == [("g1", "a", 3, ["c", "e"], "A", "z", "2001", None), ("g2", "a", 4, ["c", "d"], "C", "y", "2002", "y")]


def test_hot_group_shrinks_before_python(spark):
    df = spark.range(20_000).selectExpr("'g' AS duplicate_group_id", "lpad(id, 6, '0') AS record_id", "'2022-01-01' AS retrieval_timestamp", *[f"IF(id % {i + 2} = 0, 'v', NULL) AS {f}" for i, f in enumerate(FIELDS)])
    assert survivor.survivors(df).select("record_id").first()[0] == "000000"


def test_canonical(spark, rows):
    ref = spark.createDataFrame([(1, "m", "Pulverised coal fly ash, low lime", ["PCFA-L"]), (2, "m", "Pulverised coal fly ash, high lime", ["PCFA-H"]), (3, "m", "Ground granulated blast slag", None), (4, "t", "Oxygen-fired kiln", []), (5, "m", None, None)], "ref_id long, list_name string, canonical_name string, aliases array<string>")
    typed = {"pcfa-h": 2, "PCFA-L": 1, "pulv. coal fly ash, low lime (batch 2)": 1, "LIME, PULVERRIZED COAL FLY ASH HIGH": 2, "GRD._GRNAULATED_BLAST_SLAG ?": 3, "* our own slag, Ground granulated blast": 3, "?": -1, "Oxygen-fired kiln": -1, "epoxy coating": -1, "x" * 20_000: -1}
    names_ = spark.createDataFrame([(i, "m", n, 9) for i, n in enumerate(typed)] + [(98, "m", None, 9), (99, "m", " N.A. ", 9), (97, "t", "fired Oxygen kiln", 9)], "id int, list_name string, raw_name string, form int").drop("form")
    got = dict(rows(canonical.map_to_canonical(names_, ref), "id", "ref_id"))
    assert got == {**{i: r for i, r in enumerate(typed.values())}, 97: -1}
    assert canonical.unmatched(names_, ref).count() == 5
    assert canonical.map_to_canonical(names_.limit(0), ref).count() == 0
    assert set(rows(canonical.map_to_canonical(names_, ref.limit(0)), "ref_id")) == {(-1,)}


def test_unmatched_query_has_the_names_without_an_entry(spark, rows, tmp_path):
    import __spark_entry__

    spark.createDataFrame([("s1", "Fly ash, wet"), ("s1", "Fly ash, wet"), ("s2", "epoxy"), ("s3", "epoxy"), ("s4", "N.A.")], "discovery_record_id string, raw_material_name string").write.parquet(f"{tmp_path}/scm_discovery.parquet")
    spark.createDataFrame([("c1", "Oxygen kiln"), ("c2", "Fly ash, wet"), (None, "epoxy"), ("c3", "?")], "record_id string, raw_technology_name string").write.parquet(f"{tmp_path}/cementitious.parquet")
    spark.createDataFrame([(1, "material", "Fly ash, wet", []), (2, "technology", "Oxygen kiln", [])], "ref_id long, list_name string, canonical_name string, aliases array<string>").write.parquet(f"{tmp_path}/canonical_names.parquet")
    got, found = (rows(__spark_entry__.queries()[q](spark, str(tmp_path))) for q in ("p6_unmatched", "p6_found"))
    assert got == [("material", "epoxy", 2), ("technology", "?", 1), ("technology", "Fly ash, wet", 1)]
    assert sum(n for *_, n in got) == sum(r == -1 for *_, r in found)


def test_pigeonhole_equals_brute_force(spark, rows):
    import random

    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    refs = sorted({word(rng.randint(4, 18)) for _ in range(60)})
    keys = sorted({word(rng.randint(3, 20)) for _ in range(300)} | {r[:3] + r[4:] for r in refs})
    forms = spark.createDataFrame([("l", i, r) for i, r in enumerate(refs)], "list_name string, ref_id long, form string").selectExpr("*", canonical.EDITS.replace("{0}", "length(form)") + " AS edits")
    k = spark.createDataFrame([("l", x) for x in keys], "list_name string, form string")
    brute = spark.sql("SELECT k.form, min(struct(levenshtein(k.form, f.form) AS d, f.ref_id)).ref_id AS ref_id FROM {k} k JOIN {f} f ON levenshtein(k.form, f.form) <= f.edits GROUP BY k.form", k=k, f=forms)
    assert rows(canonical.match_keys(k, forms), "form", "ref_id") == rows(brute, "form", "ref_id")


def test_names(spark, rows):
    a = spark.createDataFrame([("Byzepygo Cement Industries AG ",), ("byzeppygo cement ind. a.g.",), ("Byzepygo Cement Industries Ltd",), ("Byzepygo Kiln Services AG",), ("N.A.",), (None,), ("",), ("Byzepygo Cement Industries AG",)], "name string")
    b = spark.createDataFrame([("Cement Industries Byzepygo AG", 1), ("K. Rope Consulting", 1), ("Katherine Rope Consultancy", 1), ("Rope, Liz - Consulting", 1)], "c string, name int")
    pairs = rows(names.name_pairs(names.link_names([(a, "name"), (b, "c")])))
    agent = ["Byzepygo Cement Industries AG", "Cement Industries Byzepygo AG", "byzeppygo cement ind. a.g."]
    assert pairs == [(agent[0], agent[1]), (agent[0], agent[2]), (agent[1], agent[2]), ("K. Rope Consulting", "Katherine Rope Consultancy")]
    assert names.name_pairs(names.link_names([(a.limit(0), "name")])).count() == 0


def test_salted_pairs_are_whole(spark):
    one = spark.range(60).selectExpr("concat('n', lpad(id, 3, '0')) AS name", "1L AS organisation")
    assert names.name_pairs(one, block=7).distinct().count() == 60 * 59 // 2


def test_encode(spark, rows):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "kiln", 5), (3, "kiln", 5)], "doc_id long, text string, ids int")
    got = rows(bpe.encode_corpus(df))
    assert got[0] == (1, []) and got[1] == (2, []) and got[2] == got[3] and len(got[2][1]) > 0
    assert bpe.encode_corpus(df.limit(0)).count() == 0


ITEM = "Inspector Mubo rejected lot 70 because its loss on firing reached 4,515 units against a ceiling of 0.58 set for the eastern furnace by Stopy in March while two rigs pumped 377 buckets through 9 filters until filter 6 clogged near the old pier and nobody could say why it happened. What follows?"


def test_leaks(spark, rows):
    w = ITEM.split()
    docs = [(1, ITEM.upper().replace(",", "")), (2, "x " * 30_000 + " ".join(w[:22]) + " y" * 2000), (3, " ".join(w[:7])), (4, None), (5, ""), (6, "What follows?"), (7, "nothing here at all"), (1, ITEM), (8, " ".join(w[2:14]) + " gap " * 50 + " ".join(w[20:34]))]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(9))
    i = spark.createDataFrame([(70, ITEM), (71, None), (72, ""), (None, ITEM)], "item_id long, text string")
    assert rows(leakage.find_leaks(d, i), "doc_id", "item_id") == [(1, 70), (2, 70), (8, 70)]
    assert rows(leakage.find_leaks(d, i, block=1), "doc_id", "item_id") == [(1, 70), (2, 70), (8, 70)]
    assert leakage.find_leaks(d.limit(0), i).count() == 0 and leakage.find_leaks(d, i.limit(0)).count() == 0


def test_leaks_do_not_depend_on_blocks(spark, rows):
    """A template that items of other blocks share is not distinctive."""
    template = " ".join(f"t{n}" for n in range(20))
    i = spark.createDataFrame([(k, f"{template} " + " ".join(f"i{k}w{n}" for n in range(30)) + ".") for k in range(4)], "item_id long, text string")
    d = spark.createDataFrame([(1, f"{template} and nothing else of it"), (2, f"{template} " + " ".join(f"i2w{n}" for n in range(20)))], "doc_id long, text string")
    whole = rows(leakage.find_leaks(d, i))
    assert [(r[0], r[1]) for r in whole] == [(2, 2)] and all(rows(leakage.find_leaks(d, i, block=b)) == whole for b in (1, 3))


def test_levels(spark, rows):
    from test_exactness import LEVELS

    s = spark.createDataFrame([(t, k) for k, t in LEVELS.items()] * 3 + [(None, 1), ("x", None)], "text string, level_no int")
    docs = [(k, (t + " ") * 6) for k, t in LEVELS.items()] + [(4, None), (5, ""), (6, LEVELS[1]), (7, "Der Hund und die Katze sind in dem Haus. " * 30), (8, "Strength: 4 MPa | the ash | 3 d\n" * 60), (2, (LEVELS[2] + " ") * 6)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("level_no", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(9))
    assert rows(level.reading_levels(d, s)) == [(1, 1), (2, 2), (3, 3)]
    assert level.reading_levels(d.limit(0), s).count() == 0 and level.reading_levels(d, s.limit(0)).count() == 0


PAGE = "Home | News | Shop | Costs\n\nWe use cookies to improve your visit. Accept all | Reject\nRope tests fly ash for a wall\nCosts\nMix | Age | Strength\nB5 | 3 d | 9 MPa\nSponsored: save 8% on rope\nCookie-shaped discs were cut.\n- fly ash, 4 % by mass\nShop\nCosts\nHome\nHosted by Rope\n© 2020 Rope. All rights reserved."


def test_page_bodies(spark, rows):
    pages = [(f"p{i}", "h", PAGE.replace("B5 | 3", f"B5 | {i}").replace("4 %", f"{i} %").replace("wall", f"wall {'x' * i}").replace("discs", f"discs {'y' * i}")) for i in range(10)]
    pages += [("p0", "h", pages[0][2]), ("n1", None, None), ("n2", "h", " N.A. "), ("n3", "h", "None"), ("n4", None, "Only prose here.\n\n" + "long " * 40_000)]
    df = spark.createDataFrame([(*p, 3) for p in pages], "id string, host string, text string, line_no int")
    got = rows(pagebody.main_body(df, "id", "text", "host"), "row_key", "line_no")
    assert [n for k, n in got if k == "p3"] == [4, 5, 6, 7, 9, 10]
    assert [n for k, n in got if k == "n4"] == [1, 3] and {k for k, _ in got} == {f"p{i}" for i in range(10)} | {"n4"} and len(got) == 62
    assert pagebody.main_body(df.limit(0), "id", "text", "host").count() == 0


def test_page_bodies_of_a_large_host(spark):
    """Headings stay whatever the host's size: over a paragraph, over another heading, and on a fifth of the pages; what repeats alone goes."""
    top = ["concat('Trial ', id, ' of ash')", "IF(id % 27 = 0, concat('How the mix behaves\n\nThe cubes of lot ', id, ' held.'), '')", "IF(id % 5 = 0, concat('Findings\nTags: a, b\n- lot ', id, ' kept\n- lot ', id, ' sold'), '')"]
    low = ["IF(id % 25 = 0, concat('Site and materials\nSampling\nDrum ', id, ' was cut.'), '')", "'Hosted by Rope'", "IF(id % 3 = 0, 'Ask the harbour office', '')"]
    df = spark.range(120_000).selectExpr("concat('p', id) AS id", "'h' AS host", f"concat_ws('\n', {', '.join(top + low)}) AS text")
    got = pagebody.main_body(df, "id", "text", "host").selectExpr("row_key AS id", "line_no")
    lines = df.selectExpr("id", "posexplode(split(text, '\n')) AS (n, s)").selectExpr("id", "n + 1 AS line_no", "regexp_replace(s, '[0-9]+', '0') AS s").where("s <> ''")
    kept = {r[0]: r[1] for r in lines.join(got.withColumn("k", got.line_no), ["id", "line_no"], "left").groupBy("s").agg({"k": "count"}).collect()}
    assert kept == {"Trial 0 of ash": 120_000, "How the mix behaves": 4445, "The cubes of lot 0 held.": 4445, "Findings": 24_000, "Tags: a, b": 0, "- lot 0 kept": 24_000, "- lot 0 sold": 24_000, "Site and materials": 4800, "Sampling": 4800, "Drum 0 was cut.": 4800, "Hosted by Rope": 0, "Ask the harbour office": 0}


def test_page_importance_is_exact(spark, rows):
    """A list of lines at 0, 0 and 0.75 has mean 0.25 and is cut; a line that one page repeats is on one page."""
    page = "Drum {0} held.\n- lot one kept\n- lot two sold\n- lot {1} lost"
    pages = [(f"p{i:02}", "h", page.format(i, "ab" if i < 2 else i) + ("\nSo it went." * 20 if i == 5 else "")) for i in range(16)]
    got = rows(pagebody.main_body(spark.createDataFrame(pages, "id string, host string, text string"), "id", "text", "host"), "row_key", "line_no")
    assert [n for k, n in got if k == "p00"] == [1] and [n for k, n in got if k == "p07"] == [1, 2, 3, 4] and [n for k, n in got if k == "p05"] == list(range(1, 25))


def test_page_tree_alone(spark):
    """Without any list of forms, on hosts with menus of their own: furniture by what repeats and by what it stands beside."""
    import random

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3))
    rows_, true = [], set()
    for h in range(40):
        menu, foot = [word().title() for _ in range(6)], f"Hosted by {word()}, all the year"
        for n in range(25):
            teasers = [f"In our shop: {word()} and {word()} for {n} coins", f"Next week: {word()} meets {word()} | {word()}", f"Guests of {word()} also saw {word()}, {n} times", f"Win {n} tickets to {word()}"]
            rng.shuffle(teasers)
            at = [(m, False) for m in rng.sample(menu, 5)] + [(t, False) for t in teasers[:2]]
            at += [(f"Trials of {word()} in the {word()} yard", True)]
            at += [(f"The {word()} was {word()} before {word()} could {word()} it. We saw {word()} again.", True) for _ in range(rng.randint(1, 5))]
            at += [("Findings", True), (f"- {word()} at {n} days", True), (f"- {word()} at {n + 7} days", True)] if n % 3 == 0 else []
            at += [(t, False) for t in teasers[2:]] + [(foot, False)]
            rows_.append((f"{h}-{n}", f"h{h}", "\n".join(s for s, _ in at)))
            true |= {(f"{h}-{n}", i) for i, (_, y) in enumerate(at, 1) if y}
    df = spark.createDataFrame(rows_, "id string, host string, text string")
    got = {tuple(r) for r in pagebody.main_body(df, "id", "text", "host", forms={}, rounds=4, least_belief=0.4).collect()}
    assert len(got & true) >= 0.9 * len(true) and len(got & true) >= 0.9 * len(got)


def test_names_by_token(spark):
    """Reordered, abbreviated and mistyped words link; two edits do with ``most`` = 2 only; other names, trades and legal forms don't."""
    groups = [
        ["Alpha Beta Cement Ltd", "Beta Alpha Cement Ltd", "Betta Alpha Cement"], ["Byzepygo Cemnet Industries", "Byzepygo Cement Industries", "BYZEPYGO CEM. IND."], ["Smith Ptnrs GmbH", "Smith Partners GmbH"],
        ["Alpha Gamma Cement Ltd"], ["Alpha Beta Cement GmbH"], ["Smith Partners Slag GmbH"], ["Smith Brothers GmbH"], ["Byzpego Concrete"], ["Byzepygo Concrete"],
    ]
    df = spark.createDataFrame([(n,) for g in groups for n in g] + [(None,), (" N.A. ",)], "name string")

    def found(**kw):
        by = {}
        for r in names.link_names([(df, "name")], **kw).collect():
            by.setdefault(r[1], []).append(r[0])
        return sorted(map(sorted, by.values()))

    strict = [g for g in groups if g != ["Alpha Beta Cement GmbH"]]
    got = found()
    assert [g for g in got if "Cement GmbH" not in g[0] and "Betta Alpha Cement" not in g] == sorted(sorted(g) for g in strict if "Betta Alpha Cement" not in g)
    assert any({"Alpha Beta Cement Ltd", "Beta Alpha Cement Ltd", "Betta Alpha Cement"} <= set(g) for g in got)  # a name without a legal form agrees with any
    assert sorted(["Byzepygo Concrete", "Byzpego Concrete"]) in found(most=2)
    assert names.link_names([(df.limit(0), "name")]).count() == 0


def test_names_without_generic_words(spark):
    """An empty list makes every word a proper one; what is left is order, edits, abbreviations and endings."""
    df = spark.createDataFrame([(n,) for n in ("Gastiwahu Clay Development LLC", "Clay Devt. Gastiwahu", "Gastiwahhu Clay Development", "Tubizanir Slag Processing", "Tubizanir Slag Processors", "Tubizanir Kiln Processing")], "name string")
    by = {r[0]: r[1] for r in names.link_names([(df, "name")], words={}).collect()}
    assert len({by[n] for n in by if n.startswith(("Gast", "Clay"))}) == 1 and by["Tubizanir Slag Processing"] == by["Tubizanir Slag Processors"] != by["Tubizanir Kiln Processing"]
