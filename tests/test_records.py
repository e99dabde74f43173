"""Field normalisers, record rules and folds: hand-made rows, nulls, blanks, ties, empty tables."""

import pytest
from pyspark.sql import functions as F

from kilnspark.functions import normalise as N
from kilnspark.operators import integrity, merging, payloads, records


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_vocabulary(spark):
    stages = ("Laboratory", "Pilot", "Commercial")
    patterns = [("semi-industrial", "Pilot"), ("full.scale", "Commercial")]
    stage = lambda x: N.vocabulary(F.lit(x), stages, {"lab": "Laboratory"}, patterns, "planned|by 203")
    r = one(spark, a=stage("Pilot"), b=stage("LAB"), c=stage("full scale plant"), d=stage("planned commercial plant"), e=stage("a pilot line"), f=stage("copilot"), g=stage(" N/A "), h=stage("Commercial by 2035"), i=stage("Commercial"))
    assert [(x.value, x.corrected) for x in r] == [("Pilot", False), ("Laboratory", True), ("Commercial", True), ("N.A.", True), ("Pilot", True), ("N.A.", True), ("N.A.", False), ("N.A.", True), ("Commercial", False)]
    assert one(spark, n=N.vocabulary(F.lit(None).cast("string"), stages)).n.value == "N.A."


def test_short_texts(spark):
    r = one(
        spark, a=N.concise(F.lit("steam  cured. Then dried"), 12), b=N.concise(F.lit("one two three four"), 2), c=N.concise(F.lit(None).cast("string")), d=N.concise_list(F.lit("a" * 100 + ", " + "b" * 100)), e=N.concise_number(F.lit("about -3.5 to 4")), f=N.concise_number(F.lit("x" * 50)),
        g=N.split_unit(F.lit("12.5 MPa"), F.lit(""), ["MPa", "%"]), h=N.split_unit(F.lit("12.5 MPa"), F.lit("N/mm2"), ["MPa", "%"]), i=N.split_unit(F.lit(None).cast("string"), F.lit(None).cast("string"), ["MPa"]),
    )
    assert (r.a, r.b, r.c, r.d, r.e, r.f) == ("steam cured", "one two", "N.A.", "a" * 100, "-3.5", "x" * 40)
    assert [tuple(x) for x in (r.g, r.h, r.i)] == [("12.5", "MPa"), ("12.5 MPa", "N/mm2"), ("N.A.", "N.A.")]


def test_numbers_lists_and_years(spark):
    r = one(
        spark, a=N.number_in(F.lit("1,234.5 kg")), b=N.number_in(F.lit("none")), c=N.integer_in(F.lit("up to 7.9")), d=N.three_way(F.lit(" YES ")), e=N.three_way(F.lit("maybe")), f=N.encode_list(F.lit(" a, b,, c")), g=N.encode_list(F.lit('["x", "y"]')), h=N.encode_list(F.lit("NA")), i=N.encode_list(F.lit("[broken")),
        j=N.decode_list(F.lit('["x", "y"]')), k=N.decode_list(F.lit(None).cast("string")), l=N.text_list(F.lit("a, b; N.A.; c")), m=N.category(F.lit("steel slag"), ("Slag", "Ash"), {"pfa": "Ash"}), n=N.category(F.lit("PFA"), ("Slag", "Ash"), {"pfa": "Ash"}), o=N.category(F.lit(""), ("Slag",), {}),
        p=N.acronym_case(F.lit("GGBS")), q=N.acronym_case(F.lit("fly  ash")), s=N.year_of([F.lit(None).cast("string"), F.lit("published 2011")], F.lit("10.1/j.2009.04")), t=N.year_of([F.lit("n/a")], F.lit("10.1016/j.x.2009.04.001")), u=N.year_of([F.lit("n/a")], F.lit(None).cast("string")),
    )
    assert (r.a, r.b, r.c, r.d, r.e, r.f, r.g, r.h, r.i) == (1234.5, None, 7, "true", "NA", '["a","b","c"]', '["x","y"]', "NA", "[broken")
    assert (r.j, r.k, r.l, r.m, r.n, r.o, r.p, r.q) == (["x", "y"], [], ["a, b", "c"], "Slag", "Ash", "Other", "GGBS", "Fly ash")
    assert [tuple(x) for x in (r.s, r.t, r.u)] == [("2011", "metadata"), ("2009", "doi_inferred"), ("Not Reported", "not_reported")]


def test_rows_through_normalisers(spark, rows):
    df = spark.createDataFrame([(1, "med", "x"), (2, "High", None), (3, None, " ")], "id int, conf string, old string")
    spec = {"level": N.vocabulary("conf", ("High", "Medium"), {"med": "Medium"}), "x": N.missing_to("old", "NA")}
    assert rows(records.normalise(df, ["id"], spec)) == [(1, "Medium", "x", 1), (2, "High", "NA", 0), (3, "N.A.", "NA", 0)]
    assert rows(records.map_columns(df, ["id"], {"new": ["gone", "old", "conf"]})) == [(1, "x"), (2, "High"), (3, None)]
    assert records.duplicate_columns(["A", "a_2", "b"]) == {"a": ["A", "a_2"]}
    assert rows(records.warnings(df, "id", {"no old": F.col("old").isNull(), "low": F.col("conf") == "low"})) == [(2, "no old")]
    assert records.normalise(df.limit(0), ["id"], spec).count() == 0


def test_folds(spark, rows):
    df = spark.createDataFrame([(1, "k", "a", None), (2, "k", "b", "u"), (3, "k", "b", "v"), (4, "k", "N.A.", "v"), (5, "m", None, None)], "id int, k string, f string, g string")
    got = {(r.k, r.field): (r.value, bool(r.promoted), r.sources, r.conflicts) for r in records.fold(df, "k", ["f", "g"], "id", "id").collect()}
    assert got == {("k", "f"): ("a", False, 0, 2), ("k", "g"): ("v", True, 1, 2)}  # one later value is no majority; among several the most frequent wins
    lists = spark.createDataFrame([(2, "k", ["B ", "c"]), (1, "k", ["a", "b", None, ""]), (3, "k", None)], "id int, k string, xs array<string>")
    assert rows(records.union_in_order(lists, "k", "xs", "id")) == [("k", 0, "a"), ("k", 1, "b"), ("k", 2, "c")]
    assert rows(records.best_label(spark.createDataFrame([("k", "low"), ("k", "high"), ("m", "?")], "k string, c string"), "k", "c", {"low": 1, "high": 2})) == [("k", "high"), ("m", "Not Reported")]
    c = records.completeness(df, ["f", "g", "k"]).where("id = 5").first()
    assert (c.missing_fields, c.coverage_score) == (["f", "g"], 0.3333)


def test_compatible_fill(spark, rows):
    data = [(1, "p", "2020", None, None), (2, "p", "2021", "x", "u"), (3, "p", None, "y", None), (4, "p", "2020", "z", "w"), (5, None, "2020", None, None), (6, None, "2020", "q", "q")]
    df = spark.createDataFrame(data, "id int, k string, y string, a string, b string")
    got = rows(merging.compatible_fill(df.withColumn("o", F.col("id")), ["k"], ["y"], ["a", "b"], "o", "id"))
    assert got == [(1, "y", "w", 2), (2, "x", "u", 0), (3, "y", "u", 1), (4, "z", "w", 0), (5, None, None, 0), (6, "q", "q", 0)]
    assert merging.compatible_fill(df.limit(0).withColumn("o", F.col("id")), ["k"], ["y"], ["a"], "o", "id").count() == 0


def test_hot_links_are_spread(spark, rows):
    a = spark.createDataFrame([(f"l{i}", "p") for i in range(60)] + [("x", None)], "id string, k string")
    b = spark.createDataFrame([(f"r{i}", "p") for i in range(40)] * 2, "rid string, k string")
    got = merging.link(a, b, [("project", "k", 0.8)], "id", "rid", F.lit(False), block=7)
    assert got.count() == got.select("id", "rid").distinct().count() == 2400


def test_integrity(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "id int, p string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id int, p string")
    assert rows(integrity.multiset_difference(a, b, ["id", "p"])) == [(1, "x", 2, 1), (3, "y", 0, 1)]
    assert rows(integrity.both_ways(a, "id", b, "id", "a", "b")) == [("b", 3)]
    assert rows(integrity.checks({"ok": (a, F.col("id") < 0), "bad": (a, F.col("p").isNull())})) == [("bad", "fail", 1), ("ok", "pass", 0)]
    assert rows(integrity.in_several(a.unionAll(b), "id", "p")) == []
    assert rows(integrity.required(a, "p", ["x", "z"], {"twice": F.col("id") == 1})) == [("x", "twice"), ("z", "missing")]
    assert rows(integrity.counts_by(a, {"p": F.col("p"), "id": F.col("id")})) == [("id", "1", 2), ("id", "2", 1), ("p", None, 1), ("p", "x", 2)]
    assert rows(integrity.checks({"empty": (a.limit(0), F.lit(True))})) == [("empty", "pass", 0)]


def test_payloads(spark, rows):
    df = spark.createDataFrame([(1, "n", ["a", "b"]), (2, "m", []), (3, "o", None)], "id int, t string, xs array<string>")
    assert rows(payloads.inherit(df, "xs", "x", ["id"], ["t"]), "id", "position", "x", "t") == [(1, 0, "a", "n"), (1, 1, "b", "N.A."), (2, 0, None, "m"), (3, 0, None, "o")]
    assert rows(payloads.with_fallback(df, "xs", "x", F.col("t"), ["id"])) == [(1, False, "a"), (1, False, "b"), (2, True, "m"), (3, True, "o")]
    assert rows(payloads.route(df, [("one", F.col("id") == 1), ("late", F.col("xs").isNull())], "rest"), "id", "status") == [(1, "one"), (2, "rest"), (3, "late")]
    q = spark.createDataFrame([("g", 1, "a?"), ("g", 2, "b?"), ("g", 3, "c?")], "g string, place int, question string")
    a = spark.createDataFrame([("g", 1, "b?", "B"), ("g", 2, "z?", "Z"), ("g", 3, "b?", "late")], "g string, place int, question string, answer string")
    assert rows(payloads.answers(q, a, "g")) == [("g", 1, "a?", "Z", "place"), ("g", 2, "b?", "B", "text"), ("g", 3, "c?", "Not answered", "none")]
    n = spark.createDataFrame([("s", i) for i in (3, 7, 11, 12, 13, 14)], "s string, i int")
    assert rows(payloads.id_ranges(n, ["s"], "i")) == [("s", "3,7,11-14")] and rows(payloads.id_ranges(n, ["s"], "i", 2)) == [("s", "3,7,+1")]
    assert payloads.inherit(df.limit(0), "xs", "x", ["id"], ["t"]).count() == 0


@pytest.mark.parametrize("text,json,problem", [('{"a": 1}', '{"a":1}', None), ('```json\n{"a": "}"}\n```', '{"a":"}"}', None), ('so: {"a": {"b": 2}} and {x}', '{"a":{"b":2}}', None), ("none", None, "no object"), ('{"a": ', None, "not readable"), (None, None, "no object")])
def test_json_answers(spark, text, json, problem):
    from kilnspark.operators import documents

    r = documents.json_answers(spark.createDataFrame([(1, text)], "id int, t string"), "id", "t").first()
    assert (r.json, r.problem) == (json, problem)


def test_readable_pages(spark):
    from kilnspark.operators import documents

    pages = [(1, "<html><nav>Home</nav><article><h1>Ash &amp; lime</h1><p>Cured <b>wet</b>.</p><aside>More</aside></article><footer>x</footer></html>"), (2, "<body>Only<br>this<script>no</script></body>"), (3, None), (4, "plain"), (5, "<p>" + "long " * 50_000)]
    got = {r.id: r.text for r in documents.readable(spark.createDataFrame(pages, "id int, h string"), "id", "h").collect()}
    assert (got[1], got[2], got[3], got[4], len(got[5])) == ("Ash & lime\nCured wet.", "Only\nthis", "", "plain", 249_999)
