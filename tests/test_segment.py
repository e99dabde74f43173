import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kilnspark.operators.segment import Splitter, split_fields

S = Splitter(["grinding to 0,000 cm0/g", "ash > reclaimed; wet", "limestone filler, class 0"])

CASES = {
    "": [], "  ": [], "sieving": ["sieving"], '"sieving"': ["sieving"], "a; b ;c;;": ["a", "b", "c"], "a | | b": ["a", "b"], "a\r\nb\n\nc": ["a", "b", "c"], "\ta\tb": ["a", "b"], "a / b/c": ["a", "b/c"],
    '["x, y", "the \\"wet\\" one"]': ["x, y", 'the "wet" one'], "['a, b', 'c']": ["a, b", "c"], '["broken, x': ['["broken', "x"], '"the ""fine"" fraction";b': ['the "fine" fraction', "b"],
    "1) one 2) two 3) three": ["one", "two", "three"], "(i) one; (ii) two": ["one", "two"], "• one • two": ["one", "two"], "- one\n- two": ["one", "two"], "1. one\n2. two": ["one", "two"],
    "de-ironing, grinding to 4,675 cm2/g; sieving": ["de-ironing", "grinding to 4,675 cm2/g", "sieving"], "Ash > Reclaimed; wet; other": ["Ash > Reclaimed; wet", "other"], '"limestone filler, class 3"|x': ["limestone filler, class 3", "x"],
    "two-stage separation (wet)": ["two-stage separation (wet)"], "a;a;a": ["a", "a", "a"],
}


def test_cases():
    for cell, want in CASES.items():
        assert S(cell) == want, cell


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abcdef gh", min_size=1).map(str.strip).filter(lambda x: len(x) > 1 and not x.startswith(("a)", "i)"))), min_size=1, max_size=6), st.sampled_from(["; ", ";", " | ", "|", "\n", "\t", ", "]))
def test_round_trip(values, mark):
    assert S(mark.join(values)) == values
    assert S(json.dumps(values)) == values
    assert S(mark.join('"' + v + '"' for v in values)) == values


def test_table(spark, rows):
    df = spark.createDataFrame([("f", "1", "a, class 5; b", 9), ("f", "1", "a, class 5; b", 9), ("f", "2", None, 9), ("f", "3", "N.A.", 9), ("f", None, "x", 9), ("f", "5", '["a, class 5"]', 9), ("f", "6", '"a, class 6";z', 9), ("f", "7", "y" * 50_000 + ";z", 9)], "field_name string, row_key string, cell string, pos_no int")
    got = rows(split_fields(df))
    assert [r[1:] for r in got if r[1] < "7"] == [("1", 1, "a, class 5"), ("1", 2, "b"), ("5", 1, "a, class 5"), ("6", 1, "a, class 6"), ("6", 2, "z")]
    assert [len(r[3]) for r in got if r[1] == "7"] == [50_000, 1]
    assert split_fields(df.limit(0)).count() == 0


def test_dictionary_is_whole_or_fails(spark, rows):
    """The bound holds for a field, not for all together; long values are known too; what lies beyond the bound is no silent loss."""
    long = "fine " * 50 + "ash, wet"
    cells = [("f", f"{v}{i}", json.dumps([f"{v}, class"])) for v in "abc" for i in range(3)] + [("g", f"g{i}", json.dumps([long])) for i in range(2)] + [("g", "g9", f"{long}; other"), ("f", "f9", "c, class; other")]
    df = spark.createDataFrame(cells, "field_name string, row_key string, cell string")
    got = rows(split_fields(df, max_entries=3))
    assert [r[1:] for r in got if r[1] in ("f9", "g9")] == [("f9", 1, "c, class"), ("f9", 2, "other"), ("g9", 1, long), ("g9", 2, "other")]
    with pytest.raises(ValueError, match="more than 2 known values .* in f:"):
        split_fields(df, max_entries=2)
