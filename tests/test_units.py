from fractions import Fraction as Fr

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kilnspark.operators import units as U


def test_cycles_are_checked():
    with pytest.raises(ValueError, match="inconsistent"):
        U.compose([("a", "b", Fr(2), Fr(0)), ("b", "c", Fr(3), Fr(0)), ("a", "c", Fr(7), Fr(0))], {"q": "c"})
    with pytest.raises(ValueError, match="inverted"):
        U.compose([("a", "b", Fr(0), Fr(0))], {"q": "b"})
    with pytest.raises(ValueError, match="belongs"):
        U.compose([("a", "b", Fr(1), Fr(0))], {"q": "b", "r": "a"})


@settings(max_examples=50, deadline=None)
@given(st.sampled_from(sorted(U.compose())), st.floats(-1e6, 1e6))
def test_composition_equals_walking_the_edges(unit, x):
    """Every edge leads to the same canonical amount."""
    c = U.compose()
    q, a, b = c[unit]
    for s, t, k, d in U.EDGES:
        if s == unit:
            _, a2, b2 = c[t]
            assert a * x + b == pytest.approx(a2 * (float(k) * x + float(d)) + b2, rel=1e-9, abs=1e-6)


CASES = [  # value, unit, notes -> strength in MPa times 100
    ("47,3MPa", None, None, 4730), ("0.0512", "GPa", "", 5120), ("101,449", "kPa", None, 10145), ("1 000", "bar", None, 10000), ("12592", "-", "strength as lb/in2 in table 3", 8682), ("66.9 N/mm²", "unknown", "[CO2 saving: kg CO2/m3]", 6690),
    ("1.000600e+04", "kPa", None, 1001), ("approx. 16.7MPa", None, None, 1670), ("+20", " Mpa. ", None, 2000), ("10 MPa", "n/a", None, 1000),
    ("10-15", "MPa", None, None), (">40", "MPa", None, None), ("up to 9", "MPa", None, None), ("30", "%", "strength given in MPa", None), ("30", None, "[CO2 saving: kg/t]", None), ("see text", "MPa", None, None), (None, "MPa", None, None), ("", "MPa", None, None),
]


def test_strengths(spark):
    df = spark.createDataFrame([(i, v, u, n, "x") for i, (v, u, n, _) in enumerate(CASES)], "id int, value string, unit string, notes string, common string")
    got = U.to_common(df, "value", [F.col("unit"), U.noted_unit(F.col("notes"), "strength")], ["strength"])
    got = {r.id: r.v for r in got.select("id", F.round(F.col("common_value") * 100).cast("int").alias("v")).collect()}
    assert [got[i] for i in range(len(CASES))] == [c[3] for c in CASES]


def test_tables(spark, rows):
    c = spark.createDataFrame([("r1", None, "10", "MPa", "5", "kg/t"), ("r1", None, "10", "MPa", "5", "kg/t"), (None, None, "1", "MPa", None, None), ("r2", None, None, None, "1,234", "Mt/yr")], "record_id string, notes string, compressive_strength_value string, compressive_strength_unit string, co2_reduction_value string, co2_reduction_unit string")
    m = spark.createDataFrame([(1, "Process temp.", 140.0, "°F", None), (2, "Cube strength [ksi]", 2.0, "see name", None), (3, "Cube strength", 5.0, "kg/t", None), (4, "Energy per tonne", float("nan"), "MJ/t", None), (5, "Blaine fineness", 1800.0, "", "1800 cm2/g at steady state")], "metric_id long, metric_name string, metric_value double, unit string, notes string")
    assert rows(U.common_amounts(c, m)) == [("cementitious", "r1", "co2_mass", 500), ("cementitious", "r1", "strength", 1000), ("cementitious", "r2", "co2_year", 123400), ("metric_intel", "1", "temperature", 6000), ("metric_intel", "2", "strength", 1379), ("metric_intel", "5", "fineness", 18000)]
    assert U.common_amounts(c.limit(0), m.limit(0)).count() == 0
