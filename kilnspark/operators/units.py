"""One unit per quantity: conversions as a graph of affine edges, composed once, then an equi-join on the unit.

``EDGES`` holds (from, to, a, b) with ``to = a * from + b``. :func:`compose` walks shortest paths from every unit to its
canonical target, checks that every edge agrees with the paths (so all cycles are consistent), and gives one affine function
per unit. :func:`spellings` gives the written forms of each unit. Both are small, fixed by configuration, and never grow with
the data; the data side is JVM expressions and one equi-join.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Mapping
from fractions import Fraction as Fr

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import BLANK, NO_DATA, plain_digits

# Exact conversion factors.
_LB = Fr("0.45359237")  # kg
_SHORT = 2000 * _LB  # kg
_YD3 = Fr("0.9144") ** 3  # m3
_FT3 = Fr("0.3048") ** 3  # m3
_KGF = Fr("9.80665")  # N
_INCH2 = Fr("0.0254") ** 2  # m2
_PSI = _LB * _KGF / _INCH2  # Pa
_BTU = Fr("1.05505585262")  # kJ

#: quantity -> canonical unit
CANONICAL = {
    "strength": "mpa", "co2_mass": "kg/t", "co2_volume": "kg/m3", "co2_year": "kt/yr",
    "energy": "mj/t", "temperature": "degc", "fineness": "m2/kg",
}

#: Affine edges (from, to, a, b), to = a * from + b.
EDGES: list[tuple[str, str, Fr, Fr]] = [
    (s, t, Fr(a), Fr(b))
    for s, t, a, b in [
        ("pa", "kpa", Fr(1, 1000), 0), ("kpa", "mpa", Fr(1, 1000), 0), ("gpa", "mpa", 1000, 0), ("bar", "kpa", 100, 0), ("bar", "mpa", Fr(1, 10), 0), ("atm", "kpa", Fr("101.325"), 0),
        ("psi", "pa", _PSI, 0), ("ksi", "psi", 1000, 0), ("kgf/cm2", "pa", _KGF * 10000, 0),
        ("kg/kg", "kg/t", 1000, 0), ("t/t", "kg/kg", 1, 0), ("g/kg", "kg/t", 1, 0), ("g/t", "g/kg", Fr(1, 1000), 0), ("lb/lb", "kg/kg", 1, 0), ("lb/short", "lb/lb", Fr(1, 2000), 0), ("lb/t", "kg/t", _LB, 0),
        ("t/m3", "kg/m3", 1000, 0), ("g/l", "kg/m3", 1, 0), ("kg/l", "t/m3", 1, 0), ("g/m3", "kg/m3", Fr(1, 1000), 0), ("lb/yd3", "kg/m3", _LB / _YD3, 0), ("lb/ft3", "lb/yd3", 27, 0), ("lb/ft3", "kg/m3", _LB / _FT3, 0),
        ("kg/yr", "t/yr", Fr(1, 1000), 0), ("t/yr", "kt/yr", Fr(1, 1000), 0), ("mt/yr", "kt/yr", 1000, 0), ("mt/yr", "t/yr", 1000000, 0), ("short/yr", "kg/yr", _SHORT, 0), ("kshort/yr", "short/yr", 1000, 0), ("mshort/yr", "kshort/yr", 1000, 0), ("lb/yr", "kg/yr", _LB, 0),
        ("mj/kg", "mj/t", 1000, 0), ("kj/kg", "mj/t", 1, 0), ("gj/t", "mj/t", 1000, 0), ("gj/t", "mj/kg", 1, 0), ("kwh/t", "mj/t", Fr("3.6"), 0), ("kwh/kg", "kwh/t", 1000, 0), ("mwh/t", "kwh/t", 1000, 0), ("btu/lb", "kj/kg", _BTU / _LB, 0), ("kcal/kg", "kj/kg", Fr("4.184"), 0),
        ("kelvin", "degc", 1, Fr("-273.15")), ("degf", "degc", Fr(5, 9), Fr(-160, 9)), ("degf", "kelvin", Fr(5, 9), Fr("459.67") * 5 / 9),
        ("m2/g", "m2/kg", 1000, 0), ("cm2/g", "m2/kg", Fr(1, 10), 0), ("cm2/g", "m2/g", Fr(1, 10000), 0),
    ]
]

#: Largest amounts that are believed, in the canonical unit; only used to tell "1,234" as a decimal comma from thousands.
CEILING = {"strength": 2000.0, "co2_mass": 20000.0, "co2_volume": 20000.0, "co2_year": 100000.0, "energy": 100000.0, "temperature": 5000.0, "fineness": 100000.0}


def compose(edges: list[tuple[str, str, Fr, Fr]] = EDGES, canonical: dict[str, str] = CANONICAL) -> dict[str, tuple[str, float, float]]:
    """unit -> (quantity, a, b) with canonical = a * amount + b, along shortest paths.

    Raises ValueError if two ways between units disagree, if a unit reaches two canonical units, or if a factor is zero.
    Arithmetic is exact (fractions) until the end.
    """
    near: dict[str, list[tuple[str, Fr, Fr]]] = defaultdict(list)
    for s, t, a, b in edges:
        if a == 0:
            raise ValueError(f"edge {s} -> {t} can't be inverted")
        near[s].append((t, a, b))
        near[t].append((s, 1 / a, -b / a))
    out: dict[str, tuple[str, Fr, Fr]] = {}
    for quantity, target in canonical.items():
        # to[u]: u = a * target + b, found breadth first, so by the fewest edges
        to = {target: (Fr(1), Fr(0))}
        queue = deque([target])
        while queue:
            u = queue.popleft()
            a, b = to[u]
            for v, c, d in near[u]:
                if v not in to:
                    to[v] = (c * a, c * b + d)
                    queue.append(v)
        for u, (a, b) in to.items():
            for v, c, d in near[u]:
                if to[v] != (c * a, c * b + d):
                    raise ValueError(f"cycle through {u} -> {v} is inconsistent")
            if u in out:
                raise ValueError(f"{u} belongs to {out[u][0]} and {quantity}")
            out[u] = (quantity, 1 / a, -b / a)
    return {u: (q, float(a), float(b)) for u, (q, a, b) in out.items()}


def spellings() -> dict[str, str]:
    """Written form (as :func:`unit_key` gives it) -> unit. Built from spellings of the parts, not listed one by one."""
    # Written forms of the parts of units, in lower case without blanks and full stops.
    mass = {"g": ["g", "gram", "grams"], "kg": ["kg", "kilogram", "kilograms", "kgs"], "t": ["t", "tonne", "tonnes", "metricton", "metrictons", "mg"], "lb": ["lb", "lbs", "pound", "pounds"]}
    large = {"kt": ["kt", "gg", "thousandtonnes", "thousandt", "kilotonne", "kilotonnes"], "mt": ["mt", "milliontonnes", "milliont", "megatonne", "megatonnes", "tg"], "short": ["shortton", "shorttons", "ston", "stons"], "kshort": ["thousandshorttons", "thousandshortton"], "mshort": ["millionshorttons", "millionshortton"]}
    product = {"t": ["t", "tonne", "tonnes", "metricton", "ton(metric)"], "kg": ["kg", "kilogram"], "lb": ["lb", "pound"], "short": ["shortton", "ston"]}
    volume = {"m3": ["m3", "cubicmetre", "cubicmeter", "cum"], "yd3": ["yd3", "cuyd", "cubicyard", "cy"], "ft3": ["ft3", "cuft", "cubicfoot"], "l": ["l", "litre", "liter"]}
    year = ["yr", "year", "a", "annum", "y", "pa"]
    out = {
        "mpa": "mpa", "megapascal": "mpa", "megapascals": "mpa", "n/mm2": "mpa", "nmm-2": "mpa", "mn/m2": "mpa", "mnm-2": "mpa", "gpa": "gpa", "gigapascal": "gpa", "gn/m2": "gpa", "kpa": "kpa", "kilopascal": "kpa", "kn/m2": "kpa", "knm-2": "kpa", "pa": "pa", "pascal": "pa", "n/m2": "pa", "bar": "bar", "bars": "bar", "atm": "atm",
        "psi": "psi", "lb/in2": "psi", "lbf/in2": "psi", "lbs/in2": "psi", "lbin-2": "psi", "ksi": "ksi", "kpsi": "ksi", "kip/in2": "ksi", "kips/in2": "ksi", "kgf/cm2": "kgf/cm2", "kg/cm2": "kgf/cm2", "kgfcm-2": "kgf/cm2", "kgcm-2": "kgf/cm2", "kp/cm2": "kgf/cm2",
        "c": "degc", "°c": "degc", "℃": "degc", "degc": "degc", "degreec": "degc", "degreesc": "degc", "celsius": "degc", "degreescelsius": "degc", "degcelsius": "degc", "k": "kelvin", "kelvin": "kelvin", "kelvins": "kelvin", "f": "degf", "°f": "degf", "℉": "degf", "degf": "degf", "fahrenheit": "degf", "degreesf": "degf", "degreesfahrenheit": "degf",
        "tpa": "t/yr", "ktpa": "kt/yr", "mtpa": "mt/yr",
    }
    for unit, own in (mass | large).items():
        for x in own:
            for y in year:
                out.setdefault(f"{x}/{y}", f"{unit}/yr")
            if unit not in mass:
                continue
            for p, ps in product.items():
                for y in ps:
                    out.setdefault(f"{x}/{y}", f"{unit}/{p}")
            for v, vs in volume.items():
                for y in vs:
                    out.setdefault(f"{x}/{y}", f"{unit}/{v}")
    heat = {"mj": ["mj"], "kj": ["kj"], "gj": ["gj"], "kwh": ["kwh", "kw·h", "kw-h"], "mwh": ["mwh", "mw·h"], "btu": ["btu"], "kcal": ["kcal"]}
    for unit, own in heat.items():
        for x in own:
            for p, ps in product.items():
                for y in ps:
                    out.setdefault(f"{x}/{y}", f"{unit}/{p}")
    for unit, own in {"m2": ["m2", "sqm", "squaremetre", "squaremetres"], "cm2": ["cm2", "sqcm", "squarecentimetre"]}.items():
        for x in own:
            for y in ("kg", "g"):
                out.setdefault(f"{x}/{y}", f"{unit}/{y}")
    units = compose()
    return {k: v for k, v in out.items() if v in units}


def unit_rows() -> list[tuple[str, str, float, float]]:
    """(unit_key, quantity, a, b): one row per written form, also behind 'thousand' and 'million'."""
    units, forms = compose(), spellings()
    rows = {k: units[u] for k, u in forms.items()}
    for word, times in (("thousand", 1e3), ("million", 1e6)):
        for k, u in forms.items():
            q, a, b = units[u]
            rows.setdefault(word + k, (q, a * times, b))
    return [(k, *v) for k, v in sorted(rows.items())]


def unit_table(spark: SparkSession) -> DataFrame:
    """:func:`unit_rows` as a table. Bounded by configuration (a few thousand short rows)."""
    return spark.createDataFrame(unit_rows(), "unit_key string, quantity string, a double, b double")


def unit_key(c: Column) -> Column:
    """A unit as written in the form that :func:`spellings` uses; blank and no-data give ''; NULL gives ''.

    Raised digits become plain, 'per' and '·' between parts become '/', CO2 marks (CO2, CO2e, CO2-eq) and words that name
    the product (cement, clinker, binder, concrete, Blaine, 'dry basis') go.
    """
    s = F.lower(plain_digits(F.coalesce(c, F.lit(""))))
    s = F.regexp_replace(s, rf"{BLANK}+", " ")
    s = F.trim(F.regexp_replace(s, r"\((?:dry|wet) basis\)", ""))
    s = F.when(s.isin(*NO_DATA, "-", "see name"), "").otherwise(s)
    s = F.regexp_replace(s, r"co2(?:[ -]?eq?\b\.?|eq?)?", "")
    s = F.regexp_replace(s, r"\b(?:of )?(?:cement|clinker|binder|concrete|blaine|product)\b", "")
    s = F.regexp_replace(s, r"\bper\b", "/")
    s = F.regexp_replace(s, r"p\. ?a\.?$", "/yr")
    return F.regexp_replace(s, r"[ .]", "")


#: A number at the start of a text: sign, digits with marks for decimals and thousands, exponent.
_NUMBER = r"^(?:(?:~|≈|approx\.?|ca\.?|circa|about|c\.)\s*)?\+?([0-9](?:[0-9.,']| (?=[0-9]{3}(?![0-9])))*)(e[+-]?[0-9]+)?(.*)$"


def _prepared(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(plain_digits(F.coalesce(c, F.lit("")))), rf"{BLANK}+", " "))


def number_part(prepared: Column, part: int) -> Column:
    """Digits and marks (1), exponent (2) or rest (3) of a single amount, from :func:`_prepared` text; '' for ranges, bounds and texts without a
    number in front."""
    return F.regexp_extract(prepared, _NUMBER, part)


def amount(t: Column, e: Column) -> Column:
    """The amount of digits with marks and an exponent, commas read as thousands where they can be (1,234 is 1234; 10,4 and 0,123 are
    decimals); NULL if none."""
    comma, dot = t.contains(","), t.contains(".")
    plain = (
        F.when(~comma & ~dot, t)
        .when(comma & dot & (F.length(t) - F.instr(F.reverse(t), ",") < F.length(t) - F.instr(F.reverse(t), ".")), F.replace(t, F.lit(","), F.lit("")))
        .when(comma & dot, F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .when(comma & t.rlike(r"^[1-9][0-9]{0,2}(,[0-9]{3})+$"), F.replace(t, F.lit(","), F.lit("")))
        .when(comma & t.rlike(r"^[0-9]+,[0-9]+$"), F.replace(t, F.lit(","), F.lit(".")))
        .when(dot & t.rlike(r"^[1-9][0-9]{0,2}(\.[0-9]{3}){2,}$"), F.replace(t, F.lit("."), F.lit("")))
        .when(comma, F.lit(None).cast("string"))
        .otherwise(t)
    )
    return F.concat(plain, e).try_cast("double")


def amount_as_decimal(t: Column) -> Column:
    """The amount with a lone comma read as the decimal mark; NULL where :func:`amount` has no doubt."""
    return F.when(t.contains(",") & t.rlike(r"^[1-9][0-9]{0,2},[0-9]{3}$"), F.replace(t, F.lit(","), F.lit(".")).try_cast("double"))


def to_common(df: DataFrame, value: str, units: list[Column], quantities: list[str], out: str = "common", ceiling: Mapping[str, float] = CEILING) -> DataFrame:
    """Adds ``{out}_quantity`` and ``{out}_value`` (in the canonical unit), NULL where the row has no single absolute amount.

    ``value`` is a text or numeric column. ``units`` are columns where the unit may stand, first choice first; a text right
    behind the number in ``value`` comes before all. The first that states anything decides: if that isn't a unit of one of
    ``quantities``, there is no amount. NULL, empty and no-data values give NULL. Rows are kept, repeated rows too.

    "1,234" is 1234 unless that is more than ``ceiling`` of its quantity, in the canonical unit: then it is 1.234. Nothing else is
    judged by size; an empty ``ceiling`` reads all such numbers as thousands.
    """
    spark = df.sparkSession
    v = F.col(f"`{value}`")
    text = dict(df.dtypes)[value] == "string"
    d, first = df, F.lit("")
    if text:  # each step reads the one before more than once, so none is computed twice; rows without a digit have no amount and are not looked at
        d = d.withColumn("__p", F.when(v.rlike("[0-9⁰¹²³⁴-⁹₀-₉]"), _prepared(v)).otherwise(""))
        d = d.withColumns({"__t": F.regexp_replace(number_part(F.col("__p"), 1), "[ ']", ""), "__e": number_part(F.col("__p"), 2), "__rest": F.trim(number_part(F.col("__p"), 3))})
        d = d.withColumn("__key0", F.when(F.col("__rest") != "", unit_key(F.col("__rest"))).otherwise(""))
        first = F.col("__key0")
        some = F.col("__t") != ""
    else:
        some = v.isNotNull()
    for n, u in enumerate(units, 1):
        d = d.withColumn(f"__key{n}", F.when(first != "", first).when(some, unit_key(u)).otherwise(""))
        first = F.col(f"__key{n}")
    plain = amount(F.col("__t"), F.col("__e")) if text else F.when(~F.isnan(v), v.cast("double"))
    other = amount_as_decimal(F.col("__t")) if text else F.lit(None).cast("double")
    d = d.withColumns({"__key": F.when(first != "", first), "__plain": plain, "__other": other})
    t = unit_table(spark).where(F.col("quantity").isin(*quantities)).select(F.col("unit_key").alias("__unit"), F.col("quantity").alias("__q"), F.col("a").alias("__a"), F.col("b").alias("__b"))
    d = d.join(F.broadcast(t), F.col("__key") == F.col("__unit"), "left")  # the unit table is bounded by configuration
    most = F.element_at(F.create_map(*[x for q, c in ceiling.items() for x in (F.lit(q), F.lit(c))]), F.col("__q")) if ceiling else F.lit(None)
    best = F.when((F.col("__a") * F.col("__plain") + F.col("__b") > most) & F.col("__other").isNotNull(), F.col("__other")).otherwise(F.col("__plain"))
    d = d.withColumn(f"{out}_value", F.col("__a") * best + F.col("__b"))
    return d.withColumn(f"{out}_quantity", F.when(F.col(f"{out}_value").isNotNull(), F.col("__q"))).drop("__key", "__plain", "__other", "__unit", "__q", "__a", "__b", "__p", "__t", "__e", "__rest", "__key0", *[f"__key{n}" for n in range(1, len(units) + 1)])


def noted_unit(notes: Column, topic: str) -> Column:
    """The unit that a remark states for ``topic`` ('[topic: u]', 'topic given in u', 'Unit of topic: u', 'topic as u in table 3')."""
    n = F.coalesce(notes, F.lit(""))
    return F.regexp_extract(n, rf"(?i)(?:unit of )?{topic}(?::| given in| as) *([^;\]]+?) *(?: in table [0-9]+ *)?(?:[;\]]|$)", 1)


def remarked_unit(notes: Column, value: Column) -> Column:
    """The unit in a metric's remark ('unit: u (from table)', 'value in u', 'reported as u', '<amount> u at steady state')."""
    n = F.coalesce(notes, F.lit(""))
    return F.coalesce(
        *[F.when(x != "", x) for x in (
            F.regexp_extract(n, r"(?i)unit: *(.+?) *(?:\(from table\))? *(?:;|$)", 1),
            F.regexp_extract(n, r"(?i)(?:value in|reported as|given in|expressed in) +(.+?) *(?:;|$)", 1),
            F.regexp_extract(n, r"(?i)^[~+]?[0-9][0-9.,]*(?:e[+-]?[0-9]+)? *(.+?) +at steady state", 1),
        )]
    )


def named_unit(name: Column) -> Column:
    """The unit behind a metric's name: 'name (u)', 'name [u]', 'name , u', 'name in u'; '' if none."""
    n = F.coalesce(name, F.lit(""))
    return F.coalesce(*[F.when(x != "", x) for x in (F.regexp_extract(n, r",\s+(.+)$", 1), F.regexp_extract(n, r"\s+in\s+(\S.*)$", 1), F.regexp_extract(n, r"\[([^\[\]]+)\]\s*$", 1), F.regexp_extract(n, r"\(([^()]*(?:\([^()]*\))?[^()]*)\)\s*$", 1))], F.lit(""))


#: What a metric's name says about its quantity, first match first.
METRIC_QUANTITY = [
    ("strength", "strength"), ("per volume|concrete co2", "co2_volume"), ("per mass|specific co2", "co2_mass"), ("annual|yearly", "co2_year"),
    ("temp", "temperature"), ("surface|fineness|blaine", "fineness"), ("energy|heat", "energy"),
]


def metric_quantity(name: Column) -> Column:
    """The quantity that a metric's name stands for, NULL if it tells nothing."""
    n, out = F.lower(F.coalesce(name, F.lit(""))), F.lit(None).cast("string")
    for pattern, q in reversed(METRIC_QUANTITY):
        out = F.when(n.rlike(pattern), q).otherwise(out)
    return out


def common_amounts(cementitious: DataFrame, metric_intel: DataFrame) -> DataFrame:
    """(origin, row_key, quantity, common_value): amounts of both tables in canonical units, times 100, rounded.

    Ranges, bounds, percentages and amounts without a fitting unit give no row. Rows delivered again give one.
    """
    c = cementitious.select("record_id", "notes", *[f"{k}_{x}" for k in ("compressive_strength", "co2_reduction") for x in ("value", "unit")])
    s = to_common(c, "compressive_strength_value", [F.col("compressive_strength_unit"), noted_unit(F.col("notes"), "strength")], ["strength"])
    e = to_common(c, "co2_reduction_value", [F.col("co2_reduction_unit"), noted_unit(F.col("notes"), "CO2 saving")], ["co2_mass", "co2_volume", "co2_year"])
    m = metric_intel.select("metric_id", "metric_name", "metric_value", "unit", "notes")
    m = to_common(m, "metric_value", [F.col("unit"), named_unit(F.col("metric_name")), remarked_unit(F.col("notes"), F.col("metric_value"))], list(CANONICAL))
    says = metric_quantity(F.col("metric_name"))
    m = m.where(says.isNull() | (says == F.col("common_quantity")))
    parts = [
        d.where("common_quantity IS NOT NULL").select(F.lit(o).alias("origin"), F.col(k).cast("string").alias("row_key"), F.col("common_quantity").alias("quantity"), F.round(F.col("common_value") * 100).cast("long").alias("common_value"))
        for o, k, d in (("cementitious", "record_id", s), ("cementitious", "record_id", e), ("metric_intel", "metric_id", m))
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).where("row_key IS NOT NULL").distinct()
