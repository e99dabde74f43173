"""Several values packed in one field: dictionary-guided segmentation.

Whole values that hold delimiters themselves ("grinding to 1,083 cm2/g") are learned from cells that leave no doubt (JSON
lists, quoted pieces). A multi-pattern automaton finds them in every other cell, and dynamic programming picks the cover of
the cell's pieces with most known text; delimiters inside known values are thereby protected.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import present
from ..sources.tables import checkpointed

#: Characters that part values; a slash does only between blanks.
DELIMITERS = ";,|\t\r\n"
_BLANKS = " \u00a0\u2007\u202f\u200b\ufeff\t\r\n"
_MARK = re.compile(r"^(?:[-*•–]\s+|•|\(?(?:\d{1,2}|[ivx]{1,5}|[a-z])\)\s+|\d{1,2}\.\s+)")
_PLAIN = re.compile(r"[;,|\t\r\n\"'•\[\]/*()]|^\s*[-–]|\d[.)]\s")
_DIGIT = re.compile(r"\d")


def shape(value: str) -> str:
    """Lower case, every digit as 0: the form in which values are known. Keeps the length."""
    return _DIGIT.sub("0", value.lower()) if len(value.lower()) == len(value) else _DIGIT.sub("0", value)


def shape_column(c: Column) -> Column:
    """:func:`shape` as an expression."""
    return F.regexp_replace(F.lower(c), r"[0-9]", "0")


def dictionary(cells: DataFrame, field: str, cell: str, support: int = 2, max_entries: int = 100_000) -> DataFrame:
    """(field, shape, n): shapes of whole values with a delimiter inside, seen ``support`` times or more in JSON lists or quotes.

    At most ``max_entries`` + 1 a field, most frequent first: one too many tells the caller that there are more. A shape may be of any
    length. Shapes mask digits, so the count follows the vocabulary, not the rows.
    """
    c = F.col(cell)
    listed = F.from_json(F.when(F.trim(c).startswith("["), c), "array<string>", {"mode": "PERMISSIVE"})
    quoted = F.transform(
        F.when(~F.trim(c).startswith("["), F.regexp_extract_all(c, F.lit(r'(?:^|[;,|\t\r\n])[ ]*"((?:[^"]|"")+)"[ ]*(?=$|[;,|\t\r\n])'), F.lit(1))),
        lambda x: F.replace(x, F.lit('""'), F.lit('"')),
    )
    items = cells.select(F.col(field), F.explode(F.concat(F.coalesce(listed, F.array().cast("array<string>")), F.coalesce(quoted, F.array().cast("array<string>")))).alias("__v"))
    known = items.select(field, shape_column(F.trim("__v")).alias("shape")).where(F.col("shape").rlike(r"[;,|\t\r\n]| / "))
    known = known.groupBy(field, "shape").agg(F.count("*").alias("n")).where(F.col("n") >= support)
    w = W.partitionBy(field).orderBy(F.desc("n"), "shape")
    return known.withColumn("__at", F.row_number().over(w)).where(F.col("__at") <= max_entries + 1).drop("__at")


class Splitter:
    """Splits cells of one field, given the shapes of its known values."""

    def __init__(self, shapes: Iterable[str]):
        import ahocorasick

        self.known = ahocorasick.Automaton()
        for s in shapes:
            self.known.add_word(s, len(s))
        if len(self.known):
            self.known.make_automaton()

    def __call__(self, cell: str) -> list[str]:
        """The values of a cell in order, without blanks around, list marks, enclosing quotes and escapes; no empty ones."""
        s = cell.strip(_BLANKS)
        if not _PLAIN.search(s):
            return [s] if s else []
        if s[:1] == "[" and s[-1:] == "]" and (items := self._listed(s)) is not None:
            return items
        atoms = self._atoms(s)
        spans = self._cover(s, atoms)
        out = []
        for i, j in spans:
            text, quoted = (atoms[i][2], atoms[i][3]) if i == j else (s[atoms[i][0] : atoms[j][1]], False)
            text = text.strip(_BLANKS)
            if not quoted:
                text = _MARK.sub("", text).strip(_BLANKS)
                if len(text) > 1 and text[0] == text[-1] == '"' and '"' not in text[1:-1].replace('""', ""):
                    text = text[1:-1].replace('""', '"').strip(_BLANKS)
            if text:
                out.append(text)
        return out

    @staticmethod
    def _listed(s: str) -> list[str] | None:
        """A JSON list, or one in single quotes; None if it is neither."""
        try:
            items = json.loads(s)
        except ValueError:
            pieces = re.findall(r"""\s*(?:'((?:[^'\\]|\\.)*)'|"((?:[^"\\]|\\.)*)")\s*(?:,|$)""", s[1:-1])
            if not pieces or re.sub(r"""\s*(?:'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")\s*(?:,|$)""", "", s[1:-1]).strip():
                return None
            items = [re.sub(r"\\(.)", r"\1", a or b) for a, b in pieces]
        return [x for x in (str(i).strip(_BLANKS) for i in items if i is not None) if x]

    @staticmethod
    def _atoms(s: str) -> list[tuple[int, int, str, bool]]:
        """(start, end, text, quoted) of the pieces between possible delimiters."""
        cuts = {m.start(): m.end() for m in re.finditer(r"[;,|\t\r\n]|(?<=\s)/(?=\s)", s)}
        if s[:1] == "•":
            cuts |= {m.start(): m.start() for m in re.finditer(r"(?<=\s)•", s)}
        elif m := re.match(r"(\(?)(1|i|a)([.)])\s", s):  # 1) one 2) two: the marks count up
            at, n = m.end(), 2
            roman = ["", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x", "xi", "xii", "xiii", "xiv", "xv"]
            while True:
                label = str(n) if m[2] == "1" else (roman[n] if m[2] == "i" and n < len(roman) else chr(96 + n) if n < 27 else "\0")
                if not (x := re.compile(rf"\s(?={re.escape(m[1] + label + m[3])}\s)").search(s, at)):
                    break
                cuts.setdefault(x.start(), x.end())
                at, n = x.end(), n + 1
        out, start, i = [], 0, 0
        while i <= len(s):
            if i == start or not s[start:i].strip(_BLANKS):
                if i < len(s) and s[i] in "\"'":
                    q = s[i]
                    if m := re.compile(rf"{q}((?:[^{q}]|{q}{q})*){q}(?!{q})").match(s, i):
                        after = m.end()
                        while after < len(s) and s[after] in " \u00a0" and after not in cuts:
                            after += 1
                        if after == len(s) or after in cuts:
                            out.append((start, after, m[1].replace(q + q, q), True))
                            start = i = cuts.get(after, after + 1)
                            if after == len(s):
                                return out
                            continue
            if i == len(s) or i in cuts:
                out.append((start, i, s[start:i], False))
                if i == len(s):
                    return out
                start = cuts[i]
                i = max(start, i + 1)
                continue
            i += 1
        return out

    def _cover(self, s: str, atoms: list[tuple[int, int, str, bool]]) -> list[tuple[int, int]]:
        """The cover of the atoms with most known text, then with most values: (first, last) atom of each value."""
        n = len(atoms)
        if n == 1 or not len(self.known):
            return [(i, i) for i in range(n)]
        starts, ends = {}, {}
        for k, (a, b, _, quoted) in enumerate(atoms):
            if not quoted:
                piece = s[a:b]
                lead = len(piece) - len(piece.lstrip(_BLANKS))
                if m := _MARK.match(piece[lead:]):
                    lead += m.end()
                starts[a + lead] = k
                ends[a + len(piece.rstrip(_BLANKS))] = k
        merges: dict[int, list[tuple[int, int]]] = {}
        for end, size in self.known.iter(shape(s)):
            i, j = starts.get(end + 1 - size), ends.get(end + 1)
            if i is not None and j is not None and i < j and not any(atoms[k][3] for k in range(i, j + 1)):
                merges.setdefault(j, []).append((i, size))
        best: list[tuple[int, int, int]] = [(0, 0, -1)]  # known text, values, first atom of the last value
        for j in range(n):
            options = [(best[j][0], best[j][1] + 1, j)]
            options += [(best[i][0] + size, best[i][1] + 1, i) for i, size in merges.get(j, [])]
            best.append(max(options, key=lambda o: o[:2]))
        out, j = [], n
        while j:
            i = best[j][2]
            out.append((i, j - 1))
            j = i
        return out[::-1]


def split_fields(cells: DataFrame, field: str = "field_name", key: str = "row_key", cell: str = "cell", support: int = 2, max_entries: int = 100_000) -> DataFrame:
    """(field_name, row_key, pos_no, item_value): one row per value of each cell, positions from 1.

    Cells that are NULL, blank or a no-data marker give no rows; a single value gives one. Empty pieces take no position.
    Rows delivered again count once. A cell that looks like a list but can't be read as one is split at its delimiters.
    Very long cells are processed whole (time grows with their length). Values known from elsewhere are kept whole although
    they hold delimiters. Other columns are left out, so their names cannot clash.

    A field of more than ``max_entries`` such shapes raises ValueError, since a value left out would be split at its inner delimiters.
    """
    c = cells.where(present(cell) & F.col(key).isNotNull()).select(F.col(field).alias("field_name"), F.col(key).cast("string").alias("row_key"), F.col(cell).alias("cell")).distinct()
    c = checkpointed(c)  # read twice, for the dictionary and for the split
    learned: dict[str, list[str]] = {}
    for r in dictionary(c, "field_name", "cell", support, max_entries).select("field_name", "shape").collect():  # bounded by max_entries
        learned.setdefault(r[0], []).append(r[1])
    if over := sorted(f for f, shapes in learned.items() if len(shapes) > max_entries):
        raise ValueError(f"more than {max_entries} known values with delimiters inside in {', '.join(over)}: allow more")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        splitters: dict[str, Splitter] = {}
        for b in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for f, k, v in zip(b["field_name"], b["row_key"], b["cell"]):
                if f not in splitters:
                    splitters[f] = Splitter(learned.get(f, []))
                for n, x in enumerate(splitters[f](v), 1):
                    out[0].append(f), out[1].append(k), out[2].append(n), out[3].append(x)
            yield pd.DataFrame({"field_name": out[0], "row_key": out[1], "pos_no": pd.array(out[2], "int32"), "item_value": out[3]})

    return c.mapInPandas(run, "field_name string, row_key string, pos_no int, item_value string")


def packed_cells(tables: Sequence[tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """(field_name, row_key, cell) of several columns: (table, key column, columns) each; a table is read once."""
    out = None
    for df, key, columns in tables:
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(f"`{c}`").alias("cell")) for c in columns]))
        long = df.select(F.col(f"`{key}`").cast("string").alias("row_key"), pairs.alias("__p")).select("__p.field_name", "row_key", "__p.cell")
        out = long if out is None else out.unionAll(long)
    return out
