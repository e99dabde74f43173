"""Column functions on text: no-data markers, blanks, folding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The no-data markers of the tables, compared trimmed and in lower case.
NO_DATA = ("", "n.a.", "na", "n/a", "not reported", "unknown", "not available")

#: Blank characters that count as outer blanks: Java's \\s does not hold the no-break spaces.
BLANK = r"[\s\u00a0\u2007\u202f\u200b\ufeff]"


def squeeze(c: Column | str) -> Column:
    """The text without outer blanks (no-break spaces included); NULL stays NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, rf"^{BLANK}+|{BLANK}+$", "")


def present(c: Column | str) -> Column:
    """TRUE if the value is neither NULL nor blank nor a no-data marker; never NULL."""
    s = F.lower(squeeze(c))
    return F.coalesce(~s.isin(*NO_DATA), F.lit(False))


def known(c: Column | str) -> Column:
    """The value, or NULL where it is missing."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(present(c), c)


#: Accented letters and their plain forms, position by position.
_ACCENTED = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿ"
_PLAIN = "aaaaaaceeeeiiiinoooooouuuuyy"


def fold(c: Column | str) -> Column:
    """Lower case without accents (Latin letters), ß as ss."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.translate(F.lower(c), _ACCENTED, _PLAIN), "ß", "ss")


#: Raised and lowered digits and their plain forms.
_RAISED = "⁰¹²³⁴⁵⁶⁷⁸⁹₀₁₂₃₄₅₆₇₈₉"
_DIGITS = "01234567890123456789"


def plain_digits(c: Column) -> Column:
    """Superscript and subscript digits as plain digits."""
    return F.translate(c, _RAISED, _DIGITS)
