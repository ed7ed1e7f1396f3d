"""String helpers with Python ``str`` semantics, as native Spark expressions.

Java regexes need ``(?U)`` to treat non-ASCII letters and whitespace the way
Python's ``re``/``str`` do; Spark's ``trim`` only removes spaces, so Python's
``strip()`` is expressed with a Unicode-whitespace regex instead.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Every code point Python's ``str.strip()`` removes (``str.isspace``), derived by rule.
PY_WHITESPACE = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(col) -> Column:
    """``str.strip()``: drop leading/trailing whitespace (Python's exact set)."""
    return F.btrim(_c(col), F.lit(PY_WHITESPACE))


def collapse_ws(col) -> Column:
    """``re.sub(r'\\s+', ' ', s.strip())``: strip, then every whitespace run -> one space."""
    return F.regexp_replace(py_strip(col), r"(?U)\s+", " ")


def blank_to_null(col) -> Column:
    """Python truthiness for strings: '' behaves like None."""
    c = _c(col)
    return F.when(c == "", F.lit(None)).otherwise(c)


def py_or(*cols) -> Column:
    """``a or b or c`` for string columns: first non-null, non-empty value."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def is_blank(col) -> Column:
    """``not s or not s.strip()``."""
    c = _c(col)
    return c.isNull() | (py_strip(c) == "")


def contains_any(col, terms) -> Column:
    """Literal substring test against a list of terms (no word boundaries)."""
    c = _c(col)
    out = F.lit(False)
    for t in terms:
        out = out | F.contains(c, F.lit(t))
    return out


def word_boundary_any(col, terms) -> Column:
    """Whole-word variant of :func:`contains_any` (opt-in)."""
    import re as _re
    pat = r"(?U)\b(?:" + "|".join(_re.escape(t) for t in terms) + r")\b"
    return _c(col).rlike(pat)
