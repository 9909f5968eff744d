"""Text scalars as Column expressions.

Cases: null in, null out, but for ``script`` (latin) and ``safe_filename`` (the default name); an empty text has no
tokens, no lines and no private characters and is clean.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ZERO_WIDTH = r"[\x{200B}-\x{200D}\x{FEFF}]"
PRIVATE = r"\x{E000}-\x{F8FF}"
#: Characters that are words of their own.
IDEOGRAPHS = r"\x{3040}-\x{30FF}\x{FF66}-\x{FF9F}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{AC00}-\x{D7AF}"
SCRIPTS = {
    "thai": r"\x{0E00}-\x{0E7F}",
    "cyrillic": r"\x{0400}-\x{04FF}",
    "arabic": r"\x{0600}-\x{06FF}",
    "devanagari": r"\x{0900}-\x{097F}",
    "cjk": r"\x{3040}-\x{30FF}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7AF}",
}
_SPANS = {k: [(int(a, 16), int(b, 16)) for a, b in re.findall(r"\\x\{(\w+)\}-\\x\{(\w+)\}", r)] for k, r in SCRIPTS.items()}
_FIRST, _LATIN = min(a for spans in _SPANS.values() for a, _ in spans), [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F)]
CONFUSED = ("oil", "01l")


def strip_zero_width(s: Column) -> Column:
    return F.regexp_replace(s, ZERO_WIDTH, "")


def count_in(s: Column, ranges: str) -> Column:
    """Characters of the ranges; what lies between them is taken out run by run, as each match costs far more than a character."""
    return F.length(F.regexp_replace(s, f"[^{ranges}]+", ""))


def private_use(s: Column) -> Column:
    return count_in(s, PRIVATE)


def non_space(s: Column) -> Column:
    return F.length(F.regexp_replace(s, r"(?U)\s+", ""))


def is_clean(s: Column, share: float = 0.01) -> Column:
    return F.when(non_space(s) > 0, private_use(s) / non_space(s) <= share).otherwise(F.lit(True))


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


@F.pandas_udf(T.StringType())
def full_casefold(s: pd.Series) -> pd.Series:
    return s.map(str.casefold, na_action="ignore")


def collapse(s: Column) -> Column:
    return F.trim(F.regexp_replace(s, r"(?U)\s+", " "))


def normalize(s: Column) -> Column:
    """NFC, single spaces.  Columns of ASCII alone can use ``collapse`` and stay in the JVM."""
    return collapse(nfc(s))


def casefold(s: Column) -> Column:
    """Case folding for Latin text: lower case and sharp s."""
    return F.replace(F.lower(s), F.lit("ß"), F.lit("ss"))


def tokens(s: Column) -> Column:
    """Words by white space; each ideograph is a word."""
    return F.regexp_extract_all(s, F.lit(f"[{IDEOGRAPHS}]|[^\\s{IDEOGRAPHS}]+"), 0)


def _within(points: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    return np.logical_or.reduce([(points >= a) & (points <= b) for a, b in spans])


def script_of(text: str | None, least: float = 0.10) -> str:
    if text is None or text.isascii():
        return "latin"
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    held = {name: _within(points, spans) for name, spans in _SPANS.items()} if points.max() >= _FIRST else {}
    # Most letters first, then the earliest place.
    told = sorted((-int(np.count_nonzero(x)), int(x.argmax()), name) for name, x in held.items() if x.any())
    total = int(np.count_nonzero(_within(points, _LATIN))) - sum(n for n, _, _ in told)
    return told[0][2] if told and -told[0][0] >= least * total else "latin"


def script(s: Column, least: float = 0.10) -> Column:
    """The strongest non-Latin script with at least ``least`` of the letters counted, else latin; ties go to the
    script seen first in the text.  A pattern of several ranges is slow in the JVM (measured ten times one of a single range)."""

    @F.pandas_udf(T.StringType())
    def told(xs: pd.Series) -> pd.Series:
        return pd.Series([script_of(x, least) for x in xs], dtype=object)

    return told(s)


def escape_html(s: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def table_markup(s: Column) -> Column:
    found = F.regexp_extract(s, r"(?s)<table.*</table>", 0)
    return F.when(found == "", s).otherwise(found)


def safe_filename(s: Column, default: str = "upload.pdf") -> Column:
    name = F.regexp_extract(F.coalesce(s, F.lit("")), r"[^/]*$", 0)
    return F.when(name.isin("", ".", ".."), F.lit(default)).otherwise(name)


def lines(s: Column) -> Column:
    """Trimmed lines that are not blank."""
    return F.filter(F.transform(F.split(s, r"\R"), F.trim), lambda x: x != "")


def fill_cells(html: Column, cells: Column) -> Column:
    """Put the nth of ``cells`` (struct text, confidence) into the nth empty <td>; further ones stay empty."""
    parts = F.split(html, r"<td[^>]*></td>", -1)
    tags = F.regexp_extract_all(html, F.lit(r"<td[^>]*></td>"), 0)

    def filled(tag: Column, i: Column) -> Column:
        cell = F.get(cells, i)
        made = F.concat(F.lit('<td data-confidence="'), cell["confidence"], F.lit('">'), escape_html(cell["text"]), F.lit("</td>"))
        return F.concat(F.get(parts, i), F.when(cell.isNull(), tag).otherwise(made))

    return F.concat(F.array_join(F.transform(tags, filled), ""), F.element_at(parts, -1))

