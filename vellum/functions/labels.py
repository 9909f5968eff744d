"""Small lookups and reports: layout kinds, probe answers, prompts, text audits, page scaling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layout labels by kind, and the answers of a script probe.
KINDS = {
    "table": ["table"],
    "figure": ["figure", "image", "chart", "seal"],
    "header": ["header", "doc_title", "title", "paragraph_title", "figure_title", "table_title", "abstract_title", "content_title"],
    "footer": ["footer", "number", "footnote"],
    "paragraph": ["text", "abstract", "content", "reference", "formula"],
}
ANSWERS = {"latin": ["latin"], "thai": ["thai"], "cyrillic": ["cyrillic"], "arabic": ["arabic"], "cjk": ["cjk", "chinese", "japanese", "korean", "han"], "devanagari": ["devanagari", "hindi"]}


def _map(groups: dict[str, list[str]]) -> Column:
    return F.create_map(*(F.lit(x) for value, keys in groups.items() for k in keys for x in (k, value)))


def kind(label: Column) -> Column:
    """Region kind of a layout label, ``other`` if unknown or null."""
    return F.coalesce(F.element_at(_map(KINDS), F.lower(label)), F.lit("other"))


def probe_script(answer: Column) -> Column:
    """The first word of an answer that names a script; empty if none does."""
    words = F.split(F.lower(F.regexp_replace(F.coalesce(answer, F.lit("")), "[.,]", " ")), r"\s+")
    known = F.filter(F.transform(words, lambda w: F.element_at(_map(ANSWERS), w)), lambda s: s.isNotNull())
    return F.coalesce(F.get(known, F.lit(0)), F.lit(""))


def prompt(model: Column, table: bool = False) -> Column:
    """Name of the prompt a model is asked with."""
    return F.when(F.contains(F.lower(model), F.lit("typhoon")), "specialist").otherwise("table" if table else "transcribe")


def repeated_line_share(text: Column, least: int = 15) -> Column:
    """Share of the lines over ``least`` characters that repeat another."""
    long = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.length(F.trim(x)) > least)
    return F.element_at(F.transform(F.array(long), lambda ls: F.when(F.size(ls) > 0, (F.size(ls) - F.size(F.array_distinct(ls))) / F.size(ls)).otherwise(0.0)), 1)


def strip_markup(text: Column) -> Column:
    """Text without formula delimiters, Markdown marks and rules."""
    bare = F.regexp_replace(text, r"\$+|\\[()\[\]]", " ")
    bare = F.regexp_replace(bare, r"[#*_`|>]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, "-{3,}", " "), r"(?U)\s+", " "))


def suspicion(text: Column) -> Column:
    """Why a reading that people called good may not be: markup, runs of marks, repeated lines, or nothing of the kind."""
    return F.when(F.contains(text, F.lit("\\")) | F.contains(text, F.lit("$")), "formula").when(text.rlike("[|#*]{3,}"), "marks").when(repeated_line_share(text) >= 0.30, "repeats").otherwise("other")


def crop_box(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column, margin: int = 12) -> Column:
    """A box with a margin, within the image."""
    zero = F.lit(0)
    return F.struct(F.greatest(zero, x0 - margin).alias("x0"), F.greatest(zero, y0 - margin).alias("y0"), F.least(width, x1 + margin).alias("x1"), F.least(height, y1 + margin).alias("y1"))


def unit_quad(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """Pixel box, from the top, of a normalised box measured from the bottom left."""
    return F.struct((x * width).alias("x0"), ((1 - y - h) * height).alias("y0"), ((x + w) * width).alias("x1"), ((1 - y) * height).alias("y1"))


def truth_box(box: Column, points: Column) -> Column:
    """A truth's box: its four numbers, or the extent of its polygon; null without either."""
    xs, ys = F.transform(points, lambda p: F.get(p, F.lit(0))), F.transform(points, lambda p: F.get(p, F.lit(1)))
    around = F.when(F.size(points) > 0, F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)))
    return F.when(F.size(box) == 4, box).otherwise(around)
