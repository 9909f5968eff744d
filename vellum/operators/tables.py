"""Table regions: targets, grids, cells and their markup.

Cases: null texts and names are empty; missing cells of a ragged row have no box; a grid without rows is an
empty table; ties of a classifier's scores go to the first name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import escape_html

PAGE = ["doc_id", "pg"]


def layout_targets(pages: DataFrame) -> DataFrame:
    return pages.filter("needs_ocr or has_text_layer")


def table_pages(pages: DataFrame, regions: DataFrame) -> DataFrame:
    """Pages that are not rotated and have a table region."""
    return pages.filter("rotation = 0").join(regions.filter("kind = 'table'").select(*PAGE).distinct(), PAGE, "left_semi")


def crop_targets(pages: DataFrame, regions: DataFrame, least: float = 8.0) -> DataFrame:
    """Unread table regions of scanned, unrotated pages that are large enough to crop."""
    met = regions.filter("kind = 'table' and coalesce(table_vlm, '') = ''").join(pages.filter("needs_ocr and rotation = 0").select(*PAGE), PAGE, "left_semi")
    return met.filter((F.col("x1") - F.col("x0") >= least) & (F.col("y1") - F.col("y0") >= least))


def fillable(regions: DataFrame) -> DataFrame:
    return regions.filter("kind = 'table' and table_html <> '' and size(cells) > 0 and table_engine <> 'find_tables'")


def variant(names: Column, scores: Column) -> Column:
    """wireless if the name with the best score says so, else wired."""
    best = F.element_at(names, F.array_position(scores, F.array_max(scores)).cast("int"))
    return F.when((F.size(names) > 0) & (F.size(scores) > 0) & F.contains(best, F.lit("wireless")), "wireless").otherwise("wired")


def crop_window(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column, dpi: int = 150) -> Column:
    """Pixel window of a region clamped to the image; null if under 8 pixels either way."""
    scale = dpi / 72.0
    px0, py0 = F.greatest(F.lit(0), (x0 * scale).cast("int")), F.greatest(F.lit(0), (y0 * scale).cast("int"))
    px1, py1 = F.least(width, (x1 * scale).cast("int")), F.least(height, (y1 * scale).cast("int"))
    return F.when((px1 - px0 >= 8) & (py1 - py0 >= 8), F.struct(px0.alias("x0"), py0.alias("y0"), px1.alias("x1"), py1.alias("y1")))


def cell_box(quad: Column, ox: Column, oy: Column, dpi: int = 150) -> Column:
    """Page box of a cell given as x, y, x, y, ... in pixels of a crop at (ox, oy)."""
    scale = dpi / 72.0
    xs, ys = F.filter(quad, lambda v, i: i % 2 == 0), F.filter(quad, lambda v, i: i % 2 == 1)
    of = lambda o, v: (o + v) / F.lit(scale)
    return F.struct(of(ox, F.array_min(xs)).alias("x0"), of(oy, F.array_min(ys)).alias("y0"), of(ox, F.array_max(xs)).alias("x1"), of(oy, F.array_max(ys)).alias("y1"))


def grid(rows: Column, boxes: Column, header: Column | None = None) -> Column:
    """array<array<struct<text, box>>>: cells by position, short box rows padded with null, a header with any name first."""
    paired = F.transform(
        rows,
        lambda row, r: F.transform(row, lambda t, k: F.struct(F.coalesce(t, F.lit("")).alias("text"), F.get(F.get(boxes, r), k).alias("box"))),
    )
    if header is None:
        return paired
    nothing = F.get(F.get(boxes, F.lit(0)), F.lit(-1))
    first = F.transform(header, lambda n: F.struct(F.coalesce(n, F.lit("")).alias("text"), nothing.alias("box")))
    named = F.exists(F.coalesce(header, F.array().cast("array<string>")), lambda n: F.trim(F.coalesce(n, F.lit(""))) != "")
    return F.when(named, F.concat(F.array(first), paired)).otherwise(paired)


def grid_html(cells: Column) -> Column:
    """Markup of a grid, each cell clean or empty."""

    def cell(c: Column) -> Column:
        t = F.trim(c["text"])
        return F.concat(F.lit('<td data-confidence="'), F.when(t != "", "clean").otherwise("empty"), F.lit('">'), escape_html(t), F.lit("</td>"))

    rows = F.transform(cells, lambda row: F.concat(F.lit("<tr>"), F.array_join(F.transform(row, cell), ""), F.lit("</tr>")))
    return F.concat(F.lit("<table><tbody>"), F.array_join(rows, ""), F.lit("</tbody></table>"))


def grid_boxes(cells: Column) -> Column:
    return F.filter(F.transform(F.flatten(cells), lambda c: c["box"]), lambda b: b.isNotNull())


def confidence_tally(html: Column) -> Column:
    """map<level, count> of data-confidence attributes."""
    found = F.regexp_extract_all(html, F.lit('data-confidence="(\\w+)"'), 1)
    return F.map_from_arrays(F.array_distinct(found), F.transform(F.array_distinct(found), lambda x: F.size(F.filter(found, lambda y: y == x))))
