"""What a page becomes: overlay rows, Markdown, the segment index.

``segments`` have doc_id, pg, ix, box, best_text, source, superseded and a reading rank; pages have their reading.

Cases: null best_text is empty and written nowhere; a page without text adds nothing to its document; a document
without any gets the placeholder; equal ranks keep list order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions.text import table_markup
from .tables import confidence_tally

PAGE = ["doc_id", "pg"]
PLACEHOLDER = "_(no text extracted yet)_\n"
NOTE = "> _Some pages were transcribed by a model and may hold its inferences; the segment index is the record._\n\n"


def best_text(segments: DataFrame) -> DataFrame:
    """The reading, else the detection, of segments that have no best text and are not superseded."""
    open_ = ~F.col("superseded") & (F.coalesce("best_text", F.lit("")) == "")
    read = F.coalesce(F.nullif("vlm_text", F.lit("")), F.nullif("det_text", F.lit("")), F.lit(""))
    fused = open_ & F.col("source").isin("paddle", "vision") & (F.coalesce("vlm_text", F.lit("")) != "")
    return segments.withColumns({"source": F.when(fused, "fused").otherwise(F.col("source")), "best_text": F.when(open_, read).otherwise(F.coalesce("best_text", F.lit("")))})


def visible(segments: DataFrame) -> DataFrame:
    return segments.filter("not superseded and coalesce(best_text, '') <> ''")


def font_size(text: Column, width: Column, height: Column, unit: float = 0.5) -> Column:
    """Size at which a text fills its width, from 1 to its height; a character is ``unit`` wide at size 1."""
    return F.greatest(F.lit(1.0), F.least(height, F.greatest(width, F.lit(1.0)) / (F.greatest(F.length(text), F.lit(1)) * unit)))


def overlay_rows(segments: DataFrame, words: bool = False) -> DataFrame:
    """(doc_id, pg, ix, word, text, x, y, width, size) of the text to lay over a page; text-layer text is there already."""
    kept = visible(segments).filter("source <> 'textlayer'")
    span = F.col("x1") - F.col("x0")
    if not words:
        cut = kept.select(*PAGE, "ix", F.lit(0).alias("word"), F.col("best_text").alias("text"), F.col("x0").alias("x"), F.col("y1").alias("y"), span.alias("width"), (F.col("y1") - F.col("y0")).alias("h"))
    else:
        said = kept.withColumn("ws", F.regexp_extract_all("best_text", F.lit(r"(?U)\S+"), 0)).filter("size(ws) > 0")
        cut = said.select(*PAGE, "ix", "x0", "y1", (F.col("y1") - F.col("y0")).alias("h"), (span / F.size("ws")).alias("width"), F.posexplode("ws").alias("word", "text"))
        cut = cut.select(*PAGE, "ix", "word", "text", (F.col("x0") + F.col("word") * F.col("width")).alias("x"), F.col("y1").alias("y"), "width", "h")
    return cut.select(*PAGE, "ix", "word", "text", "x", "y", "width", font_size(F.col("text"), F.col("width"), F.col("h")).alias("size"))


def overlay_totals(segments: DataFrame) -> DataFrame:
    """Per page of the rows of ``overlay_rows`` by words: sums of places and of left edges, the greatest width and the
    last text.  Each segment's words are summed up in its row, so that only segments are sorted and shuffled."""
    kept = visible(segments).filter("source <> 'textlayer'")
    said = kept.select(*PAGE, "x0", "x1", F.regexp_extract_all("best_text", F.lit(r"(?U)\S+"), 0).alias("ws")).filter("size(ws) > 0")
    said = said.withColumns({"n": F.size("ws").cast("long"), "width": (F.col("x1") - F.col("x0")) / F.size("ws")})
    edges = F.transform("ws", lambda w, k: F.col("x0") + k * F.col("width"))
    one = said.select(*PAGE, F.expr("n * (n - 1) div 2").alias("word"), F.aggregate(edges, F.lit(0.0), lambda acc, x: acc + x).alias("x"), "width", F.array_max("ws").alias("text"))
    return one.groupBy(*PAGE).agg(F.sum("word").alias("words"), F.sum("x").alias("x"), F.max("width").alias("widest"), F.max("text").alias("last"))


def loose(segments: DataFrame, tables: DataFrame) -> DataFrame:
    """Visible segments whose centre lies in no table region."""
    t = tables.select(*PAGE, *(F.col(c).alias(f"t_{c}") for c in ("x0", "y0", "x1", "y1")))
    return visible(segments).join(t, [segments["doc_id"] == t["doc_id"], segments["pg"] == t["pg"], g.contains_center(g.box("t_"), g.box())], "left_anti")


def page_markdown(segments: DataFrame, readings: DataFrame, tables: DataFrame) -> DataFrame:
    """(doc_id, pg, body).  A page with a table that was read by itself, or without a reading, is put together from
    blocks: each table at its region's place, the lines outside tables around it.  Any other page is its reading, or
    its lines.  ``tables``: doc_id, pg, rix, box, rank, table_html, table_vlm; segments: region_rank, rank."""
    tables = tables.filter("coalesce(table_vlm, '') <> '' or contains(coalesce(table_html, ''), '<table')")
    by_page = tables.groupBy(*PAGE).agg(F.bool_or(F.coalesce("table_vlm", F.lit("")) != "").alias("own"))
    read = readings.select(*PAGE, F.trim(F.coalesce("reading", F.lit(""))).alias("reading"))
    pages = read.join(by_page, PAGE, "left").withColumn("blocks", F.col("own").isNotNull() & (F.col("own") | (F.col("reading") == "")))
    block_pages = pages.filter("blocks").select(*PAGE)
    grid = tables.join(block_pages, PAGE).select(*PAGE, F.struct(F.col("rank").cast("int").alias("a"), F.lit(0).alias("b"), F.col("rix").cast("int").alias("c"), F.coalesce(F.nullif("table_vlm", F.lit("")), table_markup(F.col("table_html"))).alias("t")).alias("x"))
    line = lambda d: d.select(*PAGE, F.struct(F.col("region_rank").cast("int").alias("a"), F.lit(1).alias("b"), F.col("rank").cast("int").alias("c"), F.col("best_text").alias("t")).alias("x"))
    text = lambda sep: F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), sep)
    whole = grid.unionByName(line(loose(segments, tables).join(block_pages, PAGE))).groupBy(*PAGE).agg(text("\n\n").alias("made"))
    flat = line(visible(segments).join(pages.filter("not blocks and reading = ''").select(*PAGE), PAGE)).groupBy(*PAGE).agg(text("\n").alias("made"))
    met = pages.join(whole.unionByName(flat), PAGE, "left")
    return met.select(*PAGE, F.coalesce("made", F.when(F.col("blocks"), "").otherwise(F.col("reading"))).alias("body"))


def document_markdown(bodies: DataFrame, models: DataFrame) -> DataFrame:
    """(doc_id, markdown): the pages' bodies, under a note if a model read any page."""
    turn = F.array_sort(F.collect_list(F.when(F.col("body") != "", F.struct("pg", "body"))))
    text = F.array_join(F.transform(turn, lambda x: x["body"]), "\n\n")
    told = bodies.groupBy("doc_id").agg(F.when(F.count_if(F.col("body") != "") > 0, text).otherwise(F.lit(PLACEHOLDER)).alias("body"))
    noted = models.groupBy("doc_id").agg(F.bool_or(~F.coalesce("model", F.lit("")).isin("", "apple_vision")).alias("noted"))
    return told.join(noted, "doc_id", "left").select("doc_id", F.concat(F.when(F.col("noted"), NOTE).otherwise(""), F.col("body")).alias("markdown"))


def segment_index(regions: DataFrame, segments: DataFrame) -> DataFrame:
    """(doc_id, json): pages with their regions, and flat segments; table regions alone have the table's fields."""
    table = F.col("kind") == "table"
    only = lambda c: F.when(table, c)
    region = F.struct("rix", "kind", F.col("rank").alias("reading_order"), F.array("x0", "y0", "x1", "y1").alias("bbox"), only(F.col("table_html")).alias("table_html"), only(confidence_tally(F.col("table_html"))).alias("cell_confidence"))
    paged = regions.groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct(F.col("rix").alias("k"), F.to_json(region).alias("r")))).alias("rs"))
    pages = paged.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pg", F.concat(F.lit("["), F.array_join(F.transform("rs", lambda x: x["r"]), ","), F.lit("]")).alias("r")))).alias("ps"))
    one = F.to_json(F.struct(F.col("pg").alias("page"), "ix", "best_text", "source", "superseded", F.array("x0", "y0", "x1", "y1").alias("bbox")))
    flat = segments.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pg", "ix", one.alias("s")))).alias("ss"))
    met = pages.join(flat, "doc_id", "full")
    page = lambda p: F.concat(F.lit('{"index":'), p["pg"].cast("string"), F.lit(',"regions":'), p["r"], F.lit("}"))
    listed = lambda xs: F.concat(F.lit("["), F.coalesce(F.array_join(xs, ","), F.lit("")), F.lit("]"))
    return met.select("doc_id", F.concat(F.lit('{"pages":'), listed(F.transform("ps", page)), F.lit(',"segments":'), listed(F.transform("ss", lambda x: x["s"])), F.lit("}")).alias("json"))
