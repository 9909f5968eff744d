"""Page composition: which reading of a place survives, and in what order it is read.

Every spatial join meets on (doc_id, page) first and keeps the overlap test as a residual.

Cases: boxes without area overlap nothing; rows with a null box or key meet nothing and stay as they are; equal
overlaps go to the first region or table; repeated rows are segments of their own; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g

PAGE = ["doc_id", "pg"]


def _renamed(df: DataFrame, prefix: str, *keep: str) -> DataFrame:
    return df.select(*PAGE, *(F.col(c).alias(f"{prefix}{c}") for c in ("x0", "y0", "x1", "y1", *keep)))


def superseded(detected: DataFrame, layer: DataFrame, least: float = 0.5) -> DataFrame:
    """Detected segments that a clean text-layer segment covers."""
    clean = _renamed(layer.filter("not contaminated"), "l_")
    close = g.iou(g.box(), g.box("l_")) >= least
    return detected.join(clean, [detected["doc_id"] == clean["doc_id"], detected["pg"] == clean["pg"], close], "left_semi")


def kept(detected: DataFrame, layer: DataFrame, least: float = 0.5) -> DataFrame:
    clean = _renamed(layer.filter("not contaminated"), "l_")
    close = g.iou(g.box(), g.box("l_")) >= least
    return detected.join(clean, [detected["doc_id"] == clean["doc_id"], detected["pg"] == clean["pg"], close], "left_anti")


def contaminated_superseded(detected: DataFrame, layer: DataFrame, least: float = 0.5) -> DataFrame:
    """Contaminated text-layer segments that a kept detection covers."""
    dirty, found = layer.filter("contaminated"), _renamed(kept(detected, layer, least), "o_")
    close = g.iou(g.box(), g.box("o_")) >= least
    return dirty.join(found, [dirty["doc_id"] == found["doc_id"], dirty["pg"] == found["pg"], close], "left_semi")


def region_coverage(regions: DataFrame, layer: DataFrame) -> DataFrame:
    """Share of each region that clean segments cover, overlaps counted twice, at most 1; and its source."""
    clean = _renamed(layer.filter("not contaminated"), "l_")
    common = g.intersection(g.box(), g.box("l_"))
    met = regions.join(clean, PAGE, "left").groupBy(*PAGE, "rix", "kind").agg((F.coalesce(F.sum(common), F.lit(0.0)) / F.first(g.area(g.box()))).alias("share"))
    share = F.least("share", F.lit(1.0))
    return met.select(*PAGE, "rix", "kind", share.alias("coverage"), F.when(share >= 0.5, "textlayer").otherwise("ocr").alias("region_source"))


def composed(detected: DataFrame, layer: DataFrame, regions: DataFrame, machine: float = 0.5) -> DataFrame:
    """``detected`` with ``superseded``: a clean text-layer segment covers it, or it is centred in a region of which
    clean text covers ``machine`` or more.  Nothing is dropped; segments without a page in ``regions`` are judged by
    overlap alone."""
    covered = superseded(detected, layer).select(*PAGE, "ix")
    share = region_coverage(regions, layer).filter(F.col("coverage") >= machine).select(*PAGE, "rix")
    exact = _renamed(regions.join(share, [*PAGE, "rix"], "left_semi"), "r_")
    inside = g.contains_center(g.box("r_"), g.box())
    held = detected.join(exact, [detected["doc_id"] == exact["doc_id"], detected["pg"] == exact["pg"], inside], "left_semi").select(*PAGE, "ix")
    marked = covered.union(held).distinct().withColumn("superseded", F.lit(True))
    return detected.join(marked, [*PAGE, "ix"], "left").withColumn("superseded", F.coalesce("superseded", F.lit(False)))


def first_region(segments: DataFrame, regions: DataFrame) -> DataFrame:
    """Each segment with the first region, by position, that holds its centre; -1 if none does."""
    r = _renamed(regions, "r_", "rix")
    held = segments.join(r, PAGE).filter(g.contains_center(g.box("r_"), g.box()))
    first = held.groupBy(*PAGE, "ix").agg(F.min("r_rix").alias("region"))
    return segments.join(first, [*PAGE, "ix"], "left").withColumn("region", F.coalesce("region", F.lit(-1)))


def reading_order(placed: DataFrame) -> DataFrame:
    """Rank of each segment on its page: region, height band, x, then position."""
    key = F.when(F.col("region") < 0, 1_000_000).otherwise(F.col("region"))
    order = Window.partitionBy(*PAGE).orderBy(key, g.band(F.col("y0")), "x0", "ix")
    return placed.withColumn("rank", F.row_number().over(order) - 1)


def page_text(ordered: DataFrame, text: str = "det_text") -> DataFrame:
    turn = F.struct("rank", F.col(text).alias("t"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(turn)), lambda x: x["t"]), "\n")
    return ordered.groupBy(*PAGE).agg(joined.alias("page_text"), F.count("*").alias("n_lines"))


def cell_confidence(cells: DataFrame, segments: DataFrame) -> DataFrame:
    """Per cell the text of the segments centred in it and whether it is empty, clean or spanning."""
    s = _renamed(segments, "s_", "ix", "det_text")
    common, own = g.intersection(g.box("s_"), g.box()), F.greatest(g.area(g.box("s_")), F.lit(1.0))
    met = cells.join(s, PAGE, "left").withColumn("touch", common >= 0.1 * own).withColumn("inside", common / own)
    word = F.when(g.contains_center(g.box(), g.box("s_")), F.struct(g.band(F.col("s_y0")).alias("b"), "s_x0", "s_ix", F.col("s_det_text").alias("t")))
    found = met.groupBy(*PAGE, "rix").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(word)), lambda x: x["t"]), " ").alias("cell_text"),
        F.count_if("touch").alias("touching"),
        F.min(F.when(F.col("touch"), F.col("inside"))).alias("least"),
    )
    state = F.when(F.col("touching") == 0, "empty").when(F.col("least") < 0.7, "spanning").otherwise("clean")
    return found.select(*PAGE, "rix", F.trim("cell_text").alias("cell_text"), "touching", state.alias("confidence"))


def best_table(regions: DataFrame, tables: DataFrame, least: float = 0.30) -> DataFrame:
    """For each region the found table with the largest overlap fraction above ``least``, the first of equals, if its
    markup (column ``html``) has a cell at all."""
    t = _renamed(tables, "t_", "tix", "html")
    share = g.overlap_fraction(g.box(), g.box("t_"))
    met = regions.join(t, PAGE).withColumn("share", share).filter(F.col("share") > least)
    rank = F.row_number().over(Window.partitionBy(*PAGE, "rix").orderBy(F.desc("share"), "t_tix"))
    return met.withColumn("n", rank).filter("n = 1 and contains(t_html, '<td')").select(*PAGE, "rix", F.col("t_tix").alias("tix"), "share")
