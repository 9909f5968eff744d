"""Placement: whether words land on their own line."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as g
from ..functions.metrics import words_of

PAGE = ["doc_id", "pg"]


def _lines(truth: DataFrame) -> DataFrame:
    return truth.select(*PAGE, F.col("ix").alias("line"), *(F.col(c).alias(f"g_{c}") for c in ("x0", "y0", "x1", "y1")))


def strict(segments: DataFrame, truth: DataFrame, least: float = 0.3) -> DataFrame:
    """Each segment on the line of largest overlap, the last of equals."""
    met = segments.join(_lines(truth), PAGE).withColumn("iou", g.iou(g.box(), g.box("g_"))).filter(F.col("iou") >= least)
    rank = F.row_number().over(Window.partitionBy(*PAGE, "ix").orderBy(F.desc("iou"), F.desc("line")))
    return met.withColumn("n", rank).filter("n = 1").select(*PAGE, "ix", "line", "det_text")


def band(segments: DataFrame, truth: DataFrame) -> DataFrame:
    """Each segment on every line it covers."""
    return segments.join(_lines(truth), PAGE).filter(g.covers_line(g.box(), g.box("g_"))).select(*PAGE, "ix", "line", "det_text")


@F.pandas_udf(T.StructType([T.StructField(n, T.LongType()) for n in ("placed", "plain", "total")]))
def _page_counts(lines: pd.Series, texts: pd.Series, held: pd.Series, said: pd.Series, heard: pd.Series) -> pd.DataFrame:
    out = []
    for ls, ts, hs, ss, det in zip(lines, texts, held, said, heard):
        own: dict[int, set[str]] = {}
        for line, text in zip(*((hs, ss) if hs is not None else ((), ()))):
            own.setdefault(line, set()).update(words_of(text))
        known = {w for text in (det if det is not None else ()) for w in words_of(text)}
        placed = plain = total = 0
        for line, text in zip(ls, ts):
            words, mine = words_of(text), own.get(line, ())
            placed += sum(w in mine for w in words)
            plain += sum(w in known for w in words)
            total += len(words)
        out.append((placed, plain, total))
    return pd.DataFrame(out, columns=["placed", "plain", "total"])


def counts(matched: DataFrame, segments: DataFrame, truth: DataFrame) -> DataFrame:
    """Per page with words: truth words found on their own line, anywhere on the page, and in all.  A page's lines meet
    in one row, so that texts and not their words are shuffled."""
    both = lambda a, b: (F.transform("xs", lambda x: x["a"]).alias(a), F.transform("xs", lambda x: x["b"]).alias(b))
    paired = lambda df, a, b: df.groupBy(*PAGE).agg(F.collect_list(F.struct(F.col(a).alias("a"), F.coalesce(b, F.lit("")).alias("b"))).alias("xs"))
    lines = paired(truth, "ix", "t").select(*PAGE, *both("lines", "texts"))
    own = paired(matched, "line", "det_text").select(*PAGE, *both("held", "said"))
    heard = segments.groupBy(*PAGE).agg(F.collect_list("det_text").alias("heard"))
    met = lines.join(own, PAGE, "left").join(heard, PAGE, "left")
    return met.select(*PAGE, _page_counts("lines", "texts", "held", "said", "heard").alias("n")).select(*PAGE, "n.*").filter("total > 0")


def summary(counted: DataFrame) -> DataFrame:
    total = F.greatest(F.sum("total"), F.lit(1)).cast("double")
    return counted.agg((F.sum("placed") / total).alias("placement_recall"), (F.sum("plain") / total).alias("plain_recall"), ((F.sum("plain") - F.sum("placed")) / total).alias("gap"))
