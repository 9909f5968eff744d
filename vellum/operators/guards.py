"""Which pages a reader sees, and which of its readings are believed.

Cases: null counts and confidences count as absent; a page without segments is blank; a null reading is
empty and therefore refused; ties of the most frequent word or character do not matter, only its count does.
"""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE = ["doc_id", "pg"]
# What a reader says that did not read.
MARKERS = ("[image content", "[image]", "i cannot", "i can't", "i'm unable", "i am unable", "unable to read", "unable to process", "as an ai", "i'm sorry", "i am sorry")


#: White space of Unicode, which lacks the four separators that Python splits at.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_WORD = re.compile(f"[^{WHITE}]+")


def _words(text: str | None) -> list[str]:
    text = text or ""
    return _WORD.findall(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()


def _floods(words: list[str]) -> bool:
    chars = "".join(words)
    kinds = set(chars) if len(chars) >= 200 else ()
    return bool(kinds) and (len(kinds) <= 3 or max(map(chars.count, kinds)) >= 0.90 * len(chars))


def _loops(words: list[str]) -> bool:
    times = Counter(words) if len(words) >= 40 else ()
    return bool(times) and (max(times.values()) >= 0.40 * len(words) or len(times) / len(words) < 0.10)


@F.pandas_udf(T.BooleanType())
def flooded(text: pd.Series) -> pd.Series:
    """One character, or three at most, fill 200 or more that are not white space."""
    return pd.Series([_floods(_words(x)) for x in text], dtype=bool)


@F.pandas_udf(T.BooleanType())
def looping(text: pd.Series) -> pd.Series:
    """One of 40 or more words is 40 % of them, or under a tenth of them differ."""
    return pd.Series([_loops(_words(x)) for x in text], dtype=bool)


@F.pandas_udf(T.BooleanType())
def degenerate(text: pd.Series) -> pd.Series:
    return pd.Series([_floods(ws) or _loops(ws) for ws in map(_words, text)], dtype=bool)


def refused(reading: Column, detected: Column) -> Column:
    """Whether a reading is none: blank, a short excuse, far shorter than what was detected, or a loop."""
    said = F.lower(F.btrim(F.coalesce(reading, F.lit("")), F.lit(WHITE)))
    excuse = F.exists(F.array(*map(F.lit, MARKERS)), lambda m: F.contains(said, m))
    n = F.length(said)
    return (n == 0) | ((n < 200) & excuse) | ((detected >= 80) & (n < 0.25 * detected)) | degenerate(reading)


def needs_ocr(non_space: Column, pua: Column, text_area: Column, page_area: Column, image_share: Column) -> Column:
    """No text, a contaminated layer, or a large image under little text."""
    partial = (image_share > 0.40) & (text_area / F.greatest(page_area, F.lit(1.0)) < 0.50)
    return (non_space == 0) | (pua > 0.01 * non_space) | partial


def image_share(rects: DataFrame, page_area: float) -> DataFrame:
    """Per page the largest image rectangle (x0, y0, x1, y1) over the page's area."""
    area = F.abs((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))
    return rects.groupBy(*PAGE).agg((F.coalesce(F.max(area), F.lit(0.0)) / max(page_area, 1.0)).alias("image_share"))


def confidences(segments: DataFrame) -> DataFrame:
    """Per page the mean confidence of each engine, and the detected characters of the first."""
    of = lambda e: F.avg(F.when(F.col("engine") == e, F.col("det_conf")))
    chars = F.coalesce(F.sum(F.when(F.col("engine") == "paddle", F.length("det_text"))), F.lit(0)).cast("long")
    return segments.groupBy(*PAGE).agg(of("paddle").alias("paddle_conf"), of("vision").alias("vision_conf"), chars.alias("det_chars"))


def confident(mean: Column, threshold: float, off_at_zero: bool = False) -> Column:
    """Whether a mean confidence reaches a threshold; none does not."""
    if off_at_zero and threshold <= 0:
        return F.lit(False)
    return F.coalesce(mean >= threshold, F.lit(False))


def unsure(mean: Column, threshold: float) -> Column:
    return F.lit(False) if threshold <= 0 else F.coalesce(mean < threshold, F.lit(False))


def reading_plan(pages: DataFrame, segments: DataFrame, vision: float = 0.92, paddle: float = 0.0) -> DataFrame:
    """Per page (doc_id, pg, needs_ocr) what reads it: none, blank, vision, paddle or reader."""
    met = pages.join(confidences(segments), PAGE, "left")
    blank = F.col("det_chars").isNull()
    plan = F.when(~F.col("needs_ocr"), "none").when(blank, "blank").when(confident(F.col("vision_conf"), vision), "vision")
    plan = plan.when(confident(F.col("paddle_conf"), paddle, True), "paddle").otherwise("reader")
    return met.select(*PAGE, plan.alias("plan"), F.coalesce("det_chars", F.lit(0).cast("long")).alias("det_chars"))


def escalated(readings: DataFrame, model: str, stronger: str | None, below: float = 0.0) -> DataFrame:
    """Adds model, reading and read_failed after a second reading where the first is refused or unsure.  ``readings``
    has reading, second, det_chars, paddle_conf, failed; a failed first reading is not retried."""
    # Judged in a projection of its own: once, not in each branch that asks.
    judged = readings.select("*", refused(F.col("reading"), F.col("det_chars")).alias("_poor"), refused(F.col("second"), F.col("det_chars")).alias("_second_poor"))
    poor = F.col("_poor")
    wanted = F.lit(bool(stronger) and stronger != model) & (poor | unsure(F.col("paddle_conf"), below))
    swap = wanted & ~F.col("_second_poor")
    text = F.when(F.col("failed"), "").when(swap, F.col("second")).when(poor, "").otherwise(F.col("reading"))
    by = F.when(F.col("failed"), "").when(swap, F.lit(stronger)).when(poor, "").otherwise(F.lit(model))
    return judged.select(*readings.columns, text.alias("final"), by.alias("read_model"), F.col("failed").alias("read_failed"))
