"""Reading order of boxed lines where none is given: bands of about a line's height, then left to right.

Cases: lines without a box come last in list order; equal centres keep list order; a page of one line has one band.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reading_bands(lines: DataFrame) -> DataFrame:
    """(doc_id, pg, ix, rank).  A line joins the band before it if its centre is within 0.6 of the (upper) median
    height of the band's first line.  A page's lines are folded in one row."""
    box = F.col("x0").isNotNull() & F.col("y0").isNotNull() & F.col("y1").isNotNull()
    row = F.struct(((F.col("y0") + F.col("y1")) / 2).alias("cy"), "ix", "x0", (F.col("y1") - F.col("y0")).alias("h"))
    pages = lines.groupBy("doc_id", "pg").agg(F.array_sort(F.collect_list(F.when(box, row))).alias("ls"), F.array_sort(F.collect_list(F.when(~box, F.col("ix")))).alias("rest"))
    heights = F.array_sort(F.transform("ls", lambda x: x["h"]))
    pages = pages.withColumn("reach", 0.6 * F.greatest(F.get(heights, F.floor(F.size(heights) / 2).cast("int")), F.lit(1.0)))
    start = F.struct(F.lit(None).cast("double").alias("base"), F.lit(0).alias("band"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, x: Column, reach: Column) -> Column:
        same = F.coalesce(x["cy"] - acc["base"] <= reach, F.lit(False))
        band = F.when(same, acc["band"]).otherwise(acc["band"] + 1)
        return F.struct(F.when(same, acc["base"]).otherwise(x["cy"]).alias("base"), band.alias("band"), F.concat(acc["out"], F.array(band)).alias("out"))

    numbered = F.aggregate("ls", start, lambda acc, x: step(acc, x, F.col("reach")), lambda acc: acc["out"])
    placed = F.array_sort(F.zip_with("ls", numbered, lambda x, b: F.struct(b.alias("b"), x["x0"].alias("x0"), x["cy"].alias("cy"), x["ix"].alias("ix"))))
    order = F.concat(F.transform(placed, lambda x: x["ix"].cast("int")), F.transform("rest", lambda i: i.cast("int")))
    return pages.select("doc_id", "pg", F.posexplode(order).alias("rank", "ix"))
