"""Script routing: which recogniser, reader and engine a page gets.

Cases: an unknown or null script takes latin's route; an override's null column changes nothing; of several overrides
of one script the caller must choose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Script, language of the recogniser, special reader, its address, engine.
ROUTES = [
    ("latin", "en", None, None, "paddle"),
    ("thai", "th", "mlx-community/typhoon-ocr1.5-2b-8bit", None, "paddle"),
    ("cyrillic", "cyrillic", None, None, "paddle"),
    ("arabic", "arabic", None, None, "paddle"),
    ("cjk", "ch", None, None, "paddle"),
    ("devanagari", "devanagari", None, None, "paddle"),
]
COLUMNS = ("ocr_lang", "reader", "base_url", "engine")
#: Rows of an override table that may be broadcast.
MOST = 10_000


def routes(spark: SparkSession) -> DataFrame:
    """The dimension of routes: six rows."""
    return spark.createDataFrame(ROUTES, "script string, ocr_lang string, reader string, base_url string, engine string")


def resolve(scripts: DataFrame, table: DataFrame, override: DataFrame | None = None) -> DataFrame:
    """Left join to the routes; an unknown script takes latin's, an override wins column by column."""
    known = table.select("script", F.struct(*COLUMNS).alias("own"))
    latin = table.filter("script = 'latin'").select(F.struct(*COLUMNS).alias("base"))
    met = scripts.join(F.broadcast(known), "script", "left").crossJoin(F.broadcast(latin)).withColumn("own", F.coalesce("own", "base"))
    if override is None:
        return met.select(*scripts.columns, "own.*")
    given = override.select("script", F.struct(*(F.col(c) if c in override.columns else F.lit(None).cast("string").alias(c) for c in COLUMNS)).alias("given"))
    met = met.join(F.broadcast(given) if override.count() <= MOST else given, "script", "left")
    return met.select(*scripts.columns, *(F.coalesce(f"given.{c}", f"own.{c}").alias(c) for c in COLUMNS))


def auto_engine(script: Column, preferred: list[tuple[str, list[str], bool]]) -> Column:
    """The first preferred engine (name, its scripts, whether it is available) that reads the script, else null."""
    out = F.lit(None).cast("string")
    for name, scripts, available in reversed(preferred):
        if available:
            out = F.when(script.isin(scripts), name).otherwise(out)
    return out
