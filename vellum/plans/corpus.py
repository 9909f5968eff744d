"""Corpora derived from the shared tables by whole-number rules, in Spark and in SQL alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import CONFUSED

#: Injected by doc_id modulo 10, so that zero-width, private-use and other scripts occur.
INJECTED = ["​", "", "слово ", "คำ ", "文字 ", "كلمة ", "शब्द "]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    extra = F.lit("")
    for k, s in enumerate(INJECTED):
        extra = F.when(F.col("doc_id") % 10 == k, F.repeat(F.lit(s), F.floor(F.length("text") / 15).cast("int"))).otherwise(extra)
    return docs.select("doc_id", "lang", "source", F.concat("text", extra).alias("text"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    cut = docs.select("doc_id", "lang", "source", F.posexplode(F.split("text", "\n")).alias("ix", "t"))
    return cut.filter(F.trim("t") != "")


def confused(column: str):
    return F.translate(F.col(column), *CONFUSED)


def text_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines(spark, sf_dir).filter("(doc_id + ix) % 3 <> 0")
    placed = _placed(cut, F.lit(0), F.lit(0))
    return placed.withColumn("contaminated", (F.col("doc_id") * 13 + F.col("ix")) % 11 == 0)


def detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines(spark, sf_dir)
    dx, dy = (F.col("doc_id") * 7 + F.col("ix") * 3) % 9 - 4, (F.col("doc_id") + F.col("ix") * 5) % 13 - 6
    placed = _placed(cut, dx, dy)
    engine = F.when((F.col("doc_id") + F.col("ix")) % 4 == 0, "vision").otherwise("paddle")
    return placed.select("*", confused("t").alias("det_text"), (((F.col("doc_id") * 31 + F.col("ix") * 17) % 100) / 100.0).alias("det_conf"), engine.alias("engine"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader makes of each page: its lines, every twentieth missing; pages of every seventh document unread."""
    cut = lines(spark, sf_dir).select("doc_id", "ix", "t", ((F.col("ix") - F.col("ix") % 40) / 40).cast("int").alias("pg"))
    kept = F.collect_list(F.when(F.col("ix") % 20 != 4, F.struct("ix", "t")))
    text = F.array_join(F.transform(F.array_sort(kept), lambda x: x["t"]), "\n")
    told = cut.groupBy("doc_id", "pg").agg(text.alias("reading"))
    unread = F.col("doc_id") % 7 == 0
    return told.select("doc_id", "pg", F.when(unread, "").otherwise(F.col("reading")).alias("reading"), F.when(unread, "").otherwise("general").alias("model"))


def _placed(cut: DataFrame, dx, dy) -> DataFrame:
    ix = F.col("ix")
    x0 = (72 + 240 * (ix % 2) + dx).cast("double")
    y0 = (72 + 16 * ((ix % 40 - (ix % 40) % 2) / 2) + dy).cast("double")
    boxed = cut.select("doc_id", "lang", "source", "ix", "t", ((ix - ix % 40) / 40).cast("int").alias("pg"), x0.alias("x0"), y0.alias("y0"))
    return boxed.withColumn("x1", F.col("x0") + 6 * F.least(F.length("t"), F.lit(38))).withColumn("y1", F.col("y0") + 12)


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four bands of each page of lines, of three kinds."""
    pages = lines(spark, sf_dir).select("doc_id", ((F.col("ix") - F.col("ix") % 40) / 40).cast("int").alias("pg")).distinct()
    cut = pages.select("doc_id", "pg", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("rix"))
    kind = F.element_at(F.array(*map(F.lit, ("header", "paragraph", "table", "paragraph"))), F.col("rix") + 1)
    top = (60 + 80 * F.col("rix")).cast("double")
    return cut.select("doc_id", "pg", "rix", F.col("rix").alias("rank"), kind.alias("kind"), F.lit(60.0).alias("x0"), top.alias("y0"), F.when(F.col("rix") % 2 == 0, 420.0).otherwise(560.0).alias("x1"), (top + 90).alias("y1"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One made score per document and arm: what a parameter sweep leaves."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    arms = docs.crossJoin(F.broadcast(spark.range(4).select((F.col("id") * 20).cast("int").alias("threshold"))))
    placed = (F.col("n_chars") * 7 + F.col("doc_id") * (3 + F.col("threshold"))) % (F.col("n_chars") + 1)
    return arms.withColumn("hits", F.when(F.col("threshold") == 0, F.col("n_chars")).otherwise(placed))


def _case(fmt: str) -> str:
    return " ".join(f"WHEN {k} THEN '{s}'" for k, s in enumerate(INJECTED))


#: The same as DuckDB common table expressions.
SQL = {
    "dirty": f"dirty AS (SELECT doc_id, lang, source, text || repeat(CASE doc_id % 10 {_case('')} ELSE '' END, (length(text) // 15)::BIGINT) AS text FROM documents)",
    "lines": "lines AS (SELECT * FROM (SELECT doc_id, lang, source, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ix, unnest(string_split(text, chr(10))) AS t FROM documents) WHERE trim(t) <> '')",
    "tl": "tl AS (SELECT *, x0 + 6 * least(length(t), 38) AS x1, y0 + 12 AS y1, (doc_id * 13 + ix) % 11 = 0 AS contaminated FROM (SELECT doc_id, lang, source, ix, t, ((ix - ix % 40) // 40)::INT AS pg, (72 + 240 * (ix % 2))::DOUBLE AS x0, (72 + 16 * ((ix % 40 - (ix % 40) % 2) // 2))::DOUBLE AS y0 FROM lines WHERE (doc_id + ix) % 3 <> 0))",
    "ocr": "ocr AS (SELECT *, x0 + 6 * least(length(t), 38) AS x1, y0 + 12 AS y1, translate(t, 'oil', '01l') AS det_text, ((doc_id * 31 + ix * 17) % 100) / 100.0::DOUBLE AS det_conf, CASE WHEN (doc_id + ix) % 4 = 0 THEN 'vision' ELSE 'paddle' END AS engine FROM (SELECT doc_id, lang, source, ix, t, ((ix - ix % 40) // 40)::INT AS pg, (72 + 240 * (ix % 2) + (doc_id * 7 + ix * 3) % 9 - 4)::DOUBLE AS x0, (72 + 16 * ((ix % 40 - (ix % 40) % 2) // 2) + (doc_id + ix * 5) % 13 - 6)::DOUBLE AS y0 FROM lines))",
    "regions": "regions AS (SELECT doc_id, pg, rix, rix AS rank, ['header','paragraph','table','paragraph'][rix + 1] AS kind, 60.0::DOUBLE AS x0, (60 + 80 * rix)::DOUBLE AS y0, CASE WHEN rix % 2 = 0 THEN 420.0 ELSE 560.0 END::DOUBLE AS x1, (150 + 80 * rix)::DOUBLE AS y1 FROM (SELECT DISTINCT doc_id, ((ix - ix % 40) // 40)::INT AS pg FROM lines), (SELECT unnest(range(0, 4))::INT AS rix))",
    "readings": "readings AS (SELECT doc_id, pg, CASE WHEN doc_id % 7 = 0 THEN '' ELSE coalesce(string_agg(t, chr(10) ORDER BY ix) FILTER (ix % 20 <> 4), '') END AS reading, CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'general' END AS model FROM (SELECT doc_id, ix, t, ((ix - ix % 40) // 40)::INT AS pg FROM lines) GROUP BY doc_id, pg)",
    "scores": "scores AS (SELECT *, CASE WHEN threshold = 0 THEN n_chars ELSE (n_chars * 7 + doc_id * (3 + threshold)) % (n_chars + 1) END AS hits FROM (SELECT doc_id, lang, source, n_chars FROM documents), (SELECT (unnest(range(0, 4)) * 20)::INT AS threshold))",
}
IOU = "(CASE WHEN least({a}.x1,{b}.x1) > greatest({a}.x0,{b}.x0) AND least({a}.y1,{b}.y1) > greatest({a}.y0,{b}.y0) THEN (least({a}.x1,{b}.x1)-greatest({a}.x0,{b}.x0))*(least({a}.y1,{b}.y1)-greatest({a}.y0,{b}.y0)) / (({a}.x1-{a}.x0)*({a}.y1-{a}.y0)+({b}.x1-{b}.x0)*({b}.y1-{b}.y0)-(least({a}.x1,{b}.x1)-greatest({a}.x0,{b}.x0))*(least({a}.y1,{b}.y1)-greatest({a}.y0,{b}.y0))) ELSE 0.0 END)"


def with_sql(*names: str) -> str:
    return "WITH " + ", ".join(SQL[n] for n in names) + " "
