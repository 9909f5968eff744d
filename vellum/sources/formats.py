"""Format sniffing, ingest gates and annotation loaders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MAGIC = {"255044462D": "pdf", "89504E470D0A1A0A": "png", "FFD8FF": "jpeg", "49492A00": "tiff", "4D4D002A": "tiff"}


def sniff(content: Column) -> Column:
    """Format by the first 16 bytes, null if unknown."""
    head = F.hex(F.substr(content, F.lit(1), F.lit(16)))
    out = F.lit(None).cast("string")
    for magic, name in reversed(MAGIC.items()):
        out = F.when(F.startswith(head, F.lit(magic)), name).otherwise(out)
    return out


def gate(fmt: Column, size: Column, most: int) -> Column:
    return F.when((size == 0) | fmt.isNull(), 415).when(size > most, 413).otherwise(202)


def valid_digest(s: Column) -> Column:
    return s.rlike("^[0-9a-fA-F]{64}$")


def box_list(spark: SparkSession, path: str) -> DataFrame:
    """One JSON a file with ocr_boxes: (path, text), texts in the order of the annotation."""
    schema = "ocr_boxes array<struct<points:array<array<double>>,text:string>>"
    read = spark.read.schema(schema).option("multiLine", True).json(path).withColumn("path", F.input_file_name())
    return read.select("path", F.array_join(F.transform("ocr_boxes", lambda b: F.coalesce(b["text"], F.lit(""))), "\n").alias("text"))


def form_list(spark: SparkSession, path: str) -> DataFrame:
    """One JSON a file with form entries: (path, text), empty ones skipped."""
    schema = "form array<struct<text:string,box:array<double>,label:string>>"
    read = spark.read.schema(schema).option("multiLine", True).json(path).withColumn("path", F.input_file_name())
    texts = F.filter(F.transform("form", lambda b: b["text"]), lambda t: t.isNotNull() & (t != ""))
    return read.select("path", F.array_join(texts, "\n").alias("text"))


def handwriting_lines(raw: DataFrame, drop_err: bool = False) -> DataFrame:
    """``value`` rows of a line index: (form, line, ok, x, y, w, h, text)."""
    told = raw.filter("value <> '' and not startswith(value, '#')").select(F.split("value", " ", 9).alias("p"))
    lid = F.get("p", 0)
    cut = told.select(
        F.regexp_extract(lid, "^(.*)-([^-]*)$", 1).alias("form"),
        F.regexp_extract(lid, "^(.*)-([^-]*)$", 2).cast("int").alias("line"),
        (F.get("p", 1) == "ok").alias("ok"),
        *(F.get("p", k).cast("int").alias(c) for k, c in zip((4, 5, 6, 7), "xywh")),
        F.replace(F.coalesce(F.get("p", 8), F.lit("")), F.lit("|"), F.lit(" ")).alias("text"),
    )
    return cut.filter("ok") if drop_err else cut


def handwriting_forms(lines: DataFrame) -> DataFrame:
    turn = F.struct("line", "text")
    return lines.groupBy("form").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(turn)), lambda t: t["text"]), "\n").alias("text"),
        F.min("x").alias("x0"), F.min("y").alias("y0"), F.max(F.col("x") + F.col("w")).alias("x1"), F.max(F.col("y") + F.col("h")).alias("y1"),
    )


def first_pairs(images: DataFrame, truths: DataFrame, n: int) -> DataFrame:
    """Images with their annotation across splits by stem, the last of equal stems, first n by path."""
    last = F.row_number().over(Window.partitionBy("stem").orderBy(F.desc("truth_path")))
    one = truths.withColumn("k", last).filter("k = 1").drop("k")
    return images.join(one, "stem").orderBy("path").limit(n)


def peek(spark: SparkSession, path: str) -> DataFrame:
    """(path, format) of the files under a path by their first bytes; null if unknown or unreadable."""
    raw = spark.read.format("binaryFile").option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).load(path)
    return raw.select("path", sniff(F.col("content")).alias("format"))


def as_pdf(fmt: Column) -> Column:
    """What becomes of an upload: a PDF is kept, an image converted, anything else refused with a reason."""
    action = F.when(fmt == "pdf", "keep").when(fmt.isNotNull(), "convert").otherwise("refuse")
    return F.struct(action.alias("action"), F.when(fmt.isNull(), F.lit("unsupported format")).alias("error"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Labels of a JSON manifest: (id, pdf, pages, transcript, note, render); transcripts lie beside the manifest."""
    entry = "struct<id:string,pdf:string,page:int,pages:array<int>,transcript:string,note:string,render:boolean>"
    read = spark.read.schema(f"labels array<{entry}>").option("multiLine", True).json(path).select(F.explode("labels").alias("l")).select("l.*")
    folder = path.rsplit("/", 1)[0] if "/" in path else "."
    return read.select("id", "pdf", F.coalesce("pages", F.array("page")).alias("pages"), F.concat(F.lit(folder + "/"), "transcript").alias("transcript"), F.coalesce("note", F.lit("")).alias("note"), F.coalesce("render", F.lit(False)).alias("render"))


def truth_lines(spark: SparkSession, path: str) -> DataFrame:
    """Boxed lines of form annotations: (path, ix, text, x0, y0, x1, y1), blank texts and missing boxes left out."""
    read = spark.read.schema("form array<struct<text:string,box:array<double>>>").option("multiLine", True).json(path).withColumn("path", F.input_file_name())
    rows = read.select("path", F.posexplode("form").alias("ix", "f")).filter("coalesce(f.text, '') <> '' and size(f.box) = 4")
    return rows.select("path", "ix", "f.text", *(F.get("f.box", F.lit(k)).alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))))


def append_rows(rows: DataFrame, path: str) -> None:
    """Add result rows to a CSV folder."""
    rows.write.mode("append").option("header", True).csv(path)


def result_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
