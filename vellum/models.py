"""The document record as a Spark schema, and its JSON form.

Decoding follows the schema: a missing field gets its default, an unknown one is ignored, an explicit null in a
field without default stays null.  Cases: null or malformed JSON is a record of defaults without pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTS = "array<struct<x:double,y:double>>"
REGION = f"struct<box:{POINTS},kind:string,reading_order:int,source:string,table_html:string,cells:array<{POINTS}>,table_vlm:string,table_read_by:string,table_engine:string>"
SEGMENT = f"struct<id:string,page:int,box:{POINTS},best_text:string,source:string,det_text:string,det_conf:double,vlm_text:string,read_by:string,superseded:boolean,translations:map<string,string>>"
PAGE = f"struct<index:int,width:double,height:double,has_text_layer:boolean,needs_ocr:boolean,rotation:int,script:string,read_model:string,read_failed:boolean,image_ref:string,vlm_reading:string,regions:array<{REGION}>,segments:array<{SEGMENT}>>"
DOCUMENT = f"sha256 string, source_path string, languages array<string>, pages array<{PAGE}>, artifacts map<string,string>, stage_completed string, recipe string, stage_seconds map<string,double>"

#: Defaults by field; a field that is not here is null where it is missing.
DEFAULTS = {
    "source_path": "", "recipe": "", "width": 0.0, "height": 0.0, "has_text_layer": False, "needs_ocr": True, "rotation": 0, "script": "", "read_model": "", "read_failed": False,
    "vlm_reading": "", "kind": "paragraph", "reading_order": 0, "source": "paddle", "table_html": "", "table_vlm": "", "table_read_by": "", "table_engine": "", "best_text": "", "read_by": "", "superseded": False,
}
#: A region's source has another default than a segment's.
REGION_SOURCE = ""


def _filled(value: Column, kind: T.DataType, name: str, owner: str) -> Column:
    if isinstance(kind, T.StructType):
        fields = [_filled(value[f.name], f.dataType, f.name, name).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        element = kind.elementType
        whole = F.transform(value, lambda x: _filled(x, element, name, name)) if isinstance(element, (T.StructType, T.ArrayType)) else value
        return F.coalesce(whole, F.array().cast(kind))
    if isinstance(kind, T.MapType):
        return F.coalesce(value, F.create_map().cast(kind))
    if name == "source" and owner == "regions":
        return F.coalesce(value, F.lit(REGION_SOURCE))
    return F.coalesce(value, F.lit(DEFAULTS[name])) if name in DEFAULTS else value


def schema(spark: SparkSession) -> T.StructType:
    return spark.createDataFrame([], DOCUMENT).schema


def decode(df: DataFrame, column: str = "json") -> DataFrame:
    """One row a document, from a column of JSON."""
    kind = schema(df.sparkSession)
    told = df.select(F.from_json(column, kind).alias("d"))
    return told.select(*(_filled(F.col(f"d.{f.name}"), f.dataType, f.name, "").alias(f.name) for f in kind.fields))


def encode(documents: DataFrame, into: str = "json") -> DataFrame:
    """Documents as JSON, nulls left out and characters as they are."""
    return documents.select(F.to_json(F.struct(*documents.columns)).alias(into))


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Archived records, one JSON file each."""
    return decode(spark.read.text(path, wholetext=True), "value")


def flat(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pages, regions and segments as tables keyed by sha256, page and position, boxes as their extent."""
    pages = documents.select("sha256", F.explode("pages").alias("p"))
    told = pages.select("sha256", F.col("p.index").alias("pg"), *(F.col(f"p.{c}").alias(c) for c in ("width", "height", "has_text_layer", "needs_ocr", "rotation", "script", "read_model", "read_failed", "vlm_reading")))

    def boxed(name: str, at: str) -> DataFrame:
        rows = pages.select("sha256", F.col("p.index").alias("pg"), F.posexplode(f"p.{name}").alias(at, "s"))
        side = lambda f, axis: f(F.transform("s.box", lambda q: q[axis]))
        box = [side(f, axis).alias(n) for n, f, axis in (("x0", F.array_min, "x"), ("y0", F.array_min, "y"), ("x1", F.array_max, "x"), ("y1", F.array_max, "y"))]
        return rows.select("sha256", "pg", at, *box, "s.*").drop("box", "page")

    return told, boxed("regions", "rix"), boxed("segments", "ix")
