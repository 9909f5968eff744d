"""Shared pieces of the training-data operators."""

from __future__ import annotations

import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_GAP = "[\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir.  Where it is unset, a local session (tests) gets a
    temporary folder, and a cluster an error, since its machines would not see each other's files."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="vellum-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    return base.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes what is materialized inside, at the end, but for what is kept."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            remove(spark, path)


def materialize(df: DataFrame, label: str, path: str | None = None, keep: bool = False) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = path or new_path(spark, label)
    if _scratch and not keep:
        _scratch[-1].append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def fitted(sample: DataFrame, fit: Callable[[pa.Table], Any]) -> Any:
    """What ``fit`` makes of the rows of a bounded sample, in one task: Spark gives its Python one BLAS thread and
    runs it again elsewhere if the executor is lost."""
    schema = sample.limit(0).toArrow().schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = fit(pa.Table.from_batches(list(batches), schema))
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(made)]})

    row = sample.repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(row["model"]) if row else fit(schema.empty_table())


def let(value: Column, body) -> Column:
    """Bind an expression once, so that a lambda inside ``body`` does not evaluate it per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def dealt(left: DataFrame, right: DataFrame, on: list[str] | str, how: str = "inner") -> DataFrame:
    """A join of two tables that grow with the input: always shuffled.  Left to itself Spark broadcasts an exploded table
    whenever what it was exploded from is small, since its estimate leaves the rows that explode adds out."""
    return left.hint("merge").join(right.hint("merge"), on, how)


def free_names(taken: list[str], *names: str) -> list[str]:
    """The names, each with underscores added until no column has it."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null or blank: empty."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP))


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null ids fall in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0).cast("long"))
