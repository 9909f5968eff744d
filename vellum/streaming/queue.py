"""Streaming: a drop folder, idempotent enqueueing and windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.formats import sniff

BINARY = "path string, modificationTime timestamp, length long, content binary"


def drop_folder(spark: SparkSession, path: str) -> DataFrame:
    """Files of a folder as they appear, with digest and format.  Writers should rename into place: a path is
    offered once."""
    raw = spark.readStream.format("binaryFile").schema(BINARY).load(path)
    return raw.select("path", "modificationTime", "length", F.sha2("content", 256).alias("sha256"), sniff(F.col("content")).alias("format"))


def enqueue(files: DataFrame) -> DataFrame:
    """One queued job per digest."""
    return files.filter("format is not null").dropDuplicates(["sha256"]).select("sha256", F.col("path").alias("source_path"), F.lit("queued").alias("status"))


def tumbling(events: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Counts per window and type (an extension: the modelled job flow has no windows)."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if timed.isStreaming:
        timed = timed.withWatermark("ts", late)
    counted = timed.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").cast("timestamp_ntz").alias("starts"), "event_type", "n")


def run_available(stream: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Everything there is now, into a memory table."""
    q = stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)


def settled(files: DataFrame, seconds: float, now=None) -> DataFrame:
    """Files that have not changed for ``seconds``; younger ones wait for the next look."""
    now = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return files.filter(F.unix_micros(now) - F.unix_micros("modificationTime") >= int(seconds * 1e6))


def split_outcomes(done: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (sha256, source_path, error) as finished jobs, and as dead letters with their error."""
    stamp = F.unix_micros(F.current_timestamp()) / 1e6
    good = done.filter("error is null").select("sha256", "source_path", F.lit("done").alias("status"), F.lit(None).cast("string").alias("error"), stamp.alias("updated_at"))
    bad = done.filter("error is not null").select("sha256", "source_path", F.lit("error").alias("status"), "error", stamp.alias("updated_at"))
    return good, bad


def archive_name(folder: str, digest, path):
    """Where a handled file goes: its digest with its old ending."""
    ending = F.regexp_extract(path, r"(\.[^./]+)$", 1)
    return F.concat(F.lit(folder.rstrip("/") + "/"), digest, ending)


def scan_once(spark: SparkSession, path: str, jobs: DataFrame, seconds: float = 2.0, now=None) -> DataFrame:
    """Jobs to add after one look at a folder: settled files of a known format whose digest no job has."""
    raw = spark.read.format("binaryFile").option("ignoreCorruptFiles", True).load(path)
    found = settled(raw, seconds, now).select("path", F.sha2("content", 256).alias("sha256"), sniff(F.col("content")).alias("format"))
    fresh = found.filter("format is not null").groupBy("sha256").agg(F.min("path").alias("source_path"))
    return fresh.join(jobs, "sha256", "left_anti").select("sha256", "source_path", F.lit("queued").alias("status"))
