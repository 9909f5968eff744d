"""The job queue as folds over an event log keyed by digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: status, event -> next status; anything else leaves the status.
MOVES = {("", "queued"): "queued", ("queued", "running"): "running", ("running", "done"): "done", ("running", "error"): "error"}
REPROCESS = {("done", "running"): "running", ("error", "running"): "running"}


def step(status: str, event: str, reprocess: bool = False) -> str:
    moves = MOVES | (REPROCESS if reprocess else {})
    return moves.get((status, event), status)


def event_log(events: DataFrame) -> DataFrame:
    """Site events read as job events."""
    kind = F.element_at(F.create_map(*map(F.lit, ("signup", "queued", "view", "running", "purchase", "done", "error", "error"))), F.col("event_type"))
    return events.select(F.sha2(F.col("user_id").cast("string"), 256).alias("sha256"), "event_id", "ts", kind.alias("event")).filter("event is not null")


def latest(log: DataFrame) -> DataFrame:
    return log.groupBy("sha256").agg(F.max_by("event", F.struct("ts", "event_id")).alias("status"), F.max("ts").alias("updated_at"), F.count("*").alias("n_events"))


def _next(status: Column, event: Column, reprocess: bool) -> Column:
    out = status
    for (a, b), c in (MOVES | (REPROCESS if reprocess else {})).items():
        out = F.when((status == a) & (event == b), F.lit(c)).otherwise(out)
    return out


def folded(log: DataFrame, reprocess: bool = True) -> DataFrame:
    """Run the state machine over each job's events, natively."""
    told = log.groupBy("sha256").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", "event"))).alias("es"))
    start = F.struct(F.lit("").alias("status"), F.lit(0).alias("moves"))
    fold = F.aggregate("es", start, lambda acc, e: F.struct(_next(acc["status"], e["event"], reprocess).alias("status"), (acc["moves"] + (_next(acc["status"], e["event"], reprocess) != acc["status"]).cast("int")).alias("moves")))
    return told.select("sha256", fold.alias("x")).select("sha256", F.col("x.status").alias("status"), F.col("x.moves").alias("moves"))
