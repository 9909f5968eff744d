"""Experiment analytics: deltas against a baseline, verdicts, worst cases, resume lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rate(hits: str = "hits", n: str = "n_chars") -> Column:
    return F.sum(hits).cast("double") / F.greatest(F.sum(n), F.lit(1)).cast("double")


def by_arm(scores: DataFrame, group: str = "source") -> DataFrame:
    return scores.groupBy(group, "threshold").agg(rate().alias("recall"), F.count("*").alias("n"))


def deltas(aggregates: DataFrame, group: str = "source") -> DataFrame:
    """Each arm less the arm with threshold 0 of its group."""
    base = aggregates.filter("threshold = 0").select(group, F.col("recall").alias("base"))
    return aggregates.join(base, group).select(group, "threshold", "recall", (F.col("recall") - F.col("base")).alias("delta"))


def verdicts(delta: DataFrame, group: str = "source") -> DataFrame:
    """The largest change of each threshold, its class, and whether groups moved apart."""
    worst = F.max(F.abs("delta"))
    grade = F.when(worst < 0.005, "benign").when(worst >= 0.02, "load-bearing").otherwise("mild")
    apart = F.coalesce(F.bool_or(F.col("delta") > 0) & F.bool_or(F.col("delta") < 0), F.lit(False))
    return delta.filter("threshold > 0").groupBy("threshold").agg(worst.alias("max_abs_delta"), grade.alias("verdict"), apart.alias("opposed"))


def worst_items(scores: DataFrame, k: int = 5) -> DataFrame:
    """The k largest losses of each threshold against the item's own baseline."""
    base = scores.filter("threshold = 0").select("doc_id", F.col("hits").alias("base"))
    lost = scores.filter("threshold > 0").join(base, "doc_id").withColumn("loss", F.col("base") - F.col("hits"))
    rank = F.row_number().over(Window.partitionBy("threshold").orderBy(F.desc("loss"), "doc_id"))
    return lost.withColumn("rank", rank).filter(F.col("rank") <= k).select("threshold", "rank", "doc_id", "loss")


def bottom_share(df: DataFrame, by: str, key: str, parts: int = 10) -> DataFrame:
    """The lowest 1/parts of the rows (one at least), by a threshold on the value; only rows that tie on it are sorted."""
    n = max(1, df.count() // parts)
    edge = df.groupBy(by).agg(F.count("*").alias("k")).select(by, "k")
    upto = edge.select(by, F.sum("k").over(Window.orderBy(by)).alias("upto"), "k").filter(F.col("upto") - F.col("k") < n).agg(F.max(by).alias("edge"), F.max_by("upto", by).alias("upto"), F.max_by("k", by).alias("k")).first()
    if upto is None or upto["edge"] is None:
        return df.limit(0)
    below = df.filter(F.col(by) < upto["edge"])
    ties = df.filter(F.col(by) == upto["edge"]).orderBy(key).limit(int(n - (upto["upto"] - upto["k"])))
    return below.unionByName(ties)


def todo(work: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    return work.join(done, key, "left_anti")


def sample(df: DataFrame, key: str, seed: int, n: int) -> DataFrame:
    """n rows by a portable hash of key and seed."""
    return df.orderBy(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 256)).limit(n)


def arms(scores: DataFrame, a: int, b: int, group: str = "source") -> DataFrame:
    """Items that arm ``b`` reads better and worse than arm ``a``, by group."""
    left = scores.filter(F.col("threshold") == a).select("doc_id", group, "hits")
    right = scores.filter(F.col("threshold") == b).select("doc_id", F.col("hits").alias("other"))
    met = left.join(right, "doc_id")
    return met.groupBy(group).agg(F.count_if(F.col("other") > F.col("hits")).alias("rescued"), F.count_if(F.col("other") < F.col("hits")).alias("lost"), F.count("*").alias("n"))


def weighted(scores: DataFrame, base: DataFrame) -> DataFrame:
    """Per arm the error rate weighted by characters, the mean time, and how much faster than ``base`` that is."""
    error = F.sum(F.col("cer") * F.col("n_chars")) / F.greatest(F.sum("n_chars"), F.lit(1))
    told = scores.groupBy("threshold").agg(error.alias("cer"), F.avg("secs").alias("secs"))
    slow = base.agg(F.avg("secs").alias("base"))
    return told.crossJoin(F.broadcast(slow)).select("threshold", "cer", "secs", (F.col("base") / F.greatest("secs", F.lit(1e-9))).alias("speedup"))


def skip_gate(scores: DataFrame, allowed: float, group: str = "source") -> DataFrame:
    """Per threshold whether no group loses more than ``allowed`` recall, and the largest share skipped."""
    told = scores.groupBy(group, "threshold").agg(rate().alias("recall"), (F.count_if("skipped") / F.count("*")).alias("skipped"))
    base = told.filter("threshold = 0").select(group, F.col("recall").alias("base"))
    met = told.filter("threshold > 0").join(base, group)
    return met.groupBy("threshold").agg(F.bool_and(F.col("recall") - F.col("base") >= -allowed).alias("passes"), F.max("skipped").alias("most_skipped"))


def reproduced(now: DataFrame, committed: DataFrame, group: str = "source") -> DataFrame:
    """Items whose rounded rate equals the one committed before."""
    met = now.select("doc_id", group, "rate").join(committed.select("doc_id", F.col("rate").alias("was")), "doc_id")
    return met.groupBy(group).agg(F.count_if(F.col("rate") == F.col("was")).alias("same"), F.count("*").alias("n"))


def divergence(rows: DataFrame) -> DataFrame:
    """Tally of verdicts: a confident detection that the reading contradicts, a reading that ran away, or neither."""
    candidate = (F.col("f1") < 0.5) & (F.col("conf") >= 0.80) & (F.col("chars") >= 20) & (F.col("segments") >= 3)
    verdict = F.when(candidate, "candidate").when(F.col("inserted") > 5 * F.col("ref_chars"), "runaway").otherwise("ok")
    return rows.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


def adaptive_sample(df: DataFrame, key: str, seconds_each: float, budget: float, seed: int = 0, n: int = 150) -> DataFrame:
    """All rows if they are expected to take no longer than ``budget``, else a seeded sample of n."""
    return df if df.count() * seconds_each <= budget else sample(df, key, seed, n)
