"""Stages over a table of documents, with snapshots that a later run starts from.

A stage has a name and turns one DataFrame into another.  After each stage its table is written under
``root/recipe=<fingerprint>/stage=<position>-<name>``; a run begins behind the last snapshot of its own recipe, or
at the stage named by ``rerun_from`` if the one before it is there.

Cases: a snapshot that was not finished has no _SUCCESS mark and does not count; an unknown ``rerun_from`` is an error;
an empty table passes through all stages.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

READERS = ("vlm_read", "table_read")


@dataclass(frozen=True)
class Stage:
    name: str
    run: Callable[[DataFrame, dict], DataFrame]


def without_readers(stages: list[Stage]) -> list[Stage]:
    """The stages that need no reader."""
    return [s for s in stages if s.name not in READERS]


def fingerprint(stages: list[Stage], settings: dict, prompts: dict[str, str]) -> str:
    """16 hex digits over all that decides the output: stage names, readers, routes, flags and prompts; not folders."""
    run = {k: v for k, v in settings.get("run", {}).items() if k not in ("in_dir", "out_dir", "airgap", "max_upload_mb", "settle_seconds")}
    vlm = {k: v for k, v in settings.get("vlm", {}).items() if k not in ("api_key", "max_retries")}
    told = {"pipeline": [s.name for s in stages], "vlm": vlm, "routes": settings.get("routing", {}), "flags": run, "prompts": prompts}
    return hashlib.sha256(json.dumps(told, sort_keys=True, ensure_ascii=False).encode()).hexdigest()[:16]


def _path(root: str, recipe: str, k: int, stage: Stage) -> str:
    return f"{root.rstrip('/')}/recipe={recipe}/stage={k:02d}-{stage.name}"


def _done(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def start_at(done: list[bool], names: list[str], rerun_from: str | None = None, force: bool = False) -> int:
    """Position of the first stage to run, given which have a snapshot of this recipe."""
    if rerun_from is not None and rerun_from not in names:
        raise ValueError(f"{rerun_from} is no stage of {names}")
    start = 0 if force else max((k + 1 for k, d in enumerate(done) if d), default=0)
    if rerun_from is not None and names.index(rerun_from) < start:
        at = names.index(rerun_from)
        start = at if at and done[at - 1] else 0
    return start


def process(documents: DataFrame, stages: list[Stage], settings: dict, root: str, prompts: dict[str, str] | None = None, rerun_from: str | None = None, force: bool = False) -> tuple[DataFrame, list[str], dict[str, float]]:
    """The last stage's table, the names of the stages that ran, and their seconds."""
    spark = documents.sparkSession
    recipe = fingerprint(stages, settings, prompts or {})
    paths = [_path(root, recipe, k, s) for k, s in enumerate(stages)]
    start = start_at([_done(spark, p) for p in paths], [s.name for s in stages], rerun_from, force)
    now, seconds = documents if not start else spark.read.parquet(paths[start - 1]), {}
    for k in range(start, len(stages)):
        began = time.perf_counter()
        stages[k].run(now, settings).write.mode("overwrite").parquet(paths[k])
        now = spark.read.parquet(paths[k])
        seconds[stages[k].name] = round(time.perf_counter() - began, 3)
    return now, [s.name for s in stages[start:]], seconds
