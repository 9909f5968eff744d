"""Records, settings, readers, stages, folders and scores on small hand-made cases."""

from __future__ import annotations

import json
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellum import __main__ as cli
from vellum import models, readers
from vellum import settings as config
from vellum.functions import metrics
from vellum.operators import bands, experiments
from vellum.plans import stages
from vellum.sources import formats
from vellum.streaming import queue


def test_document_json_round_trip(spark):
    made = {"sha256": "ab", "extra": 1, "pages": [{"index": 0, "segments": [{"id": "s", "page": 0, "box": [{"x": 1, "y": 2}, {"x": 5, "y": 9}], "det_text": "één"}], "regions": [{"kind": "table", "box": []}]}]}
    rows = spark.createDataFrame([(json.dumps(made),), (None,), ("{",)], "json string")
    docs = models.decode(rows)
    first = docs.filter("sha256 = 'ab'").first()
    page = first.pages[0]
    assert (first.recipe, first.stage_completed, page.needs_ocr, page.rotation, page.regions[0].source, page.segments[0].source) == ("", None, True, 0, "", "paddle")
    assert first.languages == [] and first.artifacts == {} and docs.count() == 3
    again = models.decode(models.encode(docs))
    assert sorted(map(str, again.collect())) == sorted(map(str, docs.collect()))
    pages, regions, segments = models.flat(docs)
    s = segments.first()
    assert pages.count() == 1 and regions.count() == 1 and (s.x0, s.y0, s.x1, s.y1, s.det_text) == (1.0, 2.0, 5.0, 9.0, "één")


def test_settings_apply_all_or_nothing(tmp_path):
    now = config.load(tmp_path / "none.toml")
    assert now == config.defaults()
    after = config.apply(now, {"run.fuse_min_sim": 1, "vlm.api_key": 'k"\\'})
    assert after["run"]["fuse_min_sim"] == 1.0 and now["run"]["fuse_min_sim"] == 0.34
    for bad in ({"run.fuse_min_sim": 1.5}, {"vlm.max_tokens": True}, {"run.granularity": "page"}, {"run.in_dir": "x"}, {"nope": 1}):
        with pytest.raises(config.SettingError):
            config.apply(now, {"vlm.model": "other", **bad})
    assert {s["value"] for s in config.surface(after) if s["path"] == "vlm.api_key"} == {"***"}
    after["routing"] = {"thai": {"reader": "special"}}
    config.save(after, tmp_path / "a.toml")
    assert config.load(tmp_path / "a.toml") == after
    assert [config.is_loopback(h) for h in ("localhost", "127.8.0.1", "[::1]", "example.org", "10.0.0.1")] == [True, True, True, False, False]


def test_a_failing_reader_fails_its_row(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    got = {r.k: r.t for r in df.select("k", readers.reading(F.col("k"), lambda: readers.Told({"a": "alpha", "": ""})).alias("t")).collect()}
    assert tuple(got["a"]) == ("alpha", False, None) and got["b"].failed and got["b"].error.startswith("KeyError") and got[None].text == ""
    waits, tries = [], iter([OSError("down"), OSError("down"), "up"])

    def read():
        x = next(tries)
        if isinstance(x, Exception):
            raise x
        return x

    assert readers.patient(read, 3, waits.append) == "up" and waits == [0.5, 1.0] and readers.backoff(9) == 8.0

    class Sealed:
        def read(self, request, prompt):
            raise readers.SealError("remote")

    with pytest.raises(readers.SealError):
        readers.ready(Sealed(), wait=waits.append)
    assert not readers.ready(readers.Told({}), wait=lambda s: None)
    readers.register("told", lambda: readers.Told({}))
    readers.register("absent", lambda: readers.Told({}), lambda: False)
    assert readers.available() == ["told"] and readers.named("told")().answers == {}


def test_stages_resume_behind_the_last_snapshot(spark, tmp_path):
    add = lambda k: stages.Stage(k, lambda df, cfg, k=k: df.withColumn("trace", F.concat("trace", F.lit(k))))
    steps = [add("a"), add("b"), add("vlm_read")]
    df, cfg, root = spark.createDataFrame([("",)], "trace string"), config.defaults(), str(tmp_path)
    run = lambda **more: stages.process(df, steps, more.pop("cfg", cfg), root, **more)
    out, ran, took = run()
    assert out.first().trace == "abvlm_read" and ran == ["a", "b", "vlm_read"] and set(took) == set(ran)
    assert run()[1] == [] and run(force=True)[1] == ["a", "b", "vlm_read"] and run(rerun_from="b")[1] == ["b", "vlm_read"] and run(rerun_from="a")[1] == ["a", "b", "vlm_read"]
    assert run(rerun_from="b")[0].first().trace == "abvlm_read"
    assert run(cfg=config.apply(cfg, {"vlm.model": "new"}))[1] == ["a", "b", "vlm_read"]
    assert run(cfg=config.apply(cfg, {"vlm.api_key": "k"}))[1] == []
    with pytest.raises(ValueError):
        run(rerun_from="nope")
    assert [s.name for s in stages.without_readers(steps)] == ["a", "b"]


def test_folder_is_looked_at_once(spark, tmp_path):
    for name, data, age in (("a.pdf", b"%PDF-1", 60), ("b.pdf", b"%PDF-1", 60), ("c.png", b"\x89PNG\r\n\x1a\n1", 0), ("d.txt", b"no", 60)):
        (tmp_path / name).write_bytes(data)
        os.utime(tmp_path / name, (1_700_000_000 - age,) * 2)
    none = spark.createDataFrame([], "sha256 string")
    first = queue.scan_once(spark, str(tmp_path), none, 2.0, "2023-11-14 22:13:21")
    assert [r.source_path.rsplit("/", 1)[1] for r in first.collect()] == ["a.pdf"]
    assert queue.scan_once(spark, str(tmp_path), first, 2.0, "2023-11-14 22:13:21").count() == 0
    assert queue.scan_once(spark, str(tmp_path), first, 2.0, "2023-11-14 22:14:00").count() == 1
    assert {r.format for r in formats.peek(spark, str(tmp_path)).collect()} == {"pdf", "png", None}
    done = spark.createDataFrame([("x", "/in/a.pdf", None), ("y", "/in/b.png", "broken")], "sha256 string, source_path string, error string")
    good, bad = queue.split_outcomes(done)
    assert good.first().status == "done" and bad.first().error == "broken"
    assert [r[0] for r in done.select(queue.archive_name("/failed/", F.col("sha256"), F.col("source_path"))).collect()] == ["/failed/x.pdf", "/failed/y.png"]
    plan = spark.createDataFrame([("pdf",), ("tiff",), (None,)], "f string").select(formats.as_pdf(F.col("f")).alias("p")).collect()
    assert [(r.p.action, r.p.error) for r in plan] == [("keep", None), ("convert", None), ("refuse", "unsupported format")]


def test_manifests_and_result_rows(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"labels": [{"id": "one", "pdf": "x.pdf", "page": 3, "transcript": "one.txt"}, {"id": "two", "pdf": "y.pdf", "pages": [1, 2], "transcript": "two.txt", "render": True, "note": "n"}]}))
    rows = formats.manifest(spark, str(tmp_path / "m.json")).collect()
    assert [(r.id, r.pages, r.note, r.render) for r in rows] == [("one", [3], "", False), ("two", [1, 2], "n", True)] and rows[0].transcript.endswith("/one.txt")
    df = spark.createDataFrame([("a", 0.5)], "id string, recall double")
    for _ in range(2):
        formats.append_rows(df, str(tmp_path / "r"))
    assert formats.result_rows(spark, str(tmp_path / "r"), "id string, recall double").count() == 2


@settings(max_examples=200, deadline=None)
@given(st.text("ab ", max_size=14), st.text("ab ", max_size=14))
def test_edit_counts_are_those_of_the_whole_table(a, b):
    assert metrics.edit_counts(a, b) == metrics.edit_ops(list(a), list(b))


def test_scores(spark):
    s = metrics.score("harbour  lights", "harbor lights x")
    assert (s["ref_chars"], s["char_errors"], s["char_ins"], s["ref_words"], s["word_errors"], s["word_overlap"]) == (14, 3, 2, 2, 2, 1)
    assert metrics.score("ÉTÉ", "e\u0301té", caseless=True)["cer"] == 0 and metrics.score("", "ab")["cer"] == 2 and metrics.score(None, None)["word_recall"] == 0
    rng = random.Random(3)
    rows = [(k, "x" if k % 2 else "y", "".join(rng.choice("abc ") for _ in range(30)), "".join(rng.choice("abc ") for _ in range(30))) for k in range(12)]
    df = spark.createDataFrame([*rows, (99, "y", None, "")], "id int, g string, ref string, hyp string")
    got = {r.id: r for r in metrics.pair_scores(df, "ref", "hyp").collect()}
    assert all(got[k].asDict()[c] == v for k, _, a, b in rows for c, v in metrics.score(a, b).items()) and got[99].ref_chars == 1
    card = {r.g: r for r in metrics.scorecard(metrics.pair_scores(df, "ref", "hyp"), "g").collect()}
    assert card[None].pages == 13 and card[None].cer == sum(r.char_errors for r in got.values()) / sum(r.ref_chars for r in got.values())


def test_reading_bands(spark):
    rows = [(1, 0, 0, 200.0, 10.0, 20.0), (1, 0, 1, 20.0, 13.0, 23.0), (1, 0, 2, 20.0, 40.0, 50.0), (1, 0, 3, None, None, None), (1, 0, 4, 10.0, 44.0, 54.0)]
    df = spark.createDataFrame(rows, "doc_id long, pg int, ix int, x0 double, y0 double, y1 double")
    assert [r.ix for r in bands.reading_bands(df).orderBy("rank").collect()] == [1, 0, 4, 2, 3]
    assert bands.reading_bands(df.limit(0)).count() == 0


def test_adaptive_sample(spark):
    df = spark.range(1000)
    assert experiments.adaptive_sample(df, "id", 0.1, 1000).count() == 1000
    assert experiments.adaptive_sample(df, "id", 10, 1000).count() == 150


def test_command_line(spark, capsys, tmp_path):
    assert cli.main(["--list"]) == 0 and "page_markdown" in capsys.readouterr().out
    assert cli.main(["/root/testdata/sf0.001", "layout_kinds", "--report", str(tmp_path / "r.md")]) == 0
    assert "| kind | n |" in (tmp_path / "r.md").read_text()
