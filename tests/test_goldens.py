"""Small hand-made cases with known answers."""

from __future__ import annotations

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellum.functions import geometry, metrics
from vellum.functions import text as tx
from vellum.operators import align, compose, guards, jobs, placement
from vellum.sources import formats
from vellum.streaming import queue


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text, n", [("the cat sat", 3), ("图图图", 3), ("图2 test", 3), ("", 0), ("  ", 0)])
def test_tokens(spark, text, n):
    assert len(one(spark, tx.tokens(F.lit(text)))) == n


@pytest.mark.parametrize("a, b, want", [("abc", "abc", (0, 0, 0)), ("abc", "axc", (1, 0, 0)), ("abc", "ac", (0, 1, 0)), ("ac", "abc", (0, 0, 1)), ("", "ab", (0, 0, 2)), ("ab", "", (0, 2, 0))])
def test_edit_ops(a, b, want):
    assert metrics.edit_ops(list(a), list(b)) == want


@settings(max_examples=200, deadline=None)
@given(st.text("abç", max_size=30), st.text("abç", max_size=30))
def test_bit_distance_is_the_edit_distance(a, b):
    assert metrics.bit_distance(a, b) == sum(metrics.edit_ops(list(a), list(b)))


def test_distance_of_short_and_long_lines(spark):
    rows = [("kitten", "sitting"), ("x" * 5000 + "y", "x" * 5000), (None, "a"), ("", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert [r[0] for r in df.select(metrics.distance(F.col("a"), F.col("b"))).collect()] == [3, 1, None, 0]


@pytest.mark.parametrize("text, script", [("Ünïcode café", "latin"), ("สวัสดี", "thai"), ("слово", "cyrillic"), ("", "latin"), ("12:30 --", "latin"), ("中文 abc", "cjk")])
def test_script(spark, text, script):
    assert one(spark, tx.script(F.lit(text))) == script


def test_normalize_and_casefold(spark):
    assert one(spark, tx.normalize(F.lit("a   b\n\n c"))) == "a b c"
    assert one(spark, tx.normalize(F.lit("é"))) == "é"
    assert one(spark, tx.full_casefold(F.lit("Straße"))) == "strasse"
    assert one(spark, tx.safe_filename(F.lit("/tmp/x/../a.pdf"))) == "a.pdf"
    assert one(spark, tx.safe_filename(F.lit("/tmp/.."))) == "upload.pdf"


@pytest.mark.parametrize(
    "text, detected, want",
    [("", 0, True), (None, 0, True), ("  \n", 0, True), ("[IMAGE]", 0, True), ("Alas, I cannot tell.", 0, True), ("As an AI, no.", 0, True), ("ab", 400, True), ("ab", 70, False), ("river " * 90, 500, True), (" ".join(f"stone{k}" for k in range(90)), 500, False), ("a quiet line", 0, False), ("I cannot " + " ".join(f"say{k}" for k in range(60)), 0, False)],
)
def test_refusal(spark, text, detected, want):
    assert one(spark, guards.refused(F.lit(text).cast("string"), F.lit(detected))) is want


@pytest.mark.parametrize("text, want", [("(blur) " * 90, True), ("~" * 3000, True), ("= " * 300, True), (" ".join(f"reed{k}" for k in range(250)), False), ("Sum: 4.20", False), ("", False), ("abc" * 70, True)])
def test_degenerate(spark, text, want):
    assert one(spark, guards.degenerate(F.lit(text))) is want


@pytest.mark.parametrize("other, share", [((0, 0, 100, 100), 1.0), ((200, 200, 300, 300), 0.0), ((50, 0, 150, 100), 0.5), ((0, 0, 50, 50), 1.0)])
def test_overlap_fraction(spark, other, share):
    lit = lambda b: tuple(F.lit(float(x)) for x in b)
    assert one(spark, geometry.overlap_fraction(lit((0, 0, 100, 100)), lit(other))) == share


BOX = "doc_id long, pg int, ix int, x0 double, y0 double, x1 double, y1 double, "


def test_mixed_page_keeps_the_text_layer_header(spark):
    layer = spark.createDataFrame([(1, 0, 0, 10.0, 10.0, 590.0, 45.0, False), (1, 0, 1, 10.0, 10.0, 400.0, 40.0, True)], BOX + "contaminated boolean")
    found = spark.createDataFrame([(1, 0, 5, 12.0, 12.0, 588.0, 43.0), (1, 0, 6, 12.0, 312.0, 588.0, 343.0)], BOX.rstrip(", "))
    assert [r.ix for r in compose.superseded(found, layer).collect()] == [5]
    assert [r.ix for r in compose.kept(found, layer).collect()] == [6]
    assert compose.contaminated_superseded(found, layer).count() == 0


def test_placement(spark):
    seg = BOX + "det_text string"
    two = spark.createDataFrame([(1, 0, 0, 0.0, 0.0, 20.0, 10.0, "hello"), (1, 0, 1, 0.0, 50.0, 20.0, 60.0, "world")], BOX + "t string")
    apart = spark.createDataFrame([(1, 0, 0, 0.0, 0.0, 20.0, 10.0, "hello"), (1, 0, 1, 0.0, 50.0, 20.0, 60.0, "world")], seg)
    joint = spark.createDataFrame([(1, 0, 0, 0.0, 0.0, 20.0, 10.0, "hello world")], seg)
    for segments, want in ((apart, (2, 2, 2)), (joint, (1, 2, 2))):
        r = placement.counts(placement.strict(segments, two), segments, two).first()
        assert (r.placed, r.plain, r.total) == want
    tall = spark.createDataFrame([(1, 0, 0, 0.0, 0.0, 30.0, 40.0, "alpha beta")], seg)
    lines = spark.createDataFrame([(1, 0, 0, 0.0, 0.0, 30.0, 18.0, "alpha"), (1, 0, 1, 0.0, 20.0, 30.0, 38.0, "beta")], BOX + "t string")
    assert placement.counts(placement.strict(tall, lines), tall, lines).first().placed == 1
    assert placement.counts(placement.band(tall, lines), tall, lines).first().placed == 2


@pytest.mark.parametrize("rotation, want", [(0, "CBA"), (90, "ABC"), (180, "ABC"), (270, "CBA")])
def test_rotated_order(spark, rotation, want):
    boxes = {"A": (10, 70, 30, 90), "B": (90, 30, 110, 50), "C": (170, 0, 190, 20)}
    width, height = (100, 200) if rotation in (90, 270) else (200, 100)
    rows = [(k, (b[0] + b[2]) / 2, (b[1] + b[3]) / 2) for k, b in boxes.items()]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    if rotation in (90, 270):
        width, height = 200, 100
    _, dy = geometry.displayed(F.col("x"), F.col("y"), F.lit(rotation), F.lit(float(width)), F.lit(float(height)))
    assert "".join(r.k for r in df.orderBy(dy).collect()) == want


def test_clusters_and_fusion():
    assert align.cluster_lines([(0, 10, 40, 30), (60, 12, 90, 31), (5, 50, 70, 70)]) == [[0, 1], [2]]
    assert align.fuse(["M0rn1ng ta1de", "cornes ear1y"], [0.5, 0.5], "Morning tide\ncomes early") == ["Morning tide", "comes early"]
    # One line of prose flows over the short lines that it covers.
    assert align.fuse(["qu1et r1ver", "runs s1owly", "to the sea"], [0.4] * 3, "quiet river runs slowly to the sea") == ["quiet river", "runs slowly", "to the sea"]
    assert align.fuse(["Freight 42.50 due"], [0.97], "herons nest in upland bogs") == [""]
    assert align.fuse(["Fre1ght 42.5O dve"], [0.2], "Freight 42.50 due") == ["Freight 42.50 due"]
    assert align.fuse(["one"], [0.2], "  ") == [""]
    assert align.spread_words(["ggg kkk", "ppp"], "alder birch") is None
    assert align.align(["north gate", "south gate"], ["north gate!", "south gate."]) == {0: 0, 1: 1}
    assert align.similarity("tide", "diet") == 0.25 and align.similarity("diet", "tide") == 0.5


def test_columns_are_read_one_after_the_other():
    boxes = [(0, 0, 40, 10), (60, 0, 100, 10), (0, 20, 40, 30), (60, 20, 100, 30), (200, 5, 220, 15)]
    left, right = (0, 0, 50, 100), (55, 0, 110, 100)
    assert align.cluster_by_region(boxes, [left, right], [0, 1]) == [[0], [2], [1], [3], [4]]
    assert align.cluster_by_region(boxes, [left, right], [1, 0]) == [[1], [3], [0], [2], [4]]


def _whole_table(left, right, gap=align.GAP):
    from difflib import SequenceMatcher

    same = lambda a, b: SequenceMatcher(None, a.lower(), b.lower()).ratio() if a and b else 0.0
    best = [[0.0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i in range(len(left) + 1):
        for j in range(len(right) + 1):
            ways = [best[i - 1][j] + gap] if i else []
            ways += [best[i][j - 1] + gap] if j else []
            ways += [best[i - 1][j - 1] + same(left[i - 1], right[j - 1])] if i and j else []
            best[i][j] = max(ways, default=0.0)
    out, i, j = [], len(left), len(right)
    while i or j:
        if i and j and best[i][j] == best[i - 1][j - 1] + same(left[i - 1], right[j - 1]):
            i, j = i - 1, j - 1
            out.append((i, j))
        elif i and best[i][j] == best[i - 1][j] + gap:
            i -= 1
            out.append((i, None))
        else:
            j -= 1
            out.append((None, j))
    return out[::-1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abA1", min_size=1, max_size=5), max_size=25), st.lists(st.text("abA1", min_size=1, max_size=5), max_size=25))
def test_pruned_alignment_is_that_of_the_whole_table(a, b):
    assert align.steps(a, b) == _whole_table(a, b)


def test_fused_segments_keep_engine_box_and_confidence(spark):
    seg = BOX + "det_text string, det_conf double, engine string"
    segments = spark.createDataFrame([(1, 0, 0, 0.0, 0.0, 20.0, 10.0, "warm ra1n", 0.4, "vision"), (1, 0, 1, 30.0, 1.0, 50.0, 11.0, "fal1s", None, "vision"), (1, 0, 2, 0.0, 40.0, 50.0, 50.0, "Pier 9 shut", 0.95, "vision")], seg)
    told = spark.createDataFrame([(1, 0, "warm rain falls", "m")], "doc_id long, pg int, reading string, model string")
    rows = align.fuse_pages(segments, told).orderBy("line").collect()
    assert [(r.best_text, r.source, r.read_by, r.det_conf) for r in rows] == [("warm rain falls", "fused", "m", 0.4), ("Pier 9 shut", "vision", "", 0.95)]
    assert (rows[0].x0, rows[0].x1, rows[0].id, rows[0].members) == (0.0, 50.0, "p0-f0", [0, 1])
    assert align.fuse_pages(segments.limit(0), told).count() == 0


def test_fill_cells(spark):
    html = "<table><tr><td></td><td class='a'></td><td></td><td> </td></tr></table>"
    cells = F.array(F.struct(F.lit("A & B").alias("text"), F.lit("clean").alias("confidence")), F.struct(F.lit("C").alias("text"), F.lit("clean").alias("confidence")))
    got = one(spark, tx.fill_cells(F.lit(html), cells))
    assert got.count('data-confidence="clean"') == 2 and "A &amp; B" in got and got.count("<td></td>") == 1 and "<td> </td>" in got


@pytest.mark.parametrize("head, fmt", [(b"%PDF-1.7", "pdf"), (b"\x89PNG\r\n\x1a\nx", "png"), (b"\xff\xd8\xff\xe0", "jpeg"), (b"II*\0x", "tiff"), (b"MM\0*x", "tiff"), (b"text", None), (b"", None)])
def test_sniff(spark, head, fmt):
    assert one(spark, formats.sniff(F.lit(head))) == fmt


def test_annotation_loaders(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"ocr_boxes": [{"points": [[0, 0], [1, 0], [1, 1], [0, 1]], "text": "one"}, {"points": [], "text": "two"}]}))
    assert formats.box_list(spark, str(tmp_path / "a.json")).first().text == "one\ntwo"
    (tmp_path / "b.json").write_text(json.dumps({"form": [{"text": "Name", "box": [0, 0, 1, 1], "label": "q"}, {"text": "", "box": [0, 0, 1, 1]}]}))
    assert formats.form_list(spark, str(tmp_path / "b.json")).first().text == "Name"


def test_jobs_by_event(spark):
    assert jobs.step("", "queued") == "queued" and jobs.step("queued", "queued") == "queued"
    assert jobs.step("running", "running") == "running" and jobs.step("done", "running") == "done"
    assert jobs.step("done", "running", reprocess=True) == "running"


def test_drop_folder_is_queued_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, data in (("a.pdf", b"%PDF-1"), ("b.pdf", b"%PDF-1"), ("c.txt", b"no")):
        (tmp_path / "in" / name).write_bytes(data)
    stream = queue.enqueue(queue.drop_folder(spark, str(tmp_path / "in")))
    got = queue.run_available(stream, "queued_jobs", str(tmp_path / "state")).collect()
    assert len(got) == 1 and got[0].status == "queued"


def test_streamed_windows_equal_the_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").filter("event_id < 200")
    events.write.parquet(str(tmp_path / "e"))
    stream = queue.tumbling(spark.readStream.schema(events.schema).parquet(str(tmp_path / "e")))
    got = queue.run_available(stream, "windows", str(tmp_path / "s"), "complete").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, queue.tumbling(events).collect()))
