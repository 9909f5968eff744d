"""SimHash near-duplicate detection by multi-index hashing.

A 64-bit fingerprint is cut into segments.  Two fingerprints at most R bits apart
agree within a small radius on at least one segment, so each one probes the Hamming
ball around each of its segments in that segment's table, and every match is
verified over all 64 bits.  With s = R // m and a = R - m * s the first a + 1
segments need radius s, the others s - 1.

Equal fingerprints are folded to one class before any probing.  A bucket of a segment
table that holds more than ``bucket`` classes is not joined: its members and probers go
through midpoints instead.  Two fingerprints are within 4 bits exactly if some midpoint is
within 2 bits of both, so (midpoint, class) rows grouped by midpoint link the same pairs by
stars, in work linear in the number of classes.  No pair is dropped either way.

Cases: a null or word-less text has fingerprint zero and links like any other; a text of
fewer words than the shingle is one shingle; repeated rows keep their own output row; a row
with a null doc_id gets the component of its fingerprint, and null if no id is in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dealt, free_names, materialize, scratch
from .components import connected_components

SEED = 42
RADIUS = 4
BUCKET = 128
#: Rows to remove that may be broadcast: two numbers each.
BROADCAST_ROWS = 1_000_000
_LANES = (np.arange(8, dtype=np.uint16) * 256)[None, :]
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(text: str | None, shingle: int) -> list[int]:
    """Hash of each run of ``shingle`` words; fewer words are one run, none give nothing."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return [digest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = shingle - 1
    return [digest(joined[s:e], SEED) for s, e in zip(starts[:-last or None].tolist(), ends[last:].tolist())]


def fingerprint(hashes: list[int] | np.ndarray) -> int:
    """Bits set in over half of the hashes; zero for none."""
    if not len(hashes):
        return 0
    lanes = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8) + _LANES
    counts = np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int.from_bytes(np.packbits((2 * counts > len(hashes)).ravel(), bitorder="little").tobytes(), "little")


def text_fingerprint(text: str | None, shingle: int = 4) -> int:
    return fingerprint(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, h, fp long) of every row; ``h`` is a hash of the text that tells rows of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((text_fingerprint(t.as_py(), shingle) for t in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], names=["doc_id", "h", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), "text").mapInArrow(run, "doc_id long, h long, fp long")


def _segments(m: int) -> list[tuple[int, int]]:
    edges = [64 * k // m for k in range(m + 1)]
    return list(zip(edges[:-1], (b - a for a, b in zip(edges, edges[1:]))))


def _ball(width: int, radius: int) -> list[int]:
    masks = [0]
    if radius >= 1:
        masks += [1 << i for i in range(width)]
    if radius >= 2:
        masks += [1 << i | 1 << j for i in range(width) for j in range(i)]
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _segment(fp: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))


def linked_classes(classes: DataFrame, segments: int, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b), a < b, that connect ``classes`` (rep, fp) exactly as all pairs within RADIUS bits do."""
    radius, rest = RADIUS // segments, RADIUS % segments
    tables, probes = [], []
    for k, (low, width) in enumerate(_segments(segments)):
        value = _segment(F.col("fp"), low, width)
        r = radius if k <= rest else radius - 1
        key = F.lit(k << 40).bitwiseOR(value)
        tables.append(key)
        probes += [key.bitwiseXOR(F.lit(x)) for x in _ball(width, r)]
    stored = classes.select(F.explode(F.array(*tables)).alias("key"), "rep", "fp")
    probing = classes.select(F.explode(F.array(*probes)).alias("key"), F.col("rep").alias("rep2"), F.col("fp").alias("fp2"))
    hot = materialize(stored.groupBy("key").count().filter(F.col("count") > bucket).select("key"), "simhash-hot")
    close = (F.col("rep") < F.col("rep2")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= RADIUS)
    if hot.isEmpty():
        return dealt(stored, probing, "key").filter(close).select(F.col("rep").alias("a"), F.col("rep2").alias("b")).distinct()
    pairs = dealt(stored.join(hot, "key", "left_anti"), probing, "key").filter(close)
    pairs = pairs.select(F.col("rep").alias("a"), F.col("rep2").alias("b"))
    crowd = probing.join(hot, "key", "left_semi").select(F.col("rep2").alias("rep"), F.col("fp2").alias("fp")).distinct()
    ball = F.array([F.lit(_signed(x)) for x in _ball(64, RADIUS // 2)])
    middle = crowd.select("rep", "fp", F.explode(ball).alias("x")).select("rep", F.col("fp").bitwiseXOR(F.col("x")).alias("mid"))
    stars = middle.groupBy("mid").agg(F.min("rep").alias("a"), F.collect_list("rep").alias("bs")).filter(F.size("bs") > 1)
    stars = stars.select("a", F.explode("bs").alias("b")).filter("a < b")
    return pairs.union(stars).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, segments: int | None = None, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, h, fp, component_id): fingerprints link at 4 or fewer differing bits, components are the
    closure, named by their smallest doc_id.  ``segments``: 3, or 2 (longer keys, larger balls) from
    2**26 distinct fingerprints on; either finds every pair."""
    prints = materialize(fingerprints(docs, shingle), "simhash-prints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("rep")).filter("rep is not null")
    classes = materialize(classes, "simhash-classes")
    if segments is None:
        segments = 3 if classes.count() < 1 << 26 else 2
    edges = linked_classes(classes, segments, bucket)
    labels = connected_components(edges)
    named = dealt(classes, labels.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("fp", F.coalesce("component", "rep").alias("component_id"))
    return _spread(prints, named)


def _spread(prints: DataFrame, named: DataFrame, salts: int = 16) -> DataFrame:
    """Join classes back to rows; the class side is repeated per salt, so that one frequent fingerprint
    does not land in one task."""
    left = prints.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    right = named.withColumn("salt", F.explode(F.array([F.lit(i).cast("long") for i in range(salts)])))
    return dealt(left, right, ["fp", "salt"], "left").select("doc_id", "h", "fp", "component_id")


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without all but the first of each component of fingerprints."""
    with scratch(docs.sparkSession):
        return first_of_each(docs, near_duplicates(docs, **options))


def first_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with one row of each component of ``found`` (doc_id, h, fp, component_id), all columns kept: the row whose
    id names the component; of several rows of that id and fingerprint, the one with the least h, then the least
    columns.  Rows of the id with another fingerprint stay.  Rows without an id stay, since nothing names them.

    Only ids and hashes are shuffled.  Rows to remove are broadcast up to BROADCAST_ROWS, beyond it they meet the
    documents in a sort-merge join."""
    named = found.filter("doc_id is not null").select("doc_id", "h", "fp", "component_id")
    own = named.filter("doc_id = component_id").groupBy("doc_id", "fp").agg(F.min("h").alias("first"), F.count("*").alias("k"))
    losers = named.filter("doc_id <> component_id").select("doc_id", "h")
    several = materialize(own.filter("k > 1").select("doc_id", "fp", "first"), "simhash-repeats", keep=True)
    if not several.isEmpty():
        losers = losers.union(named.filter("doc_id = component_id").join(several, ["doc_id", "fp"]).filter("h <> first").select("doc_id", "h"))
    d, h, first = free_names(docs.columns, "_d", "_h", "_first")
    losers = materialize(losers.distinct().withColumnsRenamed({"doc_id": d, "h": h}), "simhash-losers", keep=True)
    small = losers.count() <= BROADCAST_ROWS
    same = (docs["doc_id"].cast("long") == F.col(d)) & (F.xxhash64(docs["text"]) == F.col(h))
    kept = docs.join(F.broadcast(losers) if small else losers, same, "left_anti")
    if several.isEmpty():
        return kept
    # Repeats of the row that stays: the least by its columns.
    named_once = several.select(F.col("doc_id").alias(d), F.col("first").alias(first))
    same = (kept["doc_id"].cast("long") == F.col(d)) & (F.xxhash64(kept["text"]) == F.col(first))
    single = kept.join(named_once, same, "left_anti")
    whole = F.struct(*kept.columns)
    order = F.struct(*(c for c, t in kept.dtypes if "map<" not in t and t != "variant"))
    repeats = kept.join(named_once, same, "left_semi").groupBy("doc_id", F.xxhash64("text").alias(h)).agg(F.min_by(whole, order).alias(first))
    return single.unionByName(repeats.select(f"{first}.*"))
