"""Near-duplicates by exact similarity of word-shingle sets.

Two texts link if the Jaccard similarity of their sets of five-word shingles is at least 4/5.
Candidates come first from multi-index hashing of the sets' SimHash fingerprints, as in simhash.  Sets of similarity
0.8 differ by about 10 of 64 bits, which no segment table reaches short of comparing a large part of all pairs;
so sets that lie beyond the fingerprints' radius of 4 bits and are not connected yet meet in bands: 32 of four
min-hashes, of which a pair at similarity 0.8 shares none with probability (1 - 0.8**4)**32 < 5e-8, a more similar one
still less often.  Every candidate is verified on the whole sets, so nothing below 0.8 links.

Equal sets are folded to one class first.  Pairs that share rare shingles are compared directly; beside them, a
set with many rare shingles cannot reach 4/5 with any other and leaves.  In a band's bucket every member is compared with one centre, then with a few more, and at last all pairs
that no component joins yet are compared: a group of copies of one text takes work near linear in its size, and no
pair that could link is dropped.

Cases: texts without words are alike and link to each other only; a text of fewer words than the
shingle is one shingle; repeated rows and rows without an id are as in simhash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dealt, materialize, new_path, remove, scratch
from .components import ONE_TASK, connected_components
from .simhash import BROADCAST_ROWS, _spread, fingerprint, first_of_each, linked_classes, shingle_hashes

SHINGLE = 5
BANDS, ROWS = 32, 4
#: Centres of each bucket in the rounds before all remaining pairs are compared.
CENTRES = (1, 4)
#: Members of a bucket that one task compares; a larger bucket is split into parts.
SHARE = 256
#: Sets that a rare shingle is in at most.
RARE = 8
PART = 1024
_RNG = np.random.default_rng(42)
_XORS = _RNG.integers(0, 1 << 64, BANDS * ROWS, np.uint64)
_ODDS = _RNG.integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)
_NAMES = _RNG.integers(0, 1 << 64, BANDS, np.uint64)


def text_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct shingle hashes, ascending."""
    return np.unique(np.array(shingle_hashes(text, shingle), np.uint64))


def band_keys(members: np.ndarray) -> np.ndarray:
    """One key a band; none for an empty set."""
    if not len(members):
        return np.zeros(0, np.uint64)
    least = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    for s in range(0, len(members), PART):
        mixed = members[s : s + PART, None] ^ _XORS
        mixed *= _ODDS
        np.minimum(least, mixed.min(axis=0), out=least)
    keys = _NAMES.copy()
    for row in least.reshape(BANDS, ROWS).T:
        keys = (keys ^ row) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(a) for a in arrays], dtype=np.int64))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*arrays, np.zeros(0, np.uint64)]).view(np.int64)))


def read_sets(docs: DataFrame, shingle: int, whole: bool) -> DataFrame:
    """(doc_id, h, fp binary, n, sim, and band keys or, if ``whole``, members) of every row; ``fp`` names the set, ``h`` the
    text, ``sim`` is the set's SimHash fingerprint."""
    last = "members" if whole else "keys"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for all_rows in batches:
            for at in range(0, all_rows.num_rows, PART):
                b = all_rows.slice(at, PART)
                sets = [text_set(t.as_py(), shingle) for t in b.column(2)]
                made = [b.column(0), b.column(1), pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in sets], pa.binary()), pa.array([len(x) for x in sets], pa.int32())]
                made.append(pa.array(np.fromiter(map(fingerprint, sets), np.uint64, len(sets)).view(np.int64)))
                yield pa.RecordBatch.from_arrays([*made, _lists(sets if whole else [band_keys(x) for x in sets])], names=["doc_id", "h", "fp", "n", "sim", last])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), "text").mapInArrow(run, f"doc_id long, h long, fp binary, n int, sim long, {last} array<long>")


def close_sets(own: DataFrame, segments: int | None = None) -> DataFrame:
    """Pairs (a, b), a < b, of the sets ``own`` (rep, v, sim) that connect them as all pairs of fingerprints within the
    radius do: multi-index hashing links fingerprints, the sets of one fingerprint meet the least of them."""
    sims = materialize(own.groupBy("sim").agg(F.min("rep").alias("rep")), "sets-sims")
    if segments is None:
        segments = 3 if sims.count() < 1 << 26 else 2
    linked = linked_classes(sims.select("rep", F.col("sim").alias("fp")), segments)
    equal = _spread(own.select(F.col("rep").alias("doc_id"), F.col("v").alias("h"), F.col("sim").alias("fp")), sims.select(F.col("sim").alias("fp"), F.col("rep").alias("component_id")))
    return linked.union(equal.filter("component_id < doc_id").select("component_id", "doc_id")).distinct()


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) of similarity 4/5 or more, by their ``sets`` (rep, members)."""
    both = pairs.join(sets.select(F.col("rep").alias("a"), F.col("members").alias("x")), "a").join(sets.select(F.col("rep").alias("b"), F.col("members").alias("y")), "b")
    return both.filter(9 * F.size(F.array_intersect("x", "y")) >= 4 * (F.size("x") + F.size("y"))).select("a", "b").distinct()


def _ordered(pairs: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b, of ``pairs`` (r1, n1, u1, c1, r2, n2, u2, c2) that may reach 4/5 and are not connected yet."""
    fit = (F.col("c1") != F.col("c2")) & (5 * F.least("n1", "n2") >= 4 * F.greatest("n1", "n2"))
    fit = fit & (9 * F.least(F.col("n1") - F.col("u1"), F.col("n2") - F.col("u2")) >= 4 * (F.col("n1") + F.col("n2")))
    return pairs.filter(fit).select(F.least("r1", "r2").alias("a"), F.greatest("r1", "r2").alias("b")).distinct()


def can_link(met: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``met`` with ``u``, the number of a set's rare shingles (in RARE met sets at most), and the pairs (a, b) that
    share rare shingles and may reach 4/5.  Any other pair shares none, so that a set with too many rare ones for a
    common part of 4/9 of both sizes, with any member of its bucket, leaves."""
    told = sets.select("rep", "v", F.explode("members").alias("x"))
    rare = told.groupBy("x").agg(F.count("*").alias("k")).filter(F.col("k") <= RARE)
    sizes = sets.select("rep", "v", F.size("members").alias("n"))
    own = materialize(told.join(rare, "x").select("x", "rep", "v", "k"), "sets-rare")
    counts = materialize(own.groupBy("rep", "v").agg(F.count("*").alias("u")), "sets-own")
    side = lambda m, at: [F.col(f"{m}.{c}").alias(f"{c}{at}") for c in ("rep", "v", "n")]
    near = own.filter("k > 1").join(sizes, ["rep", "v"]).groupBy("x").agg(F.collect_list(F.struct("rep", "v", "n")).alias("l"))
    near = near.select("l", F.explode("l").alias("m")).select("m", F.explode("l").alias("o")).filter("m.rep < o.rep")
    near = near.select(*side("m", 1), *side("o", 2)).groupBy("rep1", "v1", "n1", "rep2", "v2", "n2").agg(F.count("*").alias("r"))
    near = near.filter(5 * F.least("n1", "n2") >= 4 * F.greatest("n1", "n2"))
    for at in "12":
        near = near.join(counts.select(F.col("rep").alias(f"rep{at}"), F.col("v").alias(f"v{at}"), F.col("u").alias(f"u{at}")), [f"rep{at}", f"v{at}"])
    near = near.filter(9 * (F.least(F.col("n1") - F.col("u1"), F.col("n2") - F.col("u2")) + F.col("r")) >= 4 * (F.col("n1") + F.col("n2")))
    least = met.groupBy("key").agg(F.min("n").alias("low"))
    members = met.join(counts, ["rep", "v"], "left").withColumn("u", F.coalesce("u", F.lit(0))).join(least, "key")
    members = members.filter(9 * (F.col("n") - F.col("u")) >= 4 * (F.col("n") + F.greatest(F.col("low"), F.ceil(F.col("n") * 4 / 5)))).select("key", "rep", "n", "u")
    return members, near.select(F.col("rep1").alias("a"), F.col("rep2").alias("b")).distinct()


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) that ``labels`` do not connect yet."""
    for at in "ab":
        pairs = dealt(pairs, labels.select(F.col("node").alias(at), F.col("component").alias(f"c{at}")), at, "left")
    return pairs.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def _joined(labels: DataFrame | None, found: DataFrame) -> DataFrame:
    """``labels`` with the links ``found``; those before are in the labels, one a node."""
    edges = found if labels is None else labels.select(F.col("component").alias("a"), F.col("node").alias("b")).union(found)
    return materialize(connected_components(edges, one_task=ONE_TASK), "sets-labels")


def linked_sets(members: DataFrame, near: list[DataFrame], sets: DataFrame, centres: tuple[int, ...] = CENTRES) -> DataFrame | None:
    """(node, component) of all nodes that links connect; ``members`` has key, rep, n, u of the buckets, ``near`` lists more
    candidates, each verified where those before have not connected it."""
    labels = None
    for pairs in near:
        found = materialize(verified(pairs if labels is None else _apart(pairs, labels), sets), "sets-edges")
        if not found.isEmpty():
            labels = _joined(labels, found)
    for k in (*centres, 0):
        now = members.withColumn("c", F.col("rep"))
        if labels is not None:
            now = members.join(labels, members["rep"] == labels["node"], "left").select("key", "rep", "n", "u", F.coalesce("component", "rep").alias("c"))
        open_keys = now.groupBy("key").agg(F.min("c").alias("c1"), F.max("c").alias("c2"), F.ceil(F.count("*") / SHARE).alias("parts")).filter("c1 < c2").select("key", "parts")
        now = materialize(now.join(open_keys, "key"), "sets-open")
        one = now.select("key", "parts", *(F.col(x).alias(y) for x, y in (("rep", "r1"), ("n", "n1"), ("u", "u1"), ("c", "c1"))))
        if k:
            # The first centre is the set with the fewest rare shingles, as the common origin of copies has.
            first = lambda i: (F.col("u1") / F.col("n1")) if i == 0 else F.xxhash64("r1", F.lit(i)).cast("double")
            one = one.groupBy("key", "parts").agg(F.array_distinct(F.array(*(F.min(F.struct(first(i).alias("o"), "r1", "n1", "u1", "c1")) for i in range(k)))).alias("m"))
            one = one.select("key", "parts", F.explode("m").alias("m")).select("key", "parts", "m.r1", "m.n1", "m.u1", "m.c1")
        # The members of a large bucket are dealt to its parts, and those they are compared with go to each part.
        one = one.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
        two = now.select("key", F.pmod(F.xxhash64("rep"), "parts").alias("part"), *(F.col(x).alias(y) for x, y in (("rep", "r2"), ("n", "n2"), ("u", "u2"), ("c", "c2"))))
        pairs = one.join(two, ["key", "part"]) if k else one.join(two, ["key", "part"]).filter("r1 < r2")
        found = materialize(verified(_ordered(pairs), sets), "sets-edges")
        if not found.isEmpty():
            labels = _joined(labels, found)
    return labels


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, centres: tuple[int, ...] = CENTRES) -> DataFrame:
    """(doc_id, h, fp, component_id) of every row; components are the closure of the links, named by their smallest doc_id."""
    spark = docs.sparkSession
    read = materialize(read_sets(docs, shingle, False), "sets-read")
    classes = materialize(read.groupBy("fp").agg(F.min("doc_id").alias("rep")).filter("rep is not null"), "sets-classes")
    # ``v`` tells sets of one doc_id apart.
    v = F.xxhash64("fp").alias("v")
    own = read.select(F.col("doc_id").alias("rep"), "fp", v, "n", "sim", "keys").join(classes, ["rep", "fp"])
    path = new_path(spark, "sets-bands")
    banded = materialize(own.select(F.explode("keys").alias("key"), "rep", "v", "n"), "sets-bands", path)
    shared = banded.groupBy("key").agg(F.min("rep").alias("r1"), F.max("rep").alias("r2")).filter("r1 < r2").select("key")
    met = materialize(banded.join(shared, "key").distinct(), "sets-members")
    remove(spark, path)
    close = materialize(close_sets(own.select("rep", "v", "sim")), "sets-close")
    # Whole sets are made of the rows that share a bucket or lie close alone, where their texts are.
    ends = close.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    wanted = met.select("rep", "v").union(dealt(own.select("rep", "v"), ends, "rep")).distinct()
    rows = read.select(F.col("doc_id").alias("rep"), "h", v).join(wanted, ["rep", "v"])
    rows = materialize(rows.groupBy("rep", "v").agg(F.min("h").alias("h")).select(F.col("rep").alias("_rep"), F.col("h").alias("_h")).distinct(), "sets-rows")
    same = (F.col("doc_id") == F.col("_rep")) & (F.col("h") == F.col("_h"))
    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), "text").join(F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows, same, "left_semi")
    sets = read_sets(texts, shingle, True).select(F.col("doc_id").alias("rep"), v, "members")
    sets = materialize(sets.dropDuplicates(["rep", "v"]), "sets-met")
    members, near = can_link(met, sets)
    # Each set with the least that lies close first, so that a group of copies takes work linear in its size.
    stars = close.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    labels = linked_sets(materialize(members, "sets-linkable"), [stars, close, near], sets, centres)
    named = classes.select("fp", F.col("rep").alias("component_id"))
    if labels is not None:
        named = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return _spread(read.select("doc_id", "h", "fp"), named)


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without all but the first of each component."""
    with scratch(docs.sparkSession):
        return first_of_each(docs, near_duplicates(docs, **options))
