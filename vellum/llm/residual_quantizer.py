"""Approximate nearest neighbours by additive quantisation.

A vector is the sum of one codeword from each of several full-dimensional codebooks, each fitted to
what the earlier ones leave over; a beam search picks the codewords.  A query scores a code by table
look-ups (its products with all codewords) and the stored norm of the sum; the best of the whole index
are measured again on the original vectors.

Codebooks are fitted on at most ``sample`` rows by hash of the id; every row is indexed.  The index holds codes and
norms alone; the query set is dealt in blocks that are sent to it, and originals are read for the shortlists only.

Cases: vectors that are null, zero, of another length than most of the sample, or hold null or non-finite
components take no part as query or candidate; equal distances go to the smaller vec_id, also before
reranking; equal rows count once; different vectors of one vec_id are candidates each, and the least of them asks;
fewer candidates than k: all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fitted, materialize

SAMPLE = 8_192
BOOKS, WORDS, BEAM = 32, 256, 3
#: Candidates of each query, over the whole index, that are measured exactly.
SHORTLIST = 128
CANDIDATES, QUERIES, SLICE = 16_384, 1_024, 4_096
#: Query blocks that are broadcast at a time, and shortlist rows (two numbers each) that may be.
BLOCKS, BROADCAST_ROWS = 16, 1_000_000


def usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def _nearest_word(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    far = x @ words.T
    far *= -2
    far += (words**2).sum(1)
    return far.argmin(1)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 5) -> np.ndarray:
    words = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _nearest_word(x, words)
        order = near.argsort(kind="stable")
        used, first, n = np.unique(near[order], return_index=True, return_counts=True)
        made = x[rng.integers(0, len(x), len(words))]
        made[used] = np.add.reduceat(x[order], first, axis=0) / n[:, None]
        words = made
    return words.astype(np.float32)


@dataclass
class Quantizer:
    books: list[np.ndarray]

    @classmethod
    def fit(cls, x: np.ndarray, books: int = BOOKS, words: int = WORDS) -> Quantizer:
        rng, rest, found = np.random.default_rng(5), x.astype(np.float32), []
        for _ in range(books):
            c = _kmeans(rest, words, rng)
            found.append(c)
            rest = rest - c[_nearest_word(rest, c)]
        return cls(found)

    def encode(self, x: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Codes and squared norms of the sums, some rows at a time for the beams' sake."""
        if len(x) > 1_024:
            parts = [self.encode(x[s : s + 1_024], beam) for s in range(0, len(x), 1_024)]
            return np.concatenate([c for c, _ in parts]), np.concatenate([n for _, n in parts])
        n = len(x)
        rest = x.astype(np.float32)[:, None, :]
        codes = np.zeros((n, 1, 0), np.uint8)
        error = np.zeros((n, 1), np.float32)
        row = np.arange(n)
        for c in self.books:
            e = rest.reshape(-1, rest.shape[2]) @ c.T
            e *= -2
            e += (c**2).sum(1)
            e += error.reshape(-1, 1)
            flat = e.reshape(n, -1)
            take = min(beam, flat.shape[1])
            best = np.empty((n, take), np.int64)
            error = np.empty((n, take), np.float32)
            for k in range(take):  # a few passes for the least are faster than a partition
                best[:, k] = flat.argmin(1)
                error[:, k] = flat[row, best[:, k]]
                flat[row, best[:, k]] = np.inf
            at, word = best // len(c), best % len(c)
            rest = np.take_along_axis(rest, at[:, :, None], 1) - c[word]
            codes = np.concatenate([np.take_along_axis(codes, at[:, :, None], 1), word[:, :, None].astype(np.uint8)], axis=2)
        codes = codes[np.arange(n), error.argmin(1)]
        total = sum(c[codes[:, m]] for m, c in enumerate(self.books))
        return codes, (total**2).sum(1)

    def tables(self, q: np.ndarray) -> list[np.ndarray]:
        return [-2 * q @ c.T for c in self.books]


@dataclass
class _Shortlists:
    """The ``size`` best scored candidates so far of each query of a block, ties to the smaller ids."""

    z: Quantizer
    qid: np.ndarray
    size: int

    def start(self, q: np.ndarray) -> None:
        self.tables = self.z.tables(q.astype(np.float32))
        self.ids = np.zeros((len(self.qid), 0), np.int64)
        self.scores = np.zeros((len(self.qid), 0), np.float32)

    def add(self, ids: np.ndarray, codes: np.ndarray, norms: np.ndarray) -> None:
        """Score one block of candidates."""
        for s in range(0, len(ids), SLICE):
            part, own = codes[s : s + SLICE], ids[s : s + SLICE]
            score = np.repeat(norms[None, s : s + SLICE], len(self.qid), 0)
            for m, t in enumerate(self.tables):
                score += t[:, part[:, m]]
            score[own[None, :] == self.qid[:, None]] = np.inf
            self._keep(np.concatenate([self.scores, score], axis=1), np.concatenate([self.ids, np.broadcast_to(own, score.shape)], axis=1))

    def _keep(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if scores.shape[1] > self.size:
            edge = np.partition(scores, self.size - 1, axis=1)[:, self.size - 1 : self.size]
            # Below the edge all stay; of those on it the smaller ids, as many as there is room for.
            rank = np.where(scores < edge, np.int64(-1 << 62), np.where(scores == edge, ids, np.int64((1 << 63) - 1)))
            best = np.argpartition(rank, self.size - 1, axis=1)[:, : self.size]
            scores, ids = np.take_along_axis(scores, best, 1), np.take_along_axis(ids, best, 1)
        self.scores, self.ids = scores, ids

    def rows(self) -> pa.RecordBatch:
        found = np.isfinite(self.scores)
        which = np.repeat(self.qid[:, None], self.ids.shape[1], 1)[found]
        return pa.RecordBatch.from_arrays([pa.array(which), pa.array(self.ids[found]), pa.array(self.scores[found])], names=["query_id", "vec_id", "near"])


def fit(vectors: DataFrame, sample: int = SAMPLE) -> tuple[Quantizer | None, int]:

    def of(rows: pa.Table) -> tuple[Quantizer | None, int]:
        if not rows.num_rows:
            return None, 0
        rows = rows.sort_by("vec_id")
        lists = rows["embedding"].combine_chunks()
        lengths = np.asarray(pc.list_value_length(lists))
        d = int(np.bincount(lengths).argmax())
        x = lists.filter(pa.array(lengths == d)).flatten().to_numpy(zero_copy_only=False)
        return Quantizer.fit(x.astype(np.float32).reshape(-1, d)), d

    return fitted(vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample), of)


def _vectors(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and components of up to ``size`` rows at a time."""
    ids, xs, n = [], [], 0
    for b in batches:
        if not b.num_rows:
            continue
        i = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        x = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(i), -1)
        for s in range(0, len(i), size):
            ids.append(i[s : s + size])
            xs.append(x[s : s + size])
            n += len(ids[-1])
            if n >= size:
                yield np.concatenate(ids), np.concatenate(xs)
                ids, xs, n = [], [], 0
    if n:
        yield np.concatenate(ids), np.concatenate(xs)


def _index(vectors: DataFrame, z: Quantizer) -> DataFrame:
    """Rows of up to CANDIDATES vectors: ids, codes and norms as binary.  No components, and no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, x in _vectors(batches, CANDIDATES):
            codes, norms = z.encode(x)
            yield pa.RecordBatch.from_pydict({"ids": [i.tobytes()], "codes": [codes.tobytes()], "norms": [norms.astype(np.float32).tobytes()]})

    return vectors.select("vec_id", "embedding").mapInArrow(run, "ids binary, codes binary, norms binary")


def _query_blocks(queries: DataFrame, n: int) -> DataFrame:
    """(qb, qids, qx): the queries dealt by hash to ``n`` blocks."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("vec_id")
        x = group["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return pa.Table.from_pydict({"qb": group["qb"][:1], "qids": [group["vec_id"].to_numpy().astype(np.int64).tobytes()], "qx": [x.tobytes()]})

    dealt = queries.select(F.pmod(F.xxhash64("vec_id"), F.lit(n)).alias("qb"), "vec_id", "embedding")
    return dealt.groupBy("qb").applyInArrow(run, "qb long, qids binary, qx binary")


def _distinct(embeddings: DataFrame) -> DataFrame:
    """Usable rows, equal ones once.  Only rows of ids that occur more than once are shuffled whole."""
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    many = rows.groupBy("vec_id").count().filter("count > 1").select("vec_id")
    many = materialize(many, "ann-repeats")
    if many.isEmpty():
        return rows
    same = rows.join(many, "vec_id", "left_semi").distinct()
    return rows.join(many, "vec_id", "left_anti").unionByName(same)


def search(embeddings: DataFrame, is_query: Column, k: int = 10, shortlist: int = SHORTLIST) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by Euclidean distance of each query row.

    The queries go, QUERIES * BLOCKS of them at a time, to wherever the codes are; each task keeps one shortlist a
    query over all its codes, the shortlists of a query are merged to one of ``shortlist`` rows, and only those are
    measured on the original vectors."""
    spark = embeddings.sparkSession
    vectors = _distinct(embeddings)
    z, d = fit(vectors)
    if z is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    vectors = vectors.filter(F.size("embedding") == d)
    # An id with several vectors asks with the least of them.
    queries = materialize(vectors.filter(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "ann-queries")
    n = max(1, -(-queries.count() // QUERIES))
    blocks = materialize(_query_blocks(queries, n), "ann-blocks")
    index = materialize(_index(vectors, z), "ann-index")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Shortlists] = {}
        for b in batches:
            for ids, codes, norms, qb, qids, qx in zip(*(b.column(c).to_pylist() for c in range(6))):
                if qb not in held:
                    held[qb] = _Shortlists(z, np.frombuffer(qids, np.int64), shortlist)
                    held[qb].start(np.frombuffer(qx, np.float64).reshape(-1, d))
                i = np.frombuffer(ids, np.int64)
                held[qb].add(i, np.frombuffer(codes, np.uint8).reshape(len(i), -1), np.frombuffer(norms, np.float32))
        for lists in held.values():
            yield lists.rows()

    best = F.row_number().over(Window.partitionBy("query_id").orderBy("near", "vec_id"))
    found = None
    for at in range(0, n, BLOCKS):
        few = blocks.filter(F.col("qb").between(at, at + BLOCKS - 1))
        met = index.withColumn("qb", F.explode(F.sequence(F.lit(at).cast("long"), F.lit(min(n, at + BLOCKS) - 1).cast("long")))).join(F.broadcast(few), "qb")
        near = met.select("ids", "codes", "norms", "qb", "qids", "qx").mapInArrow(run, "query_id long, vec_id long, near float")
        # An id with two vectors may be listed twice.
        near = near.withColumn("n", best).filter(F.col("n") <= shortlist).select("query_id", "vec_id").distinct()
        near = materialize(near, "ann-near")
        found = near if found is None else found.union(near)
    few = found.count() <= BROADCAST_ROWS
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    told = vectors.join(F.broadcast(found) if few else found, "vec_id")
    told = told.join(F.broadcast(asked) if n <= BLOCKS else asked, "query_id")
    score = F.sqrt(F.aggregate(F.zip_with("embedding", "q", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x))
    measured = told.select("query_id", "vec_id", score.alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return measured.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
