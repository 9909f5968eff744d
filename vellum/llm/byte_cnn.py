"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters run over chunks of 8 bytes that overlap by half and
cover the whole document, each filter keeps its largest response, and a logistic layer
combines these into one probability.  The gradient of a max-pool flows to the winning chunk
alone, so training touches one chunk per filter and document.

Fitting takes at most ``sample`` labelled rows of at most ``longest`` bytes each (whole texts, in
order of a hash of the id), from the training fold only.  Scoring reads every byte of every text.

Cases: null text is the empty text and is scored like any other (one chunk of padding); without
both labels to learn from, the score is the share of label 1 (0.5 without any); repeated
label rows of an id count once, by their largest quality; repeated documents are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fitted, fold

HALF, DIM, FILTERS = 4, 8, 48
SAMPLE, LONGEST = 5_000, 16_384
EPOCHS, BATCH, RATE = 10, 32, 4e-3
SLICE = 1 << 15


def _blocks(text: bytes) -> np.ndarray:
    """Half-chunks of a text: rows of 4 bytes, one row of padding before and at least one behind."""
    n = -(-len(text) // HALF) + 2
    out = np.zeros(n * HALF, np.uint8)
    out[HALF : HALF + len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, HALF)


class ByteCnn:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        f = np.float32
        self.p = {
            "emb": r.normal(0, 0.5, (256, DIM)).astype(f),
            "top": r.normal(0, 0.18, (HALF * DIM, FILTERS)).astype(f),
            "low": r.normal(0, 0.18, (HALF * DIM, FILTERS)).astype(f),
            "bias": np.zeros(FILTERS, f),
            "out": r.normal(0, 0.1, FILTERS).astype(f),
            "c": np.zeros(1, f),
        }
        self.prior: float | None = None

    def pooled(self, blocks: np.ndarray) -> np.ndarray:
        """Largest response of each filter, in slices so that a long text needs no more memory."""
        p = self.p
        both = np.concatenate([p["top"], p["low"]], axis=1)
        best = np.full(FILTERS, -np.inf, np.float32)
        for s in range(0, len(blocks) - 1, SLICE):
            part = blocks[s : s + SLICE + 1]
            r = p["emb"][part].reshape(len(part), -1) @ both
            np.maximum(best, (r[:-1, :FILTERS] + r[1:, FILTERS:]).max(axis=0), out=best)
        return best + p["bias"]

    def score(self, text: bytes) -> float:
        if self.prior is not None:
            return self.prior
        z = float(np.maximum(self.pooled(_blocks(text)), 0) @ self.p["out"] + self.p["c"][0])
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def fit(self, texts: list[bytes], labels: list[int], epochs: int = EPOCHS) -> ByteCnn:
        y = np.array(labels, np.float32)
        if not len(y) or y.min() == y.max():
            self.prior = float(y.mean()) if len(y) else 0.5
            return self
        p = self.p
        blocks = [_blocks(t) for t in texts]
        m1 = {k: np.zeros_like(v) for k, v in p.items()}
        m2 = {k: np.zeros_like(v) for k, v in p.items()}
        r, step = np.random.default_rng(11), 0
        p["c"][0] = np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
        for e in range(epochs):
            rate = RATE * (1 - e / epochs)
            order = r.permutation(len(y))
            for at in range(0, len(order), BATCH):
                few = order[at : at + BATCH]
                g = {k: np.zeros_like(v) for k, v in p.items()}
                for i in few:
                    b = blocks[i]
                    x = p["emb"][b].reshape(len(b), -1)
                    act = (x @ p["top"])[:-1] + (x @ p["low"])[1:]
                    win = act.argmax(axis=0)
                    top = act[win, np.arange(FILTERS)] + p["bias"]
                    h = np.maximum(top, 0)
                    z = np.clip(h @ p["out"] + p["c"][0], -30, 30)
                    d = (1 / (1 + np.exp(-z)) - y[i]) / len(few)
                    g["out"] += d * h
                    g["c"] += d
                    dh = (d * p["out"] * (top > 0)).astype(np.float32)
                    g["bias"] += dh
                    g["top"] += (x[win] * dh[:, None]).T
                    g["low"] += (x[win + 1] * dh[:, None]).T
                    np.add.at(g["emb"], b[win].ravel(), (p["top"] * dh).T.reshape(-1, DIM))
                    np.add.at(g["emb"], b[win + 1].ravel(), (p["low"] * dh).T.reshape(-1, DIM))
                step += 1
                for k in p:
                    grad = g[k] + (1e-4 * p[k] if k in ("out", "top", "low") else 0)
                    m1[k] = 0.9 * m1[k] + 0.1 * grad
                    m2[k] = 0.99 * m2[k] + 0.01 * grad * grad
                    p[k] -= rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-7)
        return self


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, sample: int = SAMPLE, longest: int = LONGEST) -> ByteCnn:
    """Fit on a bounded sample of the labelled rows outside the held-out fold."""
    known = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    texts = docs.filter(F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != held)).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.filter(F.octet_length("text") <= longest)
    # The ids are chosen first, so that only the chosen rows' texts move.
    chosen = known.filter(fold(F.col("doc_id"), folds) != held).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min_by(F.struct("text", "quality"), "text").alias("x")).select("doc_id", "x.*")

    def fit(drawn: pa.Table) -> ByteCnn:
        drawn = drawn.sort_by("doc_id")
        return ByteCnn().fit([t.encode("utf-8", "replace") for t in drawn["text"].to_pylist()], [int(q > 0) for q in drawn["quality"].to_pylist()])

    return fitted(rows, fit)


def score_table(docs: DataFrame, model: ByteCnn, threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [model.score((t.as_py() or "").encode("utf-8", "replace")) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, predicted int")
