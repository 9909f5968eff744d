"""Language identification as a mixture: expectation-maximisation over words.

Each language has a hashed byte-trigram model.  A document's words get a log-likelihood
under each language; EM estimates the document's language proportions; the set of
languages grows from the best single one, most likely next, while the gain in log-likelihood beats
a penalty per language.  The prediction is the largest share in the chosen set.

Fitting takes about ``per_lang`` rows of each language, of at most ``longest`` bytes each, whole texts, chosen
by a hash of the id in the training fold.  Prediction reads whole texts.

Cases: null text or text without a letter is ``und`` with score 0; without any language to learn, all
are ``und``; null langs teach nothing; repeated rows are predicted each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fitted, fold

PER_LANG, LONGEST = 500, 16_384
BUCKETS = 1 << 16
ROUNDS = 12
#: Gain in log-likelihood that one more language must bring, besides half the log of the word count.
PENALTY = 8.0
SLICE = 1 << 21
_FOLDED = np.array([x if x >= 128 or 97 <= x <= 122 else 32 for x in range(256)], np.uint8)
_FOLDED[65:91] = np.arange(97, 123)


def _keys(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Trigram buckets of a text and the starts of its words among them."""
    raw = _FOLDED[np.frombuffer((" " + text.lower() + "  ").encode("utf-8", "replace"), np.uint8)]
    a, b, c = raw[:-2].astype(np.uint32), raw[1:-1].astype(np.uint32), raw[2:].astype(np.uint32)
    keys = ((a * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA6B) ^ c * np.uint32(0xC2B2AE35)) >> np.uint32(7)) & np.uint32(BUCKETS - 1)
    # A word's trigrams start at the space before it; those that start on a space before a space say nothing.
    useful = (a != 32) | (b != 32)
    starts = np.flatnonzero((a == 32) & useful)
    place = np.cumsum(useful) - 1
    return keys[useful], place[starts]


class Mixture:
    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages, self.table = languages, table

    @classmethod
    def fit(cls, texts: dict[str, list[str]]) -> Mixture:
        languages = sorted(texts)
        counts = np.zeros((BUCKETS, len(languages)))
        for k, lang in enumerate(languages):
            for t in texts[lang]:
                counts[:, k] += np.bincount(_keys(t)[0], minlength=BUCKETS)
        # Shared smoothing: what no language has seen counts alike for all.
        back = (counts.sum(axis=1) + 0.5) / (counts.sum() + 0.5 * BUCKETS) if len(languages) else np.zeros(BUCKETS)
        strength = 2000.0
        table = np.log((counts + strength * back[:, None]) / (counts.sum(axis=0) + strength)) if len(languages) else np.zeros((BUCKETS, 0))
        return cls(languages, table.astype(np.float32))

    def words(self, text: str) -> np.ndarray:
        """Log-likelihood of each word under each language, long texts in slices."""
        out = []
        for s in range(0, max(len(text), 1), SLICE):
            keys, starts = _keys(text[s : s + SLICE])
            if len(starts):
                out.append(np.add.reduceat(self.table[keys], starts, axis=0).astype(np.float64))
        return np.concatenate(out) if out else np.zeros((0, len(self.languages)))

    @staticmethod
    def _em(like: np.ndarray, among: list[int]) -> tuple[np.ndarray, float]:
        """Shares of ``among`` and the log-likelihood (up to the words' own maxima)."""
        x = like[:, among]
        pi = np.full(len(among), 1 / len(among))
        for _ in range(ROUNDS):
            resp = x * pi
            pi = (resp / resp.sum(axis=1, keepdims=True)).mean(axis=0) + 1e-9
            pi /= pi.sum()
        return pi, float(np.log(x @ pi).sum())

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not any(map(str.isalpha, text)):
            return "und", 0.0
        ll = self.words(text)
        if not len(ll):  # letters outside the folded alphabet's words cannot occur, but stay defined
            return self.languages[0], 0.0
        top = ll.max(axis=1, keepdims=True)
        like = np.exp(np.maximum(ll - top, -60.0))
        totals = np.log(like).sum(axis=0)
        chosen, shares, best = [int(totals.argmax())], np.ones(1), float(totals.max())
        if len(self.languages) > 1:
            full, _ = self._em(like, list(range(len(self.languages))))
            for k in sorted((k for k in range(len(full)) if k != chosen[0]), key=lambda k: -full[k]):
                pi, value = self._em(like, [*chosen, k])
                if value - best <= PENALTY + 0.5 * np.log(len(ll)):
                    break
                chosen, shares, best = [*chosen, k], pi, value
        at = int(shares.argmax())
        return self.languages[chosen[at]], float(min(1.0, shares[at]))


def train(docs: DataFrame, folds: int = 3, held: int = 1, per_lang: int = PER_LANG, longest: int = LONGEST) -> Mixture:
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), folds) != held) & (F.octet_length("text") <= longest))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return Mixture.fit({})
    # A share of each language by hash, so that no language meets in one task.
    share = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1 << 20, max(1, per_lang * (1 << 20) // n)))))
    drawn = known.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < share[F.col("lang")])

    def fit(rows: pa.Table) -> Mixture:
        texts: dict[str, list[str]] = {}
        for lang, text in sorted(zip(rows["lang"].to_pylist(), rows["text"].to_pylist())):
            texts.setdefault(lang, []).append(text)
        return Mixture.fit(texts)

    return fitted(drawn.select("lang", "text"), fit)


def predict_table(docs: DataFrame, model: Mixture) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [model.predict(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Mixture, least: float = 0.5) -> DataFrame:
    """Documents with a language of at least ``least`` of the words, all columns kept."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = [lang != "und" and score >= least for lang, score in (model.predict(t.as_py()) for t in b.column(at))]
            yield b.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
