"""Scores of a reading against a reference: pair counts, and micro-averages of their sums."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import tokens

#: White space of the JVM's patterns, which is narrower than Python's.
_SPACE = " \\t\\n\\x0b\\f\\r"
_IDEOGRAPHS = "\u3040-\u30FF\uFF66-\uFF9F\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\uAC00-\uD7AF"
_WORD = re.compile(f"[{_IDEOGRAPHS}]|[^{_SPACE}{_IDEOGRAPHS}]+")
BAG = ("overlap", "ref_words", "hyp_words")
#: Keys of repeated rows that may be broadcast.
MOST = 1_000_000


def _longs(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.LongType()) for n in names])


def words_of(text: str) -> list[str]:
    """As ``text.tokens``."""
    plain = text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f")
    return text.split() if plain else _WORD.findall(text)


def bag_sizes(ref: str | None, hyp: str | None) -> tuple[int, int, int]:
    """Size of the multiset intersection of the tokens of two texts, and both sizes."""
    a, b = words_of(ref or ""), words_of(hyp or "")
    said = Counter(a)
    return sum(min(k, said[w]) for w, k in Counter(b).items() if w in said), len(a), len(b)


@F.pandas_udf(_longs(*BAG))
def _bag_sizes(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([bag_sizes(x, y) for x, y in zip(a, b)], columns=BAG)


def bag_overlap(pairs: DataFrame, key: list[str], ref: str, hyp: str) -> DataFrame:
    """Per key the size of the multiset intersection of two token columns, and both sizes; 0 without tokens.  A row
    is counted by itself; only rows that share a key, whose bags are one bag, meet in a shuffle of their tokens."""
    repeated = pairs.groupBy(*key).count().filter("count > 1").select(*(F.col(k).alias(f"_{k}") for k in key))
    many = repeated.limit(MOST + 1).count()
    alone = lambda rows: rows.select(*key, _bag_sizes(ref, hyp).alias("b")).select(*key, "b.*")
    if not many:
        return alone(pairs)
    held = repeated if many > MOST else F.broadcast(repeated)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    return alone(pairs.join(held, same, "left_anti")).unionByName(_merged_overlap(pairs.join(held, same, "left_semi"), key, ref, hyp))


def _merged_overlap(pairs: DataFrame, key: list[str], ref: str, hyp: str) -> DataFrame:
    none = F.array(F.struct(F.lit(None).cast("string").alias("w"), F.lit(0).alias("r"), F.lit(0).alias("h")))
    both = [F.coalesce(F.col(x), F.lit("")) for x in (ref, hyp)]
    said = pairs.select(*key, F.explode(F.concat(none, F.transform(tokens(both[0]), lambda w: F.struct(w.alias("w"), F.lit(1).alias("r"), F.lit(0).alias("h"))), F.transform(tokens(both[1]), lambda w: F.struct(w.alias("w"), F.lit(0).alias("r"), F.lit(1).alias("h"))))).alias("x"))
    counted = said.groupBy(*key, "x.w").agg(F.sum("x.r").alias("r"), F.sum("x.h").alias("h"))
    return counted.groupBy(*key).agg(F.sum(F.least("r", "h")).alias("overlap"), F.sum("r").alias("ref_words"), F.sum("h").alias("hyp_words"))


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b with an empty denominator counted as 1."""
    return a.cast("double") / F.coalesce(F.nullif(b, F.lit(0)), F.lit(1)).cast("double")


def micro(overlap: str = "overlap", ref: str = "ref_words", hyp: str = "hyp_words", errors: str = "char_errors", chars: str = "ref_chars") -> list[Column]:
    return [
        F.count("*").alias("pages"),
        safe_ratio(F.sum(overlap), F.sum(F.greatest(F.col(ref), F.lit(1)))).alias("word_recall"),
        safe_ratio(F.sum(overlap), F.sum(F.greatest(F.col(hyp), F.lit(1)))).alias("word_precision"),
        safe_ratio(F.sum(errors), F.sum(F.greatest(F.col(chars), F.lit(1)))).alias("cer"),
    ]


def bit_distance(a: str, b: str) -> int:
    """Edit distance with a column of the table held as two bit vectors (differences up and down)."""
    if not a or not b:
        return len(a) + len(b)
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = full, 0, len(a)
    for c in b:
        same = at.get(c, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        right, left = down | ~(diagonal | up) & full, up & diagonal
        score += bool(right & top) - bool(left & top)
        right, left = (right << 1 | 1) & full, left << 1 & full
        up, down = left | ~(diagonal | right) & full, right & diagonal
    return score


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def distances(a: list[str], b: list[str]) -> np.ndarray:
    """Edit distances of pairs.  In a pair of one length whose unequal places hold characters that replace none of each
    other, no alignment can save any of them, so their number is the distance; other pairs are compared in full."""
    n, m = (np.array([len(x) for x in side], np.int64) for side in (a, b))
    out = np.full(len(a), -1, np.int64)
    even = np.flatnonzero(n == m)
    if len(even):
        x, y = (code_points("".join([side[k] for k in even.tolist()])) for side in (a, b))
        at = np.flatnonzero(x != y)
        row = np.searchsorted(np.cumsum(n[even]), at, "right")
        lost, new = (row << 21 | side[at] for side in (x, y))
        open_ = np.intersect1d(lost, new) >> 21
        out[even] = np.bincount(row, minlength=len(even))
        out[even[open_]] = -1
    for k in np.flatnonzero(out < 0).tolist():
        out[k] = bit_distance(a[k], b[k])
    return out


@F.pandas_udf(T.LongType())
def _distance(a: pd.Series, b: pd.Series) -> pd.Series:
    whole = (a.notna() & b.notna()).to_numpy()
    out = pd.Series([None] * len(a), dtype="Int64")
    out[whole] = distances(a[whole].tolist(), b[whole].tolist())
    return out


def distance(a: Column, b: Column) -> Column:
    """Edit distance in code points."""
    return _distance(a, b)


@F.pandas_udf(_longs(*BAG, "char_errors", "ref_chars"))
def page_counts(ref: pd.Series, hyp: pd.Series) -> pd.DataFrame:
    """Sizes of the token bags and their overlap, edit distance and length of normalised texts without nulls."""
    out = pd.DataFrame([bag_sizes(x, y) for x, y in zip(ref, hyp)], columns=BAG)
    return out.assign(char_errors=distances(ref.tolist(), hyp.tolist()), ref_chars=[len(x) for x in ref])


def edit_ops(ref: list, hyp: list) -> tuple[int, int, int]:
    """Substitutions, deletions, insertions of one least-cost alignment; ties prefer a match or
    substitution, then a deletion."""
    n = len(hyp)
    rows = [list(range(n + 1))]
    for i, a in enumerate(ref, 1):
        last, now = rows[-1], [i]
        for j, b in enumerate(hyp, 1):
            now.append(min(last[j - 1] + (a != b), last[j] + 1, now[-1] + 1))
        rows.append(now)
    i, j, s, d = len(ref), n, 0, 0
    ins = 0
    while i or j:
        if i and j and rows[i][j] == rows[i - 1][j - 1] + (ref[i - 1] != hyp[j - 1]):
            s += ref[i - 1] != hyp[j - 1]
            i, j = i - 1, j - 1
        elif i and rows[i][j] == rows[i - 1][j] + 1:
            d, i = d + 1, i - 1
        else:
            ins, j = ins + 1, j - 1
    return s, d, ins


#: Length of the pieces that anchor an alignment of characters and of words; classes of characters in a bag.
GRAM, CLASSES = {str: 8, list: 2}, 1024
#: Cells of a table whose bits are kept whole; of larger ones every so many columns, and a block is made again.
KEPT = 1 << 27


def _shifted(a: np.ndarray, b: np.ndarray) -> int:
    """Cost of the best alignment that pairs a head and a tail place by place and skips between them on one side."""
    if len(a) < len(b):
        a, b = b, a
    n, more = len(b), len(a) - len(b)
    if not n or not more:
        return more + int(np.count_nonzero(a != b)) if n else more
    head, tail = np.cumsum(a[:n] != b), np.cumsum((a[more:] != b)[::-1])
    return more + min(int(tail[-1]), int(head[-1]), int((head[:-1] + tail[-2::-1]).min(initial=n)))


def _grams(x: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the pieces that occur once, in order, and their places."""
    n = len(x) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    x, h = x.astype(np.uint64), np.zeros(n, np.uint64)
    for k in range(size):
        h = h * np.uint64(1_000_003) + x[k : k + n]
    found, at, times = np.unique(h, return_index=True, return_counts=True)
    return found[times == 1], at[times == 1]


def _rising(y: np.ndarray) -> np.ndarray:
    """Places of a longest rising subsequence."""
    if not (np.diff(y) <= 0).any():
        return np.arange(len(y))
    tops: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for k, v in enumerate(y.tolist()):
        p = bisect_left(tops, v)
        if p == len(tops):
            tops.append(v)
            at.append(k)
        else:
            tops[p], at[p] = v, k
        before.append(at[p - 1] if p else -1)
    out, k = [], at[-1]
    while k >= 0:
        out.append(k)
        k = before[k]
    return np.array(out[::-1])


def _anchored(a: np.ndarray, b: np.ndarray, size: int) -> int:
    """Cost of an alignment that holds on to pieces that occur once on both sides."""
    (x, i), (y, j) = _grams(a, size), _grams(b, size)
    _, p, q = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    i, j = i[p], j[q]
    order = np.argsort(i)
    i, j = i[order], j[order]
    if len(i):
        kept = _rising(j)
        i, j = i[kept], j[kept]
    turns = np.flatnonzero(np.diff(i - j))
    cost = at = to = 0
    for first, last in zip([0, *(turns + 1).tolist()], [*turns.tolist(), len(i) - 1]) if len(i) else ():
        skip = max(at - int(i[first]), to - int(j[first]), 0)
        i0, j0, end = int(i[first]) + skip, int(j[first]) + skip, int(i[last]) + size
        if i0 < end:
            n = end - i0
            cost += _shifted(a[at:i0], b[to:j0]) + int(np.count_nonzero(a[i0:end] != b[j0 : j0 + n]))
            at, to = end, j0 + n
    return cost + _shifted(a[at:], b[to:])


def _settled(a: np.ndarray, b: np.ndarray, size: int) -> tuple[int, int, int] | None:
    """The counts of every least-cost alignment where the bags of both sides tell them, else None.

    What one bag holds beyond the other is substituted or deleted (or, on the other side, inserted).  An alignment that
    costs no more than that is a least one, and none of these has a step of the third kind."""
    x, y = (c & (CLASSES - 1) for c in (a, b)) if size == GRAM[str] else (a, b)
    n = int(max(x.max(), y.max())) + 1
    beyond = np.bincount(x, minlength=n) - np.bincount(y, minlength=n)
    lost, new = int(beyond[beyond > 0].sum()), -int(beyond[beyond < 0].sum())
    more = len(a) - len(b)
    least = max(lost, new)
    if least != _shifted(a, b) and least != _anchored(a, b, size):
        return None
    return (lost - more, more, 0) if lost >= new else (new + more, 0, -more)


def _traced(a: list[int], b: list[int]) -> tuple[int, int, int]:
    """Counts from the table held as bits: for each column the cells equal to their diagonal neighbour, and those one
    above their upper one."""
    place: dict[int, int] = {}
    for i, c in enumerate(a):
        place[c] = place.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1

    def columns(up: int, down: int, part: list[int]):
        for c in part:
            same = place.get(c, 0)
            diagonal = (((same & up) + up) ^ up) | same | down
            right, left = down | ~(diagonal | up) & full, up & diagonal
            right, left = (right << 1 | 1) & full, left << 1 & full
            up, down = left | ~(diagonal | right) & full, right & diagonal
            yield diagonal, up, down

    block = max(1, min(len(b), KEPT // len(a)))
    starts = [(full, 0)]
    if block < len(b):
        for k, (_, up, down) in enumerate(columns(full, 0, b), 1):
            if k % block == 0:
                starts.append((up, down))
    i, j, s, d, ins = len(a), len(b), 0, 0, 0
    base, held = len(b) + 1, []
    while i or j:
        if j and j <= base:
            k = (j - 1) // block
            base = k * block
            held = list(columns(*starts[k], b[base : base + block]))
        diagonal, up, _ = held[j - 1 - base] if j else (0, full, 0)
        if i and j and (a[i - 1] == b[j - 1] or not diagonal >> i - 1 & 1):
            s += a[i - 1] != b[j - 1]
            i, j = i - 1, j - 1
        elif i and up >> i - 1 & 1:
            d, i = d + 1, i - 1
        else:
            ins, j = ins + 1, j - 1
    return s, d, ins


def edit_counts(ref: str | list, hyp: str | list) -> tuple[int, int, int]:
    """As ``edit_ops`` of long sequences: from bags and an anchored alignment where these settle them, else from the
    table as bits, one for each choice on the way back."""
    if isinstance(ref, str) and isinstance(hyp, str):
        a, b = code_points(ref).astype(np.int64), code_points(hyp).astype(np.int64)
    else:
        codes: dict = {}
        a, b = (np.array([codes.setdefault(x, len(codes)) for x in side], np.int64) for side in (ref, hyp))
    n = min(len(a), len(b))  # an equal end is matched first in any case
    apart = np.flatnonzero(a[len(a) - n :] != b[len(b) - n :])
    tail = n - 1 - int(apart[-1]) if len(apart) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not len(a) or not len(b):
        return 0, len(a), len(b)
    return _settled(a, b, GRAM[type(ref)]) or _traced(a.tolist(), b.tolist())


SCORE = "cer double, wer double, insertion_rate double, ref_chars long, char_errors long, char_ins long, ref_words long, word_errors long, word_overlap long, hyp_words long, word_recall double, word_precision double"
_TOKEN = re.compile("[\u3040-\u30FF\uFF66-\uFF9F\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\uAC00-\uD7AF]|[^\\s\u3040-\u30FF\uFF66-\uFF9F\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\uAC00-\uD7AF]+")


def score(ref: str | None, hyp: str | None, caseless: bool = False) -> dict:
    """Rates and raw counts of one reading against its reference, both normalised."""
    sides = []
    for text in (ref or "", hyp or ""):
        text = text.casefold() if caseless else text
        sides.append(" ".join(unicodedata.normalize("NFC", text).split()))
    words = [_TOKEN.findall(x) for x in sides]
    chars, said = edit_counts(*sides), edit_counts(*words)
    n, m, h = max(len(sides[0]), 1), max(len(words[0]), 1), max(len(words[1]), 1)
    common = (Counter(words[0]) & Counter(words[1])).total()
    return {
        "cer": sum(chars) / n, "wer": sum(said) / m, "insertion_rate": chars[2] / n, "ref_chars": n, "char_errors": sum(chars), "char_ins": chars[2],
        "ref_words": m, "word_errors": sum(said), "word_overlap": common, "hyp_words": h, "word_recall": common / m, "word_precision": common / h,
    }


def pair_scores(pairs: DataFrame, ref: str, hyp: str, caseless: bool = False) -> DataFrame:
    """All other columns of ``pairs`` and the scores of each pair, nulls being empty."""
    keep = [c for c in pairs.columns if c not in (ref, hyp)]

    @F.pandas_udf(SCORE)
    def scored(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([score(x, y, caseless) for x, y in zip(a, b)], columns=[c.split()[0] for c in SCORE.split(", ")])

    return pairs.select(*keep, scored(ref, hyp).alias("s")).select(*keep, "s.*")


def scorecard(scored: DataFrame, by: str) -> DataFrame:
    """Micro-averages of each group and of all rows: total errors over total length."""
    over = lambda a, b: safe_ratio(F.sum(a), F.sum(b))
    return scored.rollup(by).agg(
        F.count("*").alias("pages"), over("char_errors", "ref_chars").alias("cer"), over("word_errors", "ref_words").alias("wer"), over("char_ins", "ref_chars").alias("insertion_rate"),
        over("word_overlap", "ref_words").alias("word_recall"), over("word_overlap", "hyp_words").alias("word_precision"), F.sum("ref_chars").alias("ref_chars"),
    )
