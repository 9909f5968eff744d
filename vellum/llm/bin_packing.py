"""Variable-capacity best-fit packing.

Documents become pieces of at most the largest permitted length; only ids and lengths are
shuffled.  Pieces are dealt by hash to groups of bounded size, each packed by itself, largest piece
first: into the open bin it fits best, else into a new bin of the permitted length whose cost for each
unit expected to fill it is least.  At the end each bin shrinks to the least permitted length that
holds its contents.

A length counts the bytes of the UTF-8 text and one end mark unless a column is named.

Cases: null or empty text is one piece of length 1 (its end mark); repeated rows are packed each;
an empty table gives no rows; documents longer than the largest length are split, in order.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

CAPACITIES = (2_048, 4_096, 8_192, 16_384)
#: What opening a sequence costs beside its length.
OVERHEAD = 8
GROUP = 40_000
#: Different lengths that an estimate of a bin's fill looks at.
LOOK = 64


def pieces(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, length: Column | None = None) -> DataFrame:
    """(doc_id, piece, start, length)."""
    most = max(capacities)
    if length is None:
        length = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    sized = docs.select(F.col("doc_id").cast("long"), length.cast("long").alias("size"))
    cut = sized.select("doc_id", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.greatest("size", F.lit(1)) - 1) / most))).alias("piece"))
    return cut.select("doc_id", "piece", (F.col("piece") * most).alias("start"), F.least(F.lit(most), F.col("size") - F.col("piece") * most).alias("length"))


class _Ahead:
    """The pieces still to place, longest first: what they would fill of a space."""

    def __init__(self, lengths: list[int]):
        self.down = [-n for n in lengths]
        self.sums = [0, *accumulate(reversed(lengths))][::-1]

    def fill(self, space: int, at: int, steps: int = LOOK) -> int:
        """Units that the pieces from position ``at`` on put into ``space``, the longest that fits first."""
        start, n = space, len(self.down)
        for _ in range(steps):
            at = bisect_left(self.down, -space, at)
            if at == n or not space:
                return start - space
            length = -self.down[at]
            alike = bisect_right(self.down, self.down[at], at)
            space -= length * min(alike - at, space // length)
            at = alike
        return start - space + min(space, self.sums[at])


def _place(lengths: list[int], order: list[int], choose) -> tuple[list[int], list[int], list[int]]:
    """Bin and place of each length by best fit, and what each bin holds; ``choose`` sizes a new bin."""
    bins, places = [0] * len(lengths), [0] * len(lengths)
    filled: list[int] = []
    room: list[tuple[int, int]] = []  # (space left, bin), ascending
    for k, i in enumerate(order):
        n = lengths[i]
        at = bisect_left(room, (n, -1))
        if at < len(room):
            space, b = room.pop(at)
        else:
            b, space = len(filled), choose(n, k + 1)
            filled.append(0)
        bins[i], places[i] = b, filled[b]
        filled[b] += n
        if space > n:
            insort(room, (space - n, b))
    return bins, places, filled


def pack_lengths(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD) -> tuple[list[int], list[int], list[int]]:
    """Bin and place of each length (in the order given), and the final capacity of each bin.

    A new bin takes the permitted length that costs least for each unit which it and the pieces still to come would
    fill of it.  The packings that open one length alone are made as well, and the one of least total length, then
    of fewest bins, is returned, so that the joint choice is never worse than any single length."""
    sizes = sorted(capacities)
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    if not order:
        return [], [], []
    ahead = _Ahead([lengths[i] for i in order])

    def jointly(n: int, at: int) -> int:
        return min((c for c in sizes if c >= n), key=lambda c: ((c + overhead) / (n + ahead.fill(c - n, at)), c))

    longest = lengths[order[0]]
    ways = [jointly, *((lambda n, at, c=c: c) for c in sizes if c >= longest)]
    best = None
    for way in ways:
        bins, places, filled = _place(lengths, order, way)
        final = [next(c for c in sizes if c >= f) for f in filled]
        cost = (sum(final), len(final))
        if best is None or cost < best[0]:
            best = cost, bins, places, final
    return best[1:]


def pack(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, length: Column | None = None, group: int = GROUP) -> DataFrame:
    """(doc_id, piece, start, length, bin_id, place, capacity)."""
    cut = materialize(pieces(docs, capacities, length), "packing-pieces")
    n = max(1, -(-cut.count() // group))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("length", "ascending")])
        bins, places, final = pack_lengths(group["length"].to_pylist(), capacities)
        base = group["g"][0].as_py() << 32
        made = {"bin_id": [base + b for b in bins], "place": places, "capacity": [final[b] for b in bins]}
        out = group.select(["doc_id", "piece", "start", "length"])
        for name, values in made.items():
            out = out.append_column(name, pa.array(values, pa.int64()))
        return out

    # Repeated rows hash alike; a row's own number in its task tells them apart.
    dealt = cut.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece", "length", F.monotonically_increasing_id()), F.lit(n)))
    return dealt.groupBy("g").applyInArrow(run, "doc_id long, piece long, start long, length long, bin_id long, place long, capacity long")
