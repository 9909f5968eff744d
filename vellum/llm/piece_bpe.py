"""Exact merge-type byte-pair encoding by backtracking.

A vocabulary whose merges join any two neighbours whose concatenation is a piece, best
score first, has one valid encoding of a text: the one in which every adjacent pair of tokens
would itself survive encoding.  So the encoder walks left to right with the longest match at
each place (found for all places at once by an Aho-Corasick automaton), checks the new token
against its left neighbour by undoing merges, and on a clash tries the next shorter prefix or
steps back.  A bitfield marks the places already shown to lead nowhere, which bounds the work.

No piece has a space mark after another character, so a text falls into runs of space marks with
the word behind them, and no merge crosses a run.  Runs are encoded one by one and
remembered in a bounded table per worker, which changes speed only.

Cases: null is the empty text (begin and end ids only); characters outside the vocabulary become
their UTF-8 byte pieces; a space mark in the text is taken as a space, as the library does.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
REMEMBERED = 800_000
_RUN = re.compile(" +[^ ]*|[^ ]+")


class Vocabulary:
    """Tables of one model, built once per process."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_id: dict[int, int] = {}
        self.decoded: list[bytes] = []
        for i, p in enumerate(self.pieces):
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                self.decoded.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i):
                self.decoded.append(b"")
            elif sp.is_unknown(i):
                self.decoded.append(" ⁇ ".encode())
            else:
                self.decoded.append(p.replace(MARK, " ").encode())
        normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in normal}
        # Rank by score, best first; ids break ties as the order of the file does.
        order = sorted(normal, key=lambda i: (-sp.get_score(i), i))
        self.rank = [1 << 30] * n
        for r, i in enumerate(order):
            self.rank[i] = r
        self.split: list[tuple[int, int] | None] = [None] * n
        #: Pair of ids -> merged id, for pairs that the vocabulary can merge.
        valid = []
        for i in order:
            p = self.pieces[i]
            if len(p) == 1:
                valid.append(i)
                continue
            last = self._last_merge(p)
            if last:
                self.split[i] = last
                valid.append(i)
        #: The longest piece that is a proper prefix of each piece.
        known = {self.pieces[i] for i in valid}
        self.shorter = [-1] * n
        machine = ahocorasick.Automaton()
        for i in valid:
            p = self.pieces[i]
            machine.add_word(p, (i, len(p) - 1))
            for k in range(len(p) - 1, 0, -1):
                if p[:k] in known:
                    self.shorter[i] = self.ids[p[:k]]
                    break
        machine.make_automaton()
        self.machine = machine
        self.characters = {p for p in self.ids if len(p) == 1}
        self.length = [len(p) for p in self.pieces]
        self.pair_ok: dict[int, bool] = {}
        self.memory: dict[str, bytes] = {}

    def _last_merge(self, piece: str) -> tuple[int, int] | None:
        """The merge that forms ``piece`` when it is encoded alone, or None if it never forms."""
        parts = [self.ids.get(c, -1) for c in piece]
        if -1 in parts:
            return None
        last = None
        while len(parts) > 1:
            best, at = 1 << 30, -1
            for k in range(len(parts) - 1):
                m = self.ids.get(self.pieces[parts[k]] + self.pieces[parts[k + 1]])
                if m is not None and self.rank[m] < best:
                    best, at = self.rank[m], k
            if at < 0:
                return None
            last = (parts[at], parts[at + 1])
            parts[at : at + 2] = [self.ids[self.pieces[last[0]] + self.pieces[last[1]]]]
        return last

    def compatible(self, left: int, right: int) -> bool:
        """Whether encoding the two pieces' text gives these two tokens back; answers are remembered."""
        if len(self.pair_ok) > 1_000_000:
            self.pair_ok.clear()
        found = self.pair_ok[left << 32 | right] = self._compatible(left, right)
        return found

    def _compatible(self, a: int, b: int) -> bool:
        """Undo merges on either side of the seam, latest first; a merge across it that ranks before the
        undone ones would have come first."""
        limit = 1 << 30
        ids, pieces, rank, split = self.ids, self.pieces, self.rank, self.split
        while True:
            across = ids.get(pieces[a] + pieces[b])
            if across is not None and rank[across] < limit:
                return False
            ra = rank[a] if split[a] else -1
            rb = rank[b] if split[b] else -1
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit = ra
                a = split[a][1]
            else:  # of equal ranks the left merges first, so the right is undone first
                limit = rb + 1
                b = split[b][0]

    def _known(self, text: str) -> list[int]:
        """Tokens of a run all of whose characters are pieces."""
        whole = self.ids.get(text)
        if whole is not None and (len(text) == 1 or self.split[whole]):
            return [whole]
        n = len(text)
        longest = [-2] * (n + 1)
        length = self.length
        for end, (i, before) in self.machine.iter(text):  # by end, so the longest of a start comes last
            longest[end - before] = i
        failed = 0
        tokens: list[int] = []
        at, token = 0, longest[0]
        shorter, compatible, pair_ok = self.shorter, self.compatible, self.pair_ok
        left = -1
        while True:
            while token >= 0:
                end = at + length[token]
                if not failed >> end & 1:
                    ok = left < 0 or pair_ok.get(left << 32 | token)
                    if ok is None:
                        ok = compatible(left, token)
                    if ok:
                        tokens.append(token)
                        left, at = token, end
                        token = longest[at]
                        continue
                token = shorter[token]
            if token == -2:
                return tokens
            failed |= 1 << at
            token = tokens.pop()
            left = tokens[-1] if tokens else -1
            at -= length[token]
            token = shorter[token]

    def run(self, text: str) -> bytes:
        """Ids of one run, as little-endian 32-bit words."""
        if self.characters.issuperset(text):
            return array("I", self._known(text)).tobytes()
        ids: list[int] = []
        start = 0
        for k, c in enumerate(text):
            if c not in self.ids:
                if k > start:
                    ids += self._known(text[start:k])
                ids += [self.byte_id[x] for x in c.encode("utf-8", "replace")]
                start = k + 1
        if start < len(text):
            ids += self._known(text[start:])
        return array("I", ids).tobytes()

    def encode(self, text: str | None) -> bytes:
        """All ids with begin and end, as little-endian 32-bit words."""
        parts = [np.array([self.bos], "<u4").tobytes()]
        if text:
            spaced = " " + text.replace(MARK, " ")
            memory = self.memory
            if "  " in spaced:
                runs = _RUN.findall(spaced)
            else:
                runs = [" " + w for w in spaced[1:].split(" ")]
                if runs[-1] == " " and len(runs) > 1 and not spaced.endswith(" "):
                    runs.pop()
            for r in runs:
                got = memory.get(r)
                if got is None:
                    if len(memory) >= REMEMBERED:
                        memory.clear()
                    got = self.run(r.replace(" ", MARK))
                    if len(r) <= 64:
                        memory[r] = got
                parts.append(got)
        parts.append(np.array([self.eos], "<u4").tobytes())
        return b"".join(parts)

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 text of ids: pieces joined, the first space dropped, malformed bytes replaced."""
        at = self.decoded
        joined = b"".join([at[i] for i in np.frombuffer(ids, "<u4").tolist()])
        if joined[:1] == b" ":
            joined = joined[1:]
        return joined


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_table(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids binary, decoded string) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for b in batches:
            ids = [v.encode(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array([v.decode(i).decode() for i in ids], pa.string())],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def encode_digests(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests taken where the ids are, so that neither
    ids nor texts return to the JVM."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        digest = lambda x: hashlib.sha256(x).hexdigest()
        for b in batches:
            n, a, d = [], [], []
            for t in b.column(1):
                ids = v.encode(t.as_py())
                n.append(len(ids) // 4)
                a.append(digest(ids))
                d.append(digest(v.decode(ids)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(d)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
