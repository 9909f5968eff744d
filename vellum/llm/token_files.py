"""Token ids in bit-plane files.

A document's ids come from the tokenizers library; an end id closes each document.  Shards are written in
ascending doc_id order.  One file per shard:

    magic "VPLANE1\\0"
    chunks: up to CHUNK ids each, transposed into byte planes (or bit planes), each plane compressed with
            zstandard; an all-zero plane takes no bytes
    footer: zstandard of [u32 unit, u32 planes, u64 chunks, u64 docs,
            per chunk u64 offset, u32 ids, u32 crc32, u32 length per plane; doc_id i64 each; ids u64 each]
    u64 footer offset, magic

A reader seeks from the footer to any chunk.  File names carry a unique tag, and only the names that
reach the committed manifest count, so a task that dies or runs twice leaves nothing that is read.

The encoder cuts a text where its pre-tokenizer always cuts (before a lone space or around a lone newline)
and remembers the ids of pieces in two bounded tables per worker, a newer and an older one.  Two white-space
characters with a word behind are two pre-tokens, so texts without longer runs are cut at every space and newline,
a slice of them at once, and each distinct piece is looked up once.  This changes speed only.

Cases: null is the empty text (its end id alone); repeated rows follow each other, ordered by text; a
null doc_id sorts first; a special token's string in a text becomes its id, as the library does by default.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, new_path

MAGIC = b"VPLANE1\0"
CHUNK = 1 << 17
SHARD_BYTES = 16 << 20
SLICE_BYTES = 4 << 20
REMEMBERED = 400_000
_GAP = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: White space that may be cut only before its last character, or not at all (before the end or a special token).
_RUNS = rf"{_GAP}{{3}}|{_GAP}{{2}}(\z|<\|)"
_CUTS = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")


class Encoder:
    """The library's ids of whole texts, from remembered ids of pieces.  A piece that has no space before it stands
    after a newline, so it is remembered with the newline's id in front: a text is its pieces' ids less a first one."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [x for x in range(256) if x not in set(printable)]
        #: The byte-level alphabet, by byte.
        self.alphabet = {x: x for x in printable} | {x: 256 + k for k, x in enumerate(others)}
        self.space = chr(self.alphabet[32])
        self.newline = self.whole("\n")
        self.memory = Memory(self.find)

    def word(self, piece: str) -> bytes:
        """Ids of a piece that is one pre-token: the library's model without its text layers."""
        if piece.isascii():
            mapped = self.space + piece[1:] if piece[0] == " " else piece
        else:
            mapped = piece.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def whole(self, piece: str) -> bytes:
        return array("I", self.library.encode_batch_fast([piece], add_special_tokens=False)[0].ids).tobytes()

    def find(self, piece: str) -> bytes:
        """Ids of a piece, after a newline's unless it starts with a space."""
        ids = self.word(piece) if piece[piece[:1] == " " :].isalpha() else self.whole(piece)
        return ids if piece[:1] == " " else self.newline + ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit words."""
        return [*self.stream(pa.array(texts, pa.string()))]

    def stream(self, texts: pa.Array) -> Iterator[bytes]:
        """``encode`` of a column, a bounded slice at a time."""
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        s = 0
        while s < len(texts):
            upto = max(s + 1, int(np.searchsorted(ends, (ends[s - 1] if s else 0) + SLICE_BYTES, "right")))
            yield from self._slice(texts.slice(s, upto - s))
            s = upto

    def _slice(self, texts: pa.Array) -> list[bytes]:
        known = self.memory.__getitem__
        self.memory.long.clear()
        if len(texts) == 1 or pc.any(odd := pc.match_substring_regex(texts, _RUNS)).as_py():
            odd = [True] if len(texts) == 1 else odd.to_pylist()
            rest = iter(self._slice(texts.filter(pa.array([not x for x in odd])))) if not all(odd) else iter(())
            return [self._cut(t) if x else next(rest) for t, x in zip(texts.to_pylist(), odd)]
        # Each piece of these texts is looked up once.
        cut = pc.split_pattern(pc.replace_substring(texts, " ", "\n "), "\n")
        pieces = cut.flatten().dictionary_encode()
        found = list(map(known, pieces.dictionary.to_pylist()))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(sizes) - sizes
        which = pieces.indices.to_numpy()
        size = sizes[which]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = np.frombuffer(b"".join(found), "<u4")[np.repeat(starts[which] - ends[:-1], size) + np.arange(ends[-1])]
        at = (ends[np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy())])] * 4).tolist()
        raw = ids.tobytes()
        return [raw[a + 4 : b] for a, b in zip(at, at[1:])]

    def _cut(self, text: str) -> bytes:
        known = self.memory.__getitem__
        return b"".join([known(p) if p[:1] == " " else known(p)[4:] for p in _CUTS.split(text)])


class Memory(dict):
    """Ids by piece.  When full, what was there becomes the older half, and what is met again is taken over from it,
    so that frequent pieces stay.  Long pieces are kept for the texts of one slice."""

    def __init__(self, find: Callable[[str], bytes]):
        self.find = find
        self.older: dict[str, bytes] = {}
        self.long: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        stem = piece.rstrip(punctuation)
        # Closing marks are a pre-token of their own after a letter: stem and marks may be known.
        if len(stem) < len(piece) and stem[-1:].isalpha() and "<|" not in piece:
            return self[stem] + self[piece[len(stem) :]][4:]
        if len(piece) > 64:
            found = self.long.get(piece)
            if found is None:
                found = self.long[piece] = self.find(piece)
            return found
        found = self.older.get(piece)
        if found is None:
            found = self.find(piece)
        if len(self) >= REMEMBERED:
            self.older = self.copy()
            self.clear()
        self[piece] = found
        return found


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def split_planes(ids: np.ndarray, unit: int) -> list[bytes]:
    """Planes of 32-bit ids: 4 byte planes (unit 8) or 32 bit planes (unit 1)."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if unit == 8:
        return [np.ascontiguousarray(octets[:, k]).tobytes() for k in range(4)]
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def join_planes(planes: list[bytes], n: int, unit: int) -> np.ndarray:
    if unit == 8:
        octets = np.zeros((n, 4), np.uint8)
        for k, p in enumerate(planes):
            if p:
                octets[:, k] = np.frombuffer(p, np.uint8)
    else:
        bits = np.zeros((n, 32), np.uint8)
        for k, p in enumerate(planes):
            if p:
                bits[:, k] = np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little")
        octets = np.packbits(bits, axis=1, bitorder="little")
    return octets.reshape(-1).view("<u4")


class PlaneWriter:
    def __init__(self, out, unit: int = 8, chunk: int = CHUNK, level: int = 1):
        self.out, self.unit, self.chunk = out, unit, chunk
        self.packer = zstandard.ZstdCompressor(level=level)
        self.at = out.write(MAGIC) or len(MAGIC)
        self.at = len(MAGIC)
        self.index: list[bytes] = []
        self.waiting: list[bytes] = []
        self.held = 0
        self.docs, self.sizes = array("q"), array("Q")

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(-(1 << 63) if doc_id is None else doc_id)
        self.sizes.append(len(ids) // 4)
        self.waiting.append(ids)
        self.held += len(ids) // 4
        if self.held >= self.chunk:
            self._flush(False)

    def _flush(self, everything: bool) -> None:
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        upto = len(ids) if everything else len(ids) - len(ids) % self.chunk
        for s in range(0, upto, self.chunk):
            part = ids[s : min(s + self.chunk, upto)]
            packed = [self.packer.compress(p) if p.strip(b"\0") else b"" for p in split_planes(part, self.unit)]
            self.index.append(struct.pack("<QII", self.at, len(part), zlib.crc32(part.tobytes())) + struct.pack(f"<{len(packed)}I", *map(len, packed)))
            for p in packed:
                self.out.write(p)
                self.at += len(p)
        self.waiting, self.held = [ids[upto:].tobytes()], len(ids) - upto

    def close(self) -> int:
        if self.held:
            self._flush(True)
        head = struct.pack("<IIQQ", self.unit, 32 // self.unit, len(self.index), len(self.docs))
        footer = self.packer.compress(head + b"".join(self.index) + self.docs.tobytes() + self.sizes.tobytes())
        self.out.write(footer)
        self.out.write(struct.pack("<Q", self.at) + MAGIC)
        return int(np.frombuffer(self.sizes, np.uint64).sum()) if len(self.sizes) else 0


class PlaneReader:
    def __init__(self, source):
        self.source = source
        end = source.size()
        source.seek(end - 16)
        tail = source.read(16)
        if tail[8:] != MAGIC:
            raise ValueError("not a plane file")
        at = struct.unpack("<Q", tail[:8])[0]
        source.seek(at)
        footer = zstandard.ZstdDecompressor().decompress(source.read(end - 16 - at))
        self.unit, self.planes, chunks, docs = struct.unpack_from("<IIQQ", footer)
        at, self.chunks = 24, []
        for _ in range(chunks):
            self.chunks.append(struct.unpack_from(f"<QII{self.planes}I", footer, at))
            at += 16 + 4 * self.planes
        self.doc_ids = np.frombuffer(footer, "<i8", docs, at)
        self.sizes = np.frombuffer(footer, "<u8", docs, at + 8 * docs)

    def chunk(self, k: int) -> np.ndarray:
        at, n, crc, *lengths = self.chunks[k]
        self.source.seek(at)
        unpack = zstandard.ZstdDecompressor().decompress
        planes = [unpack(self.source.read(size)) if size else b"" for size in lengths]
        ids = join_planes(planes, n, self.unit)
        if zlib.crc32(ids.tobytes()) != crc:
            raise ValueError(f"chunk {k} is damaged")
        return ids

    def documents(self) -> Iterator[tuple[int | None, list[np.ndarray]]]:
        """(doc_id, its ids in pieces), reading each chunk once."""
        k, left = 0, np.zeros(0, "<u4")
        for doc, size in zip(self.doc_ids.tolist(), self.sizes.tolist()):
            parts = []
            while size:
                if not len(left):
                    left, k = self.chunk(k), k + 1
                parts.append(left[:size])
                size -= len(parts[-1])
                left = left[len(parts[-1]) :]
            yield (None if doc == -(1 << 63) else doc), parts


def write_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, unit: int = 8, shards: int | None = None) -> DataFrame:
    """Write shards under ``path``; the committed manifest (part, path, n_docs, n_tokens)."""
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    if shards is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(8, min(-(-size // SHARD_BYTES), 1 << 20))
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer, out, n = TaskContext.get().partitionId(), None, None, 0
        coder = encoder(tokenizer)
        for b in batches:
            if b.num_rows and writer is None:
                store, base = fs.FileSystem.from_uri(path)
                store.create_dir(base, recursive=True)
                name = f"part-{part:06d}-{uuid.uuid4().hex}.vpl"
                out = store.open_output_stream(f"{base}/{name}")
                writer = PlaneWriter(out, unit)
            for doc, ids in zip(b.column(0).to_pylist(), coder.stream(b.column(1).cast(pa.string()))):
                writer.add(doc, ids + end)
                n += 1
        if writer is not None:
            total = writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "path": [f"{path}/{name}"], "n_docs": pa.array([n], pa.int64()), "n_tokens": pa.array([total], pa.int64())})

    dealt = docs.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    written = dealt.mapInArrow(run, "part long, path string, n_docs long, n_tokens long")
    return materialize(written, "token-manifest")


def read_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files of a manifest, one file a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                store, name = fs.FileSystem.from_uri(file)
                with store.open_input_file(name) as source:
                    rows: list[tuple] = []
                    for doc, parts in PlaneReader(source).documents():
                        crc, size = 0, 0
                        for p in parts:
                            crc = zlib.crc32(p.tobytes(), crc)
                            size += len(p)
                        rows.append((doc, start, size, crc))
                        start += size
                columns = list(zip(*rows)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # One row per shard: the running sum is over the manifest only.
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = manifest.select("path", before.cast("long").alias("start"))
    files = max(manifest.count(), 1)
    return placed.repartition(files).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 0, unit: int = 8) -> DataFrame:
    return read_files(write_files(docs, new_path(docs.sparkSession, "tokens"), tokenizer, end_id, unit))
