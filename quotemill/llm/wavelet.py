"""Token ids as wavelet matrices, one compressed file per shard.

A shard holds whole documents in ascending id order (null ids first, then by a hash of the text), at
least one and about SHARD_TOKENS tokens. Its ids are stored as bit planes, most significant first; a
plane is written in the order that the planes above it give, zeros before ones, so ranks on the
planes lead from a position to its id (access), from an id to how often it came before a position
(rank), and back to the k-th place of an id (select), without the ids themselves. Planes are
compressed one by one; rank directories are counted when a shard is opened.

A null text is an empty document, which still gets its end id; repeated rows are documents of their
own; an empty table gives no shards.
"""

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from quotemill.llm.common import space_chunks, stage

MAGIC = b"QMWM"
SHARD_TOKENS = 1 << 21
MEMO_ENTRIES = 1_200_000  # about 200 MB
_INNER_SPACE = re.compile(r".\s|^\s*$|^[^\S ]", re.DOTALL).search


class WaveletMatrix:
    def __init__(self, planes: list[np.ndarray], zeros: list[int], size: int):
        self.planes, self.zeros, self.size = planes, zeros, size
        self.levels = len(planes)
        self._ranks: list[np.ndarray | None] = [None] * self.levels

    @classmethod
    def build(cls, values: np.ndarray, levels: int | None = None):
        """Of an array of unsigned integers."""
        levels = levels or max(int(values.max()).bit_length() if len(values) else 1, 1)
        planes, zeros = [], []
        for level in reversed(range(levels)):
            bit = (values & values.dtype.type(1 << level)) != 0
            packed = np.packbits(bit, bitorder="little")
            planes.append(np.pad(packed, (0, -len(packed) % 8)).view("<u8"))
            low = values[~bit]
            zeros.append(len(low))
            values = np.concatenate([low, values[bit]])
        return cls(planes, zeros, len(values))

    def ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """How many ones a plane has before each position."""
        plane, ranks = self.planes[level], self._ranks[level]
        if ranks is None:
            ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(plane), dtype=np.int64)])
            self._ranks[level] = ranks
        word, inside = at >> 6, (at & 63).astype(np.uint64)
        part = np.append(plane, np.uint64(0))[word] & ((np.uint64(1) << inside) - np.uint64(1))
        return ranks[word] + np.bitwise_count(part)

    def access(self, at: np.ndarray) -> np.ndarray:
        at, out = np.asarray(at, np.int64), np.zeros(len(at), np.int64)
        for level in range(self.levels):
            bit = (self.planes[level][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            ones = self.ones(level, at)
            at = np.where(bit, self.zeros[level] + ones, at - ones)
            out = out << 1 | bit
        return out

    def rank(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each value occurs before each position."""
        value, end = np.asarray(value, np.int64), np.asarray(at, np.int64)
        start = np.zeros_like(end)
        for level in range(self.levels):
            bit = (value >> (self.levels - 1 - level)) & 1 == 1
            a, b = self.ones(level, start), self.ones(level, end)
            start = np.where(bit, self.zeros[level] + a, start - a)
            end = np.where(bit, self.zeros[level] + b, end - b)
        return end - start

    def count(self, value: np.ndarray) -> np.ndarray:
        return self.rank(value, np.full(len(value), self.size, np.int64))

    def positions(self, value: int) -> np.ndarray:
        """Every place of a value (select for all k), in order."""
        start, end = np.zeros(1, np.int64), np.full(1, self.size, np.int64)
        for level in range(self.levels):
            a, b = self.ones(level, start), self.ones(level, end)
            if value >> (self.levels - 1 - level) & 1:
                start, end = self.zeros[level] + a, self.zeros[level] + b
            else:
                start, end = start - a, end - b
        at = np.arange(start[0], end[0])
        for level in reversed(range(self.levels)):
            bits = np.unpackbits(self.planes[level].view(np.uint8), count=self.size, bitorder="little")
            one = bool(value >> (self.levels - 1 - level) & 1)
            at = np.flatnonzero(bits == one)[at - (self.zeros[level] if one else 0)]
        return at

    def values(self) -> np.ndarray:
        """All values in order, plane by plane from the last one up."""
        out = np.zeros(self.size, np.uint16 if self.levels <= 16 else np.uint32)
        for shift, level in enumerate(reversed(range(self.levels))):
            bit = np.unpackbits(self.planes[level].view(np.uint8), count=self.size, bitorder="little").view(bool)
            below, out = out, np.empty_like(out)
            out[~bit] = below[: self.zeros[level]]
            out[bit] = below[self.zeros[level] :] | out.dtype.type(1 << shift)
        return out

    def to_parts(self) -> list[bytes]:
        pack = zstandard.ZstdCompressor(level=1).compress
        return [np.array([self.size, *self.zeros], "<u8").tobytes(), *[pack(p.tobytes()) for p in self.planes]]

    @classmethod
    def from_parts(cls, parts: list[bytes]):
        head = np.frombuffer(parts[0], "<u8").tolist()
        unpack = zstandard.ZstdDecompressor().decompress
        return cls([np.frombuffer(unpack(p), "<u8") for p in parts[1:]], head[1:], head[0])


def join_parts(parts: list[bytes]) -> bytes:
    """MAGIC, number of parts, their lengths, the parts."""
    return b"".join([MAGIC, np.array([len(parts), *map(len, parts)], "<u8").tobytes(), *parts])


def split_parts(blob: bytes) -> list[bytes]:
    if blob[:4] != MAGIC:
        raise ValueError("not a shard file")
    n = int(np.frombuffer(blob, "<u8", 1, 4)[0])
    ends = 12 + 8 * n + np.cumsum(np.concatenate([[0], np.frombuffer(blob, "<u8", n, 12).astype(np.int64)]))
    return [blob[a:b] for a, b in zip(ends, ends[1:])]


def pack_rows(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return zstandard.ZstdCompressor(level=1).compress(sink.getvalue().to_pybytes())


def unpack_rows(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data)).read_all()


class Encoder:
    """A tokenizer file with a bounded memo of chunks between spaces."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        split = self.tokenizer.pre_tokenizer
        self.chunked = self.tokenizer.normalizer is None and isinstance(split, ByteLevel) and split.use_regex and not split.add_prefix_space
        self.tokenizer.model._resize_cache(0)  # only new pieces come here
        self.line_feed = self.tokenizer.token_to_id("Ċ")
        self.memo: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks without line feeds: one library call on all of them, a line feed between two.

        The split pattern makes each of these line feeds a pre-token, so its id marks the cuts.
        """
        ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(chunks) + "\n"], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(ids == self.line_feed)
        if len(ends) != len(chunks):
            return self._library(chunks)
        data, starts = ids.tobytes(), np.concatenate([[0], ends[:-1] + 1])
        return [data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers, as the library gives them for whole texts."""
        cut = [space_chunks(t) if self.chunked else None for t in texts]
        memo = self.memo
        seen = set().union(*[c for c in cut if c])
        if len(memo) > MEMO_ENTRIES:
            memo = self.memo = {c: memo[c] for c in seen if c in memo}
        new = seen.difference(memo)
        single = [c for c in new if not _INNER_SPACE(c)]
        for at in range(0, len(single), 4096):
            part = single[at : at + 4096]
            memo.update(zip(part, self._pieces(part), strict=True))
        whole = [c for c in new if c not in memo]
        memo.update(zip(whole, self._library(whole), strict=True))
        uncut = iter(self._library([t for t, c in zip(texts, cut, strict=True) if c is None]))
        return [next(uncut) if chunks is None else b"".join(map(memo.__getitem__, chunks)) for chunks in cut]


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def write_shards(docs: DataFrame, tokenizer_path: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Shard files in ascending id order: (part, seq, n_docs, n_tokens, file). Texts are shuffled once, by id range."""
    ordered = docs.select(F.col(doc_id).alias("_id"), F.coalesce(text, F.lit("")).alias("_text"))
    ordered = ordered.repartitionByRange("_id").sortWithinPartitions("_id", F.xxhash64("_text"))

    def run(batches):
        coder, part, seq = _encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        ids, lengths, data, held = [], [], [], 0

        def flush():
            rows = pa.RecordBatch.from_arrays([pa.concat_arrays(ids), pa.array(lengths, pa.int64())], ["id", "n"])
            values = np.frombuffer(b"".join(data), "<u4")
            levels = max(int(values.max()).bit_length(), 1)
            matrix = WaveletMatrix.build(values.astype(np.uint16) if levels <= 16 else values, levels)
            blob = join_parts([pack_rows(rows), *matrix.to_parts()])
            arrays = [pa.array([x], t) for x, t in ((part, pa.int32()), (seq, pa.int32()), (len(lengths), pa.int64()), (held, pa.int64()), (blob, pa.binary()))]
            return pa.RecordBatch.from_arrays(arrays, ["part", "seq", "n_docs", "n_tokens", "file"])

        for b in batches:
            for at in range(0, b.num_rows, 256):
                piece = b.slice(at, 256)
                for i, raw in enumerate(coder.encode(piece.column(1).to_pylist())):
                    ids.append(piece.column(0).slice(i, 1))
                    lengths.append(len(raw) // 4 + 1)
                    data += [raw, end]
                    held += lengths[-1]
                    if held >= shard_tokens:
                        yield flush()
                        seq, ids, lengths, data, held = seq + 1, [], [], [], 0
        if lengths:
            yield flush()

    return stage(ordered.mapInArrow(run, "part int, seq int, n_docs long, n_tokens long, file binary"), "token-shards", 8)


def read_documents(shards: DataFrame, id_type: str = "long") -> DataFrame:
    """Decoded documents of shard files: (part, seq, doc_id, at, n_tokens, ids); ``at`` counts inside the shard."""

    def run(batches):
        for b in batches:
            for part, seq, blob in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                parts = split_parts(blob)
                rows = unpack_rows(parts[0])
                lengths = rows["n"].to_numpy()
                ends = np.cumsum(lengths)
                values = WaveletMatrix.from_parts(parts[1:]).values().astype("<u4")
                for a in range(0, len(lengths), 512):
                    n = len(lengths[a : a + 512])
                    starts = ends[a : a + n] - lengths[a : a + n]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, part, np.int32)),
                            pa.array(np.full(n, seq, np.int32)),
                            rows["id"].slice(a, n).combine_chunks(),
                            pa.array(starts),
                            pa.array(lengths[a : a + n]),
                            pa.array([values[s:e].tobytes() for s, e in zip(starts, ends[a : a + n], strict=True)], pa.binary()),
                        ],
                        ["part", "seq", "doc_id", "at", "n_tokens", "ids"],
                    )

    schema = f"part int, seq int, doc_id {id_type}, at long, n_tokens long, ids binary"
    return shards.select("part", "seq", "file").mapInArrow(run, schema)


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, seq, first): tokens before each shard; sums per part first, one row per part after that."""
    narrow = shards.select("part", "seq", "n_tokens")
    parts = narrow.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_first"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    return narrow.select("part", "seq", inside.alias("inside")).join(parts, "part").select("part", "seq", (F.col("part_first") + F.col("inside")).alias("first"))


def token_places(shards: DataFrame, token_ids: list[int]) -> DataFrame:
    """(part, seq, token, place): where a few tokens stand, found by ranks without decoding the shards."""

    def run(batches):
        for b in batches:
            for part, seq, blob in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                matrix = WaveletMatrix.from_parts(split_parts(blob)[1:])
                for t in token_ids:
                    at = matrix.positions(t) if t < 1 << matrix.levels else np.zeros(0, np.int64)
                    n = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, seq, np.int32)), pa.array(np.full(n, t, np.int64)), pa.array(at)],
                        ["part", "seq", "token", "place"],
                    )

    return shards.select("part", "seq", "file").mapInArrow(run, "part int, seq int, token long, place long")

