"""Byte-level BPE by longest-match backtracking.

Token bytes are mapped to Latin-1 strings, so one Aho-Corasick automaton finds the longest token at
a position. A sequence of tokens is what the merge rules give exactly when every adjacent pair is
(two tokens are compatible when merging their joined bytes gives the same two tokens back), so the
encoder takes the longest token that is compatible with its left neighbour, falls back to shorter
ones, and steps back where none fits; positions that lead nowhere are marked once, which keeps the
work linear in the piece. Compatibility is memoised; a new pair is decided at its seam: the merges
behind both tokens are undone, the latest first, and at no time may the two parts that meet at the seam
have merged before the parts were used up on their own side. That takes one look-up per undone merge.

Memos of pieces and chunks are made by the task that uses them, bounded in bytes, and gone when it ends.

Null text is encoded as the empty text, which has no tokens. Rows are encoded one by one, repeated
ones too, and an empty table gives an empty result. Columns of the input come back as they are,
but for columns with the names of the results (``token_ids``, ``n_tokens``, ``decoded``), which are replaced.
Every byte value must be a token of its own, else ``ByteBPE`` raises.
"""

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import functions as F

from quotemill.llm.common import Memo, release, space_chunks
from quotemill.session import configure

PAIRS = 1 << 18
PIECE_BYTES = 24 << 20
CHUNK_BYTES = 80 << 20
LONGEST_KEPT = 64


class ByteBPE:
    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"bytes without a token: {missing[:5]}")
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.tokens[rank] = token
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.sizes = [len(t) for t in self.tokens]
        self._pairs: dict[tuple[int, int], bool] = {}
        self._shorter: dict[int, int] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}

    def _merge(self, data: bytes, below: int) -> list[bytes]:
        """The parts left by the merges of rank under ``below``: lowest rank first, leftmost on ties."""
        parts = [bytes([b]) for b in data]
        while len(parts) > 1:
            best = min(
                ((self.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ranks),
                default=None,
            )
            if best is None or best[0] >= below:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def merged(self, data: bytes) -> list[int]:
        """The merge rules as they are written."""
        return [self.ranks[p] for p in self._merge(data, len(self.tokens))]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte and for a token no merge makes."""
        if token not in self._halves:
            parts = self._merge(self.tokens[token], token)
            self._halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self._halves[token]

    def compatible(self, left: int, right: int) -> bool:
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) >= PAIRS:
                self._pairs.clear()
            known = self._pairs[left, right] = self._seam_holds(left, right)
        return known

    def _seam_holds(self, left: int, right: int) -> bool:
        """Whether no merge crosses the seam while the two tokens grow; seen backwards in time."""
        rank, tokens, halves = self.ranks, self.tokens, self.halves
        for whole in (left, right):
            if len(tokens[whole]) > 1 and halves(whole) is None:
                return False
        until = len(tokens)  # both parts at the seam are there for merges of rank under this one
        while True:
            across = rank.get(tokens[left] + tokens[right])
            if across is not None and across < until:
                return False
            a, b = halves(left), halves(right)
            if a is None and b is None:
                return True
            # Of merges of one rank the left one comes first: it is undone last, and it goes before one across.
            if b is None or (a is not None and left > right):
                until, left = left, a[1]
            else:
                until, right = right + 1, b[0]

    def shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of this one; -1 if none."""
        found = self._shorter.get(token)
        if found is None:
            data = self.tokens[token]
            found = next((self.ranks[data[:n]] for n in range(len(data) - 1, 0, -1) if data[:n] in self.ranks), -1)
            self._shorter[token] = found
        return found

    def longest(self, text: str) -> list[int]:
        """The longest token that begins at every byte; ends rise, so a later one is a longer one."""
        out, sizes = [0] * len(text), self.sizes
        for end, token in self.automaton.iter(text):
            out[end - sizes[token] + 1] = token
        return out

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size, sizes, pairs = len(piece), self.sizes, self._pairs
        longest = self.longest(piece.decode("latin-1"))
        tokens, starts, dead = [], [], bytearray(size + 1)
        at, token, left = 0, longest[0] if size else -1, -1
        while at < size:
            while token >= 0:
                end = at + sizes[token]
                if not dead[end]:
                    if left < 0:
                        break
                    fits = pairs.get((left, token))
                    if self.compatible(left, token) if fits is None else fits:
                        break
                token = self.shorter(token)
            if token >= 0:
                tokens.append(token)
                starts.append(at)
                at, left = end, token
                token = longest[at] if at < size else -1
            else:
                if not tokens:
                    raise ValueError("no token sequence fits the merge rules")
                dead[at] = 1
                token, at = self.shorter(tokens.pop()), starts.pop()
                left = tokens[-1] if tokens else -1
        return tokens


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, with memos of pieces and of chunks between spaces."""

    def __init__(self, bpe: ByteBPE, pattern: str, piece_bytes: int = PIECE_BYTES, chunk_bytes: int = CHUNK_BYTES):
        self.bpe, self.split = bpe, regex.compile(pattern).findall
        self.pieces, self.chunks = Memo(piece_bytes), Memo(chunk_bytes)

    def _piece(self, piece: str) -> list[int]:
        got = self.pieces.get(piece)
        if got is None:
            got = self.bpe.encode(piece.encode())
            if len(piece) <= LONGEST_KEPT:
                self.pieces.put(piece, got, 2 * len(piece) + 8 * len(got))
        return got

    def _encoded(self, chunk: str) -> bytes:
        pieces = self.split(chunk)
        # a chunk that is one piece is kept as a chunk only
        ids = self.bpe.encode(chunk.encode()) if len(pieces) == 1 else [i for p in pieces for i in self._piece(p)]
        out = array("I", ids).tobytes()
        if len(chunk) <= LONGEST_KEPT:
            self.chunks.put(chunk, out, 2 * len(chunk) + len(out))
        return out

    def encode(self, text: str) -> bytes:
        cut = space_chunks(text)
        known = self.chunks.get
        return b"".join([known(c) or self._encoded(c) for c in ([text] if cut is None else cut)])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def _bpe(path: str) -> ByteBPE:
    return ByteBPE(read_ranks(path))


def encode_column(text, ranks_path: str, pattern: str):
    """Binary column: the ids of ``text`` as little-endian unsigned 32-bit integers."""

    def encode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = Encoder(_bpe(ranks_path), pattern)
        for column in columns:
            yield pa.array([None if x is None else coder.encode(x) for x in column.to_pylist()], pa.binary())
        del coder  # its memos end with the task
        release()

    return F.arrow_udf(encode, "binary")(text)


def decode_ids(ids: pa.Array, tokens: pa.Array) -> pa.Array:
    """The bytes behind a column of encoded ids: all tokens of the column are taken at once."""
    sizes = [0 if x is None else len(x) // 4 for x in ids.to_pylist()]
    flat = np.frombuffer(b"".join(x for x in ids.to_pylist() if x), "<u4")
    taken = tokens.take(pa.array(flat))
    places = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, 8 * taken.offset)
    ends = places[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)]
    joined = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends.tobytes()), taken.buffers()[2]])
    return pa.compute.if_else(ids.is_valid(), joined, pa.scalar(None, pa.large_binary())).cast(pa.binary())


def decode_column(ids, ranks_path: str):
    """Binary column: the bytes that a column of encoded ids stands for."""

    def decode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = pa.array(_bpe(ranks_path).tokens, pa.large_binary())
        for column in columns:
            yield decode_ids(column, tokens)
        release()

    return F.arrow_udf(decode, "binary")(ids)


def encode_documents(docs, ranks_path: str, pattern: str, text: str = "text"):
    """``docs`` with ``token_ids`` (binary) and ``n_tokens``; null text is encoded as empty."""
    configure(docs.sparkSession)
    ids = encode_column(F.coalesce(F.col(text), F.lit("")), ranks_path, pattern)
    return docs.withColumn("token_ids", ids).withColumn("n_tokens", (F.octet_length("token_ids") / 4).cast("long"))


def decode_documents(encoded, ranks_path: str):
    """``encoded`` with ``decoded`` (binary)."""
    configure(encoded.sparkSession)
    return encoded.withColumn("decoded", decode_column(F.col("token_ids"), ranks_path))
