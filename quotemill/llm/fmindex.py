"""Benchmark decontamination with one FM-index over words per training shard.

A shard holds whole documents, about SHARD_WORDS words, in the order they are read; nothing is
shuffled to build it. Every distinct word of a shard is a symbol, every document ends in a symbol of
its own, suffixes are sorted by prefix doubling, and the Burrows-Wheeler transform is kept as a wavelet
matrix. Test phrases are searched backwards through its ranks, all phrases of a length at once; the
suffix position of a hit is found by stepping back to the next sampled one. Hits become word spans,
and spans of a document are merged.

A window is ``width`` consecutive words of an item; an item of fewer words, but not none, is one
window. The items are read in blocks of at most BLOCK_WINDOWS windows (one item at least), so what is
broadcast is bounded; results of several blocks are merged per document.

Null and empty texts have no words and no hits; a null item id counts as the empty string; items
with equal ids are one item; repeated documents are judged one by one; an empty table gives an empty
result.
"""

from collections import defaultdict

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import raw_texts, release, stage
from quotemill.llm.wavelet import WaveletMatrix, join_parts, pack_rows, split_parts, unpack_rows

SHARD_WORDS = 1 << 20
SAMPLE = 32
WINDOW_WORDS = 10
BLOCK_WINDOWS = 1 << 16

# Lower-cases A-Z; all ASCII but digits and letters becomes a space.
_CLEAN = bytes(
    i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i > 127 else 32 for i in range(256)
)


def words(data: bytes) -> list[bytes]:
    return data.translate(_CLEAN).split()


def word_ranges(data: bytes) -> np.ndarray:
    """(start, end) byte offsets of the words, one row each."""
    inside = np.frombuffer(data.translate(_CLEAN), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    return edges.reshape(-1, 2)


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only suffixes that are still tied are sorted again."""
    n = len(symbols)
    top = int(symbols.max()) + 2
    ranks = symbols.astype(np.int64) + 1
    depth = 1
    while depth < 4 and top ** (depth + 1) < 2**62:
        depth += 1
    key, shifted = np.zeros(n, np.int64), np.concatenate([ranks, np.zeros(depth, np.int64)])
    for d in range(depth):
        key = key * top + shifted[d : d + n]
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    while True:
        slots = np.flatnonzero(~(head & np.append(head[1:], True)))  # places of tied suffixes
        if not len(slots):
            return order
        tied = order[slots]
        after = tied + depth
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        first = rank[tied]
        again = np.argsort(first * (n + 1) + second, kind="stable")
        tied, first, second = tied[again], first[again], second[again]
        order[slots] = tied
        fresh = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        head[slots] = fresh
        rank[tied] = np.maximum.accumulate(np.where(fresh, slots, 0))
        depth *= 2


class FMIndex:
    """Words of a few documents, searchable without their text."""

    def __init__(self, vocabulary: dict[bytes, int], matrix: WaveletMatrix, first: np.ndarray, marks: np.ndarray, samples: np.ndarray, starts: np.ndarray):
        self.vocabulary, self.matrix, self.first = vocabulary, matrix, first
        self.marks, self.samples, self.starts = marks, samples, starts

    @staticmethod
    def build(texts: list[list[bytes]]) -> list[bytes]:
        """Parts of the file of an index over the words of documents."""
        number: dict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        docs = len(texts)
        lengths = np.array([len(t) + 1 for t in texts], np.int64)
        ends = np.cumsum(lengths)
        symbols = np.empty(int(ends[-1]), np.int64)
        for d, (t, end) in enumerate(zip(texts, ends.tolist(), strict=True)):
            symbols[end - len(t) - 1 : end - 1] = np.fromiter(map(number.__getitem__, t), np.int64, len(t)) + docs
            symbols[end - 1] = d
        order = suffix_order(symbols)
        last = symbols[order - 1]
        marked = order % SAMPLE == 0
        pack = zstandard.ZstdCompressor(level=1).compress
        return [
            np.array([docs], "<u8").tobytes(),
            pack(b"\n".join(number)),
            pack(lengths.astype("<u4").tobytes()),
            pack(np.packbits(marked, bitorder="little").tobytes()),
            pack(order[marked].astype("<u4").tobytes()),
            *WaveletMatrix.build(last.astype(np.uint32)).to_parts(),
        ]

    @classmethod
    def open(cls, parts: list[bytes]):
        unpack = zstandard.ZstdDecompressor().decompress
        docs = int(np.frombuffer(parts[0], "<u8")[0])
        listed = unpack(parts[1])
        vocabulary = {w: i + docs for i, w in enumerate(listed.split(b"\n") if listed else [])}
        lengths = np.frombuffer(unpack(parts[2]), "<u4").astype(np.int64)
        matrix = WaveletMatrix.from_parts(parts[5:])
        marks = np.unpackbits(np.frombuffer(unpack(parts[3]), np.uint8), count=matrix.size, bitorder="little").view(bool)
        samples = np.frombuffer(unpack(parts[4]), "<u4").astype(np.int64)
        kinds = len(vocabulary) + docs
        first = np.concatenate([[0], np.cumsum(matrix.count(np.arange(kinds)))])
        return cls(vocabulary, matrix, first, marks, samples, np.concatenate([[0], np.cumsum(lengths)]))

    def ranges(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of every phrase; phrases are rows of symbols of one length."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.matrix.size, np.int64)
        alive = np.arange(len(phrases))
        for symbol in phrases.T[::-1]:
            s = symbol[alive]
            low[alive] = self.first[s] + self.matrix.rank(s, low[alive])
            high[alive] = self.first[s] + self.matrix.rank(s, high[alive])
            alive = alive[low[alive] < high[alive]]
            if not len(alive):
                break
        high = np.maximum(low, high)
        dead = np.ones(len(phrases), bool)
        dead[alive] = False
        high[dead] = low[dead]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row, by stepping back to the next sampled suffix."""
        seen = np.concatenate([[0], np.cumsum(self.marks)])
        out, steps = np.empty(len(rows), np.int64), 0
        open_, at = np.arange(len(rows)), np.asarray(rows, np.int64)
        while len(open_):
            done = self.marks[at]
            out[open_[done]] = self.samples[seen[at[done]]] + steps
            open_, at = open_[~done], at[~done]
            symbol = self.matrix.access(at)
            at = self.first[symbol] + self.matrix.rank(symbol, at)
            steps += 1
        return out

    def search(self, phrases: list[tuple[bytes, ...]]) -> tuple[np.ndarray, np.ndarray]:
        """(phrase number, text position) of all occurrences."""
        by_length: dict[int, list[int]] = {}
        for i, p in enumerate(phrases):
            if all(w in self.vocabulary for w in p):
                by_length.setdefault(len(p), []).append(i)
        found, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for numbers in by_length.values():
            low, high = self.ranges(np.array([[self.vocabulary[w] for w in phrases[i]] for i in numbers], np.int64))
            times = high - low
            rows = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
            found.append(np.repeat(np.array(numbers, np.int64), times))
            places.append(self.locate(rows))
        return np.concatenate(found), np.concatenate(places)


def build_shards(docs: DataFrame, keep: list[str], text: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """Index files (shard long, file binary); ``keep`` columns travel with each document."""

    def run(batches):
        shard = TaskContext.get().partitionId() << 32
        rows, texts, held = [], [], 0

        def flush():
            kept = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            blob = join_parts([pack_rows(kept), *FMIndex.build(texts)])
            return pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([blob], pa.binary())], ["shard", "file"])

        for b in batches:
            kept = b.select(keep)
            begin = 0
            for i, data in enumerate(raw_texts(b.column(b.schema.get_field_index(text)))):
                texts.append(words(data))
                held += len(texts[-1]) + 1
                if held >= shard_words:
                    rows.append(kept.slice(begin, i + 1 - begin))
                    yield flush()
                    shard, rows, texts, held, begin = shard + 1, [], [], 0, i + 1
            if begin < b.num_rows:
                rows.append(kept.slice(begin))
        if texts:
            yield flush()
        del rows, texts
        release()

    return stage(docs.select(*keep, text).mapInArrow(run, "shard long, file binary"), "fm-index", 8)


def windows(data: bytes, width: int) -> list[tuple[bytes, ...]]:
    w = words(data)
    if len(w) <= width:
        return [tuple(w)] if w else []
    return [tuple(w[i : i + width]) for i in range(len(w) - width + 1)]


def phrase_blocks(items: DataFrame, item_id: str, text: str, width: int, limit: int):
    """Dicts of window -> item ids; items stream through the driver, one block at a time."""
    block: dict[tuple[bytes, ...], set[str]] = {}
    for r in items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t")).toLocalIterator():
        for w in windows((r["t"] or "").encode(), width):
            block.setdefault(w, set()).add(r["i"])
        if len(block) >= limit:
            yield block
            block = {}
    if block:
        yield block


def _merge(starts, ends):
    """Union of spans sorted by start."""
    reach = np.maximum.accumulate(ends)
    head = np.concatenate([[True], starts[1:] > reach[:-1]])
    first = np.flatnonzero(head)
    return starts[first], reach[np.concatenate([first[1:] - 1, [len(starts) - 1]])]


def _search_block(shards: DataFrame, schema: str, block) -> DataFrame:
    shared = shards.sparkSession.sparkContext.broadcast([(w, sorted(ids)) for w, ids in (block or {}).items()])

    def run(batches):
        phrases = [w for w, _ in shared.value]
        sizes = np.array([len(w) for w in phrases], np.int64)
        for b in batches:
            for shard, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                parts = split_parts(blob)
                kept = unpack_rows(parts[0]).combine_chunks().to_batches()[0]
                index = FMIndex.open(parts[1:])
                n = kept.num_rows
                spans, items = [[] for _ in range(n)], [[] for _ in range(n)]
                which, place = index.search(phrases)
                if len(place):
                    order = np.argsort(place, kind="stable")
                    which, place = which[order], place[order]
                    starts, ends = _merge(place, place + sizes[which])
                    doc = np.searchsorted(index.starts, starts, side="right") - 1
                    for d, s, e in zip(doc.tolist(), (starts - index.starts[doc]).tolist(), (ends - index.starts[doc]).tolist(), strict=True):
                        spans[d].append({"first": s, "last": e})
                    hit = np.unique((np.searchsorted(index.starts, place, side="right") - 1) * len(phrases) + which)
                    found: dict[int, set[str]] = {}
                    for d, p in zip((hit // len(phrases)).tolist(), (hit % len(phrases)).tolist(), strict=True):
                        found.setdefault(d, set()).update(shared.value[p][1])
                    for d, ids in found.items():
                        items[d] = sorted(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.StructArray.from_arrays(kept.columns, kept.schema.names),
                        pa.array(np.full(n, shard, np.int64)),
                        pa.array(np.arange(n, dtype=np.int64)),
                        pa.array(np.diff(index.starts) - 1),
                        pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    ["doc", "shard", "at", "n_words", "spans", "items"],
                )

    out = f"doc {schema}, shard long, at long, n_words long, spans array<struct<first:long,last:long>>, items array<string>"
    return shards.select("shard", "file").mapInArrow(run, out)


def _union_spans(spans):
    """Merged spans of a document from those of several blocks."""
    return F.aggregate(
        F.array_sort(spans),
        F.array().cast("array<struct<first:long,last:long>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["last"] >= x["first"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["first"].alias("first"), F.greatest(F.element_at(acc, -1)["last"], x["last"]).alias("last"))),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )


def search_shards(shards: DataFrame, schema: str, items: DataFrame, item_id: str = "item_id", text: str = "text", width: int = WINDOW_WORDS, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(doc, shard, at, n_words, spans, items) of every document; spans count words, end exclusive."""
    parts = [_search_block(shards, schema, b) for b in phrase_blocks(items, item_id, text, width, block_windows)]
    if not parts:
        return _search_block(shards, schema, None)
    if len(parts) == 1:
        return parts[0]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionAll(p)
    merged = every.groupBy("shard", "at").agg(
        F.first("doc").alias("doc"),
        F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return merged.select("doc", "shard", "at", "n_words", _union_spans(F.col("spans")).alias("spans"), "items")


def contamination(docs: DataFrame, items: DataFrame, keep: list[str], text: str = "text", **options) -> DataFrame:
    """``keep`` columns of every document with n_words, spans and items."""
    shards = build_shards(docs, keep, text)
    found = search_shards(shards, docs.select(*keep).schema.simpleString(), items, **options)
    return found.select("doc.*", "n_words", "spans", "items")


def cut_words(data: bytes, spans) -> bytes:
    """A text without the words of the spans and what stands between them."""
    at = word_ranges(data)
    out, done = [], 0
    for s in spans:
        out.append(data[done : at[s["first"], 0]])
        done = at[s["last"] - 1, 1]
    return b"".join([*out, data[done:]])


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every hit passage cut from its text; all documents stay."""
    key = "_text_hash"
    marked = docs.withColumn(key, F.xxhash64(F.coalesce(text, F.lit(""))))
    hits = contamination(marked, items, [doc_id, key], text).filter(F.size("spans") > 0)
    hits = hits.select(F.col(doc_id).alias("_id"), F.col(key).alias("_hash"), F.col("spans").alias("_spans")).dropDuplicates(["_id", "_hash"])

    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array(
            [t if not s else cut_words(t.encode(), s).decode() for t, s in zip(texts.to_pylist(), spans.to_pylist(), strict=True)],
            pa.string(),
        )

    same = F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col(key) == F.col("_hash"))
    joined = marked.join(hits, same, "left")
    return joined.withColumn(text, F.arrow_udf(cut, "string")(F.col(text), F.col("_spans"))).select(*docs.columns)
