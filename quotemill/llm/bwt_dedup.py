"""Removal of repeated passages, exact to the byte, by a column-wise Burrows-Wheeler construction.

Every ``length``-byte window of a text has an anchor, the smallest hash of its ``gram``-byte strings, so
equal windows have equal anchors wherever they stand. A run of windows with one anchor is a segment.
Segments are counted by anchor and content, in the batch before the shuffle: a segment that occurs
twice is covered whole, an anchor that occurs once covers nothing. Only where segments share an anchor and differ
is there more to find, and there the collection is built column by column: the segments are laid
under each other by their anchors, and from the right each round inserts one symbol of every
segment, a stable sort by symbol of the order before. The sorted symbols are the column's
Burrows-Wheeler transform, and the common prefix of neighbours is one more than the least common
prefix between their places in the round before. A window is repeated when the prefix it shares with
a neighbour is ``length`` or longer. Columns and transforms are written and read one after the other, in files beyond SPOOL_BYTES.

Building the columns of whole texts would take as many rounds as the longest text has bytes, each over all of the
transform; laid under each other by anchors, a round holds one column, and the rounds are at most
2 * length - gram.

Rows with equal id and text count as two texts and get the same result. Null text is empty; texts
under ``length`` bytes lose nothing; an empty table gives an empty result. The distinct segments of one
anchor are built in one task, about 400 bytes each.
"""

import hashlib
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.common import mix64, raw_texts, stage

LENGTH = 200
GRAM = 32
MAX_STARTS = 256
FILTER_BITS = 1 << 24
BATCH_BYTES = 4 << 20
SPOOL_BYTES = 64 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class _Powers:
    """Powers of the hash base and its inverse modulo 2**64, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int):
        while len(cls.up) < n:
            size = len(cls.up)
            step_up, step_down = np.array([pow(_BASE, size, 1 << 64)], np.uint64), np.array([pow(_INVERSE, size, 1 << 64)], np.uint64)
            cls.up = np.concatenate([cls.up, cls.up * step_up])
            cls.down = np.concatenate([cls.down, cls.down * step_down])
        return cls.up[:n], cls.down[:n]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by prefix and suffix minima of blocks."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def gram_hashes(data: bytes, gram: int = GRAM) -> np.ndarray:
    """Hash of every ``gram``-byte string, equal for equal strings."""
    n = len(data)
    up, down = _Powers.upto(n + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[np.frombuffer(data, np.uint8)] * up[:n], dtype=np.uint64)])
    return mix64((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])


def segments(data: bytes, length: int = LENGTH, gram: int = GRAM):
    """(first, starts, key, twice) of a text: runs of ``length``-byte windows with one anchor.

    The anchor of a window is the smallest hash of its ``gram``-byte strings, so equal windows have equal
    anchors wherever they stand. ``twice`` says that the anchor occurs more than once within the run.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.astype(bool)
    grams = gram_hashes(data, gram)
    width = length - gram + 1
    low = _sliding_min(grams, width)
    first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    starts = np.diff(np.append(first, len(low)))
    key = low[first]
    # Anchor places: a gram that is the minimum of some window that holds it.
    most = ~_sliding_min(~np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)]), width)
    place = np.flatnonzero(grams == most)
    value = grams[place]
    a, b = np.searchsorted(place, first), np.searchsorted(place, first + starts + width - 1)
    times = np.zeros(len(first), np.int64)
    for t in range(int((b - a).max())):
        at = np.minimum(a + t, len(place) - 1)
        times += (a + t < b) & (value[at] == key)
    twice = times > 1
    if (starts > MAX_STARTS).any():
        pieces = -(-starts // MAX_STARTS)
        of = np.repeat(np.arange(len(first)), pieces)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first, key, twice = first[of] + nth * MAX_STARTS, key[of], twice[of]
        starts = np.minimum(starts[of] - nth * MAX_STARTS, MAX_STARTS)
    return first, starts, key.view(np.int64), twice


def repeated_windows(texts: list[bytes], keys: list[int], length: int = LENGTH, gram: int = GRAM) -> list[np.ndarray]:
    """Per segment, a mask of its windows that stand somewhere else in these segments too.

    ``keys`` are the anchors. A segment is laid down once for every place of its anchor.
    """
    left, right = length - gram, length  # columns before and after an anchor that a window can reach
    owner, places = [], []
    for i, (text, key) in enumerate(zip(texts, keys, strict=True)):
        at = np.flatnonzero(gram_hashes(text, gram).view(np.int64) == key)
        owner += [i] * len(at)
        places += at.tolist()
    n, width = len(owner), left + right
    # Symbol 0 stands where a segment has none; bytes are shifted by one.
    rows = np.zeros((n, width), np.uint16)
    for r, (i, p) in enumerate(zip(owner, places, strict=True)):
        a, b = max(p - left, 0), min(p + right, len(texts[i]))
        rows[r, left - (p - a) : left + (b - p)] = np.frombuffer(texts[i], np.uint8, b - a, a).astype(np.uint16) + 1
    out = [np.zeros(len(t) - length + 1, bool) for t in texts]
    owner, places = np.array(owner, np.int64), np.array(places, np.int64)
    with tempfile.SpooledTemporaryFile(SPOOL_BYTES) as columns:
        columns.write(np.ascontiguousarray(rows.T).tobytes())
        del rows
        order, common = np.arange(n), np.zeros(n, np.int16)
        for column in reversed(range(width)):
            columns.seek(column * n * 2)
            symbols = np.frombuffer(columns.read(n * 2), np.uint16)[order]
            step = np.argsort(symbols, kind="stable")
            transform = symbols[step]
            order = order[step]
            same = np.concatenate([[False], (transform[1:] == transform[:-1]) & (transform[1:] > 0)])
            at = np.flatnonzero(same)
            fresh = np.zeros(n, np.int16)
            if len(at):
                bounds = np.stack([step[at - 1] + 1, step[at] + 1], axis=1).reshape(-1)
                padded = np.append(common, np.int16(0))
                fresh[at] = np.minimum(np.minimum.reduceat(padded, bounds)[::2] + 1, length)
            common = fresh
            if column <= left:
                full = common == length
                full[:-1] |= full[1:]
                for i, start in zip(owner[order[full]].tolist(), (places[order[full]] + column - left).tolist(), strict=True):
                    out[i][start] = True
    return out


def _marked(first, starts, keys, data, length):
    """Content hash of each segment."""
    return np.array(
        [int.from_bytes(hashlib.blake2b(data[a : a + c + length - 1], digest_size=8).digest(), "little", signed=True) for a, c in zip(first.tolist(), starts.tolist(), strict=True)],
        np.int64,
    )


def _counted(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, digest, n, kinds, open): segments that occur twice, or whose anchor needs the columns (``open``)."""

    def count(batches):
        for b in batches:
            keys, digests, twices = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
            for data in raw_texts(b.column(0)):
                first, starts, key, twice = segments(data, length, gram)
                keys.append(key)
                digests.append(_marked(first, starts, key, data, length))
                twices.append(twice)
            key, digest, twice = np.concatenate(keys), np.concatenate(digests), np.concatenate(twices)
            order = np.lexsort((digest, key))
            key, digest, twice = key[order], digest[order], twice[order]
            head = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (digest[1:] != digest[:-1])])) if len(key) else np.zeros(0, np.int64)
            n = np.diff(np.append(head, len(key)))
            yield pa.RecordBatch.from_arrays([pa.array(key[head]), pa.array(digest[head]), pa.array(n), pa.array(twice[head])], ["key", "digest", "n", "twice"])

    found = texts.select("text").mapInArrow(count, "key long, digest long, n long, twice boolean").repartition("key")
    found = found.groupBy("key", "digest").agg(F.sum("n").alias("n"), F.max("twice").alias("twice"))
    of_key = Window.partitionBy("key")
    found = found.withColumn("kinds", F.count(F.lit(1)).over(of_key)).withColumn("open", F.max((F.col("n") == 1) & ((F.col("kinds") > 1) | F.col("twice"))).over(of_key))
    return stage(found.filter((F.col("n") > 1) | F.col("open")).select("key", "digest", "n", "open"), "segment-counts")


def _key_filter(keys: DataFrame) -> np.ndarray:
    """Bitmap of FILTER_BITS bits: no key is missing, others may get through."""
    bit = F.pmod(F.col("key"), F.lit(FILTER_BITS))
    words = keys.select((bit / 64).cast("int").alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int")).alias("v"))
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for r in words.groupBy("w").agg(F.bit_or("v").alias("v")).collect():  # at most FILTER_BITS / 64 rows
        out[r["w"]] = r["v"]
    return out.view(np.uint8)


def _through(mask: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = keys % FILTER_BITS
    return (mask[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def _located(texts: DataFrame, counted: DataFrame, length: int, gram: int) -> DataFrame:
    """(row, size, first, starts, key, digest, text): where the counted segments stand, staged; text once per batch, for open anchors only."""
    context = texts.sparkSession.sparkContext
    wanted, open_ = context.broadcast(_key_filter(counted)), context.broadcast(_key_filter(counted.filter("open")))

    def locate(batches):
        for b in batches:
            cols = [[np.zeros(0, np.int64)] for _ in range(6)]
            segment_texts, seen = [], set()
            for row, data in zip(b.column(1).to_pylist(), raw_texts(b.column(0)), strict=True):
                first, starts, key, _ = segments(data, length, gram)
                pick = _through(wanted.value, key)
                first, starts, key = first[pick], starts[pick], key[pick]
                digest = _marked(first, starts, key, data, length)
                for c, x in zip(cols, (np.full(len(key), row), np.full(len(key), len(data)), first, starts, key, digest), strict=True):
                    c.append(x)
                needed = _through(open_.value, key)
                for a, c, k, d, need in zip(first.tolist(), starts.tolist(), key.tolist(), digest.tolist(), needed.tolist(), strict=True):
                    need = need and (k, d) not in seen
                    if need:
                        seen.add((k, d))
                    segment_texts.append(data[a : a + c + length - 1] if need else None)
            yield pa.RecordBatch.from_arrays([*[pa.array(np.concatenate(c)) for c in cols], pa.array(segment_texts, pa.binary())], ["row", "size", "first", "starts", "key", "digest", "text"])

    return stage(texts.select("text", "row").mapInArrow(locate, "row long, size long, first long, starts long, key long, digest long, text binary"), "segments")


def _built(located: DataFrame, counted: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, digest, low, high): runs of repeated windows of the segments under open anchors, numbered within the segment."""
    texts = located.filter("text is not null").select("key", "digest", "text")
    texts = texts.join(counted.filter("open").select("key", "digest"), ["key", "digest"], "left_semi")
    ordered = texts.repartition("key").sortWithinPartitions("key", "digest")

    def build(batches):
        keys, digests, held, size = [], [], [], 0

        def flush():
            cols = [[], [], [], []]
            for k, d, mask in zip(keys, digests, repeated_windows(held, keys, length, gram), strict=True):
                edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]))).reshape(-1, 2)
                for c, x in zip(cols, ([k] * len(edges), [d] * len(edges), edges[:, 0].tolist(), edges[:, 1].tolist()), strict=True):
                    c += x
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["key", "digest", "low", "high"])

        for b in batches:
            for key, digest, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if keys and keys[-1] == key and digests[-1] == digest:
                    continue
                if size >= BATCH_BYTES and keys[-1] != key:
                    yield flush()
                    keys, digests, held, size = [], [], [], 0
                keys.append(key)
                digests.append(digest)
                held.append(text)
                size += len(text)
        if keys:
            yield flush()

    return stage(ordered.mapInArrow(build, "key long, digest long, low long, high long"), "repeated-windows")


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(row, size, spans): byte spans of repeated passages; ``row`` is ``row_key`` of the document."""
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), row_key(doc_id, text).alias("row"))
    counted = _counted(texts, length, gram)
    located = _located(texts, counted, length, gram)
    built = _built(located, counted, length, gram)
    none = F.lit(None).cast("long")
    covers = counted.filter("n > 1").select("key", "digest", none.alias("low"), none.alias("high")).unionAll(built)
    placed = located.drop("text").join(covers, ["key", "digest"])
    span = F.struct(
        (F.col("first") + F.coalesce("low", F.lit(0))).alias("low"), (F.col("first") + F.coalesce("high", "starts") + (length - 1)).alias("high")
    )
    return placed.groupBy("row", "size").agg(F.collect_list(span).alias("spans"))


def row_key(doc_id: str, text: str):
    return F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")))


def _union(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans and kept (the remaining bytes; a cut may fall inside a character)."""
    found = repeated_spans(docs, doc_id, text, length, gram)
    found = found.select(F.col("row").alias("_row"), F.col("size").alias("_size"), F.col("spans").alias("_spans"))
    marked = docs.withColumn("_key", row_key(doc_id, text)).withColumn("_bytes", F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long"))
    joined = marked.join(found, (F.col("_key") == F.col("_row")) & (F.col("_bytes") == F.col("_size")), "left")

    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        removed, runs, kept = [], [], []
        for data, marks in zip(raw_texts(texts), spans.to_pylist(), strict=True):
            merged = _union([(m["low"], m["high"]) for m in marks or []])
            removed.append(sum(b - a for a, b in merged))
            runs.append(len(merged))
            ends = [0, *[b for _, b in merged]]
            kept.append(b"".join([data[e:a] for e, a in zip(ends, [*[a for a, _ in merged], len(data)], strict=True)]))
        return pa.StructArray.from_arrays([pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())], ["n_removed", "n_spans", "kept"])

    made = F.arrow_udf(cut, "struct<n_removed:bigint,n_spans:bigint,kept:binary>")(F.col(text), F.col("_spans"))
    names = ("n_bytes", "n_removed", "n_spans", "kept")
    own = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    return joined.withColumn("_made", made).select(*own, F.col("_bytes").alias("n_bytes"), *[F.col(f"_made.{n}").alias(n) for n in names[1:]])
