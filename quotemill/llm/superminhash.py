"""Near-duplicate documents by SuperMinHash.

A document is the set of its distinct word shingles (ASCII-lower-cased words between ASCII white space; with
fewer words, the whole sequence is one shingle), each a 64-bit hash. SuperMinHash gives every
shingle a random permutation of the slots; in round j it offers rank j plus a fraction to the j-th
slot of its permutation. Ranks of later rounds never beat earlier ones, so a document stops as soon
as all slots are filled. Equal sets are one class with one signature. Signatures are cut into bands;
classes that share a band are compared on their full sets, and links are closed to components.

Ids are integers. A null id is linked with nothing and kept; rows with one id are one document. Texts without
words (null included) are empty sets, linked with nothing, and kept. An empty table gives an empty
result. At the threshold of 0.8 a linked pair shares no band with probability under 1e-5.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import Memo, mix64, raw_texts, release, slices, stage
from quotemill.llm.components import close_buckets, shared_buckets

BANDS, ROWS = 30, 5
SLOTS = BANDS * ROWS
PERCENT = 80
SHINGLE_WORDS = 5
SLICE_BYTES = 1 << 18
FILTER_BITS = 1 << 24
BLOCK_HASHES = 1 << 20
WORD_BYTES = 24 << 20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_STEPS = np.arange(1, 1 << 12, dtype=np.uint64) * _GOLDEN
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


class Words(Memo):
    """Word -> hash; one per task."""

    def __init__(self):
        super().__init__(WORD_BYTES)

    def __missing__(self, word):
        h = xxhash.xxh3_64_intdigest(word)
        self.put(word, h, len(word))
        return h


def shingles(data: bytes, width: int, hashes: Words) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = data.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(len(h) - width + 1, 1)
    out = np.full(n, min(width, len(h)), np.uint64)
    for k in range(min(width, len(h))):
        out = mix64(out * _GOLDEN + h[k : k + n])
    return np.unique(out)


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """One row of ``slots`` values per set; an empty set keeps the largest value everywhere."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.full((len(sets), slots), _EMPTY, np.uint64)
    if not sizes.sum():
        return out
    flat = out.reshape(-1)
    value, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = None  # of the slots still to come, per element; made for those that outlast the first round
    for j in range(slots):
        draw = mix64(value + _STEPS[j])
        pick = j + ((draw & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j) >> np.uint64(32)).astype(np.int64)
        if order is None:
            slot = pick
        else:
            rows = np.arange(len(value))
            slot = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[:, j]
        np.minimum.at(flat, doc * slots + slot, np.uint64(j) << np.uint64(32) | draw >> np.uint64(32))
        open_ = (out == _EMPTY).any(axis=1)[doc]
        if not open_.any():
            break
        if not open_.all():
            value, doc, pick = value[open_], doc[open_], pick[open_]
            order = order[open_] if order is not None else None
        if order is None:
            order = np.tile(np.arange(slots, dtype=np.uint16), (len(value), 1))
            order[np.arange(len(value)), pick] = 0
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = signature.shape[1] // bands
    parts = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(rows):
        key = mix64(key * _GOLDEN + parts[:, :, r])
    return key.view(np.int64)


def sketch(docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """(id, n_shingles, class binary, bands array): one narrow row per document, staged."""

    def run(batches):
        words = Words()
        for b in batches:
            for part in slices(b, text, SLICE_BYTES):
                sets = [shingles(x, width, words) for x in raw_texts(part.column(1))]
                keys = band_keys(signatures(sets))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * BANDS, pa.array(keys.reshape(-1))),
                    ],
                    ["id", "n_shingles", "class", "bands"],
                )
        del words
        release()

    picked = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias(text))
    return stage(picked.mapInArrow(run, "id long, n_shingles long, class binary, bands array<long>"), "sketches")


def _id_filter(ids: DataFrame) -> np.ndarray:
    """Bitmap of FILTER_BITS bits: no id of ``ids`` is missing, others may get through."""
    bit = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    words = ids.select((bit / 64).cast("int").alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int")).alias("v"))
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for r in words.groupBy("w").agg(F.bit_or("v").alias("v")).collect():  # at most FILTER_BITS / 64 rows
        out[r["w"]] = r["v"]
    return out.view(np.uint8)


def _packed(s: np.ndarray) -> bytes:
    return s.astype("<u8").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u8")


def full_sets(docs: DataFrame, ids: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """(id, hashes): the sets of some documents, sorted hashes of 64 bits, staged. Texts are scanned, not shuffled."""
    bits = docs.sparkSession.sparkContext.broadcast(_id_filter(ids))

    def run(batches):
        mask, words = bits.value, Words()
        for b in batches:
            word = b.column(2).to_numpy()
            b = b.filter(pa.array((mask[word >> 3] >> (word & 7).astype(np.uint8)) & 1 == 1))
            for part in slices(b, text, SLICE_BYTES):
                sets = [_packed(shingles(x, width, words)) for x in raw_texts(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["id", "hashes"])

    key = F.col(doc_id).cast("long")
    picked = docs.filter(key.isNotNull()).select(key.alias("id"), F.col(text).alias(text), F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)).alias("_bit"))
    sets = picked.mapInArrow(run, "id long, hashes binary").dropDuplicates(["id", "hashes"])
    return stage(sets.join(ids, "id", "left_semi"), "shingle-sets")


def _linked(a: bytes, b: bytes) -> bool:
    x, y = _unpacked(a), _unpacked(b)
    if 100 * min(len(x), len(y)) < PERCENT * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= PERCENT * (len(x) + len(y) - common)


def verify_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    def check(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([_linked(x, y) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.bool_())

    left = sets.select(F.col("id").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("id").alias("b"), F.col("hashes").alias("hb"))
    return pairs.join(left, "a").join(right, "b").filter(F.arrow_udf(check, "boolean")("ha", "hb")).select("a", "b")


def blocks_against(ids: DataFrame, candidates: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between ``ids`` and ``candidates``: blocks of ids, of at most BLOCK_HASHES hashes or one id, against all candidates.

    A block is an inverted index of its hashes; a candidate looks its own hashes up and counts, so common parts are exact.
    """
    spark = ids.sparkSession
    scanned = stage(sets.join(candidates, "id", "left_semi"), "candidate-sets")
    out = spark.createDataFrame([], "a long, b long")

    def hold(block):
        names = np.array([i for i, _ in block], np.int64)
        held = [_unpacked(h) for _, h in block]
        sizes = np.array([len(h) for h in held], np.int64)
        value = np.concatenate(held)
        order = np.argsort(value, kind="stable")
        shared = spark.sparkContext.broadcast((names, sizes, value[order], np.repeat(np.arange(len(held)), sizes)[order]))

        def run(batches):
            names, sizes, value, owner = shared.value
            for b in batches:
                left, right = [], []
                for i, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    mine = _unpacked(data)
                    low, high = np.searchsorted(value, mine, "left"), np.searchsorted(value, mine, "right")
                    times = high - low
                    at = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
                    common = np.bincount(owner[at], minlength=len(names))
                    hit = names[(100 * common >= PERCENT * (sizes + len(mine) - common)) & (names != i)]
                    left += hit.tolist()
                    right += [i] * len(hit)
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

        return scanned.mapInArrow(run, "a long, b long")

    block, size = [], 0
    for r in sets.join(ids, "id", "left_semi").toLocalIterator():  # one block on the driver at a time
        block.append((r["id"], bytes(r["hashes"])))
        size += len(r["hashes"]) // 8
        if size >= BLOCK_HASHES:
            out = out.unionAll(stage(hold(block), "block-links"))
            block, size = [], 0
    return out.unionAll(stage(hold(block), "block-links")) if block else out


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    rows = sketch(docs, doc_id, text, width)
    real = rows.filter("n_shingles > 0 and id is not null")
    classes = stage(real.groupBy("class").agg(F.min("id").alias("rep"), F.min_by("bands", "id").alias("bands")), "classes")
    members = classes.select(F.col("rep").alias("id"), F.explode("bands").alias("bucket")).distinct()
    buckets = shared_buckets(members)
    sets = full_sets(docs, buckets.select("id").distinct(), doc_id, text, width)
    components = close_buckets(
        buckets, lambda pairs: verify_pairs(pairs, sets), lambda ids, candidates: blocks_against(ids.select("id"), candidates.select("id"), sets)
    )
    # An id that stands in several classes joins them.
    named = classes.select("class", F.col("rep").alias("id")).join(components, "id", "left")
    named = named.select("class", F.coalesce("component", "id").alias("found"))
    out = rows.join(named, "class", "left")
    own = F.when(F.col("n_shingles") > 0, F.coalesce("found", "id")).otherwise(F.col("id"))
    own = F.when(F.col("id").isNull(), F.lit(None).cast("long")).otherwise(own)
    return out.select(
        F.col("id").alias("doc_id"), "n_shingles", own.alias("component_id"), F.coalesce(F.col("id") == own, F.lit(True)).alias("kept")
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` without the documents that are near copies of one with a smaller id."""
    dropped = near_duplicates(docs, doc_id, text, width).filter("not kept").select(F.col("doc_id").alias("_drop")).distinct()
    return docs.join(dropped, F.col(doc_id).cast("long") == F.col("_drop"), "left_anti")
