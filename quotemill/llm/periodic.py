"""Runs: stretches of consecutive words that repeat with a period.

A run of period ``q`` has at least ``max(SHORTEST, 2 * q)`` words, so laid over itself ``q`` words
further on it agrees with itself in at least ``max(SHORTEST - q, q)`` consecutive places: the
guaranteed overlap of lag ``q``. Every overlap of ``2 * k - 1`` places holds one k-gram that begins at a
multiple of ``k``, so with k half the least overlap of a range of lags it is enough to look these
up. Lags under 12 use grams of 3 words, lags of 12 to 23 grams of 6, of 24 to 47 grams of 12 and so on: a
gram is looked for in a window of twice its length, so a level looks at no more than about two
pairs per word of a document, even if all its words are equal, and there are as many levels as a
repeat of the document has doublings.

Seeds of a lag are extended along their diagonal from left to right. A table with the furthest
covered place per lag skips those that an earlier extension of the lag has passed. Grams are named
exactly (the name of 2k words is the number of a pair of names of k words), so an extension
compares names of falling length instead of words and takes as many steps as there are levels. A
stretch whose smallest period is a divisor of its lag comes up under that divisor with the same ends and
is dropped.

Texts are handled in slices of some megabytes, documents apart from each other, in the tasks that
read them: nothing is shuffled. A task needs some hundred bytes a word for its largest document.

Null text has no words and no runs; an empty text likewise. Repeated rows are found row by row, an
empty table gives an empty result. Columns of the input come back as they are; where one has the
name of a result column, the result takes the name with underscores added.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import free_name, raw_texts
from quotemill.session import configure

SHORTEST = 12
FIRST = SHORTEST // 4
SLICE_WORDS = 1 << 19
PAIRS_AT_ONCE = 1 << 19
RUN = "struct<start:bigint,length:bigint,period:bigint>"
FOUND = f"struct<runs:array<{RUN}>,collapsed:string>"


def _names(first: np.ndarray, second: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the pairs (first, second) found at the places ``at``; -1 for those found once and elsewhere."""
    out = np.full(n, -1, np.int32)
    if len(at) == 0:
        return out
    base = int(second.max()) + 1
    _, name, count = np.unique(first.astype(np.int64) * base + second, return_inverse=True, return_counts=True)
    again = count[name] > 1
    out[at[again]] = name[again]
    return out


def gram_levels(words: np.ndarray) -> list[np.ndarray]:
    """Names of the grams of 1, 2, FIRST, 2 * FIRST, ... words at every place, until none occurs twice."""
    n = len(words)
    levels = [words]
    for size, half in ((2, 1), (FIRST, 1)):
        at = np.arange(max(0, n - size + 1))
        short = levels[-1]
        ok = at[(short[at] >= 0) & (words[at + size - half] >= 0)]
        levels.append(_names(short[ok], words[ok + size - half], ok, n))
    size = FIRST
    while (levels[-1] >= 0).any():
        names = levels[-1]
        at = np.flatnonzero(names[: max(0, n - size)] >= 0)
        at = at[names[at + size] >= 0]
        levels.append(_names(names[at], names[at + size], at, n))
        size *= 2
    return levels


def _reach(levels: list[np.ndarray], sizes: list[int], a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
    """How many words agree from the places ``a`` and ``b`` (a < b) on, or before them.

    No gram of the largest size occurs twice, so every size fits at most once.
    """
    n = len(levels[0])
    done = np.zeros(len(a), np.int64)
    for names, size in zip(reversed(levels), reversed(sizes), strict=True):
        x, y = (a + done, b + done) if forward else (a - done - size, b - done - size)
        inside = (y + size <= n) if forward else (x >= 0)
        name = names[np.where(inside, x, 0)]
        done += np.where(inside & (name >= 0) & (name == names[np.where(inside, y, 0)]), size, 0)
    return done


def _pairs(names: np.ndarray, k: int, low: int, high: int, starts: np.ndarray):
    """Seeds of one level in parts: places of grams at multiples of ``k`` and their lags from ``low`` to ``high`` - 1."""
    at = np.flatnonzero(names >= 0)
    if len(at) == 0:
        return
    n = len(names)
    key = names[at].astype(np.int64) * n + at
    key.sort()
    within = at - starts[at]
    anchors = at[within % k == 0]
    of = names[anchors].astype(np.int64) * n
    first = np.searchsorted(key, of + np.minimum(anchors + low, n - 1))
    last = np.searchsorted(key, of + np.minimum(anchors + high, n))
    # the clamp above may point at the anchor itself or before it
    many = np.where(anchors + low < n, np.maximum(last - first, 0), 0)
    keep = many > 0
    anchors, first, many = anchors[keep], first[keep], many[keep]
    ends = np.cumsum(many)
    a = 0
    while a < len(many):
        done = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, "right")))
        count = many[a:b]
        place = np.repeat(anchors[a:b], count)
        step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        other = key[np.repeat(first[a:b], count) + step] % n
        yield place, other - place
        a = b


def find(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs in a row of documents, sorted by start and period.

    ``words``: numbers of the words, with no number in two documents; ``starts``: the place where the
    document of a place begins.
    """
    n = len(words)
    none = np.empty(0, np.int64)
    if n < SHORTEST:
        return none, none, none
    levels = gram_levels(words)
    sizes = [1, 2] + [FIRST << i for i in range(len(levels) - 2)]
    found = []
    for i in range(2, len(levels)):
        k = sizes[i]
        low, high = (1 if k == FIRST else 2 * k), 4 * k
        covered = np.full(high, -1, np.int64)
        for place, lag in _pairs(levels[i], k, low, high, starts):
            order = np.lexsort((place, lag))
            place, lag = place[order], lag[order]
            rounds = 0
            while len(place):
                fresh = place >= covered[lag]
                place, lag = place[fresh], lag[fresh]
                head = np.diff(lag, prepend=-1) != 0  # the first seed of every lag
                if rounds and head.sum() * 8 < len(place):
                    head[:] = True  # many stretches on few lags: extend all that is left
                p, d = place[head], lag[head]
                right = _reach(levels, sizes, p, p + d, True)
                left = _reach(levels, sizes, p, p + d, False)
                np.maximum.at(covered, d, p + right)
                found.append(np.stack([p - left, p + right + d, d]))
                place, lag = place[~head], lag[~head]
                rounds += 1
    if not found:
        return none, none, none
    start, end, period = np.concatenate(found, axis=1)
    long = end - start >= np.maximum(SHORTEST, 2 * period)
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (np.diff(start) != 0) | (np.diff(end) != 0)  # of equal ends the smallest period stays
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _slices(texts: list[bytes]):
    """The words of some documents at a time, SLICE_WORDS or a single document."""
    held, size = [], 0
    for text in texts:
        words = text.split()
        if held and size + len(words) > SLICE_WORDS:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def _found(texts: list[bytes]):
    """(start, length, period) arrays and collapsed text per document."""
    for docs in _slices(texts):
        sizes = np.fromiter(map(len, docs), np.int64, len(docs))
        first = np.cumsum(sizes) - sizes
        ids = np.empty(int(sizes.sum()), np.int32)
        top = 0
        for words, a in zip(docs, first, strict=True):
            number: dict[bytes, int] = {}
            ids[a : a + len(words)] = [number.setdefault(w, top + len(number)) for w in words]
            top += len(number)
        start, end, period = find(ids, np.repeat(first, sizes))
        cut = np.searchsorted(start, np.append(first, len(ids)))
        for i, words in enumerate(docs):
            s, e, q = (x[cut[i] : cut[i + 1]] for x in (start - first[i], end - first[i], period))
            if len(s):
                gone = np.zeros(len(words) + 1, np.int64)
                np.add.at(gone, s + q, 1)
                np.add.at(gone, e, -1)
                words = [w for w, k in zip(words, np.cumsum(gone).tolist(), strict=False) if k == 0]
            yield s, e - s, q, b" ".join(words)


def _column(column: pa.Array) -> pa.Array:
    counts, parts, texts = [0], [], []
    for s, size, q, text in _found(raw_texts(column)):
        counts.append(counts[-1] + len(s))
        parts.append((s, size, q))
        texts.append(text)
    flat = [np.concatenate([np.empty(0, np.int64), *x]) for x in zip(*parts, strict=True)] if parts else [np.empty(0, np.int64)] * 3
    runs = pa.StructArray.from_arrays([pa.array(x) for x in flat], ["start", "length", "period"])
    listed = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), runs)
    return pa.StructArray.from_arrays([listed, pa.array(texts, pa.binary()).cast(pa.string())], ["runs", "collapsed"])


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``runs`` (start, length and period in words, by start, then period) and ``collapsed``.

    ``collapsed`` is the text without the words that repeat: of every run the first period stays;
    words are joined by one space.
    """
    configure(docs.sparkSession)
    runs, collapsed = free_name(docs, "runs"), free_name(docs, "collapsed")
    found = F.arrow_udf(_column, FOUND)(F.col(text))
    held = free_name(docs, "found")
    return docs.withColumn(held, found).select(*docs.columns, F.col(f"{held}.runs").alias(runs), F.col(f"{held}.collapsed").alias(collapsed))


def repeat_tails(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` where one document in ten (by the crc32 ``h`` of its id) says its words from ``a`` on in a loop.

    With ``n`` words and ``g = h // 10``, ``a`` is ``g % n`` and the loop has ``1 + (n - a) // (3 + g % 8)``
    words. Null ids and texts stay as they are.
    """

    def looped(ids: pa.Array, texts: pa.Array) -> pa.Array:
        out = texts.to_pylist()
        for i, key in enumerate(ids.to_pylist()):
            h = zlib.crc32(str(key).encode())
            if key is None or not out[i] or h % 10:
                continue
            words = out[i].encode().split()
            n, g = len(words), h // 10
            if n:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                loop = words[a : a + p]
                out[i] = b" ".join(words[:a] + (loop * ((n - a) // p + 1))[: n - a]).decode()
        return pa.array(out, pa.string())

    return docs.withColumn(text, F.arrow_udf(looped, "string")(F.col(doc_id), F.col(text)))
