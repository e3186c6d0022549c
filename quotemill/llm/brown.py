"""Language-model scoring with Brown classes.

Words and one end mark per text are tokens. The TABLE_WORDS most frequent training tokens at most
(the bound on what is broadcast) form the table, and every training word gets one of ``classes`` classes.
Classes are found by exchange clustering: in every round each word of the table looks at all classes,
given the class-transition counts of the round before, and moves to the one that raises the
likelihood of the training bigrams most. One half of the words may move per round, so that neighbours do not swap
places for ever; a round that does not raise the likelihood is taken back, and smaller parts move from then on. Bigram counts stay
distributed: row blocks of words by all words, bounded by the size of the table. The words outside the table
are one class while those of the table move; then each of them, with all its occurrences, moves from there to its best class. They, their
counts and their classes stay distributed and are joined (words of equal 60-bit hash share a class). A word never seen in training
belongs where the words seen once, taken together, would go.

With ``clustered`` given, only so many words are clustered, the others of the table have a class by how often they
were seen, and all words outside the table one class of rare words, which is also that of words never seen.

    P(w | v) = P(w | c(w)) * P(c(w) | c(v))

The emission is add-ALPHA smoothed, with one place for words never seen in their class; the
transition is Witten-Bell smoothed with the class frequency. Both sum to one.

Null and empty texts are one end mark; rows with equal or null ids are scored one by one; an empty
training set gives the uniform model. Columns named like a result are replaced. Ties between classes go to the present class, then to the
lowest number; all words of the same count enter the table or stay out together.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import raw_texts, release, slices, stage
from quotemill.llm.quality import bucket

END = b"\n"
TABLE_WORDS = 1 << 18
CLASSES = 48
ROUNDS = 8
ALPHA = 0.1
TABLE_BITS = 8
BLOCK = 64
RARE_BLOCKS = 1 << 12
PENDING = 1 << 20
SLICE_BYTES = 2 << 20
GROUP = 32
OCCURRENCE = np.dtype([("h", "<i8"), ("prev", "<i4"), ("next", "<i4")])
TAIL_LIMITS = (4, 16, 64, 256)
TAIL_CLASSES = len(TAIL_LIMITS) + 2


def tokens(data: bytes) -> list[bytes]:
    """Words of ASCII-lower-cased text, then the end mark."""
    out = data.lower().split()
    out.append(END)
    return out


def word_hash(word: bytes) -> int:
    """60 bits, equal to ``word_hash_column``."""
    return int.from_bytes(hashlib.md5(word, usedforsecurity=False).digest()[:8], "big") >> 4


def word_hash_column(word):
    return F.conv(F.substring(F.md5(word), 1, 15), 16, 10).cast("long")


def word_counts(train: DataFrame, text: str = "text") -> DataFrame:
    """(word binary, n long) over all training texts; counted inside each batch before the shuffle."""

    def count(batches):
        for b in batches:
            found: dict[bytes, int] = {}
            for data in raw_texts(b.column(0)):
                for w in tokens(data):
                    found[w] = found.get(w, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"]
            )
            del found
        release()

    return train.select(text).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _table(counts: DataFrame, table_words: int):
    """The most frequent words, at most ``table_words`` and the end mark, by falling count."""
    level = bucket(F.col("n"), TABLE_BITS)
    room, least = table_words, None
    for r in counts.groupBy(level.alias("b")).count().orderBy(F.desc("b")).collect():  # at most 64 << TABLE_BITS rows
        room -= r["count"]
        if room < 0:
            break
        least = r["b"]
    if least is None:
        return []
    rows = counts.filter((level >= least) & (F.col("word") != F.lit(END))).collect()  # at most table_words rows
    rows = sorted(((bytes(r["word"]), r["n"]) for r in rows), key=lambda x: (-x[1], x[0]))
    end = counts.filter(F.col("word") == F.lit(END)).collect()
    return [(END, r["n"]) for r in end] + rows


class Model:
    """What tasks get: a table of bounded size and tables of classes by classes."""

    def __init__(self, rows, total, vocabulary, classes, clustered):
        self.index = {w: i for i, (w, _) in enumerate(rows)}
        self.counts = np.array([n for _, n in rows], np.float64)
        self.total, self.vocabulary, self.classes = total, vocabulary, classes
        self.k, self.rest = classes + TAIL_CLASSES, classes + TAIL_CLASSES - 1
        self.whole = clustered is None
        self.clustered = len(rows) if self.whole else min(clustered, len(rows))
        tail = classes + np.searchsorted(np.array(TAIL_LIMITS), self.counts[self.clustered :], side="left")
        self.symbols = self.clustered + TAIL_CLASSES
        # Class of a clustering symbol (clustered words, then the fixed classes), and symbol of a table word; rare words last.
        self.symbol_class = np.concatenate([np.arange(self.clustered) % classes, np.arange(classes, self.k)]).astype(np.int64)
        self.word_symbol = np.concatenate(
            [np.arange(self.clustered), tail - classes + self.clustered, [self.symbols - 1]]
        ).astype(np.int64)

    def words(self, data: bytes) -> np.ndarray:
        """Table numbers of a text's tokens; the table's size for rare words."""
        get, rare = self.index.get, len(self.index)
        return np.array([get(w, rare) for w in tokens(data)], np.int64)

    def fit(self, transitions: np.ndarray, rare_size=None, rare_types=None):
        """Derive log tables from the transition counts of classes, and the counts and numbers of words outside the table by class."""
        word_class = self.symbol_class[self.word_symbol]
        word_class[-1] = self.rest
        known = word_class[:-1]
        self.rest_total = float(self.total - self.counts.sum())
        self.rest_types = float(self.vocabulary - len(self.counts) + 1)
        if rare_size is None:
            rare_size, rare_types = np.zeros(self.k), np.zeros(self.k)
            rare_size[self.rest], rare_types[self.rest] = self.rest_total, self.rest_types - 1
        self.size = np.bincount(known, self.counts, self.k) + rare_size
        types = np.bincount(known, minlength=self.k).astype(np.float64) + rare_types
        types[self.rest] += 1
        # log10 of what the smoothed count of a word is divided by; a class without words is never asked
        self.class_log = np.log10(np.maximum(self.size + ALPHA * types, ALPHA))
        self.emit = np.append(np.log10(self.counts + ALPHA) - self.class_log[known], 0.0)
        self.base = np.append(np.log10((self.counts + ALPHA) / (self.total + ALPHA * (self.vocabulary + 1))), 0.0)
        arrive = transitions.sum(axis=0)
        share = (arrive + ALPHA) / (arrive.sum() + ALPHA * self.k)
        leave = transitions.sum(axis=1, keepdims=True)
        kinds = np.maximum((transitions > 0).sum(axis=1, keepdims=True), 1)
        self.move = np.log10((transitions + kinds * share) / (leave + kinds))
        self.word_class = word_class
        return self


def _pack(values: np.ndarray, size: int) -> bytes:
    """Unsigned integers of ``size`` bytes, all lowest bytes first, which compresses better."""
    return values.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T.tobytes()


def _unpack(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(size, -1).T.copy().view(f"<u{size}").ravel().astype(np.int64)


def _bigram_blocks(train: DataFrame, shared, text: str) -> DataFrame:
    """(outside, block, at0, n0, at1, n1): counts of symbol pairs in blocks of symbols, seen from the left (0) and the right (1).

    Symbol s is in block s % blocks, so that frequent words, which come first, are spread over the blocks.
    ``at`` and ``n`` are packed; a merged block has at most BLOCK * symbols entries a side.
    If all words are clustered, rows that are ``outside`` hold where the words outside the table occur, by blocks of their hash, as
    OCCURRENCE in ``at0``, and in ``at1`` the pairs of hashes of neighbours that are both outside.
    """

    def rows(symbols, keys, counts, side):
        blocks = _blocks(symbols)
        one, other = (keys // symbols, keys % symbols) if side == 0 else (keys % symbols, keys // symbols)
        block, row = one % blocks, one // blocks
        # ``keys`` rise; stable sorting of short integers is a radix sort
        order = np.argsort(row.astype(np.uint16), kind="stable") if side else np.arange(len(row))
        order = order[np.argsort(block[order].astype(np.uint16), kind="stable")]
        block, at, n = block[order], (row * symbols + other)[order], counts[order]
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        return [(side, int(block[a]), _pack(np.diff(at[a:b], prepend=0), 4), _pack(n[a:b], 4)) for a, b in zip(starts, [*starts[1:], len(at)], strict=True)]

    def packed(out):
        cols = list(zip(*out, strict=True)) if out else [(), (), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())],
            ["side", "block", "at", "n"],
        )

    def outside(places, neighbours):
        """Rows of the words outside the table of a batch."""
        block = places["h"] % RARE_BLOCKS
        order = np.argsort(block, kind="stable")
        block, places = block[order], places[order]
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        out = [(2, int(block[a]), places[a:b].tobytes(), b"") for a, b in zip(starts, [*starts[1:], len(block)], strict=True)]
        # a pair belongs to no block; any will do
        return out + ([(3, int(neighbours[0] % RARE_BLOCKS), neighbours.astype("<i8").tobytes(), b"")] if len(neighbours) else [])

    def summed(found):
        """Keys and counts of all slices of a batch, rising."""
        if len(found) == 1:
            return found[0]
        keys, counts = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[starts], np.add.reduceat(counts, starts)

    def count(batches):
        m = shared.value
        end = m.index.get(END, len(m.index))
        start, rare = m.word_symbol[end], len(m.index)
        for b in batches:
            found, places, neighbours = [], [np.zeros(0, OCCURRENCE)], []
            for some in slices(b, text, SLICE_BYTES):
                parts, hashes = [np.zeros(0, np.int64)], {}
                for data in raw_texts(some.column(0)):
                    listed = tokens(data)
                    ids = np.array([m.index.get(w, rare) for w in listed], np.int64)
                    s = np.concatenate([[start], m.word_symbol[ids]])
                    parts.append(s[:-1] * m.symbols + s[1:])
                    if m.whole and len(at := np.flatnonzero(ids == rare)):
                        for i in at:
                            if listed[i] not in hashes:
                                hashes[listed[i]] = word_hash(listed[i])
                        around = np.concatenate([[end], ids, [end]])
                        around[around == rare] = -1
                        place = np.zeros(len(at), OCCURRENCE)
                        place["h"] = [hashes[listed[i]] for i in at]
                        place["prev"], place["next"] = around[at], around[at + 2]
                        places.append(place)
                        both = np.flatnonzero(np.diff(at) == 1)
                        if len(both):
                            neighbours.append(np.stack([place["h"][both], place["h"][both + 1]], axis=1).ravel())
                found.append(np.unique(np.concatenate(parts), return_counts=True))
            if found:
                keys, counts = summed(found)
                del found
                for side in (0, 1):
                    yield packed(rows(m.symbols, keys, counts, side))
                del keys, counts
            if len(places) > 1:
                yield packed(outside(np.concatenate(places), np.concatenate(neighbours) if neighbours else []))
        release()

    def merge(batches):
        """One row per block."""
        here, ats, ns, plain = None, ([], []), ([], []), ([], [])

        def fold(side):
            at, n = np.concatenate(ats[side]), np.concatenate(ns[side])
            order = np.argsort(at, kind="stable")
            at = at[order]
            starts = np.flatnonzero(np.diff(at, prepend=-1))
            ats[side][:], ns[side][:] = [at[starts]], [np.add.reduceat(n[order], starts)]

        def flush():
            out = []
            for side in (0, 1):
                if here[0]:
                    out += [b"".join(plain[side]), b""]
                elif ats[side]:
                    fold(side)
                    out += [_pack(np.diff(ats[side][0], prepend=0), 4), _pack(ns[side][0], 8)]
                else:
                    out += [b"", b""]
                for held in (ats, ns, plain):
                    held[side].clear()
            arrays = [pa.array([x], t) for x, t in zip([*here, *out], [pa.bool_(), pa.int32(), *[pa.binary()] * 4], strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["outside", "block", "at0", "n0", "at1", "n1"])

        for b in batches:
            for side, block, at, n in zip(*(b.column(c).to_pylist() for c in ("side", "block", "at", "n")), strict=True):
                if (side > 1, block) != here:
                    if here:
                        yield flush()
                    here = (side > 1, block)
                if side > 1:
                    plain[side - 2].append(at)
                    continue
                ats[side].append(np.cumsum(_unpack(at, 4)))
                ns[side].append(_unpack(n, 4))
                if len(ats[side]) > 64 and sum(map(len, ats[side])) > PENDING + 2 * len(ats[side][0]):
                    fold(side)
        if here:
            yield flush()
        release()

    found = train.select(text).mapInArrow(count, "side int, block int, at binary, n binary").withColumn("outside", F.col("side") > 1).repartition("outside", "block")
    found = found.sortWithinPartitions("outside", "block").select("side", "block", "at", "n")
    return stage(found.mapInArrow(merge, "outside boolean, block int, at0 binary, n0 binary, at1 binary, n1 binary"), "bigram-blocks")


def _blocks(symbols: int) -> int:
    return -(-symbols // BLOCK)


def _entries(symbols, block, at, n):
    """(place in the block, other symbol, count) of a packed side."""
    at = np.cumsum(_unpack(at, 4))
    return at // symbols, at % symbols, _unpack(n, 8).astype(np.float64)


def _transitions(blocks: DataFrame, symbols: int, k: int, symbol_class) -> np.ndarray:
    """Class-transition counts: at most k * k sums come to the driver."""

    def add(batches):
        total = np.zeros(k * k)
        for b in batches:
            for block, at, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                row, right, n = _entries(symbols, block, at, n)
                total += np.bincount(symbol_class[block + row * _blocks(symbols)] * k + symbol_class[right], n, k * k)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at].astype(np.int64))], ["cell", "n"])

    out = np.zeros(k * k)
    for r in blocks.select("block", "at0", "n0").mapInArrow(add, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r["cell"]] = r["n"]
    return out.reshape(k, k)


def _xlogx(x):
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(n: np.ndarray) -> float:
    """The part of the training likelihood that depends on the classes."""
    return float(_xlogx(n).sum() - _xlogx(n.sum(axis=0)).sum() - _xlogx(n.sum(axis=1)).sum())


def best_class(n: np.ndarray, own: int, leave: np.ndarray, arrive: np.ndarray, classes: int) -> int:
    """Where a word with these transition counts to and from classes raises the likelihood most."""
    n = n.copy()
    n[own] = np.maximum(n[own] - leave, 0)
    n[:, own] = np.maximum(n[:, own] - arrive, 0)
    to, fro = np.flatnonzero(leave), np.flatnonzero(arrive)
    out, back = n[:classes].sum(axis=1), n[:, :classes].sum(axis=0)
    gain = (_xlogx(n[:classes][:, to] + leave[to]) - _xlogx(n[:classes][:, to])).sum(axis=1)
    gain += (_xlogx(n[fro][:, :classes] + arrive[fro][:, None]) - _xlogx(n[fro][:, :classes])).sum(axis=0)
    gain -= _xlogx(out + leave.sum()) - _xlogx(out) + _xlogx(back + arrive.sum()) - _xlogx(back)
    top = int(gain.argmax())
    return top if gain[top] > gain[own] + 1e-9 else own


def _moves(blocks: DataFrame, model: Model, n: np.ndarray, turn: int, parts: int) -> list:
    """(word, class) for the words of this turn's part that change; at most the words of the table."""
    symbols, k, clustered, classes = model.symbols, model.k, model.clustered, model.classes
    symbol_class = model.symbol_class

    def choose(batches):
        for b in batches:
            for start in range(0, b.num_rows, GROUP):
                some = b.slice(start, GROUP)
                block = some.column(0).to_numpy()
                words = (block[:, None] + np.arange(BLOCK) * _blocks(symbols)).ravel()
                sides = []
                for c in (1, 3):
                    profile = np.zeros((len(block), BLOCK * k))
                    for i, (at, count) in enumerate(zip(some.column(c).to_pylist(), some.column(c + 1).to_pylist(), strict=True)):
                        row, other, count = _entries(symbols, block[i], at, count)
                        profile[i] = np.bincount(row * k + symbol_class[other], count, BLOCK * k)
                    sides.append(profile.reshape(-1, k))
                turned = np.flatnonzero((words < clustered) & (words % parts == turn % parts))
                words = words[turned]
                own = symbol_class[words]
                cells = []
                for profile in sides:
                    w, c = np.nonzero(profile[turned])
                    cells.append((w, c, profile[turned][w, c].astype(np.int64)))
                best = best_classes(n, own, *cells, classes)
                moved = np.flatnonzero(best != own)
                yield pa.RecordBatch.from_arrays([pa.array(words[moved].astype(np.int32)), pa.array(best[moved].astype(np.int32))], ["w", "c"])

    return blocks.select("block", "at0", "n0", "at1", "n1").mapInArrow(choose, "w int, c int").collect()


def best_classes(n: np.ndarray, own: np.ndarray, leave, arrive, classes: int) -> np.ndarray:
    """``best_class`` of many words at once; a word whose own class is none of the ``classes`` to choose from always moves.

    ``leave`` and ``arrive`` are the transition counts (word, class, count) of the words, sorted by word and class.
    """
    words = len(own)
    gain, stay = np.zeros((words, classes)), np.zeros(words)
    at_own = [np.bincount(w[hit], x[hit], words) for w, c, x in (leave, arrive) for hit in [c == own[w]]]
    diagonal = n[own, own]
    inner = np.maximum(np.maximum(diagonal - at_own[0], 0) - at_own[1], 0)

    def side(of, back, inside, m):
        w, c, x = of
        logs, sums = _xlogx(m), m.sum(axis=1)
        pairs, which = np.unique(c * (int(x.max(initial=0)) + 1) + x, return_inverse=True)
        pc, px = pairs // (int(x.max(initial=0)) + 1), pairs % (int(x.max(initial=0)) + 1)
        table = _xlogx(m.T[pc, :classes] + px[:, None]) - logs.T[pc, :classes]
        for at in range(0, len(w), 1 << 14):
            some = slice(at, at + (1 << 14))
            starts = np.flatnonzero(np.diff(w[some], prepend=-1))
            gain[w[some][starts]] += np.add.reduceat(table[which[some]], starts, axis=0)
        total = np.bincount(w, x, words)
        sizes, which = np.unique(total, return_inverse=True)
        gain[:] -= (_xlogx(sums[:classes] + sizes[:, None]) - _xlogx(sums[:classes]))[which]
        # What the word itself gave to the counts of its own class does not count: in other classes,
        bw, bc, bx = (v[back[1] < classes] for v in back)
        less = lambda full, more: _xlogx(np.maximum(full - bx, 0) + more) - _xlogx(np.maximum(full - bx, 0)) - _xlogx(full + more) + _xlogx(full)
        gain[bw, bc] += less(m[bc, own[bw]], inside[bw]) - less(sums[bc], total[bw])
        # and in its own.
        rest = np.where(c == own[w], inner[w], np.maximum(m[own[w], c] - x, 0))
        stay[:] += np.bincount(w, _xlogx(rest + x) - _xlogx(rest), words)
        rest = np.maximum(sums[own] - total - (diagonal - inside) + inner, 0)
        stay[:] -= _xlogx(rest + total) - _xlogx(rest)

    side(leave, arrive, at_own[0], n)
    side(arrive, leave, at_own[1], n.T)
    inside = np.flatnonzero(own < classes)
    gain[inside, own[inside]] = stay[inside]
    top = gain.argmax(axis=1)
    keeps = inside[gain[inside, top[inside]] <= stay[inside] + 1e-9]
    top[keeps] = own[keeps]
    return top


def _cells(word, of_class, k: int):
    """(word, class, count) of occurrences, sorted."""
    cell, x = np.unique(word * k + of_class, return_counts=True)
    return cell // k, cell % k, x


def _rare_classes(blocks: DataFrame, model: Model, n: np.ndarray):
    """Classes (h, c, n) of the words outside the table, staged; the transition counts with them; and the class of words never seen."""
    k, classes, rest = model.k, model.classes, model.rest
    symbol_class = np.append(model.symbol_class[: model.clustered], rest)  # -1 is outside

    def assign(batches):
        for b in batches:
            for blob in b.column(0).to_pylist():
                places = np.frombuffer(blob, OCCURRENCE)
                found, word, times = np.unique(places["h"], return_inverse=True, return_counts=True)
                before, after = symbol_class[places["prev"]], symbol_class[places["next"]]
                best = best_classes(n, np.full(len(found), rest), _cells(word, after, k), _cells(word, before, k), classes)
                out = [(np.zeros(len(found), np.int64), found, best, times)]
                here = best[word]
                for kind, a, b_, some in (
                    (1, before, here, places["prev"] >= 0),
                    (1, here, after, places["next"] >= 0),
                    (2, np.zeros_like(after), after, times[word] == 1),
                    (3, np.zeros_like(before), before, times[word] == 1),
                ):
                    cell, x = np.unique(a[some] * k + b_[some], return_counts=True)
                    out.append((np.full(len(cell), kind), cell // k, cell % k, x))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out, strict=True)], ["kind", "a", "b", "n"])

    def pairs(batches):
        for b in batches:
            h = np.frombuffer(b"".join(b.column(0).to_pylist()), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(h[0::2]), pa.array(h[1::2])], ["a", "b"])

    made = stage(blocks.filter("outside").select("at0").mapInArrow(assign, "kind long, a long, b long, n long"), "rare-classes")
    found = made.filter("kind = 0").select(F.col("a").alias("h"), F.col("b").alias("c"), "n")
    out = n.copy()
    out[rest], out[:, rest] = 0, 0
    once = np.zeros((2, k))
    for r in made.filter("kind > 0").groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect():  # at most k * k + 2 * k rows
        if r["kind"] == 1:
            out[r["a"], r["b"]] += r["n"]
        else:
            once[r["kind"] - 2, r["b"]] += r["n"]
    both = blocks.filter("outside").select("at1").mapInArrow(pairs, "a long, b long")
    both = both.join(found.select(F.col("h").alias("a"), F.col("c").alias("ca")), "a").join(found.select(F.col("h").alias("b"), F.col("c").alias("cb")), "b")
    for r in both.groupBy("ca", "cb").count().collect():  # at most k * k rows
        out[r["ca"], r["cb"]] += r["count"]
    if not once.any():  # no word was seen once: all that are outside stand for those never seen
        once = np.stack([n[rest], n[:, rest]])
    unseen = int(best_classes(n, np.array([rest]), *[(np.zeros(len(at), np.int64), at, x[at].astype(np.int64)) for x in once for at in [np.flatnonzero(x)]], classes)[0])
    return found, out, unseen


def train_model(train: DataFrame, text: str = "text", classes: int = CLASSES, rounds: int = ROUNDS, table_words: int = TABLE_WORDS, clustered: int | None = None):
    """Returns (model, word counts): the model has a bounded size, the counts and classes (word, n, c) are a staged table.

    In that table ``c`` is the class of a word outside the model's table.
    """
    spark = train.sparkSession
    counts = stage(word_counts(train, text), "word-counts")
    total, vocabulary = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    model = Model(_table(counts, table_words), total, vocabulary, classes, clustered)
    staged = _bigram_blocks(train, spark.sparkContext.broadcast(model), text)
    blocks = staged.filter("not outside")
    n = _transitions(blocks, model.symbols, model.k, model.symbol_class)
    parts = 2
    for r in range(rounds if model.clustered else 0):
        before = model.symbol_class.copy()
        for w, c in _moves(blocks, model, n, r, parts):
            model.symbol_class[w] = c
        if (model.symbol_class == before).all():
            continue
        fresh = _transitions(blocks, model.symbols, model.k, model.symbol_class)
        if likelihood(fresh) <= likelihood(n):
            model.symbol_class, parts = before, parts * 2
        else:
            n = fresh
    if not model.whole or model.vocabulary == len(model.index):
        return model.fit(n), counts.withColumn("c", F.lit(model.rest).cast("long"))
    found, n, model.rest = _rare_classes(staged, model, n)
    size, types = np.zeros(model.k), np.zeros(model.k)
    for r in found.groupBy("c").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect():  # at most k rows
        size[r["c"]], types[r["c"]] = r["n"], r["words"]
    classed = counts.withColumn("h", word_hash_column(F.col("word"))).join(found.select("h", "c"), "h", "left").select("word", "n", "c")
    return model.fit(n, size, types), stage(classed, "word-classes")


def score(docs: DataFrame, model: Model, counts: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with n_tokens, n_known, train_tokens, base_score and score (log10)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    made = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    others = [c for c in docs.columns if c != text and c not in made]

    def run(batches):
        m, serial = shared.value, TaskContext.get().partitionId() << 40
        rare = len(m.index)
        start = m.word_class[m.index[END]] if END in m.index else m.rest
        for b in (x for whole in batches for x in slices(whole, text, SLICE_BYTES)):
            rows, lengths, words, near = [], [], [], [np.zeros((3, 0), np.int32)]
            for data in raw_texts(b.column(b.schema.get_field_index(text))):
                listed = tokens(data)
                ids = np.array([m.index.get(w, rare) for w in listed], np.int64)
                known = ids < rare
                # Class 0 stands for a word outside the table, whose class is joined later; -1 below.
                classes = np.concatenate([[start], m.word_class[ids]])
                placed = np.concatenate([[True], known])
                both = placed[:-1] & placed[1:]
                moved = float(m.move[classes[:-1], classes[1:]][both].sum())
                rows.append((len(ids), int(known.sum()), float(m.base[ids].sum()), float(m.emit[ids].sum()) + moved))
                at = np.flatnonzero(~known)
                words += [listed[i] for i in at]
                lengths.append(len(at))
                if len(at):
                    classes = np.append(np.where(placed, classes, -1), -1)
                    near.append(np.stack([at, classes[at], classes[at + 2]]).astype(np.int32))
            cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
            pos, prev, after = np.concatenate(near, axis=1)
            inner = pa.StructArray.from_arrays([pa.array(pos), pa.array(words, pa.binary()), pa.array(prev.astype(np.int16)), pa.array(after.astype(np.int16))], ["pos", "word", "prev", "next"])
            new = [
                pa.array(range(serial, serial + len(rows)), pa.int64()),
                pa.array(cols[0], pa.int64()),
                pa.array(cols[1], pa.int64()),
                pa.array(cols[2], pa.float64()),
                pa.array(cols[3], pa.float64()),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), inner),
            ]
            serial += len(rows)
            kept = pa.StructArray.from_arrays([b.column(b.schema.get_field_index(c)) for c in others], others)
            yield pa.RecordBatch.from_arrays([kept, *new], ["doc", "_row", "_n", "_known", "_base", "_score", "_words"])
        release()

    def add(batches):
        """Sums of the words outside the table, and of the steps to and from them, by text; the rows come by text and place."""
        m = shared.value
        last = (-1, -1, -1)
        for b in batches:
            if not b.num_rows:
                continue
            row, pos, prev, after, n, c = (x.to_numpy() for x in b.columns)
            base = np.log10((n + ALPHA) / (m.total + ALPHA * (m.vocabulary + 1)))
            score = np.log10(n + ALPHA) - m.class_log[c]
            score += np.where(prev >= 0, m.move[prev, c], 0.0) + np.where(after >= 0, m.move[c, after], 0.0)
            before = [np.concatenate([[x], y[:-1]]) for x, y in zip(last, (row, pos, c), strict=True)]
            beside = (before[0] == row) & (before[1] + 1 == pos)
            score += np.where(beside, m.move[before[2], c], 0.0)
            last = (row[-1], pos[-1], c[-1])
            starts = np.flatnonzero(np.diff(row, prepend=-1))
            sums = [np.add.reduceat(x, starts) for x in (base, score, (n > 0).astype(np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array(row[starts]), *map(pa.array, sums)], ["_row", "base", "score", "known"])

    inner = docs.select(*others).schema.simpleString()
    schema = f"doc {inner}, _row long, _n long, _known long, _base double, _score double, _words array<struct<pos:int,word:binary,prev:short,next:short>>"
    rows = stage(docs.select(*others, text).mapInArrow(run, schema), "scored")
    rare = rows.select("_row", F.explode("_words").alias("x")).select("_row", "x.*").join(counts, "word", "left")
    rare = rare.select("_row", "pos", "prev", "next", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.coalesce("c", F.lit(model.rest)).cast("long").alias("c"))
    rare = rare.repartition("_row").sortWithinPartitions("_row", "pos").mapInArrow(add, "_row long, base double, score double, known long")
    rare = rare.groupBy("_row").agg(F.sum("base").alias("more_base"), F.sum("score").alias("more_score"), F.sum("known").alias("more_known"))
    zero = F.lit(0)
    return rows.join(rare, "_row", "left").select(
        *[F.col(f"doc.`{c}`") for c in others],
        F.col("_n").alias("n_tokens"),
        (F.col("_known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("_base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("_score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


def perplexity(scored: DataFrame, *groups):
    """Per-token perplexity of groups of scored texts."""
    tokens_, total = F.sum("n_tokens"), F.sum("score")
    return scored.groupBy(*groups).agg(tokens_.alias("n_tokens"), F.pow(F.lit(10.0), -total / tokens_).alias("perplexity"))


def held_out(doc_id):
    """Every tenth document by a hash of its id; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Train on the documents that are not held out and score all of them."""
    marked = docs.withColumn("held_out", held_out(F.col(doc_id)))
    model, counts = train_model(marked.filter(~F.col("held_out")), text, **options)
    return score(marked, model, counts, text)
