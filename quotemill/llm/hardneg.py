"""Hard negatives by exact integer scores from subset-sum tables.

Components become whole numbers ``floor(256 * x)``. A candidate is kept as bit planes: for every bit
of its numbers (two's complement) and every eight dimensions one byte. An anchor is turned into
tables: for every eight dimensions the sums of all 256 subsets of its eight numbers. The score of a
candidate is then one lookup per byte, added up and shifted plane by plane, where the plane of the
sign counts negatively; it is exact, no candidate is left out.

Rows are sorted by label and id, anchors are packed into blocks and all rows into chunks. A
task holds the tables of one block and meets its candidates chunk by chunk, keeping the best of every
anchor; so its memory depends on BLOCK_BYTES and CHUNK only. Blocks and groups of chunks meet as rows of
a shuffle; nothing passes the driver but counts. The first pass scores anchors against the rows of
their label and keeps the first positives; the second scores them against all chunks and keeps,
for every positive, the first negatives inside its margin.

Rows with a null id, label or vector, or a component that is null, NaN or infinite take no part.
Vectors shorter than the longest count as padded with zeros. Rows with equal ids are rows of their own,
each an anchor and a candidate; they tie. An empty table, or one without anchors, gives an
empty result. Only the named columns are read, so other columns of any name don't matter. Components so large that a
score could leave 62 bits raise an error, as no exact score could be returned.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quotemill.llm.common import stage
from quotemill.session import configure

SCALE = 256
BLOCK_BYTES = 16 << 20  # of subset sums held by a task
CHUNK = 4096
GROUP = 1 << 20  # candidates that one task scores against one block, at most
PARTITIONS = 4096  # counts of so many partitions reach the driver, at most
TILE = 128  # anchors whose scores are added up at a time
PACKED = "part int, place long, n long, own array<long>, ids binary, labels binary, rows binary, planes binary"


def whole_numbers(rows: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """The rows that take part, as ``id``, ``label``, ``row`` (a number of its own) and ``codes`` (whole numbers)."""
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    taken = F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & ~bad
    codes = F.transform(x, lambda v: F.floor(v * SCALE))
    return rows.filter(taken).select(
        F.col(vec_id).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.monotonically_increasing_id().alias("row"),
        codes.alias("codes"),
    )


def bit_planes(codes: np.ndarray, n_planes: int) -> np.ndarray:
    """Bytes (row, plane, group of eight dimensions) of whole numbers (row, dimension); the last plane is the sign."""
    n, dims = codes.shape
    padded = np.zeros((n, -dims % 8 + dims), np.int64)
    padded[:, :dims] = codes
    bits = (padded[:, None, :] >> np.arange(n_planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def from_planes(planes: np.ndarray) -> np.ndarray:
    """The whole numbers (row, dimension) behind ``bit_planes``."""
    weight = 1 << np.arange(planes.shape[1], dtype=np.int64)
    weight[-1] = -weight[-1]
    bits = np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64)
    return np.einsum("npd,p->nd", bits, weight)


def subset_sums(codes: np.ndarray, kind) -> np.ndarray:
    """(group, 256, anchor): the sum of every subset of an anchor's eight numbers of a group."""
    n, dims = codes.shape
    eights = codes.reshape(n, dims // 8, 8).transpose(1, 2, 0)
    out = np.zeros((dims // 8, 256, n), kind)
    for t in range(8):
        out[:, 1 << t : 2 << t] = out[:, : 1 << t] + eights[:, t, None, :]
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidate, anchor): shifted sums of table lookups, from the plane of the sign down."""
    n, n_planes, groups = planes.shape
    total = np.zeros((n, tables.shape[2]), tables.dtype)
    found = np.empty_like(total)
    for plane in range(n_planes - 1, -1, -1):
        if plane < n_planes - 1:
            total <<= 1
        for g in range(groups):
            np.take(tables[g], planes[:, plane, g], axis=0, out=found, mode="clip")
            if plane == n_planes - 1:
                total -= found
            else:
                total += found
    return total


class Packed:
    """Rows sorted by label and id."""

    def __init__(self, row: dict, n_planes: int, groups: int):
        self.n = row["n"]
        self.ids, self.labels, self.rows = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "rows"))
        self.planes = np.frombuffer(row["planes"], np.uint8).reshape(self.n, n_planes, groups)


class Block(Packed):
    """Anchors with their tables."""

    def __init__(self, row: dict, n_planes: int, groups: int):
        super().__init__(row, n_planes, groups)
        codes = from_planes(self.planes)
        most = int(np.abs(codes).sum(axis=1).max(initial=0)) << n_planes
        self.table = subset_sums(codes, np.int32 if most < 1 << 30 else np.int64)

    def tiles(self, planes: np.ndarray, of: np.ndarray):
        """Scores of some anchors (their numbers ``of``) at a time against the candidates ``planes``."""
        for a in range(0, len(of), TILE):
            part = of[a : a + TILE]
            yield part, np.ascontiguousarray(scores(np.ascontiguousarray(self.table[:, :, part]), planes).T)


def _first(ids: np.ndarray, scored: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the first ``n`` by score (falling), id and row."""
    if len(scored) > 4 * n:  # all that reach the n-th score, ties included
        keep = np.flatnonzero(scored >= np.partition(scored, len(scored) - n)[len(scored) - n])
        return keep[np.lexsort((rows[keep], ids[keep], -scored[keep].astype(np.int64)))[:n]]
    return np.lexsort((rows, ids, -scored.astype(np.int64)))[:n]


class Best:
    """The first ``n`` candidates of each key, as (score, id, row) triples."""

    def __init__(self, n: int):
        self.n, self.held = n, {}

    def add(self, key, ids, scored, rows):
        old = self.held.get(key)
        if old is not None:
            ids, scored, rows = (np.concatenate(x) for x in zip(old, (ids, scored, rows), strict=True))
        first = _first(ids, scored, rows, self.n)
        self.held[key] = ids[first], scored[first].astype(np.int64), rows[first]


def _positives(block: Block, chunk: Packed, best: Best):
    """The same-label rows of a chunk for every anchor that has some."""
    for label in np.intersect1d(block.labels, chunk.labels):
        a, b = np.searchsorted(chunk.labels, [label, label + 1])
        ids, rows = chunk.ids[a:b], chunk.rows[a:b]
        for part, found in block.tiles(chunk.planes[a:b], np.flatnonzero(block.labels == label)):
            for anchor, row in zip(part.tolist(), found, strict=True):
                other = rows != block.rows[anchor]
                best.add(anchor, ids[other], row[other], rows[other])


def _negatives(block: Block, chunk: Packed, best: Best, low: int, high: int):
    """The other-label rows of a chunk inside the margin of every positive of every anchor."""
    for part, found in block.tiles(chunk.planes, np.array(sorted(block.positives), np.int64)):
        for anchor, row in zip(part.tolist(), found, strict=True):
            levels = block.positives[anchor]
            floor, top = -(-low * min(levels) // 100), high * max(levels) // 100
            use = np.flatnonzero((row >= floor) & (row <= top) & (chunk.labels != block.labels[anchor]))
            if len(use) == 0:
                continue
            order = use[np.argsort(-row[use].astype(np.int64), kind="stable")]  # a chunk may hold several labels, each sorted by id
            falling = -row[order].astype(np.int64)
            for level in levels:
                a = np.searchsorted(falling, -(high * level // 100), "left")
                b = np.searchsorted(falling, -low * level // 100, "right")
                if b > a:
                    reach = np.searchsorted(falling, falling[min(a + best.n, b) - 1], "right")  # with all ties of the last
                    pick = order[a : min(b, reach)]
                    best.add((anchor, level), chunk.ids[pick], row[pick], chunk.rows[pick])


def pack(rows: DataFrame, n_planes: int, groups: int, size: int) -> DataFrame:
    """Rows, in the order of their partitions, as one row per ``size`` of them; ``place`` counts within a partition."""
    names = [c.split()[0] for c in PACKED.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4]

    def packed(table: pa.Table, part: int, place: int) -> pa.RecordBatch:
        lists = table.column("codes").combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy())
        codes = np.zeros((table.num_rows, groups * 8), np.int64)
        row = np.repeat(np.arange(table.num_rows), lengths)
        at = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        codes[row, at] = lists.flatten().to_numpy(zero_copy_only=False)
        ids, labels, numbers = (table.column(c).to_numpy() for c in ("id", "label", "row"))
        blobs = [x.tobytes() for x in (ids, labels, numbers, bit_planes(codes, n_planes))]
        values = [part, place, table.num_rows, np.unique(labels).tolist(), *blobs]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    def run(batches):
        part, place, held = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            while held.num_rows >= size:
                yield packed(held.slice(0, size), part, place)
                held, place = held.slice(size), place + 1
        if held is not None and held.num_rows:
            yield packed(held, part, place)

    return rows.mapInArrow(run, PACKED)


def numbered(packs: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``packs`` with numbers from 0 without holes, and how many there are."""
    counts = sorted(packs.groupBy("part").count().collect())  # one row per partition, PARTITIONS at most
    before, total = [], 0
    for part, n in counts:
        before.append((part, total))
        total += n
    offsets = packs.sparkSession.createDataFrame(before, "part int, before long")
    return packs.join(F.broadcast(offsets), "part").withColumn(name, F.col("before") + F.col("place")).drop("part", "place", "before"), total


def _meet(blocks: DataFrame, chunks: DataFrame, work, tasks: int, n_planes: int, groups: int) -> DataFrame:
    """Run ``work`` for every (block, group): ``blocks`` has a row for each, ``chunks`` any number of rows.

    In a group the block comes first, then its chunks one at a time.
    """
    extra = [c for c in blocks.columns if c not in chunks.columns]
    gone = [F.lit(None).cast(blocks.schema[c].dataType).alias(c) for c in extra]
    columns = [c for c in chunks.columns if c != "number"]
    first = blocks.select(*columns, F.lit(-1).cast("long").alias("turn"), *extra)
    rest = chunks.select(*columns, F.col("number").alias("turn"), *gone)
    rows = first.unionAll(rest).repartition(max(1, min(PARTITIONS, tasks)), "block", "group").sortWithinPartitions("block", "group", "turn")

    def run(batches):
        key, block, best = None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if (row["block"], row["group"]) != key:
                    if block is not None:
                        yield work.done(key[0], block, best)
                    key, block = (row["block"], row["group"]), Block(row, n_planes, groups)
                    best = work.start(block, row)
                else:
                    work.add(block, Packed(row, n_planes, groups), best)
        if block is not None:
            yield work.done(key[0], block, best)

    return rows.mapInArrow(run, work.schema)


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [x.split()[0] for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


class FindPositives:
    """The first rows of an anchor's label."""

    schema = "block long, row long, anchor_id long, positive_id long, positive_row long, positive_score long"

    def __init__(self, n: int):
        self.n = n

    def start(self, block, row):
        return Best(self.n)

    def add(self, block, chunk, best):
        _positives(block, chunk, best)

    def done(self, number, block, best):
        rows = []
        for anchor, (ids, scored, others) in best.held.items():
            own = (number, int(block.rows[anchor]), int(block.ids[anchor]))
            rows += [(*own, *x) for x in zip(ids.tolist(), others.tolist(), scored.tolist(), strict=True)]
        return _table(rows, self.schema)


class FindNegatives:
    """The first rows of other labels inside the margin of every score that a positive of an anchor has."""

    schema = "row long, positive_score long, negative_id long, negative_row long, negative_score long"

    def __init__(self, n: int, low: int, high: int):
        self.n, self.low, self.high = n, low, high

    def start(self, block, row):
        number = {r: i for i, r in enumerate(block.rows.tolist())}
        block.positives = {number[x["row"]]: sorted(x["levels"]) for x in row["wanted"]}
        return Best(self.n)

    def add(self, block, chunk, best):
        _negatives(block, chunk, best, self.low, self.high)

    def done(self, number, block, best):
        rows = []
        for (anchor, level), (ids, scored, others) in best.held.items():
            own = (int(block.rows[anchor]), level)
            rows += [(*own, *x) for x in zip(ids.tolist(), others.tolist(), scored.tolist(), strict=True)]
        return _table(rows, self.schema)


def _top(rows: DataFrame, by: list[str], what: str, n: int) -> DataFrame:
    """The first ``n`` of every group by score (falling), id and row, with their ``rank``."""
    order = W.partitionBy(*by).orderBy(F.desc(f"{what}_score"), f"{what}_id", f"{what}_row")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def mine(
    rows: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    anchors: int = 100,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """For every anchor (id divisible by ``anchors``) and its first positives the first negatives inside the margin.

    A negative of a positive scores from ``low`` to ``high`` per cent of it. Columns: anchor_id,
    positive_id, rank (from 1), negative_id, positive_score, negative_score.
    """
    spark = configure(rows.sparkSession)
    coded = stage(whole_numbers(rows, vec_id, vector, label), "codes")
    is_anchor = F.col("id") % anchors == 0
    shape = coded.agg(
        F.max(F.size("codes")).alias("dims"),
        F.max(F.array_max("codes")).alias("most"),
        F.min(F.array_min("codes")).alias("least"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(is_anchor).alias("anchors"),
    ).first()
    groups = max(1, -(-(shape["dims"] or 0) // 8))
    bits = max((shape["most"] or 0).bit_length(), (-1 - (shape["least"] or 0)).bit_length() if (shape["least"] or 0) < 0 else 0)
    if (8 * groups) << (2 * bits + 1) >= 1 << 62:
        raise ValueError("components are too large for exact scores of 63 bits")
    n_planes = bits + 1
    size = max(16, min(1024, BLOCK_BYTES // (groups * 256 * 4)))

    def packs(part: DataFrame, n: int, each: int, name: str):
        parts = max(1, min(PARTITIONS, -(-n // (4 * each))))
        ordered = part.repartitionByRange(parts, "label", "id").sortWithinPartitions("label", "id", "row")
        return numbered(stage(pack(ordered, n_planes, groups, each), name), "block" if name == "anchors" else "number")

    blocks, n_blocks = packs(coded.filter(is_anchor), shape["anchors"], size, "anchors")
    chunks, n_chunks = packs(coded, shape["rows"], CHUNK, "candidates")
    # a task meets GROUP candidates at most, and fewer where cores would stand idle
    idle = -(-n_chunks * n_blocks // (2 * spark.sparkContext.defaultParallelism))
    each = max(1, min(GROUP // CHUNK, idle))
    chunks = chunks.withColumn("group", F.floor(F.col("number") / each))
    n_groups = -(-n_chunks // each)
    work = (n_blocks * n_groups, n_planes, groups)

    shared = blocks.select("block", F.explode("own").alias("of")).join(chunks.select("number", "group", F.explode("own").alias("of")), "of")
    shared = stage(shared.select("block", "group", "number").distinct(), "pairs")
    of_label = _meet(
        shared.select("block", "group").distinct().join(blocks.drop("own"), "block"),
        shared.join(chunks.drop("own", "group"), "number"),
        FindPositives(positives),
        *work,
    )
    found = stage(_top(of_label, ["row"], "positive", positives).drop("rank"), "positives")

    levels = found.groupBy("block", "row").agg(F.collect_set("positive_score").alias("levels"))
    wanted = levels.groupBy("block").agg(F.collect_list(F.struct("row", "levels")).alias("wanted"))  # a block's anchors
    span = F.sequence(F.lit(0).cast("long"), F.lit(max(n_groups - 1, 0)).cast("long"))
    every = F.sequence(F.lit(0).cast("long"), F.lit(max(n_blocks - 1, 0)).cast("long"))
    others = _meet(
        blocks.drop("own").join(wanted, "block").withColumn("group", F.explode(span)),
        chunks.drop("own").withColumn("block", F.explode(every)).join(wanted.select("block"), "block"),
        FindNegatives(negatives, low, high),
        *work,
    )
    best = _top(others, ["row", "positive_score"], "negative", negatives)
    return found.join(best, ["row", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
