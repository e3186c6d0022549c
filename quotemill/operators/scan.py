"""Ordered scans over groups of any size.

A plain ``Window.partitionBy(group).orderBy(order)`` sends a whole group to one task. That is the right
plan, one exchange and one sort, as long as no group is large, so groups are first counted by
``BUCKETS`` buckets of their hash: one narrow pass that returns so many rows at most. Groups in buckets far
above the others are cut into blocks of their order: a window runs inside each (group, block), one
small row per block is aggregated with partial aggregation, and the running value at the start of
each block is joined back. Only the block rows of a group meet in one task: N / block width of
them. A scan without a group has its block rows numbered by range partitions.

``block`` columns must be a coarsening of ``order``: rows sorted by ``order`` are sorted by
``block``.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotemill.session import staged

BLOCK_ROWS = 1 << 18
BUCKETS = 4096
HOT_ROWS = 1 << 22  # a bucket below this is never hot
HOT_SHARE = 8  # nor one with fewer than so many times the rows of an average bucket


@dataclass(frozen=True)
class Running:
    kind: str
    value: Column
    exclusive: bool = False


def running_sum(value, exclusive=False):
    return Running("sum", value, exclusive)


def running_count(exclusive=False):
    return Running("sum", F.lit(1).cast("long"), exclusive)


def running_max(value, exclusive=False):
    return Running("max", value, exclusive)


def running_last(value, exclusive=False):
    """Last non-null value so far."""
    return Running("last", value, exclusive)


def previous(value):
    """Value of the row before."""
    return Running("lag", value)


def block_of(order: Column, width: int = BLOCK_ROWS) -> Column:
    return F.call_function("div", order, F.lit(width))


def _local(spec, w, cumulative):
    if spec.kind == "lag":
        return F.lag(spec.value).over(w)
    frame = cumulative.rowsBetween(Window.unboundedPreceding, -1 if spec.exclusive else 0)
    if spec.kind == "last":
        return F.last(spec.value, ignorenulls=True).over(frame)
    return {"sum": F.sum, "max": F.max}[spec.kind](spec.value).over(frame)


def _block_total(spec, position):
    if spec.kind == "lag":
        return F.max_by(spec.value, position)
    if spec.kind == "last":
        return F.max_by(spec.value, F.when(spec.value.isNotNull(), position))
    return {"sum": F.sum, "max": F.max}[spec.kind](spec.value)


def _null_safe(carry: DataFrame, keys):
    """(carry with renamed keys, condition): null is a group like any other."""
    renamed = carry.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    return renamed, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])


def split_hot(df: DataFrame, group):
    """(rows of ordinary groups, rows of groups too large for a task); either may be None."""
    bucket = F.pmod(F.xxhash64(*group), F.lit(BUCKETS))
    counts = {r["b"]: r["n"] for r in df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
    limit = max(HOT_ROWS, HOT_SHARE * sum(counts.values()) // BUCKETS)
    hot = [b for b, n in counts.items() if n > limit]
    if not hot:
        return df, None
    if len(hot) == len(counts):
        return None, df
    return df.filter(~bucket.isin(hot)), df.filter(bucket.isin(hot))


def ordered_scan(df: DataFrame, *, group, block, order, hot: bool | None = None, **specs: Running) -> DataFrame:
    """Add one running column per spec, over ``order`` within ``group``.

    ``hot`` says whether groups are known to be large (or not); otherwise they are counted, which reads ``df``
    once more: give a written table then.
    """
    group, block, order = list(group), list(block), list(order)
    if hot is None and group:
        ordinary, large = split_hot(df, group)
    else:
        ordinary, large = (df, None) if group and not hot else (None, df)
    if large is None:
        return _plain_scan(ordinary, group, order, specs)
    blocked = _blocked_scan(large, group, block, order, specs)
    if ordinary is None:
        return blocked
    return _plain_scan(ordinary, group, order, specs).unionByName(blocked)


def _plain_scan(df, group, order, specs):
    w = Window.partitionBy(*group).orderBy(*order)
    found = {n: _local(s, w, w) for n, s in specs.items()}
    filled = {n: F.coalesce(c, F.lit(0)) if specs[n].kind == "sum" else c for n, c in found.items()}
    return df.select(*df.columns, *[c.alias(n) for n, c in filled.items()])


def _blocked_scan(df, group, block, order, specs):
    keys = group + block
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    w = Window.partitionBy(*keys).orderBy(*order)

    local = df
    for name, spec in specs.items():
        local = local.withColumn(f"_l_{name}", _local(spec, w, w))
    if any(s.kind == "lag" for s in specs.values()):
        local = local.withColumn("_l_row", F.row_number().over(w))

    blocks = df.groupBy(*keys).agg(
        *[_block_total(s, position).alias(f"_t_{n}") for n, s in specs.items()]
    )
    carry_over = Window.partitionBy(*group).orderBy(*block)
    before = carry_over.rowsBetween(Window.unboundedPreceding, -1)

    def carried(name, spec):
        total = F.col(f"_t_{name}")
        if spec.kind == "lag":
            return F.lag(total).over(carry_over)
        if spec.kind == "last":
            return F.last(total, ignorenulls=True).over(before)
        return {"sum": F.sum, "max": F.max}[spec.kind](total).over(before)

    # First blocks carry nothing: without them the table is small when most groups fit one block.
    some = reduce(lambda a, b: a | b, [F.col(f"_c_{n}").isNotNull() for n in specs])
    carry = blocks.select(
        *keys, *[carried(n, s).alias(f"_c_{n}") for n, s in specs.items()]
    ).filter(some)
    joined = local.join(*_null_safe(carry, keys), "left")

    def combined(name, spec):
        here, before_block = F.col(f"_l_{name}"), F.col(f"_c_{name}")
        if spec.kind == "sum":
            return F.coalesce(here, F.lit(0)) + F.coalesce(before_block, F.lit(0))
        if spec.kind == "max":
            return F.greatest(here, before_block)
        if spec.kind == "last":
            return F.coalesce(here, before_block)
        return F.when(F.col("_l_row") == 1, before_block).otherwise(here)

    return joined.select(*df.columns, *[combined(n, s).alias(n) for n, s in specs.items()])


def occurrence_number(df: DataFrame, *, keys, block, order, name="occurrence", hot: bool | None = None) -> DataFrame:
    """Number the rows of each key from 1 by ``order``; a key of any size is numbered block by block."""
    numbered = ordered_scan(df, group=keys, block=block, order=order, hot=hot, **{name: running_count()})
    return numbered.withColumn(name, F.col(name).cast("long"))


def number_all(df: DataFrame, *, block, order, name: str) -> DataFrame:
    """Number all rows from 1 by ``order``: blocks count their rows, and their first numbers come from
    ``totals_before``."""
    block = list(block)
    counts = df.groupBy(*block).agg(F.count(F.lit(1)).alias("_n"))
    # A struct of nulls equals itself, so windows and join deal rows by one key: they cross the network once.
    key = F.struct(*block).alias("_key")
    first = totals_before(counts, block, "_n", "_first").select(key, "_first")
    place = F.row_number().over(Window.partitionBy("_key").orderBy(*order))
    joined = df.select(*df.columns, key).withColumn("_row", place).join(first, "_key")
    return joined.select(*df.columns, (F.col("_first") + F.col("_row")).cast("long").alias(name))


ROW_BITS = 33  # monotonically_increasing_id: partition above, row in it below


def row_numbers(df: DataFrame, order, name: str, start: int = 0, partitions: int | None = None) -> DataFrame:
    """Number all rows by ``order``, from ``start`` on: places in range partitions, and the sizes of the
    partitions before joined back."""
    held = _ranged(df, order, partitions)
    row = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return held.join(_offsets(held, F.count(F.lit(1)), start), "_part").select(*df.columns, (F.col("_before") + row).alias(name))


def _ranged(df: DataFrame, order, partitions):
    """``df`` in range partitions of a written table, so that rows stay where they are, with their place."""
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    held = staged(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranged")
    return held.withColumn("_part", F.shiftright("_at", ROW_BITS))


def _offsets(held: DataFrame, total, start: int = 0) -> DataFrame:
    """(_part, _before): sum of ``total`` over the partitions before; the driver sees a row per partition."""
    rows, before = [], start
    for row in sorted(held.groupBy("_part").agg(total.cast("long").alias("n")).collect()):
        rows.append((row["_part"], before))
        before += row["n"]
    return F.broadcast(held.sparkSession.createDataFrame(rows, "_part long, _before long"))


def totals_before(df: DataFrame, order, value: str, name: str, partitions: int | None = None) -> DataFrame:
    """The sum of ``value`` over all rows before each one, with ``order`` unique: sums inside range partitions,
    and those of the partitions before joined back."""
    held = _ranged(df, order, partitions)
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    summed = held.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    found = summed.join(_offsets(held, F.sum(value)), "_part")
    return found.select(*[c for c in df.columns if c != value], (F.col("_before") + F.col("_inside")).alias(name))
