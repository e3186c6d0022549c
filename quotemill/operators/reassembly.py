"""TCP segment verdicts, offset reassembly and connection bytes.

Arrival order of a flow is (file, capture_seq), where capture_seq is the byte position of the
packet in its file. A flow is cut into blocks of that order; what a block does to the expected
sequence number is a step function of the value it starts with, so blocks are summarised in
parallel, the summaries of a flow are composed in a tree (``folds``), and every block is then replayed
from its exact starting value. Packets are grouped by block, whatever their flow, so a task holds one block of
bytes at a time however large a flow is or however many there are.
"""

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quotemill.operators.folds import WIDTH, states_before
from quotemill.operators.packets import FLOW
from quotemill.operators.scan import (
    block_of,
    ordered_scan,
    previous,
    running_max,
    running_sum,
)
from quotemill.schemas import schema
from quotemill.session import staged

BLOCK_BYTES = 8 << 20
BLOCK = ["file", "block"]
MOD = 1 << 32
HALF = 1 << 31


def with_blocks(packets: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    return packets.withColumn("block", block_of(F.col("capture_seq"), block_bytes))


def signed_distance(a, b):
    """a - b of two 32-bit sequence numbers, read as a signed 32-bit number."""
    return (a - b + HALF) % MOD - HALF


def expected_steps(seq, length):
    """Effect of a block on the expected sequence number, as (base, limits, results).

    Positions are signed distances from ``base``, the first sequence number of the block. An
    expected value e ends as results[i] for the first limit >= e; above the last limit it is kept.
    """
    base = int(seq[0])
    at, before = [], base
    total = 0
    for s in seq.tolist():
        total += signed_distance(s, before)
        before = s
        at.append(total)
    limits, results = [], []
    # From the last packet backwards: e <= at jumps to at + length, then meets the later packets.
    for s, n in zip(reversed(at), reversed(length.tolist())):
        end = s + n
        landed = next((r for lim, r in zip(limits, results) if end <= lim), end)
        # Everything up to s now gives ``landed``; keep only the steps above s.
        above = [(lim, r) for lim, r in zip(limits, results) if lim > s]
        steps = [(s, landed)] + above
        limits, results = [], []
        for lim, r in steps:
            if results and results[-1] == r:
                limits[-1] = lim
            else:
                limits.append(lim)
                results.append(r)
    return base, limits, results


def apply_steps(expected, base, limits, results):
    """Expected value after a block; None means the flow has not started."""
    if expected is None:
        # A first packet is accepted whatever its number: same as any value at or below it.
        return (base + results[0]) % MOD
    e = signed_distance(expected, base)
    for lim, r in zip(limits, results):
        if e <= lim:
            return (base + r) % MOD
    return expected


def merge_steps(a, b):
    """The effect of block ``a``, then block ``b``, on the expected number (each base, limits, results).

    Positions of ``a`` are not wrapped, so the two may cover more than 32 bits of numbers.
    """
    base, limits, results = a
    steps = []
    for limit, r in zip(limits, results):
        e = signed_distance(base + r, b[0])
        landed = next((x for lim, x in zip(b[1], b[2]) if e <= lim), e)
        steps.append((limit, r + landed - e))
    shift = results[-1] - signed_distance(base + results[-1], b[0])
    steps += [(lim + shift, r + shift) for lim, r in zip(b[1], b[2]) if lim + shift > limits[-1]]
    limits, results = [], []
    for limit, r in steps:
        if results and results[-1] == r:
            limits[-1] = limit
        else:
            limits.append(limit)
            results.append(r)
    return base, limits, results


STEP_SCHEMA = "base long, limits array<long>, results array<long>"
STEPS = ("base", "limits", "results")
EXPECTED = T.StructType([T.StructField("expected_seq", T.LongType())])


def _merge_rows(a, b):
    return dict(zip(STEPS, merge_steps(*[tuple(x[s] for s in STEPS) for x in (a, b)])))


def _advance(state, row):
    return (apply_steps(state[0], *(row[s] for s in STEPS)),)


def _flow_types(df, names):
    return [df.schema[n] for n in names]


def flow_slices(table):
    """(flow, start, stop) over a block's rows, which are sorted by flow and position first."""
    table = table.sort_by([(n, "ascending") for n in (*FLOW, "capture_seq")])
    flows = list(zip(*(table[n].to_pylist() for n in FLOW)))
    cuts = [i for i in range(len(flows)) if i == 0 or flows[i] != flows[i - 1]]
    return table, [(flows[a], a, b) for a, b in zip(cuts, [*cuts[1:], len(flows)])]


def rows_table(rows, arrow):
    """Arrow table of row tuples."""
    columns = zip(*rows) if rows else ((),) * len(arrow)
    return pa.table([pa.array(c, t) for c, t in zip(columns, arrow.types)], schema=arrow)


def by_flow(table, column):
    """{flow: value} of a block's carry rows."""
    return dict(zip(zip(*(table[n].to_pylist() for n in FLOW)), table[column].to_pylist()))


def block_count(packets: DataFrame) -> int:
    return packets.select(*BLOCK).distinct().count()


def expected_carry(packets: DataFrame, total: int, width: int = WIDTH) -> DataFrame:
    """(flow, block, expected_seq): the expected number each block starts with (null: first).

    ``total``: the number of blocks.
    """
    keys = FLOW + BLOCK
    narrow = packets.select(*keys, "capture_seq", "tcp_seq", "payload_len")

    def summarise(key, table):
        table, slices = flow_slices(table)
        seq, length = table["tcp_seq"].to_numpy(), table["payload_len"].to_numpy()
        place = tuple(k.as_py() for k in key)
        rows = [(*flow, *place, *expected_steps(seq[a:b], length[a:b])) for flow, a, b in slices]
        return rows_table(rows, summary_arrow)

    summary_schema = T.StructType(_flow_types(narrow, keys) + schema(STEP_SCHEMA).fields)
    summary_arrow = to_arrow_schema(summary_schema)
    blocks = narrow.groupBy(*BLOCK).applyInArrow(summarise, summary_schema)
    blocks = staged(blocks, "steps") if total > width else blocks
    found = states_before(blocks, BLOCK, _merge_rows, _advance, (None,), EXPECTED, total, width=width)
    return found.select(*keys, "expected_seq")


INIT, IN_ORDER, RETRANSMIT, GAP = "init", "in_order", "retransmit", "gap"


def replay(seq, length, expected):
    """(verdicts, expected before each packet) of consecutive packets of a flow."""
    verdicts, before = [], []
    for s, n in zip(seq, length):
        before.append(expected)
        if expected is None:
            verdict = INIT
        else:
            gap = signed_distance(s, expected)
            verdict = RETRANSMIT if gap < 0 else GAP if gap > 0 else IN_ORDER
        if verdict != RETRANSMIT:
            expected = (s + n) % MOD
        verdicts.append(verdict)
    return verdicts, before


def classify_segments(
    packets: DataFrame, block_bytes: int = BLOCK_BYTES, width: int = WIDTH
) -> DataFrame:
    """Add ``verdict`` and ``expected_seq`` (before the packet) in arrival order of each flow."""
    packets = with_blocks(packets, block_bytes)
    out = T.StructType(
        packets.drop("block").schema.fields
        + [T.StructField("verdict", T.StringType()), T.StructField("expected_seq", T.LongType())]
    )
    columns = packets.drop("block").columns
    arrow = to_arrow_schema(out)

    def run(rows, carry):
        rows, slices = flow_slices(rows)
        starts = by_flow(carry, "expected_seq")
        seq, length = rows["tcp_seq"].to_pylist(), rows["payload_len"].to_pylist()
        verdicts, before = [], []
        for flow, a, b in slices:
            v, e = replay(seq[a:b], length[a:b], starts[flow])
            verdicts += v
            before += e
        return (
            rows.select(columns)
            .append_column("verdict", pa.array(verdicts, pa.string()))
            .append_column("expected_seq", pa.array(before, pa.int64()))
            .cast(arrow)
        )

    return (
        packets.groupBy(*BLOCK)
        .cogroup(expected_carry(packets, block_count(packets), width).groupBy(*BLOCK))
        .applyInArrow(run, out)
    )


def stream_positions(packets: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Add ``stream_offset``: 64-bit unwrapped distance from the first segment of the flow."""
    blocked = with_blocks(packets, block_bytes)
    stepped = ordered_scan(
        blocked,
        group=FLOW,
        block=BLOCK,
        order=["capture_seq"],
        hot=True,
        _seq_before=previous(F.col("tcp_seq")),
    )
    step = F.coalesce(
        F.pmod(F.col("tcp_seq") - F.col("_seq_before") + F.lit(HALF), F.lit(MOD)) - F.lit(HALF),
        F.lit(0),
    )
    return ordered_scan(
        stepped.withColumn("_step", step),
        group=FLOW,
        block=BLOCK,
        order=["capture_seq"],
        hot=True,
        stream_offset=running_sum(F.col("_step")),
    ).drop("_step", "_seq_before", "block")


def merge_intervals(
    df: DataFrame, *, group, start: str, length: str, order, block_width: int = BLOCK_BYTES
) -> DataFrame:
    """Order intervals by start, keep the first copy of each, trim overlaps, report holes.

    Adds ``skip`` (leading units already covered), ``hole_start`` and ``hole_end`` (null when the
    interval joins up). Fully covered intervals are dropped. ``order`` is the arrival order.
    """
    first = Window.partitionBy(*group, start).orderBy(*order)
    firsts = (
        df.withColumn("_copy", F.row_number().over(first)).filter(F.col("_copy") == 1).drop("_copy")
    )
    # floor division also for offsets before the first segment
    block = F.floor(F.col(start) / F.lit(block_width)).cast("long")
    scanned = ordered_scan(
        firsts.withColumn("_blk", block),
        group=group,
        block=["_blk"],
        order=[start],
        hot=True,
        _covered=running_max(F.col(start) + F.col(length), exclusive=True),
    ).drop("_blk")
    covered = F.col("_covered")
    overlap = F.greatest(covered - F.col(start), F.lit(0))
    hole = covered < F.col(start)
    return (
        scanned.withColumn("skip", F.coalesce(overlap, F.lit(0)).cast("long"))
        .filter(F.col("skip") < F.col(length))
        .withColumn("hole_start", F.when(hole, covered))
        .withColumn("hole_end", F.when(hole, F.col(start)))
        .drop("_covered")
    )


def reassemble_by_offset(packets: DataFrame, block_bytes: int = BLOCK_BYTES, keep=()) -> DataFrame:
    """(flow, stream_offset, payload, hole_start, hole_end), overlap trimmed, one row per piece.

    ``keep`` names packet columns that go with each piece.
    """
    place = ["file", "capture_seq"]
    narrow = packets.select(*dict.fromkeys([*place, *FLOW, "tcp_seq", "payload_len", *keep]))
    merged = merge_intervals(
        stream_positions(narrow, block_bytes),
        group=FLOW,
        start="stream_offset",
        length="payload_len",
        order=place,
        block_width=block_bytes,
    )
    # offsets, trims and holes are settled on narrow rows; payload crosses the network once
    return merged.join(packets.select(*place, "payload"), place).select(
        *FLOW,
        (F.col("stream_offset") + F.col("skip")).alias("stream_offset"),
        F.expr("substring(payload, cast(skip as int) + 1)").alias("payload"),
        "hole_start",
        "hole_end",
        *keep,
    )


def direction_bytes(packets: DataFrame, ports=(), size: str = "payload_len") -> DataFrame:
    """Bytes per connection and direction; the initiator sent the first packet seen."""
    near = F.struct(F.col("src_ip").alias("ip"), F.col("sport").alias("port"))
    far = F.struct(F.col("dst_ip").alias("ip"), F.col("dport").alias("port"))
    wanted = [p for p in ports if p]
    accepted = (
        F.col("sport").isin(wanted) | F.col("dport").isin(wanted) if wanted else F.lit(True)
    )
    directed = packets.select(
        F.least(near, far).alias("end_a"),
        F.greatest(near, far).alias("end_b"),
        (near <= far).alias("from_a"),
        F.struct("file", "capture_seq").alias("at"),
        F.col(size).alias("n"),
        accepted.alias("accepted"),
    )
    totals = directed.groupBy("end_a", "end_b").agg(
        F.min_by("from_a", "at").alias("a_first"),
        F.sum(F.when(F.col("from_a"), F.col("n")).otherwise(0)).alias("a_bytes"),
        F.sum(F.when(F.col("from_a"), 0).otherwise(F.col("n"))).alias("b_bytes"),
        F.bool_or("accepted").alias("accepted"),
    )

    def pick(a, b):
        return F.when(F.col("a_first"), a).otherwise(b)

    return totals.select(
        pick(F.col("end_a.ip"), F.col("end_b.ip")).alias("initiator_ip"),
        pick(F.col("end_a.port"), F.col("end_b.port")).alias("initiator_port"),
        pick(F.col("end_b.ip"), F.col("end_a.ip")).alias("responder_ip"),
        pick(F.col("end_b.port"), F.col("end_a.port")).alias("responder_port"),
        pick(F.col("a_bytes"), F.col("b_bytes")).alias("sent_bytes"),
        pick(F.col("b_bytes"), F.col("a_bytes")).alias("received_bytes"),
        "accepted",
    )
