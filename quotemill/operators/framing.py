"""Message frames from TCP payload.

The bytes a flow accepts between two gaps form one stream, and a frame ends where its header says.
So what a block of packets does to the resume position is again a step function of the position it
starts with. Blocks are summarised in parallel (``_summarise``), every block is told the few bytes that
follow it, the functions of a flow are composed in a tree (``folds``), and every block then cuts its
own frames (``_cut``), once: what it finds is written by kind and read by all that follows. A frame
that runs past its block leaves parts, which meet in a group bounded by the 16 MB frame limit.
"""

import struct
import zlib
from bisect import bisect_left
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quotemill.operators.folds import WIDTH, over_groups, states_before
from quotemill.operators.packets import FLOW
from quotemill.operators.reassembly import (
    BLOCK,
    BLOCK_BYTES,
    GAP,
    INIT,
    MOD,
    RETRANSMIT,
    block_count,
    by_flow,
    expected_carry,
    flow_slices,
    reassemble_by_offset,
    replay,
    rows_table,
    with_blocks,
)
from quotemill.schemas import schema
from quotemill.session import staged

MAX_FRAME = 16 * 1024 * 1024
LOOKAHEAD = 64
SOH = b"\x01"
ZIP_HEADER = b"PK\x03\x04"
MAX_NUMBER = 18
_IS_DIGIT = frozenset(b"0123456789").__contains__


class StepFrames:
    """``8=STEP.1.0.0|9=n|...|10=xxx|`` with | = 0x01; n counts up to the SOH before ``10=``."""

    magic = b"8=STEP.1.0.0\x01"
    trailer = 7
    payload_tag = SOH + b"96="
    max_digits = LOOKAHEAD - len(magic) - 3
    fields = [
        T.StructField("category_id", T.LongType()),
        T.StructField("msg_type", T.LongType()),
        T.StructField("msg_seq_id", T.LongType()),
        T.StructField("sending_time", T.StringType()),
        T.StructField("sender", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("frame_reject", T.StringType()),
    ]

    @classmethod
    def header(cls, buf, pos):
        """Total frame length, or minus the bytes to skip, or None when more bytes are needed."""
        at = pos + len(cls.magic)
        tag = buf[at : at + 2]
        if len(tag) < 2:
            return None if b"9=".startswith(tag) else -len(cls.magic)
        if tag != b"9=":
            return -len(cls.magic)
        stop = buf.find(SOH, at + 2, at + 3 + cls.max_digits)
        digits = buf[at + 2 : stop if stop >= 0 else at + 3 + cls.max_digits]
        if digits and not digits.isdigit():
            return -len(cls.magic)
        if stop < 0:
            return None if len(digits) <= cls.max_digits else -len(cls.magic)
        total = stop + 1 - pos + int(digits or b"0") + cls.trailer
        return total if total <= MAX_FRAME else -len(cls.magic)

    @classmethod
    def parse(cls, raw):
        """Fields by tag. All but tag 96 is plain text between SOHs; tag 95 measures tag 96, which
        may hold any byte. A number above 63 bits is left out, as is a payload that its length would
        carry past the frame; ``frame_reject`` says so."""
        text, _, rest = raw.partition(cls.payload_tag)
        fields = _plain_fields(text)
        reasons = []

        def number(tag, prefix=0):
            digits = bytes(filter(_IS_DIGIT, fields.get(tag, b"")[prefix:])).lstrip(b"0")
            if len(digits) > MAX_NUMBER:
                reasons.append(f"number in tag {tag.decode()}")
                return 0
            return int(digits or b"0")

        size = number(b"95")
        payload = rest[:size]
        if len(payload) < size:
            reasons.append("payload longer than frame" if rest else "no payload")
            payload = b""
        else:
            fields = _plain_fields(rest[size:]) | fields
        words = [fields[t].decode("latin-1") if t in fields else None for t in (b"52", b"49", b"56")]
        numbers = number(b"10142"), number(b"35", len(b"UA")), number(b"10072")
        return (*numbers, *words, payload, "; ".join(reasons) or None)


def _plain_fields(text):
    """{tag: value} of ``tag=value`` items between SOHs."""
    parts = (item.partition(b"=") for item in text.split(SOH))
    return {tag: value for tag, eq, value in parts if eq}


class HeadedFrames:
    """40-byte header of ten big-endian u32, then the body."""

    magic = b"\x00\x04\xc4\x53"
    head = struct.Struct(">10I")
    fields = [
        T.StructField("length", T.LongType()),
        T.StructField("type", T.LongType()),
        T.StructField("subtype", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("zero", T.LongType()),
        T.StructField("t24", T.LongType()),
        T.StructField("flag_28", T.LongType()),
        T.StructField("compressed", T.LongType()),
        T.StructField("flag_36", T.LongType()),
        T.StructField("raw_body", T.BinaryType()),
    ]

    @classmethod
    def header(cls, buf, pos):
        if len(buf) < pos + cls.head.size:
            return None
        length = int.from_bytes(buf[pos + 4 : pos + 8], "big")
        return length if cls.head.size <= length <= MAX_FRAME else -4

    @classmethod
    def parse(cls, raw):
        return (*cls.head.unpack_from(raw)[1:], raw[cls.head.size :])


def _magics(buf, proto):
    """(starts, next positions, frame flags, tail): headers fully inside ``buf``.

    ``tail`` is where a header that needs more bytes may start.
    """
    starts, nexts, whole = [], [], []
    pos = buf.find(proto.magic)
    while pos >= 0:
        size = proto.header(buf, pos)
        if size is None:
            return starts, nexts, whole, pos
        starts.append(pos)
        nexts.append(pos + abs(size))
        whole.append(size > 0)
        pos = buf.find(proto.magic, pos + 1)
    for k in range(min(len(buf), len(proto.magic) - 1), 0, -1):
        if buf.endswith(proto.magic[:k]):
            return starts, nexts, whole, len(buf) - k
    return starts, nexts, whole, len(buf)


def _walk(entry, starts, nexts):
    """Indexes of the headers met from ``entry``, and the position after the last one."""
    met, pos = [], entry
    i = bisect_left(starts, pos)
    while i < len(starts):
        met.append(i)
        pos = nexts[i]
        i = bisect_left(starts, pos, i)
    return met, pos


def _exits(starts, nexts, whole):
    """Step function entry -> (exit, start of the frame that reaches it or -1)."""
    exits = [None] * len(starts)
    limits, values = [], []
    for i in reversed(range(len(starts))):
        j = bisect_left(starts, nexts[i])
        exits[i] = exits[j] if j < len(starts) else (nexts[i], starts[i] if whole[i] else -1)
        if values and values[-1] == exits[i]:
            continue
        limits.append(starts[i])
        values.append(exits[i])
    return limits[::-1], [v[0] for v in values[::-1]], [v[1] for v in values[::-1]]


PACKET_COLUMNS = ("capture_seq", "ts_ns", "tcp_seq", "payload_len", "payload")


def flow_pieces(table, expected):
    """(flow, Pieces) of every flow of a block; ``expected`` maps flows to starting numbers."""
    table, slices = flow_slices(table)
    columns = [table[n].to_pylist() for n in PACKET_COLUMNS]
    for flow, a, b in slices:
        yield flow, Pieces(*(c[a:b] for c in columns), expected[flow])


class Pieces:
    """Accepted bytes of a block, cut at gaps; ``continues`` when piece 0 goes on."""

    def __init__(self, capture_seq, ts_ns, seq, length, payloads, expected):
        self.capture_seq, self.ts_ns = capture_seq, ts_ns
        verdicts, _ = replay(seq, length, expected)
        parts, origins = [[]], [[]]
        self.continues = True
        size = 0
        for i, verdict in enumerate(verdicts):
            if verdict == RETRANSMIT:
                continue
            if verdict in (INIT, GAP):
                if not parts[-1] and len(parts) == 1:
                    self.continues = False
                else:
                    parts.append([])
                    origins.append([])
                size = 0
            origins[-1].append((size, i))
            parts[-1].append(payloads[i])
            size += len(payloads[i])
        self.bytes = [b"".join(p) for p in parts]
        self.origins = origins

    def place(self, piece, pos):
        """(order number, time) of a byte: its packet's position, then the offset inside it."""
        at = bisect_left(self.origins[piece], (pos + 1, -1)) - 1
        offset, i = self.origins[piece][at]
        return self.capture_seq[i] * 65536 + pos - offset, self.ts_ns[i]


SUMMARY = schema(
    "continues boolean, single boolean, size long, head binary, "
    "limits array<long>, exits array<long>, owners array<long>, tail_at long, tail binary"
)
CARRY = schema(
    "skip long, open_file string, open_block long, open_pos long, open_total long, "
    "tail_starts array<long>, tail_totals array<long>"
)


def _summarise(pieces, proto):
    last = pieces.bytes[-1]
    starts, nexts, whole, tail_at = _magics(last, proto)
    limits, exits, owners = _exits(starts, nexts, whole)
    return (
        pieces.continues,
        len(pieces.bytes) == 1,
        len(last),
        pieces.bytes[0][:LOOKAHEAD],
        limits,
        exits,
        owners,
        tail_at,
        last[tail_at:],
    )


def _seen_by_previous(ahead, row):
    """The bytes that the block before ``row`` sees behind its end; ``ahead`` is what ``row`` sees."""
    if not row["continues"]:
        return b""
    return (row["head"] + ahead if row["single"] else row["head"])[:LOOKAHEAD]


def _merge_heads(a, b):
    """Two neighbours as one block, as far as the bytes at its start go."""
    joined = a["single"] and b["continues"]
    return a | {
        "single": joined and b["single"],
        "head": (a["head"] + b["head"] if joined else a["head"])[:LOOKAHEAD],
    }


NOBODY = (None, None, None, None)
ALWAYS = 1 << 62


def _enter(row, skip, owner):
    """(skip after, its owner, tail starts, tail totals) of a block whose last piece starts ``skip`` bytes in.

    ``skip``: bytes of the piece that belong to a frame or header begun before it; ``owner``: the frame
    (file, block, position, total), or NOBODY.
    """
    here = (row["file"], row["block"])
    i = bisect_left(row["limits"], skip)
    end = skip
    if i < len(row["limits"]):
        end, start = row["exits"][i], row["owners"][i]
        owner = (*here, start, end - start) if start >= 0 else NOBODY
    starts, totals = [], []
    if end < row["size"]:
        owner = NOBODY
        # A position in the tail is looked at together with the bytes that follow it.
        base, buf = row["tail_at"], row["tail"] + row["ahead"]
        pos = max(end, base)
        while pos < row["size"]:
            at = buf.find(row["magic"], pos - base)
            size = row["proto"].header(buf, at) if at >= 0 else None
            if size is None or base + at >= row["size"]:
                pos, owner = row["size"], NOBODY
                break
            pos = base + at + abs(size)
            owner = NOBODY
            if size > 0:
                starts.append(base + at)
                totals.append(size)
                owner = (*here, base + at, size)
        end = pos
    over = end - row["size"]
    return over, owner if over > 0 else NOBODY, starts, totals


def _effect(row, proto):
    """The step function of a block: ``steps`` of (limit, skip after, owner), read like ``_leave``."""
    row = row | {"magic": proto.magic, "proto": proto}
    if not row["single"]:
        return [(ALWAYS, *_enter(row, 0, NOBODY)[:2])]
    limits, buf = list(row["limits"]), row["tail"] + row["ahead"]
    at = buf.find(proto.magic)
    while 0 <= at < row["size"] - row["tail_at"]:
        limits.append(row["tail_at"] + at)
        at = buf.find(proto.magic, at + 1)
    return _joined((lim, *_enter(row, lim, NOBODY)[:2]) for lim in sorted(set(limits)))


def _joined(steps):
    """Neighbouring steps of equal outcome as one."""
    out = []
    for step in steps:
        if out and out[-1][1:] == step[1:]:
            out[-1] = step
        else:
            out.append(step)
    return out


def _leave(continues, size, steps, skip, owner):
    """(skip, owner) behind a block or a run of blocks that is entered with ``skip`` bytes of ``owner``."""
    if not continues:
        skip, owner = 0, NOBODY
    i = bisect_left(steps, skip, key=itemgetter(0))
    if i < len(steps):
        return steps[i][1:]
    return (skip - size, owner) if skip > size else (0, NOBODY)


def _compose(a, b):
    """(continues, size, steps) of two neighbours as one."""
    if not b[0]:
        return a[0], a[1], [(ALWAYS, *_leave(*b, 0, NOBODY))]
    steps = [(lim, *_leave(*b, skip, owner)) for lim, skip, owner in a[2]]
    reached = steps[-1][0] if steps else -1
    if reached < a[1]:
        steps.append((a[1], *_leave(*b, 0, NOBODY)))
        reached = a[1]
    if reached < ALWAYS:
        shifted = [(min(lim + a[1], ALWAYS), skip, owner) for lim, skip, owner in b[2]]
        steps += [x for x in shifted if x[0] > reached]
    return a[0], a[1] + b[1], _joined(steps)


OWNER = schema("file string, block long, pos long, total long")
STEP = T.StructType([*schema("limit long, skip long").fields, T.StructField("owner", OWNER)])
STEPS = T.StructType([T.StructField("steps", T.ArrayType(STEP))])
OPENED = T.StructType([T.StructField("skip", T.LongType()), T.StructField("opened", OWNER)])
AHEAD = schema("ahead binary")
OWNER_FIELDS = OWNER.names


def _from_row(row):
    """(continues, size, steps) out of a written row."""
    steps = [(s["limit"], s["skip"], _owner(s["owner"])) for s in row["steps"]]
    return row["continues"], row["size"], steps


def _owner(value):
    return NOBODY if value is None else tuple(value[k] for k in OWNER_FIELDS)


def _as_struct(owner):
    return None if owner == NOBODY else dict(zip(OWNER_FIELDS, owner))


def _as_steps(steps):
    return [{"limit": lim, "skip": skip, "owner": _as_struct(owner)} for lim, skip, owner in steps]


def _merge_effects(a, b):
    continues, size, steps = _compose(_from_row(a), _from_row(b))
    return a | {"continues": continues, "size": size, "steps": _as_steps(steps)}


def _advance(state, row):
    skip, owner = _leave(*_from_row(row), state[0], _owner(state[1]))
    return skip, _as_struct(owner)


def _state_of(row, proto):
    """What a block needs for its cut: skip at its start, whose frame that is, and frames in its tail."""
    row = row | {"magic": proto.magic, "proto": proto}
    entry = (row["skip"], _owner(row["opened"])) if row["continues"] else (0, NOBODY)
    last = entry if row["single"] else (0, NOBODY)
    return [entry[0], *entry[1], *_enter(row, *last)[2:]]


def _cut(pieces, carry, proto):
    """(kind, piece, start, stop, frame total) of everything in a block."""
    for p, data in enumerate(pieces.bytes):
        is_last = p == len(pieces.bytes) - 1
        skip = carry["skip"] if p == 0 and pieces.continues else 0
        starts, nexts, whole, _ = _magics(data, proto)
        met, _ = _walk(skip, starts, nexts)
        frames = [(starts[i], nexts[i] - starts[i]) for i in met if whole[i]]
        if is_last:
            frames += list(zip(carry["tail_starts"], carry["tail_totals"]))
        covered = min(skip, len(data))
        if covered:
            yield "part" if carry["open_pos"] is not None else "junk", p, 0, covered, None
        for start, total in frames:
            if start > covered:
                yield "junk", p, covered, start, None
            stop = min(start + total, len(data))
            if stop - start == total:
                yield "frame", p, start, stop, total
            else:
                yield "open" if is_last else "residual", p, start, stop, total
            covered = stop
        if covered < len(data):
            yield "junk", p, covered, len(data), None


META = [
    T.StructField("kind", T.StringType()),
    T.StructField("file", T.StringType()),
    T.StructField("block", T.LongType()),
    T.StructField("frame_no", T.LongType()),
    T.StructField("ts_ns", T.LongType()),
    T.StructField("n_bytes", T.LongType()),
    T.StructField("open_file", T.StringType()),
    T.StructField("open_block", T.LongType()),
    T.StructField("open_pos", T.LongType()),
    T.StructField("open_total", T.LongType()),
    T.StructField("raw", T.BinaryType()),
]


def _flow_fields(df):
    return [df.schema[n] for n in FLOW]


def _cut_state(packets: DataFrame, proto, width: int) -> DataFrame:
    """(flow, block, expected_seq, CARRY): the state in which every block starts to cut."""
    keys = FLOW + BLOCK
    key_fields = [packets.schema[n] for n in keys]
    expected = [T.StructField("expected_seq", T.LongType())]
    summary_schema = T.StructType(key_fields + SUMMARY.fields + expected)
    summary_arrow = to_arrow_schema(summary_schema)

    def summarise(key, rows, carry):
        place = tuple(k.as_py() for k in key)
        starts = by_flow(carry, "expected_seq")
        found = [
            (*flow, *place, *_summarise(pieces, proto), starts[flow])
            for flow, pieces in flow_pieces(rows, starts)
        ]
        return rows_table(found, summary_arrow)

    total = block_count(packets)
    by_block = packets.groupBy(*BLOCK).cogroup(expected_carry(packets, total, width).groupBy(*BLOCK))
    summaries = by_block.applyInArrow(summarise, summary_schema)
    carry_schema = T.StructType(key_fields + expected + CARRY.fields)
    if total <= width:
        return over_groups(summaries, FLOW, BLOCK, _flow_walk(proto), carry_schema, False)
    summaries = staged(summaries, "summaries")

    heads = summaries.select(*keys, "continues", "single", "head")
    behind = states_before(
        heads, BLOCK, _merge_heads, lambda s, row: (_seen_by_previous(s[0], row),), (b"",), AHEAD, total, True, width
    )
    effect_schema = T.StructType(summary_schema.fields + AHEAD.fields + STEPS.fields)
    effect_arrow = to_arrow_schema(effect_schema)

    def effects(batches):
        for batch in batches:
            rows = [row | {"steps": _as_steps(_effect(row, proto))} for row in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, schema=effect_arrow)

    told = summaries.join(behind.select(*keys, "ahead"), keys)
    ready = staged(told.select(*summaries.columns, "ahead").mapInArrow(effects, effect_schema), "effects")
    entered = states_before(
        ready.select(*keys, "continues", "size", "steps"), BLOCK, _merge_effects, _advance, (0, None), OPENED, total, width=width
    )
    carry_arrow = to_arrow_schema(carry_schema)
    names = [f.name for f in CARRY.fields]

    def states(batches):
        for batch in batches:
            rows = [
                {k: row[k] for k in (*keys, "expected_seq")} | dict(zip(names, _state_of(row, proto)))
                for row in batch.to_pylist()
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=carry_arrow)

    found = ready.drop("steps").join(entered.select(*keys, "skip", "opened"), keys)
    return found.mapInArrow(states, carry_schema)


def _flow_walk(proto):
    """The state of every block of a flow of few blocks, in one walk back and one forth."""

    class Walk:
        def __init__(self):
            self.rows = []

        def take(self, row):
            self.rows.append(row)
            return ()

        def end(self):
            ahead = b""
            for row in reversed(self.rows):
                row["ahead"] = ahead
                ahead = _seen_by_previous(ahead, row)
            names = [f.name for f in CARRY.fields]
            skip, owner = 0, NOBODY
            for row in self.rows:
                told = row | {"magic": proto.magic, "proto": proto}
                entry = (skip, owner) if row["continues"] else (0, NOBODY)
                skip, owner, *tail = _enter(told, *(entry if row["single"] else (0, NOBODY)))
                state = dict(zip(names, [entry[0], *entry[1], *tail]))
                yield {k: row[k] for k in (*FLOW, *BLOCK, "expected_seq")} | state

    return Walk


def cut_events(
    packets: DataFrame, proto, block_bytes: int = BLOCK_BYTES, width: int = WIDTH
) -> DataFrame:
    """Everything the framing step sees: frames, parts of frames across blocks, and lost bytes.

    Payload is cut once; the events are a table with a folder per ``kind``, so frames, parts and lost
    bytes are read apart from each other.
    """
    packets = with_blocks(
        packets.select("file", "capture_seq", "ts_ns", *FLOW, "tcp_seq", "payload", "payload_len"),
        block_bytes,
    )
    out_schema = T.StructType(_flow_fields(packets) + META + proto.fields)
    out_arrow = to_arrow_schema(out_schema)
    no_fields, no_open = (None,) * len(proto.fields), (None,) * 5
    open_names = ("open_file", "open_block", "open_pos", "open_total")

    def cut(key, rows, carry):
        place = tuple(k.as_py() for k in key)
        states = {tuple(c[n] for n in FLOW): c for c in carry.to_pylist()}
        starts = {flow: c["expected_seq"] for flow, c in states.items()}
        out = []
        for flow, pieces in flow_pieces(rows, starts):
            state = states[flow]
            for kind, piece, start, stop, total in _cut(pieces, state, proto):
                data = pieces.bytes[piece][start:stop]
                opened, values = no_open, no_fields
                if kind == "frame":
                    values = proto.parse(data)
                elif kind == "open":
                    opened = (*place, start, total, data)
                elif kind == "part":
                    opened = (*(state[n] for n in open_names), data)
                number, ts_ns = pieces.place(piece, start)
                out.append((*flow, kind, *place, number, ts_ns, stop - start, *opened, *values))
        return rows_table(out, out_arrow)

    state = _cut_state(packets, proto, width)
    cuts = packets.groupBy(*BLOCK).cogroup(state.groupBy(*BLOCK)).applyInArrow(cut, out_schema)
    return staged(cuts, "cuts", partition_by=["kind"])


OPEN = ["open_file", "open_block", "open_pos"]


def joined_parts(events: DataFrame) -> DataFrame:
    """Frames that crossed a block boundary: (frame id, raw bytes, total, bytes seen)."""
    parts = events.filter(F.col("kind").isin("open", "part"))
    return parts.groupBy(*FLOW, *OPEN).agg(
        F.min_by("file", F.struct("file", "block")).alias("file"),
        F.min_by("frame_no", F.struct("file", "block")).alias("frame_no"),
        F.min_by("ts_ns", F.struct("file", "block")).alias("ts_ns"),
        F.max("open_total").alias("open_total"),
        F.sum("n_bytes").alias("n_bytes"),
        F.expr(
            "aggregate(sort_array(collect_list(struct(file, block, raw))), "
            "cast('' as binary), (acc, p) -> concat(acc, p.raw))"
        ).alias("raw"),
    )


def whole_frames(events: DataFrame, proto) -> DataFrame:
    """The frames of ``cut_events``, those that crossed blocks put together and parsed."""
    columns = [*FLOW, "file", "frame_no", "ts_ns", *[f.name for f in proto.fields]]
    frames = events.filter(F.col("kind") == "frame")
    joined = joined_parts(events).filter(F.col("n_bytes") == F.col("open_total"))
    kept = [*FLOW, "file", "frame_no", "ts_ns"]
    parsed = T.StructType([joined.schema[n] for n in kept] + proto.fields)
    arrow = to_arrow_schema(parsed)

    def parse(batches):
        for batch in batches:
            values = [proto.parse(raw) for raw in batch.column("raw").to_pylist()]
            columns = [
                pa.array([v[i] for v in values], arrow.field(f.name).type)
                for i, f in enumerate(proto.fields)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in kept] + columns, schema=arrow
            )

    across = joined.select(*kept, "raw").mapInArrow(parse, parsed)
    return frames.select(*columns).unionByName(across)


def in_stream_order(packets: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Packets with overlaps merged by offset, renumbered by stream position."""
    merged = reassemble_by_offset(packets, block_bytes, keep=["ts_ns"])
    return merged.select(
        # Blocks of a stream hold one flow: offsets of different flows are unrelated.
        F.concat_ws(":", *FLOW).alias("file"),
        F.col("stream_offset").alias("capture_seq"),
        "ts_ns",
        *FLOW,
        F.pmod(F.col("stream_offset"), F.lit(MOD)).alias("tcp_seq"),
        "payload",
        F.octet_length("payload").alias("payload_len"),
    )


def _ordered(packets, policy, block_bytes):
    if policy == "offset_merge":
        return in_stream_order(packets, block_bytes)
    if policy != "strict":
        raise ValueError(f"unknown policy {policy!r}")
    return packets


def cut_step_frames(
    packets: DataFrame, policy: str = "strict", block_bytes: int = BLOCK_BYTES, width: int = WIDTH
) -> DataFrame:
    """STEP frames with their tags and payload.

    ``strict`` drops a segment that starts before the expected number and restarts at a gap;
    ``offset_merge`` orders by stream offset and trims overlaps first.
    """
    packets = _ordered(packets, policy, block_bytes)
    return whole_frames(cut_events(packets, StepFrames, block_bytes, width), StepFrames)


def cut_v1_frames(
    packets: DataFrame,
    want=None,
    policy: str = "strict",
    block_bytes: int = BLOCK_BYTES,
    width: int = WIDTH,
) -> DataFrame:
    """40-byte-header frames; ``want`` is one (type, subtype)."""
    packets = _ordered(packets, policy, block_bytes)
    frames = whole_frames(cut_events(packets, HeadedFrames, block_bytes, width), HeadedFrames)
    return only_channel(frames, *want) if want else frames


def only_channel(frames: DataFrame, type_: int, subtype: int) -> DataFrame:
    return frames.filter((F.col("type") == type_) & (F.col("subtype") == subtype))


def resync_report(events: DataFrame) -> DataFrame:
    """Lost bytes: skipped between frames (junk) or in a frame that never completed (residual)."""
    skipped = events.filter(F.col("kind").isin("junk", "residual")).select(
        *FLOW, "file", "frame_no", "kind", "n_bytes"
    )
    unfinished = (
        joined_parts(events)
        .filter(F.col("n_bytes") < F.col("open_total"))
        .select(*FLOW, "file", "frame_no", F.lit("residual").alias("kind"), "n_bytes")
    )
    return skipped.unionByName(unfinished)


def lost_bytes(resync: DataFrame) -> DataFrame:
    return resync.groupBy(*FLOW).agg(F.sum("n_bytes").alias("lost_bytes"))


def rejected_frames(frames: DataFrame) -> DataFrame:
    """STEP frames of which a number or the payload could not be taken."""
    return frames.filter(F.col("frame_reject").isNotNull())


def envelope_issues(frames: DataFrame) -> DataFrame:
    """Frames whose sender or target is not the expected one."""
    return frames.filter(
        (F.coalesce(F.col("sender"), F.lit("")) != "VDE")
        | (F.coalesce(F.col("target"), F.lit("")) != "VSS")
    )


def _inflate(body):
    if len(body) < 30 or not body.startswith(ZIP_HEADER):
        return body, False
    name, extra = struct.unpack_from("<HH", body, 26)
    start = 30 + name + extra
    if start >= len(body):
        return body, False
    try:
        return zlib.decompressobj(-zlib.MAX_WBITS).decompress(body[start:]), True
    except zlib.error:
        return body, False


@F.pandas_udf(schema("body binary, ok boolean"))
def _inflated(raw: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_inflate(bytes(b)) for b in raw], columns=["body", "ok"])


def inflate_body(frames: DataFrame) -> DataFrame:
    """Add ``body`` (inflated when compressed), ``zip_ok`` and ``bad_inflate``.

    Only compressed rows go through Python; filter to the wanted channel before this.
    """
    zipped = frames.filter(F.col("compressed") == 1).withColumn("_z", _inflated("raw_body"))
    plain = frames.filter(F.col("compressed") != 1)
    return (
        zipped.withColumn("body", F.col("_z.body"))
        .withColumn("zip_ok", F.col("_z.ok"))
        .withColumn("bad_inflate", ~F.col("_z.ok"))
        .drop("_z")
        .unionByName(
            plain.withColumn("body", F.col("raw_body"))
            .withColumn("zip_ok", F.lit(False))
            .withColumn("bad_inflate", F.lit(False))
        )
    )


def flag_mismatch(frames: DataFrame, flag="compressed", body="raw_body") -> DataFrame:
    """Frames whose compression flag disagrees with the start of their body."""
    zipped = F.substring(F.col(body), 1, 4) == F.lit(bytearray(ZIP_HEADER))
    return frames.filter(((F.col(flag) == 1) & ~zipped) | ((F.col(flag) == 0) & zipped))
