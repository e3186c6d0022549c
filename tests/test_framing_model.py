"""Block-wise framing against a plain sequential pass over each flow."""

import random
from functools import reduce

import numpy as np
import pytest

from quotemill.operators import framing, reassembly
from quotemill.operators.framing import HeadedFrames, StepFrames
from quotemill.plans.fixtures import step_message, v1_message

MOD = 1 << 32


def sequential(packets, proto):
    """Verdicts and frames of one flow, one packet after the other."""
    verdicts, frames, buf, expected = [], [], b"", None
    for seq, data in packets:
        if expected is None:
            verdict = "init"
        else:
            d = (seq - expected) % MOD
            verdict = "in_order" if d == 0 else "gap" if d < MOD // 2 else "retransmit"
        verdicts.append(verdict)
        if verdict == "retransmit":
            continue
        if verdict == "gap":
            buf = b""
        expected = (seq + len(data)) % MOD
        buf += data
        while True:
            at = buf.find(proto.magic)
            if at < 0:
                buf = buf[-(len(proto.magic) - 1) :]
                break
            buf = buf[at:]
            size = proto.header(buf, 0)
            if size is None or size > len(buf):
                break
            if size > 0:
                frames.append(buf[:size])
            buf = buf[abs(size) :]
    return verdicts, frames


def scan(rows, merge, advance, start, width):
    """States before each row, by a tree of groups of ``width``."""
    if len(rows) <= width:
        out = []
        for row in rows:
            out.append(start)
            start = advance(start, row)
        return out
    groups = [rows[i : i + width] for i in range(0, len(rows), width)]
    above = scan([reduce(merge, g) for g in groups], merge, advance, start, width)
    return [s for g, own in zip(groups, above) for s in scan(g, merge, advance, own, width)]


def blockwise(packets, proto, block_rows, width=1000):
    """The same through block summaries, the tree of their effects and per-block cuts."""
    blocks = [packets[i : i + block_rows] for i in range(0, len(packets), block_rows)]
    steps = []
    for rows in blocks:
        seq, sizes = [s for s, _ in rows], [len(d) for _, d in rows]
        steps.append(reassembly.expected_steps(np.array(seq), np.array(sizes)))
    advance = lambda e, s: reassembly.apply_steps(e, *s)
    expected = scan(steps, reassembly.merge_steps, advance, None, width)
    pieces, verdicts = [], []
    for b, rows in enumerate(blocks):
        seq, sizes = [s for s, _ in rows], [len(d) for _, d in rows]
        places = [b * block_rows + i for i in range(len(rows))]
        pieces.append(
            framing.Pieces(places, [0] * len(rows), seq, sizes, [d for _, d in rows], expected[b])
        )
        verdicts += reassembly.replay(seq, sizes, expected[b])[0]
    summary = [f.name for f in framing.SUMMARY.fields]
    summaries = [
        dict(zip(summary, framing._summarise(p, proto))) | {"file": "f", "block": i}
        for i, p in enumerate(pieces)
    ]
    turned = lambda a, b: framing._merge_heads(b, a)
    ahead = scan(summaries[::-1], turned, framing._seen_by_previous, b"", width)[::-1]
    summaries = [s | {"ahead": a} for s, a in zip(summaries, ahead)]
    summaries = [s | {"steps": framing._as_steps(framing._effect(s, proto))} for s in summaries]
    states = scan(summaries, framing._merge_effects, framing._advance, (0, None), width)
    names = [f.name for f in framing.CARRY.fields]
    frames, parts, lost = [], {}, 0
    for i, (p, row, (skip, opened)) in enumerate(zip(pieces, summaries, states)):
        carry = dict(zip(names, framing._state_of(row | {"skip": skip, "opened": opened}, proto)))
        for kind, piece, start, stop, total in framing._cut(p, carry, proto):
            data = p.bytes[piece][start:stop]
            order = p.place(piece, start)[0]
            if kind == "frame":
                frames.append((order, data))
            elif kind == "open":
                parts[(i, start)] = [order, total, data]
            elif kind == "part":
                parts[(carry["open_block"], carry["open_pos"])][2] += data
            else:
                lost += stop - start
    frames += [(o, d) for o, total, d in parts.values() if len(d) == total]
    return verdicts, [d for _, d in sorted(frames)], lost


def stream(rng, proto):
    """Frames, junk, broken headers and magics inside payloads."""
    out = []
    for i in range(rng.randint(1, 12)):
        kind = rng.random()
        body = rng.randbytes(rng.choice([0, 3, 20, 90]))
        if kind < 0.2:
            body += proto.magic + rng.choice([b"9=7\x01", b"9=x\x01", b"", b"9=99999999999\x01"])
        if kind < 0.75:
            if proto is StepFrames:
                out.append(step_message(9, 5803, i, "20260114-09:30:00", body))
            else:
                out.append(v1_message(9, 5803, i, body, rng.random() < 0.3))
        elif kind < 0.85:
            out.append(rng.randbytes(rng.randint(1, 30)))
        elif kind < 0.95:
            out.append(proto.magic + rng.choice([b"9=", b"9=12", b"9=1a\x01", b"8=", b"\0\0\0\5" + bytes(32)]))
        else:
            out.append(proto.magic[: rng.randint(1, len(proto.magic) - 1)])
    return b"".join(out)


def capture(rng, proto):
    """Segments with repeats, partial overlaps, gaps and reordering, near the 2^32 wrap."""
    data, base = stream(rng, proto), rng.choice([7, MOD - 150])
    packets, at = [], 0
    while at < len(data):
        n = rng.choice([1, 2, 5, 13, 40, 64, 200])
        packets.append(((base + at) % MOD, data[at : at + n]))
        fault = rng.random()
        if fault < 0.06:
            packets.append(packets[-1])
        elif fault < 0.10 and at > 10:
            back = rng.randint(1, 10)
            packets.append(((base + at - back) % MOD, data[at - back : at + 2 * n]))
        elif fault < 0.14:
            at += rng.randint(1, 50)
        at += n
    if rng.random() < 0.2 and len(packets) > 3:
        i = rng.randrange(len(packets) - 1)
        packets[i], packets[i + 1] = packets[i + 1], packets[i]
    return [p for p in packets if p[1]]


@pytest.mark.parametrize("proto", [StepFrames, HeadedFrames])
def test_blocks_equal_sequential_pass(proto):
    rng = random.Random(5)
    whole = 0
    for _ in range(400):
        packets = capture(rng, proto)
        if not packets:
            continue
        want_verdicts, want = sequential(packets, proto)
        for rows, width in ((1, 1000), (1, 2), (1, 3), (2, 2), (2, 5), (3, 1000), (7, 2), (1000, 2)):
            verdicts, frames, _ = blockwise(packets, proto, rows, width)
            assert verdicts == want_verdicts
            assert frames == want, (rows, width, packets)
        whole += len(want)
    assert whole > 300


def test_every_accepted_byte_is_a_frame_or_reported():
    rng = random.Random(9)
    for _ in range(300):
        packets = capture(rng, StepFrames)
        if not packets:
            continue
        verdicts, frames, lost = blockwise(packets, StepFrames, 3)
        accepted = sum(len(d) for (_, d), v in zip(packets, verdicts) if v != "retransmit")
        open_bytes = accepted - lost - sum(map(len, frames))
        assert open_bytes >= 0


def test_large_frame_is_not_lost():
    body = bytes(3 << 20)
    data = step_message(9, 5803, 1, "20260114-09:30:00", body)
    packets = [(i, data[i : i + 60000]) for i in range(0, len(data), 60000)]
    _, frames, _ = blockwise(packets, StepFrames, 4)
    assert frames == [data]
    named = dict(zip([f.name for f in StepFrames.fields], StepFrames.parse(data)))
    assert named["payload"] == body and named["frame_reject"] is None


def test_effects_compose_over_more_than_32_bits():
    """Three hundred blocks of 60 MB: 18 GB of numbers, which wrap four times, with repeats and gaps."""
    rng = random.Random(21)
    at, steps = MOD - 5, []
    for _ in range(300):
        seq, sizes = [], []
        for _ in range(4):
            n = rng.choice([15_000_000, 14_000_000])
            back = rng.choice([0, 0, 0, 7, -9])
            seq.append((at - back) % MOD)
            sizes.append(n)
            at += n
        steps.append(reassembly.expected_steps(np.array(seq), np.array(sizes)))
    advance = lambda e, s: reassembly.apply_steps(e, *s)
    for start in (None, MOD - 5, MOD - 40_000_000, 7_000_000_000 % MOD, 1_000_000):
        want = scan(steps, None, advance, start, 1000)
        for width in (2, 3, 17):
            assert scan(steps, reassembly.merge_steps, advance, start, width) == want
