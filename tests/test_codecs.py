"""Vectorised codecs against one-record-at-a-time readings of the same bytes."""

import random

import pytest
import struct

import numpy as np
import pyarrow as pa

from quotemill.functions.stopbit import Tokens
from quotemill.operators import packets, records, snapshots, ticks
from quotemill.plans import fixtures


class Reader:
    """A byte cursor; raises IndexError at the end of the payload."""

    def __init__(self, data):
        self.data, self.pos = data, 0

    def token(self):
        end = self.pos
        while not self.data[end] & 0x80:
            end += 1
        raw, self.pos = self.data[self.pos : end + 1], end + 1
        return raw

    def number(self):
        value = 0
        for b in self.token():
            value = value << 7 | b & 0x7F
        if value >= 1 << 63:
            raise OverflowError
        return value

    def text(self):
        return "".join(chr(b & 0x7F) for b in self.token())

    def nullable(self, kept):
        """(value, dictionary) of a present nullable copy field."""
        wire = self.number()
        return (0, kept) if wire == 0 else (wire - 1, wire - 1)


def plain_ticks(data):
    """[(record, reason)] of one payload."""
    r, out = Reader(data), []
    kept = {"template_id": 0, "biz_index": 0, "channel": 0, "tick_time": 0}
    texts = {"security_id": "", "action": "", "bs_flag": ""}
    while r.pos < len(data):
        try:
            pmap = r.number()
            rec = {}
            for name, bit in ticks.BIT.items():
                present = pmap >> bit & 1
                if name in texts:
                    if present:
                        texts[name] = r.text()
                    rec[name] = texts[name]
                elif name == "tick_time":
                    rec[name] = kept[name]
                    if present:
                        rec[name], kept[name] = r.nullable(kept[name])
                elif name == "biz_index":
                    kept[name] = r.number() if present else kept[name] + 1
                    rec[name] = kept[name]
                elif name in kept:
                    if present:
                        kept[name] = r.number()
                    rec[name] = kept[name]
                else:
                    rec[name] = max(r.number() - 1, 0) if present else 0
        except (IndexError, OverflowError):
            out.append((None, "cut"))
            break
        rec["money_e5"] = rec["money"] * (1 if rec["action"] == "T" else 100)
        bad = (
            rec["template_id"] != 5803
            or len(rec["security_id"]) != 6
            or len(rec["action"]) != 1
            or (rec["action"] != "S" and rec["bs_flag"] not in ("B", "S", "N"))
            or (rec["action"] == "T" and rec["price_e3"] * rec["qty_e3"] != rec["money_e5"] * 10)
        )
        out.append((rec, "bad" if bad else None))
        if bad:
            break
    return out


def damaged(rng, payload):
    data = bytearray(payload)
    for _ in range(rng.choice([0, 0, 1, 2])):
        if data:
            data[rng.randrange(len(data))] ^= 1 << rng.randrange(8)
    if rng.random() < 0.3:
        del data[rng.randrange(len(data) + 1) :]
    return bytes(data)


def random_ticks(rng, n):
    action = [rng.choice("ADTCS") for _ in range(n)]
    price = np.array([rng.choice([0, 1, 13520, 99999999]) for _ in range(n)])
    qty = np.array([rng.choice([0, 1000, 100000]) for _ in range(n)])
    trade = np.array([a == "T" for a in action])
    cols = {
        "biz_index": np.arange(n) + rng.choice([0, 5, 1 << 40]),
        "channel": np.full(n, rng.choice([1, 2000])),
        "security_id": [rng.choice(["600884", "601106", "688122"]) for _ in range(n)],
        "tick_time": np.array([rng.choice([0, 9350630, 9350630, 9350631]) for _ in range(n)]),
        "action": action,
        "buy_order_no": np.array([rng.choice([0, 6829536]) for _ in range(n)]),
        "sell_order_no": np.array([rng.choice([0, 6770698]) for _ in range(n)]),
        "price_e3": price,
        "qty_e3": qty,
        "money_e5": np.where(trade, price * qty // 10, 0),
        "bs_flag": ["SUSP" if a == "S" else rng.choice("BSN") for a in action],
    }
    uneven = trade & (price * qty % 10 != 0)
    cols["qty_e3"] = np.where(uneven, 0, qty)
    cols["money_e5"] = np.where(uneven, 0, cols["money_e5"])
    return cols


def test_tick_vectors():
    trade = bytes.fromhex("4bfc2dab3630303838b4d403206be1031d208b0069d1060da100403b7a81c2")
    _, cols = ticks.decode_payloads(pa.array([trade], pa.binary()))
    got = dict(zip(ticks.TICK_COLUMNS, (c[0].as_py() for c in cols)))
    assert got["security_id"] == "600884" and got["action"] == "T" and got["bs_flag"] == "B"
    assert (got["buy_order_no"], got["sell_order_no"]) == (6829536, 6770698)
    assert (got["price_e3"], got["qty_e3"], got["money_e5"]) == (13520, 100000, 135200000)
    assert got["reject_reason"] is None
    tok = Tokens(pa.array([bytes.fromhex("026e1eca31bb004311e181d3")], pa.binary()))
    assert (tok.value[:3] - 1).tolist() == [6000457, 6330, 1100000]
    phases = pa.array([bytes.fromhex(h) for h in ("535553d0", "4f43414ccc", "53544152d4")], pa.binary())
    tok = Tokens(phases)
    assert tok.text(np.arange(3), np.ones(3, bool)).to_pylist() == ["SUSP", "OCALL", "START"]


def test_ticks_match_plain_reading():
    rng = random.Random(1)
    payloads = []
    for _ in range(1500):
        n = rng.randint(1, 6)
        new = np.zeros(n, bool)
        new[0] = True
        payloads.append(damaged(rng, b"".join(fixtures.tick_records(random_ticks(rng, n), new))))
    rows, cols = ticks.decode_payloads(pa.array(payloads, pa.binary()))
    table = list(zip(rows.tolist(), *[c.to_pylist() for c in cols]))
    by_row = {}
    for row in table:
        by_row.setdefault(row[0], []).append(dict(zip(ticks.TICK_COLUMNS, row[1:])))
    rejects = 0
    for i, payload in enumerate(payloads):
        want, got = plain_ticks(payload), by_row.get(i, [])
        assert len(want) == len(got), payload.hex()
        for (rec, reason), g in zip(want, got):
            assert (reason is None) == (g["reject_reason"] is None), (payload.hex(), g)
            rejects += reason is not None
            if reason is None:
                for name in ticks.TICK_COLUMNS:
                    if name in rec and name not in ("channel", "tick_time"):
                        assert g[name] == rec[name], (name, payload.hex())
                assert g["channel"] == rec["channel"] & 0xFFFFFFFF
                assert g["tick_time"] == rec["tick_time"] & 0xFFFFFFFF
    assert 200 < rejects < 1200


def test_wide_numbers_are_flagged():
    record = bytes.fromhex("4bfc2dab3630303838b4d4") + b"\x01" * 9 + b"\x81" + bytes.fromhex("031d208b0069d1060da100403b7a81c2")
    _, cols = ticks.decode_payloads(pa.array([record], pa.binary()))
    assert cols[-1].to_pylist() == ["overflow"]
    padded = bytes.fromhex("4bfc2dab3630303838b4d4") + b"\x00" * 9 + bytes.fromhex("03206be1031d208b0069d1060da100403b7a81c2")
    _, cols = ticks.decode_payloads(pa.array([padded], pa.binary()))
    assert cols[-1].to_pylist() == [None]


def plain_snapshots(data):
    r, out = Reader(data), []
    kept = dict.fromkeys([*snapshots.COPIED, *snapshots.NULLABLE], 0)
    texts = dict.fromkeys(snapshots.COPIED_TEXT, "")

    def levels():
        n = max(r.number() - 1, 0)
        if n > len(data):
            raise ValueError
        found, have = [], dict.fromkeys(snapshots.LEVEL_BITS, 0)
        for _ in range(n):
            pmap = r.number()
            if pmap & snapshots.LEVEL_OPERATOR:
                raise ValueError
            level = {}
            for name, bit in snapshots.LEVEL_BITS.items():
                level[name] = have[name]
                if pmap >> bit & 1:
                    level[name], have[name] = r.nullable(have[name])
            count = max(r.number() - 1, 0)
            if count > len(data):
                raise ValueError
            level["orders"], last = [], 0
            for _ in range(count):
                pmap = r.number()
                if pmap & snapshots.ORDER_OPERATORS:
                    raise ValueError
                qty = last
                if pmap & snapshots.ORDER_QTY:
                    qty, last = r.nullable(last)
                level["orders"].append(qty)
            found.append(level)
        return found

    while r.pos < len(data):
        rec = {}
        try:
            pmap = r.number()
            fields = sorted(
                {**snapshots.COPIED, **snapshots.NULLABLE, **snapshots.COPIED_TEXT}.items(),
                key=lambda kv: -kv[1],
            )
            for name, bit in fields:
                if bit == 45:
                    rec["security_id"], rec["image_status"] = r.text(), r.number()
                present = pmap >> bit & 1
                if name in texts:
                    if present:
                        texts[name] = r.text()
                    rec[name] = texts[name]
                elif name in snapshots.COPIED:
                    if present:
                        kept[name] = r.number()
                    rec[name] = kept[name]
                    if name == "template_id" and rec[name] != 3202:
                        raise ValueError
                else:
                    rec[name] = kept[name]
                    if present:
                        rec[name], kept[name] = r.nullable(kept[name])
            rec["bid_levels"], rec["offer_levels"] = levels(), levels()
        except (IndexError, ValueError, OverflowError):
            out.append(None)
            break
        out.append(rec)
    return out


def random_book(rng):
    return [
        {
            "price": rng.choice([0, 100, 100, 123456]),
            "qty": rng.choice([0, 500, 700]),
            "num_orders": rng.randint(0, 3),
            "orders": [rng.choice([0, 100, 100, 300]) for _ in range(rng.randint(0, 4))],
        }
        for _ in range(rng.randint(0, 11))
    ]


def test_snapshots_match_plain_reading():
    rng = random.Random(2)
    rows = []
    for _ in range(900):
        row = {"security_id": rng.choice(["600330", "601106"]), "image_status": rng.randint(0, 2)}
        row |= {n: rng.choice([0, 1, 95350]) for n in ("tick_time", "data_status")}
        row |= {n: rng.choice(["", "T", "START"]) or "C" for n in snapshots.COPIED_TEXT}
        row |= {n: rng.choice([0, 0, 7, 1 << 40]) for n in snapshots.NULLABLE}
        row |= {"bid_levels": random_book(rng), "offer_levels": random_book(rng)}
        rows.append(row)
    level = pa.struct([("price", pa.int64()), ("qty", pa.int64()), ("num_orders", pa.int64()), ("orders", pa.list_(pa.int64()))])
    arrays = {k: [r[k] for r in rows] for k in rows[0]}
    batch = pa.RecordBatch.from_pydict(
        {
            k: pa.array(v, pa.list_(level)) if k.endswith("levels") else pa.array(v)
            for k, v in arrays.items()
        }
    )
    clean = fixtures.snapshot_payloads(batch, records_per_frame=3)
    payloads = [damaged(rng, p) if i % 3 else p for i, p in enumerate(clean)]
    got_rows, cols = snapshots.decode_payloads(pa.array(payloads, pa.binary()))
    by_row = {}
    for row in zip(got_rows.tolist(), *[c.to_pylist() for c in cols]):
        by_row.setdefault(row[0], []).append(dict(zip(snapshots.SNAPSHOT_COLUMNS, row[1:])))
    flat = [g for i in range(0, len(payloads), 3) for g in by_row[i]]
    source = [rows[i * 3 + j] for i in range(0, len(payloads), 3) for j in range(3)]
    for want, g in zip(source, flat, strict=True):
        assert {k: g[k] for k in want} == want
    rejects = 0
    for i, payload in enumerate(payloads):
        want, got = plain_snapshots(payload), by_row.get(i, [])
        assert len(want) == len(got), (i, payload.hex())
        for w, g in zip(want, got):
            assert (w is None) == (g["reject_reason"] is not None), (payload.hex(), g)
            rejects += w is None
            if w:
                assert all(g[k] == v for k, v in w.items() if k != "template_id"), payload.hex()
    assert rejects > 20


def test_snapshot_head_vector():
    head = bytes.fromhex("6f7f6c000f7fc0" + "1982" + "0809e2" + "3630303333b0" + "81")
    tok = Tokens(pa.array([head], pa.binary()))
    assert tok.value[1] == 3202 and tok.value[2] == 132322
    assert tok.text(np.array([3]), np.ones(1, bool)).to_pylist() == ["600330"]


def chosen_frame(rng):
    """A frame built from chosen values, cut somewhere, with the columns these values must give."""
    tags, kind = rng.randint(0, 3), rng.choice(["tcp", "tcp", "udp", "icmp", "arp", "short"])
    body, trailer = rng.randbytes(rng.choice([0, 1, 7, 60])), rng.randbytes(rng.choice([0, 0, 6]))
    addresses = [rng.randbytes(4), rng.randbytes(4)]
    ports = [rng.randrange(1 << 16), rng.randrange(1 << 16)]
    link = rng.randbytes(12) + b"".join(b"\x81\x00" + rng.randbytes(2) for _ in range(tags))
    if kind == "arp":
        return link + b"\x08\x06" + body, {"eth_type": 0x0806}
    if kind == "short":  # ends inside the link header: after a tag there is only the tag's own type
        cut = rng.randrange(14 + 4 * tags)
        return (link + b"\x08\x00")[:cut], {} if cut < 14 else {"eth_type": 0x8100}
    want = {"eth_type": 0x0800, "ip_proto": {"tcp": 6, "udp": 17, "icmp": 1}[kind]}
    want |= dict(zip(("src_ip", "dst_ip"), (".".join(str(b) for b in a) for a in addresses)))
    seq, options = rng.randrange(1 << 32), rng.randbytes(4 * rng.randint(0, 10))
    transport = {
        "tcp": struct.pack(">HHIIBBHHH", *ports, seq, 0, (5 + len(options) // 4) << 4, 16, 0, 0, 0) + options,
        "udp": struct.pack(">HHHH", *ports, 8 + len(body), 0),
        "icmp": b"",
    }[kind]
    extra = rng.randbytes(4 * rng.randint(0, 10))
    size = 20 + len(extra) + len(transport) + len(body)
    network = struct.pack(">BBHIBBH", 0x45 + len(extra) // 4, 0, size, 0, 64, want["ip_proto"], 0) + b"".join(addresses)
    whole = link + b"\x08\x00" + network + extra + transport + body + trailer
    start = len(link) + 2 + len(network) + len(extra)
    cut = rng.choice([len(whole), len(whole), len(link) + 2 + rng.randrange(20), start + rng.randrange(len(transport) + len(body) + 1)])
    if cut < len(link) + 2 + 20:
        return whole[:cut], {"eth_type": 0x0800}
    if kind != "icmp" and cut >= start + {"tcp": 20, "udp": 8}[kind]:
        payload = whole[start + len(transport) : cut][: len(body)]
        want |= dict(zip(("sport", "dport"), ports)) | {"payload": payload, "payload_len": len(payload)}
        if kind == "tcp":
            want["tcp_seq"] = seq
    return whole[:cut], want


def test_packet_headers_are_the_chosen_values():
    rng = random.Random(3)
    frames, want = zip(*[chosen_frame(rng) for _ in range(4000)])
    names = [f.name for f in packets.HEADER_FIELDS]
    columns = [c.to_pylist() for c in packets.parse_frames(pa.array(frames, pa.binary()))]
    for frame, expected, values in zip(frames, want, zip(*columns), strict=True):
        assert {k: v for k, v in zip(names, values) if v is not None} == expected, frame.hex()


@pytest.mark.parametrize(
    ("hex_frame", "want"),
    [
        ("ff" * 13, {}),
        ("ff" * 12 + "86dd" + "60" * 40, {"eth_type": 0x86DD}),
        ("ff" * 12 + "81000001" + "81000002" + "0806" + "00" * 28, {"eth_type": 0x0806}),
        # a UDP length of 3, shorter than its own header: no payload
        ("ff" * 12 + "0800" + "4500001f0000000040110000" + "0a000001" + "0a000002" + "0001000200030000" + "616263",
         {"eth_type": 0x0800, "ip_proto": 17, "src_ip": "10.0.0.1", "dst_ip": "10.0.0.2", "sport": 1, "dport": 2, "payload": b"", "payload_len": 0}),
        # padding behind a TCP packet without payload
        ("ff" * 12 + "0800" + "450000280000000040060000" + "0a000001" + "0a000002" + "23a9c3510000000700000000" + "5010" + "000000000000" + "000000000000",
         {"eth_type": 0x0800, "ip_proto": 6, "src_ip": "10.0.0.1", "dst_ip": "10.0.0.2", "sport": 9129, "dport": 50001, "tcp_seq": 7, "payload": b"", "payload_len": 0}),
    ],
)
def test_packet_headers_by_hand(hex_frame, want):
    columns = packets.parse_frames(pa.array([bytes.fromhex(hex_frame)], pa.binary()))
    got = {f.name: c.to_pylist()[0] for f, c in zip(packets.HEADER_FIELDS, columns, strict=True)}
    assert {k: v for k, v in got.items() if v is not None} == want


def split(payloads, tid=b"\x2d\xab", min_gap=4):
    """Per payload: [(number, start, template place, end)] as offsets into it."""
    _, off, row, number, start, at, end = records.find_records(pa.array(payloads, pa.binary()), tid, min_gap)
    out = [[] for _ in payloads]
    for r, n, s, t, e in zip(row.tolist(), number.tolist(), start.tolist(), at.tolist(), end.tolist()):
        base = int(off[r])
        out[r].append((n, s - base, t - base, e - base))
    return out


def test_template_split_finds_encoded_records():
    """Records are made with known boundaries: a presence map ending in a stop byte, the template word, a body."""
    rng = random.Random(4)
    payloads, want = [], []
    for _ in range(400):
        data, records_here = b"", []
        for n in range(rng.randint(1, 6)):
            head = bytes(rng.randrange(1, 0x2D) for _ in range(rng.randint(0, 3))) + bytes([0x80 | rng.randrange(0x20)])
            body = bytes(0x80 | rng.randrange(0x20) if rng.random() < 0.4 else rng.randrange(0x2D) for _ in range(rng.randint(4, 30)))
            body += bytes([0x80 | rng.randrange(0x20)])
            begin = len(data)
            data += head + b"\x2d\xab" + body
            records_here.append((n, begin, begin + len(head)))
        ends = [r[1] for r in records_here[1:]] + [len(data)]
        payloads.append(data)
        want.append([(*r, e) for r, e in zip(records_here, ends)])
    assert split(payloads) == want


@pytest.mark.parametrize(
    ("data", "want"),
    [
        ("", []),
        ("2dab", []),  # no presence map before the template
        ("052dab81", []),  # the byte before has no stop bit
        ("812dab", [(0, 0, 1, 3)]),
        ("05812dab8181", [(0, 0, 2, 6)]),
        ("812dab812dab", [(0, 0, 1, 6)]),  # too close to the record before
        ("812dab0505050581812dab81", [(0, 0, 1, 8), (1, 8, 9, 12)]),
    ],
)
def test_template_split_by_hand(data, want):
    assert split([bytes.fromhex(data)]) == [want]
