"""Packet headers.

Input: ``packets(file, capture_seq, ts_ns, frame)``, frame from the Ethernet header on. Header
offsets vary with VLAN tags and IP options, so a batch is parsed with gathers on its byte buffer.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.functions.predicates import ETH_IPV4, IP_TCP, IP_UDP
from quotemill.functions.stopbit import binary_array, binary_parts

VLAN_TAG = 0x8100

PACKET_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("capture_seq", T.LongType()),
        T.StructField("ts_ns", T.LongType()),
        T.StructField("frame", T.BinaryType()),
    ]
)

HEADER_FIELDS = [
    T.StructField("eth_type", T.IntegerType()),
    T.StructField("ip_proto", T.IntegerType()),
    T.StructField("src_ip", T.StringType()),
    T.StructField("sport", T.IntegerType()),
    T.StructField("dst_ip", T.StringType()),
    T.StructField("dport", T.IntegerType()),
    T.StructField("tcp_seq", T.LongType()),
    T.StructField("payload", T.BinaryType()),
    T.StructField("payload_len", T.IntegerType()),
]
FLOW = ["src_ip", "sport", "dst_ip", "dport"]


def _dotted(values, known):
    """IPv4 integers to text; distinct addresses are formatted once."""
    distinct, inverse = np.unique(values, return_inverse=True)
    text = pa.array([".".join(str((v >> s) & 255) for s in (24, 16, 8, 0)) for v in distinct.tolist()])
    return text.take(pa.array(inverse.reshape(-1), mask=~known))


def parse_frames(column, with_payload=True, payload_bytes=None):
    """Header columns of one Arrow column of captured frames; ``payload_bytes`` of each payload, if given."""
    data, off = binary_parts(column)
    start, end = off[:-1], off[1:]
    size = end - start
    data = np.append(data, np.zeros(1, np.uint8))
    top = len(data) - 1

    def u8(pos):
        return data[np.minimum(pos, top)].astype(np.int64)

    def u16(pos):
        return u8(pos) << 8 | u8(pos + 1)

    def u32(pos):
        return u16(pos) << 16 | u16(pos + 2)

    has_eth = size >= 14
    eth_type = np.where(has_eth, u16(start + 12), -1)
    body = start + 14
    while True:
        tagged = (eth_type == VLAN_TAG) & (end >= body + 4)
        if not tagged.any():
            break
        eth_type = np.where(tagged, u16(body + 2), eth_type)
        body = np.where(tagged, body + 4, body)

    v4 = (eth_type == ETH_IPV4) & (end >= body + 20)
    proto = np.where(v4, u8(body + 9), -1)
    ihl = (u8(body) & 15) * 4
    total = u16(body + 2)
    trans = body + ihl
    tcp = v4 & (proto == IP_TCP) & (end >= trans + 20)
    udp = v4 & (proto == IP_UDP) & (end >= trans + 8)
    ported = tcp | udp
    tcp_head = (u8(trans + 12) >> 4) * 4
    declared = np.where(tcp, total - ihl - tcp_head, u16(trans + 4) - 8)
    data_at = np.where(tcp, trans + tcp_head, trans + 8)
    # The IP length drops link padding; the captured length bounds what can be read.
    length = np.where(ported, np.clip(np.minimum(declared, end - data_at), 0, None), 0)

    taken = length if payload_bytes is None else np.minimum(length, payload_bytes)

    def ints(values, known, kind):
        return pa.array(values, kind, mask=~known)

    return [
        ints(eth_type.astype(np.int32), has_eth, pa.int32()),
        ints(proto.astype(np.int32), v4, pa.int32()),
        _dotted(np.where(v4, u32(body + 12), 0), v4),
        ints(u16(trans).astype(np.int32), ported, pa.int32()),
        _dotted(np.where(v4, u32(body + 16), 0), v4),
        ints(u16(trans + 2).astype(np.int32), ported, pa.int32()),
        ints(u32(trans + 4), tcp, pa.int64()),
        *(
            [binary_array(data, np.where(ported, data_at, 0), taken, known=ported)]
            if with_payload
            else []
        ),
        ints(length.astype(np.int32), ported, pa.int32()),
    ]


def parse_packets(packets: DataFrame, with_payload: bool = True, payload_bytes: int | None = None) -> DataFrame:
    """Replace ``frame`` by its header columns and payload; absent layers give nulls.

    Statistics need no payload, or its first bytes: column pruning cannot reach into Python, so say so here.
    ``payload_len`` is that of the whole payload.
    """
    kept = [f for f in packets.schema.fields if f.name != "frame"]
    names = [f.name for f in kept]
    added = [f for f in HEADER_FIELDS if with_payload or f.name != "payload"]
    out = names + [f.name for f in added]

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + parse_frames(batch.column("frame"), with_payload, payload_bytes),
                out,
            )

    return packets.mapInArrow(run, T.StructType(kept + added))


def tcp_with_payload(parsed: DataFrame) -> DataFrame:
    return parsed.filter(
        (F.col("eth_type") == ETH_IPV4)
        & (F.col("ip_proto") == IP_TCP)
        & F.col("tcp_seq").isNotNull()
        & (F.col("payload_len") > 0)
    )
