"""The batch pipeline from landed capture to tick and snapshot tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.functions.fields import packet_time
from quotemill.functions.predicates import ETH_IPV4, filter_ports, has_prefix, protocol_class
from quotemill.operators.framing import cut_step_frames
from quotemill.operators.packets import parse_packets, tcp_with_payload
from quotemill.operators.reassembly import BLOCK_BYTES
from quotemill.operators import traffic
from quotemill.operators.routing import first_arrival, number_frames, route
from quotemill.operators.scan import block_of
from quotemill.operators.snapshots import decode_snapshots, valid_snapshots
from quotemill.operators.ticks import decode_ticks, valid_ticks
from quotemill.session import configure, staged
from quotemill.sources.pcap import PcapSource
from quotemill.sources.segments import SegmentSource, header_options

ARRIVAL = ["ts_ns", "file", "frame_no", "rec_idx"]


def tcp_table(packets: DataFrame, port: int = 0) -> DataFrame:
    """TCP payload of a port as a written table: the framing step reads it more than once."""
    return staged(tcp_with_payload(filter_ports(parse_packets(packets), port)), "packets")


def tcp_source(spark: SparkSession, kind: str, path: str, ports, **options) -> DataFrame:
    """TCP payload of a ``capseg`` or ``pcap`` source, with ports and header filters checked in the reader.

    One plan per source, see ``sources.headers``.
    """
    configure(spark)  # pushing must be allowed
    spark.dataSource.register({"capseg": SegmentSource, "pcap": PcapSource}[kind])
    reader = spark.read.format(kind).option("path", path).options(**options)
    return tcp_with_payload(reader.options(**header_options(True, ports)).option("push", "true").load())


def landed_tcp(spark: SparkSession, folder: str, prefix: str, ports=()) -> DataFrame:
    """TCP payload of some ports of landed segments as a written table."""
    return staged(tcp_source(spark, "capseg", folder, ports, prefix=prefix), "packets")


def routed_frames(
    tcp: DataFrame, rules, policy: str = "strict", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Frames with a rule, chosen before any decoding. Empty payloads decode to no rows.

    Frames whose header could not be read are listed by ``framing.rejected_frames``.
    """
    return route(cut_step_frames(tcp, policy, block_bytes).drop("frame_reject"), rules)


def numbered_frames(routed: DataFrame) -> DataFrame:
    """Add ``frame_idx``, the number of a routed frame in capture order.

    The order is that of the first bytes; where flows interleave, a frame that completes later may
    have the smaller number.
    """
    # frame_no is the packet's byte position times 2^16, plus the offset in its payload.
    block = block_of(F.col("frame_no"), BLOCK_BYTES << 16)
    return number_frames(
        routed.withColumn("_block", block), block=["file", "_block"], order=["file", "frame_no"]
    ).drop("_block")


def _deduped(rows: DataFrame, keys) -> DataFrame:
    kept = rows.filter("dedup")
    return first_arrival(kept, keys, ARRIVAL).unionByName(rows.filter("not dedup"))


def ticks_of(routed: DataFrame, all_dedup: bool = True) -> DataFrame:
    """Valid ticks of routed frames, first arrival per (channel, biz_index) where asked for."""
    wanted = (F.col("category_id") == 9) & (F.col("msg_type") == 5803)
    ticks = valid_ticks(decode_ticks(routed.filter(wanted)))
    keys = ["channel", "biz_index"]
    return first_arrival(ticks, keys, ARRIVAL) if all_dedup else _deduped(ticks, keys)


def snapshots_of(routed: DataFrame, all_dedup: bool = True) -> DataFrame:
    """Valid snapshots of routed frames, first arrival per (security_id, tick_time)."""
    wanted = (F.col("category_id") == 6) & (F.col("msg_type") == 3202)
    found = valid_snapshots(decode_snapshots(routed.filter(wanted)))
    keys = ["security_id", "tick_time"]
    return first_arrival(found, keys, ARRIVAL) if all_dedup else _deduped(found, keys)


def decode_segments(
    spark: SparkSession,
    folder: str,
    prefix: str,
    rules,
    port: int = 0,
    block_bytes: int = BLOCK_BYTES,
    numbered: bool = False,
) -> dict[str, DataFrame]:
    """{"ticks": ..., "snapshots": ...} for the rules that have a decoder.

    ``numbered`` adds the export column ``frame_idx`` at the price of one more shuffle of frames.
    """
    tcp = landed_tcp(spark, folder, prefix, port)
    routed = routed_frames(tcp, rules, block_bytes=block_bytes)
    # One folder per output: each decoder then reads only its own frames.
    routed = staged(routed, "frames", partition_by=["output"])
    if numbered:
        routed = numbered_frames(routed)
    by_type = {(9, 5803): ("ticks", ticks_of), (6, 3202): ("snapshots", snapshots_of)}
    out = {}
    for rule in rules:
        name, job = by_type.get((rule["category_id"], rule["msg_type"]), (None, None))
        if name and name not in out:
            out[name] = job(routed, rule.get("dedup", True))
    return out


MAGIC = b"\x00\x04\xc4\x53"


def traffic_tables(packets: DataFrame, ports=(), tz: str = "UTC") -> dict[str, DataFrame]:
    """The capture's statistics tables, all from one parsed and written header table."""
    headers = parse_packets(packets, payload_bytes=len(MAGIC)).withColumns(
        {
            "proto": protocol_class(F.col("eth_type"), F.col("ip_proto")),
            "magic": has_prefix(F.col("payload"), MAGIC),
            "ts": packet_time(F.col("ts_ns")),
            "n": F.coalesce("payload_len", F.lit(0)),
        }
    )
    headers = staged(headers.drop("payload"), "headers")
    matched = headers.filter(F.col("eth_type") == ETH_IPV4)
    if ports:
        matched = filter_ports(matched, ports)
    ends = traffic.endpoint_counts(matched)
    return {
        "src_ip_port": ends.filter("side = 'src'").drop("side"),
        "dst_ip_port": ends.filter("side = 'dst'").drop("side"),
        "proto_all": traffic.count_by(headers, ["proto"]),
        "proto_matched": traffic.count_by(matched, ["proto"]),
        "per_minute": traffic.per_minute(matched, "ts", "n", tz),
        "magic": matched.agg(
            F.count_if("magic").alias("hits"), F.count_if(~F.col("magic")).alias("misses")
        ),
    }
