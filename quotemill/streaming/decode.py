"""Streaming capture decode.

State per flow: the expected sequence number and one partial frame (at most 16 MB). A task holds what a
flow has in one micro-batch, and the source bounds a micro-batch by bytes, so a backlog of any length
needs no more memory than that. It is read in order and as fast as single flows allow; the batch job
splits flows.
"""

from bisect import bisect_right
from threading import Timer

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from quotemill.functions.predicates import filter_ports
from quotemill.operators.framing import StepFrames, _magics, _walk
from quotemill.operators.packets import FLOW, parse_packets, tcp_with_payload
from quotemill.operators.reassembly import GAP, INIT, RETRANSMIT, replay
from quotemill.operators.routing import route
from quotemill.operators.snapshots import decode_snapshots
from quotemill.operators.ticks import decode_ticks
from quotemill.schemas import schema
from quotemill.sources.segments import MICRO_BATCH_BYTES, stream_segments

STATE = schema("expected_seq long, partial binary, partial_no long")
EVENT = schema("kind string, frame_no long, ts_ns long, n_bytes long").fields


def _frames(buf, proto):
    """([(start, total)], position to keep from) of one stream piece."""
    starts, nexts, whole, tail = _magics(buf, proto)
    met, end = _walk(0, starts, nexts)
    frames = [(starts[i], nexts[i] - starts[i]) for i in met if whole[i]]
    if frames and sum(frames[-1]) > len(buf):
        keep = frames.pop()[0]
    else:
        keep = max(end, tail)
    return frames, min(keep, len(buf))


def reassemble_stream(packets: DataFrame, proto=StepFrames) -> DataFrame:
    """Frames of a packet stream, with one row per dropped segment, gap and run of lost bytes.

    A segment older than expected is dropped; one ahead resets the flow. ``kind`` is frame,
    retransmit, gap or junk.
    """
    flow_fields = [packets.schema[n] for n in FLOW]
    out = T.StructType(flow_fields + EVENT + proto.fields)
    names = [f.name for f in out.fields]
    empty = [None] * len(proto.fields)

    def update(key, chunks, state):
        expected, partial, partial_no = state.get if state.exists else (None, b"", 0)
        rows = pd.concat(list(chunks)).sort_values(["file", "capture_seq"])
        seqs, sizes = rows["tcp_seq"].tolist(), rows["payload_len"].tolist()
        verdicts, _ = replay(seqs, sizes, expected)
        events, last_ts = [], 0
        pieces = [([bytes(partial or b"")], [(0, partial_no, 0)])]
        used = len(partial or b"")
        for verdict, at, ts_ns, seq, size, payload in zip(
            verdicts, rows["capture_seq"].tolist(), rows["ts_ns"].tolist(), seqs, sizes, rows["payload"]
        ):
            number = at * 65536
            if verdict in (RETRANSMIT, GAP):
                events.append([verdict, number, ts_ns, size, *empty])
            if verdict == RETRANSMIT:
                continue
            if verdict in (INIT, GAP):
                pieces.append(([], []))
                used = 0
            data, origin = pieces[-1]
            origin.append((used, number, ts_ns))
            data.append(bytes(payload))
            used += size
            expected = (seq + size) % (1 << 32)
        rest, rest_no = b"", 0
        for i, (data, origin) in enumerate(pieces):
            buf = b"".join(data)
            frames, keep = _frames(buf, proto)
            offsets = [o[0] for o in origin]

            def place(pos):
                base, number, ts_ns = origin[bisect_right(offsets, pos) - 1]
                return number + pos - base, ts_ns

            covered = 0
            for start, total in frames:
                if start > covered:
                    events.append(["junk", *place(covered), start - covered, *empty])
                events.append(["frame", *place(start), total, *proto.parse(buf[start : start + total])])
                covered = start + total
            if i == len(pieces) - 1:
                if keep > covered:
                    events.append(["junk", *place(covered), keep - covered, *empty])
                rest = buf[keep:]
                rest_no = place(keep)[0] if rest else 0
            elif len(buf) > covered:
                events.append(["junk", *place(covered), len(buf) - covered, *empty])
        state.update((expected, rest, rest_no))
        yield pd.DataFrame([[*key, *e] for e in events], columns=names)

    return (
        packets.select("file", "capture_seq", "ts_ns", *FLOW, "tcp_seq", "payload", "payload_len")
        .groupBy(*FLOW)
        .applyInPandasWithState(update, out, STATE, "append", GroupStateTimeout.NoTimeout)
    )


def frame_stream(packets: DataFrame, port: int = 0) -> DataFrame:
    parsed = parse_packets(packets) if "frame" in packets.columns else packets
    return reassemble_stream(tcp_with_payload(filter_ports(parsed, port)))


# What each decoded output is made of: frame type, decoder, keys of a repeated record.
OUTPUTS = {
    "ticks": ((9, 5803), decode_ticks, ["channel", "biz_index"]),
    "snapshots": ((6, 3202), decode_snapshots, ["security_id", "tick_time"]),
}


def decode_stream(
    spark: SparkSession,
    folder: str,
    prefix: str,
    rules,
    port: int = 0,
    output: str = "ticks",
    dedup_delay: str | None = None,
    checkpoint: str | None = None,
    max_batch_bytes: int = MICRO_BATCH_BYTES,
) -> DataFrame:
    """Ticks or snapshots of landed and growing segments (T1), each decoded from its own frames only.

    With ``dedup_delay`` the first valid arrival of a record is kept in the stream; copies come in
    within that time of capture.
    """
    (category, kind), decode, keys = OUTPUTS[output]
    landed = stream_segments(
        spark, folder, prefix, checkpoint=checkpoint, max_batch_bytes=max_batch_bytes, headers=True, ports=port
    )
    events = frame_stream(landed, port)
    frames = events.filter(F.col("kind") == "frame").drop("kind", "n_bytes", "frame_reject")
    routed = route(frames, rules).filter((F.col("category_id") == category) & (F.col("msg_type") == kind))
    if dedup_delay is None:
        # Frames decode alone, so not only the few tasks that hold flows do it; with dedup a flow's frames stay in order.
        return decode(routed.repartition(spark.sparkContext.defaultParallelism, "frame_no"))
    rows = decode(routed)
    timed = rows.filter(F.col("reject_reason").isNull()).withColumn(
        "arrived", F.timestamp_micros(F.call_function("div", F.col("ts_ns"), F.lit(1000)))
    )
    return dedup_stream(timed, keys, "arrived", dedup_delay).drop("arrived")


def dedup_stream(rows: DataFrame, keys, ts: str, delay: str) -> DataFrame:
    """First arrival per key; the watermark bounds the state."""
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def publish_batches(
    stream: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None
):
    """Append every micro-batch to a Parquet folder; a batch is published when it commits.

    Every partition of the state costs each micro-batch a task and a file, also without a flow in it, so a new query has
    as many as there are cores, if the session asks for more; a restarted one keeps those of its checkpoint.
    """
    writer = (
        stream.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
    )
    spark, key = stream.sparkSession, "spark.sql.shuffle.partitions"
    asked = spark.conf.get(key)
    # a query takes the settings that hold when it starts
    spark.conf.set(key, str(min(int(asked), spark.sparkContext.defaultParallelism)))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, asked)


def run_available(stream: DataFrame, sink: str, checkpoint: str, timeout_s: int | None = None) -> None:
    """Process everything that is there in bounded batches, then stop (T5); without ``timeout_s`` however long it takes."""
    query = publish_batches(stream, sink, checkpoint, {"processingTime": "0 seconds"})
    watch = None
    if timeout_s is not None:
        watch = Timer(timeout_s, query.stop)
        watch.start()
    try:
        query.processAllAvailable()
        stopped = not query.isActive
    finally:
        if watch:
            watch.cancel()
        query.stop()
    if stopped:
        raise TimeoutError(f"stream still running after {timeout_s} s")
