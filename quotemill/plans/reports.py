"""Report jobs over whole captures: reconnaissance, 40-byte frames, and the status check of a day's start."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.operators import checks, framing, traffic
from quotemill.operators.packets import FLOW, parse_packets
from quotemill.operators.reconcile import key_set_diff, positional_match, time_diff_histogram
from quotemill.operators.scan import number_all
from quotemill.session import staged

PREVIEW_BYTES = 64
LINK_BYTES = 48
# Link type of the network cards' heartbeats, label of the frames that are sampled apart.
ETH_HEARTBEAT = 0x886D
BEAT_LABEL = "M101"
CHANNEL = ["type", "subtype"]


def link_samples(packets: DataFrame, eth_type: int = ETH_HEARTBEAT, n: int = 5) -> DataFrame:
    """The first packets of a link type with the start of their body as hex and as UTF-16 text."""
    wanted = F.substring("frame", 13, 2) == F.lit(bytearray(eth_type.to_bytes(2, "big")))
    first = traffic.sample_where(packets, wanted, n, ["file", "capture_seq"])
    body = F.substring("frame", 15, LINK_BYTES)
    return first.select(
        "file", "capture_seq", F.lower(F.hex(body)).alias("hex"), traffic.utf16_text(body).alias("text")
    )


def reconnaissance(packets: DataFrame, top: int = 10, width_s: int = 60, tz: str = "UTC") -> dict[str, DataFrame]:
    """What a capture holds, from one parsed and written header table.

    ``flows`` and ``noise`` cover all packets with ports, ``business`` the largest flows that are not
    noise; ``span``, ``rate`` and ``preview`` the TCP packets from or to the port of the largest one.
    """
    parsed = parse_packets(packets, payload_bytes=PREVIEW_BYTES).filter(F.col("sport").isNotNull())
    headers = staged(
        parsed.withColumn("ts_us", F.call_function("div", "ts_ns", F.lit(1000))).withColumn("ts", F.timestamp_micros("ts_us")),
        "recon",
    )
    flows = staged(traffic.flow_stats(headers), "flows")  # one row per flow, read by every table
    target = traffic.target_flow_rows(headers.filter("ip_proto = 6"), flows)
    filled = target.filter("payload_len > 0")
    return {
        "flows": traffic.with_noise(flows),
        "noise": traffic.noise_split(flows),
        "business": traffic.business_flows(flows, top),
        "span": traffic.time_span(target, "ts", tz),
        "rate": traffic.relative_histogram(target, "ts_us", width_s),
        "preview": traffic.preview(filled, "payload", ["sport", "dport", "payload_len"], ["file", "capture_seq"]),
        "links": link_samples(packets),
    }


def frame_report(packets: DataFrame, per_channel: int = 5, beats: int = 2, **cutting) -> dict[str, DataFrame]:
    """Tables over the 40-byte-header frames of a capture, all from one cut.

    ``channels`` and ``labels`` come from one aggregation, ``gaps`` are frames whose number does not
    follow that of their channel and flow, ``samples`` the first frames of each channel, beats apart.
    """
    events = framing.cut_events(packets, framing.HeadedFrames, **cutting)
    frames = framing.inflate_body(framing.whole_frames(events, framing.HeadedFrames))
    zipped = F.substring("raw_body", 1, len(framing.ZIP_HEADER)) == F.lit(bytearray(framing.ZIP_HEADER))
    narrow = staged(
        frames.select(
            *FLOW, *CHANNEL, "seq", "length", "zip_ok", "bad_inflate", "file", "frame_no",
            traffic.label_text(F.col("body")).alias("label"),
            ((F.col("compressed") == 1) & ~zipped | (F.col("compressed") == 0) & zipped).alias("mismatch"),
        ),
        "frame-report",
    )
    cells = narrow.groupBy(*CHANNEL, "label").agg(
        F.count(F.lit(1)).alias("frames"),
        F.sum("length").alias("bytes"),
        F.count_if("zip_ok").alias("zip_ok"),
        F.count_if("bad_inflate").alias("zip_fail"),
        F.count_if("mismatch").alias("mismatches"),
    )
    sums = ["frames", "bytes", "zip_ok", "zip_fail", "mismatches"]
    classed = narrow.withColumn("sample_class", F.when(F.col("label") == BEAT_LABEL, "beat").otherwise("frame"))
    order = ["file", "frame_no"]
    return {
        "channels": cells.groupBy(*CHANNEL).agg(*[F.sum(c).alias(c) for c in sums]),
        "labels": cells.filter(F.col("label").isNotNull()).select(*CHANNEL, "label", F.col("frames").alias("count")),
        "gaps": checks.sequence_gaps(narrow, group=[*FLOW, *CHANNEL], seq="seq", block=["file"], order=order),
        "samples": checks.sample_per_group(classed, CHANNEL, order, {"frame": per_channel, "beat": beats}),
        "lost": framing.lost_bytes(framing.resync_report(events)),
    }


def status_check(decoded: DataFrame, vendor: DataFrame, *, block, order) -> dict[str, DataFrame]:
    """Status records against the vendor's (columns security_id, bs_flag, tick_time and those of ``order``).

    ``sets`` has the (security, status) pairs that one side lacks, ``places`` the rows at the same
    place of both sides, ``times`` the most frequent differences of hundredths (times ten) to milliseconds.
    """
    keys = ["security_id", "bs_flag"]

    def placed(rows):
        return number_all(rows.select(*block, *order, "bs_flag"), block=block, order=order, name="place")

    def millis(rows, digits):
        return rows.filter(F.length("tick_time") > digits).select(
            "security_id", *order, (F.right("tick_time", F.lit(digits)).cast("long") * 10 ** (3 - digits)).alias("ms")
        )

    ours = millis(decoded, 2).withColumnRenamed("ms", "ours")
    theirs = millis(vendor, 3).withColumnRenamed("ms", "theirs")
    return {
        "sets": key_set_diff(decoded, vendor, keys),
        "places": positional_match(placed(decoded), placed(vendor), ["bs_flag"], index="place"),
        "times": time_diff_histogram(ours, theirs, id="security_id", ta="ours", tb="theirs", order=order),
    }
