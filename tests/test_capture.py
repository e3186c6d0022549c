"""Sources, the whole capture path and streaming."""

import os
import random
import struct

import pytest
from pyspark.sql import functions as F

from quotemill.operators import framing, packets, ticks
from quotemill.plans import batch, fixtures
from quotemill.plans.queries import RULES
from quotemill.session import staged
from quotemill.sources import pcap, segments, tables
from quotemill.streaming import decode as streaming

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def derived(spark):
    return fixtures.tick_projection(spark, SF).cache()


@pytest.fixture(scope="module")
def landed(spark, derived, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("capture"))
    blobs = fixtures.step_blobs(fixtures.tick_frames(derived))
    segments.write_segments(fixtures.capture_packets(blobs, copies=2), folder, "cap", 20_000)
    return folder


def values(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_segments_rotate_and_keep_order(spark, landed):
    names = sorted(n for n in os.listdir(landed) if n.endswith(".bin"))
    assert names == [f"cap_{i + 1:06d}.bin" for i in range(len(names))] and len(names) > 3
    assert all(os.path.getsize(f"{landed}/{n}") <= 20_000 for n in names)
    times = [r["ts_ns"] for r in segments.read_segments(spark, landed, "cap").orderBy("file", "capture_seq").collect()]
    assert times == sorted(times)


def test_segment_reader_stops_at_bad_records(spark, tmp_path):
    def record(body, magic=segments.MAGIC, version=1):
        return segments.RECORD.pack(magic, version, 1, 7, len(body)) + body

    (tmp_path / "x_000001.bin").write_bytes(record(b"a") + record(b"bb") + record(b"ccc")[:-1])
    (tmp_path / "x_000002.bin").write_bytes(record(b"d") + record(b"e", magic=5) + record(b"f"))
    (tmp_path / "x_000004.bin").write_bytes(record(b"after a missing number"))
    got = segments.read_segments(spark, str(tmp_path), "x", holes="stop")
    assert values(got, "file", "frame") == [
        ("x_000001.bin", bytearray(b"a")),
        ("x_000001.bin", bytearray(b"bb")),
        ("x_000002.bin", bytearray(b"d")),
    ]
    assert segments.read_segments(spark, str(tmp_path), "none").count() == 0


def test_oversize_packets_are_dropped(spark, tmp_path):
    rows = [("m", i, i, bytearray(n)) for i, n in enumerate((10, 65535, 65536))]
    df = spark.createDataFrame(rows, packets.PACKET_SCHEMA)
    segments.write_segments(df, str(tmp_path / "out"), "s")
    assert segments.read_segments(spark, str(tmp_path / "out"), "s").count() == 2


@pytest.mark.parametrize("nanos,endian", [(True, "<"), (False, "<"), (True, ">"), (False, ">")])
def test_pcap_layouts_and_splits(spark, tmp_path, nanos, endian):
    made = fixtures.event_packets(spark, SF)
    folder = str(tmp_path / "p")
    fixtures.write_pcap(made.coalesce(1), folder, nanos, endian)
    want = values(made, "ts_ns", "frame")
    whole = pcap.read_pcap(spark, folder, split_bytes=0)
    split = pcap.read_pcap(spark, folder, split_bytes=5000)
    assert split.rdd.getNumPartitions() > whole.rdd.getNumPartitions()
    assert values(whole, "ts_ns", "frame") == want == values(split, "ts_ns", "frame")
    assert values(whole, "file", "capture_seq") == values(split, "file", "capture_seq")


def test_pcap_over_a_month_with_empty_records(spark, tmp_path):
    rng = random.Random(3)
    data = struct.pack("<IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1)
    for i in range(2000):
        body = rng.randbytes(rng.choice([0, 0, 20, 200])) + bytes(rng.choice([0, 40]))
        data += struct.pack("<IIII", 1_700_000_000 + i * 1500, i % 10**6, len(body), len(body)) + body
    (tmp_path / "month.pcap").write_bytes(data)
    columns = ["file", "capture_seq", "ts_ns", "frame"]
    whole = pcap.read_pcap(spark, str(tmp_path), split_bytes=0).select(*columns)
    split = pcap.read_pcap(spark, str(tmp_path), split_bytes=30_000).select(*columns)
    assert split.rdd.getNumPartitions() > 3
    filled = {i for i, n in enumerate(split.rdd.mapPartitions(lambda x: [sum(1 for _ in x)]).collect()) if n}
    assert len(filled) > 3
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, whole.collect())) and whole.count() == 2000


def test_segments_append_and_holes(spark, tmp_path):
    rows = [("m", i, i, bytearray(b"x" * 50)) for i in range(40)]
    packets = spark.createDataFrame(rows, "file string, capture_seq long, ts_ns long, frame binary").coalesce(1)
    folder = str(tmp_path / "seg")
    segments.write_segments(packets, folder, "cap", max_bytes=500)
    segments.write_segments(packets.limit(3), folder, "cap")
    assert segments.read_segments(spark, folder, "cap").count() == 43
    numbers = sorted(segments.segment_numbers(folder, "cap"))
    assert numbers == list(range(1, numbers[-1] + 1))
    (tmp_path / "seg" / segments.segment_name("cap", 1)).unlink()
    first = segments.segment_report(spark, folder, "cap").agg({"records": "sum"}).first()[0]
    assert segments.read_segments(spark, folder, "cap").count() == first > 0
    (tmp_path / "seg" / segments.segment_name("cap", 4)).unlink()
    left = segments.segment_report(spark, folder, "cap").collect()
    assert sum(r.behind_hole for r in left) == numbers[-1] - 4
    assert segments.read_segments(spark, folder, "cap", holes="skip").count() == sum(r.records for r in left)
    with pytest.raises(Exception, match="missing from number 4"):
        segments.read_segments(spark, folder, "cap").count()


def test_ranges_of_a_segment_share_no_record_and_lose_none(tmp_path):
    rng = random.Random(4)
    bodies = [rng.randbytes(rng.randint(0, 60)) for _ in range(50)]
    data = b"".join(segments.RECORD.pack(segments.MAGIC, 1, 1, i, len(b)) + b for i, b in enumerate(bodies))
    (tmp_path / "x_000001.bin").write_bytes(data + b"cut")
    for _ in range(40):
        cuts = sorted({0, len(data) + 3, *rng.choices(range(len(data)), k=rng.randint(0, 8))})
        got = [r for a, b in zip(cuts, cuts[1:]) for r in segments.read_records(str(tmp_path), "x_000001.bin", a, b)]
        assert [r[3] for r in got] == bodies and [r[2] for r in got] == list(range(50))


def drained(spark, folder, tmp_path, run, **options):
    """Packets and batches of a stream over what is there."""
    sink, state = (str(tmp_path / f"{run}-{n}") for n in ("out", "state"))
    stream = segments.stream_segments(spark, folder, "cap", checkpoint=state, **options)
    streaming.run_available(stream, sink, state, timeout_s=300)
    return values(spark.read.parquet(sink), "file", "capture_seq", "frame"), len(os.listdir(f"{state}/offsets"))


def test_stream_starts_at_the_lowest_segment_in_bounded_batches(spark, tmp_path):
    """A thousand landed segments, of which the first four have been cleaned away, over many batches."""
    folder = tmp_path / "in"
    folder.mkdir()
    size = 0
    for n in range(1000):
        data = b"".join(segments.RECORD.pack(segments.MAGIC, 1, 1, n * 10 + i, 30) + bytes([n % 251] * 30) for i in range(3))
        (folder / segments.segment_name("cap", n + 5)).write_bytes(data)
        size += len(data)
    want = values(segments.read_segments(spark, str(folder), "cap"), "file", "capture_seq", "frame")
    got, batches = drained(spark, str(folder), tmp_path, "a", max_batch_bytes=size // 4 + 1)
    assert len(want) == 3000 and got == want and batches >= 4
    # what comes later goes on behind the checkpoint, again in bounded batches
    (folder / segments.segment_name("cap", 1005)).write_bytes(data * 50)
    got, more = drained(spark, str(folder), tmp_path, "a", max_batch_bytes=len(data) * 20)
    assert len(got) == 3150 and more >= batches + 3


def test_stream_does_not_pass_over_lost_segments(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    record = segments.RECORD.pack(segments.MAGIC, 1, 1, 7, 3) + b"abc"
    for n in (5, 6, 7):
        (folder / segments.segment_name("cap", n)).write_bytes(record * 2)
    got, _ = drained(spark, str(folder), tmp_path, "a")
    assert len(got) == 6
    for n in (5, 6, 7):
        (folder / segments.segment_name("cap", n)).unlink()
    (folder / segments.segment_name("cap", 9)).write_bytes(record)
    with pytest.raises(Exception, match="segment 7 of cap is gone"):
        drained(spark, str(folder), tmp_path, "a")
    (folder / segments.segment_name("cap", 11)).write_bytes(record)
    with pytest.raises(Exception, match="missing from number 10"):
        drained(spark, str(folder), tmp_path, "b")
    assert len(drained(spark, str(folder), tmp_path, "c", holes="skip")[0]) == 2


def test_stream_of_an_empty_folder_takes_what_comes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    query = streaming.publish_batches(
        segments.stream_segments(spark, str(tmp_path / "in"), "cap"), str(tmp_path / "o"), str(tmp_path / "s"), {"processingTime": "0 seconds"}
    )
    query.processAllAvailable()
    (tmp_path / "in" / segments.segment_name("cap", 3)).write_bytes(segments.RECORD.pack(segments.MAGIC, 1, 1, 7, 3) + b"abc")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 1


def test_pcap_stops_at_cut_record_and_filters_ports(spark, tmp_path):
    head = struct.pack("<IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1)
    frame = fixtures.tcp_frame(bytes(4), 9129, bytes(4), 1, 5, b"hello")
    other = fixtures.tcp_frame(bytes(4), 80, bytes(4), 1, 5, b"hello")
    record = b"".join(struct.pack("<IIII", 1, 2, len(f), len(f)) + f for f in (frame, other))
    (tmp_path / "a.pcap").write_bytes(head + record + struct.pack("<IIII", 1, 2, 60, 60) + b"short")
    path = str(tmp_path / "a.pcap")
    assert pcap.read_pcap(spark, path).count() == 2
    assert values(pcap.read_pcap(spark, path, port=9129), "sport", "ts_ns") == [(9129, 1_000_002_000)]


def plan_of(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_header_filters_run_in_the_reader(spark, tmp_path):
    made = fixtures.event_packets(spark, SF)
    folder = str(tmp_path / "seg")
    segments.write_segments(made, folder, "ev", 4000)
    whole = staged(packets.parse_packets(segments.read_segments(spark, folder, "ev")), "parsed")
    fresh = lambda: batch.tcp_source(spark, "capseg", folder, (), prefix="ev")
    shared = segments.read_segments(spark, folder, "ev", headers=True)
    assert fresh().columns == shared.columns == whole.columns
    tcp = packets.tcp_with_payload(whole)
    for condition in (
        "ip_proto <> 17", "sport in (7000, 5) and src_ip like '10.3.%'", "tcp_seq is null", "payload_len <= 20 and ts_ns >= 1768354200000100000",
        "tcp_seq <=> null and dport = 1985", "not (sport in (7000, 3))", "sport = 7000 or dport = 1985", "length(payload) > 18 and dst_ip = '10.4.0.1'",
    ):
        assert values(fresh().filter(condition), *whole.columns) == values(tcp.filter(condition), *whole.columns), condition
        assert values(shared.filter(condition), *whole.columns) == values(whole.filter(condition), *whole.columns), condition
    # branches of one source don't see each other's filters
    both = shared.filter("sport = 7001").unionAll(shared.filter("sport = 7000 or dport = 1985")).unionAll(shared)
    assert both.count() == whole.filter("sport = 7001").count() + 2 * whole.count()
    plan = plan_of(fresh().filter("src_ip = '10.3.0.1'"))
    assert "PushedFilters" in plan and "EqualTo(src_ip,10.3.0.1)" in plan and "GreaterThan(payload_len,0)" in plan
    only = segments.read_segments(spark, folder, "ev", ports=7001)
    assert values(only, *whole.columns) == values(whole.filter("sport = 7001 or dport = 7001"), *whole.columns)
    assert "payload" not in segments.read_segments(spark, folder, "ev", headers=True, payload=False).columns
    # what does not pass stays in the reader
    reader = segments.SegmentReader({"path": folder, "prefix": "ev", "ports": "7001", "payload": "false"})
    given = sum(b.num_rows for p in reader.partitions() for b in reader.read(p))
    assert given == only.count() < whole.count()


def test_frames_do_not_depend_on_blocks_or_partitions(spark, landed, derived):
    tcp = batch.tcp_table(segments.read_segments(spark, landed, "cap"), 9129)
    want = sorted(
        tuple(r) * 1
        for r in fixtures.tick_frames(derived)
        .withColumn("copy", F.explode(F.array(F.lit("10.2.0.1"), F.lit("10.2.0.2"))))
        .select("copy", "msg_seq_id", "payload")
        .collect()
    )
    for block, width in ((700, 1000), (700, 7), (6000, 2), (8 << 20, 1000)):
        frames = framing.cut_step_frames(tcp, block_bytes=block, width=width)
        assert values(frames, "dst_ip", "msg_seq_id", "payload") == want
    shuffled = framing.cut_step_frames(tcp.repartition(13), block_bytes=6000)
    assert values(shuffled, "dst_ip", "msg_seq_id", "payload") == want
    merged = framing.cut_step_frames(tcp, policy="offset_merge", block_bytes=6000)
    assert values(merged, "dst_ip", "msg_seq_id", "payload") == want


def test_partial_overlap_policies(spark):
    message = fixtures.step_message(9, 5803, 1, "20260114-09:30:00", b"x" * 300)
    cuts = [(0, 100), (60, 200), (200, len(message))]
    rows = [
        ("f", i, i, "10.0.0.1", 9129, "10.0.0.2", 5, a, bytearray(message[a:b]), b - a)
        for i, (a, b) in enumerate(cuts)
    ]
    ddl = (
        "file string, capture_seq long, ts_ns long, src_ip string, sport int, dst_ip string, "
        "dport int, tcp_seq long, payload binary, payload_len int"
    )
    df = spark.createDataFrame(rows, ddl)
    assert framing.cut_step_frames(df).count() == 0
    assert framing.cut_step_frames(df, policy="offset_merge").first()["payload"] == b"x" * 300


def test_pipeline_outputs(spark, landed, derived):
    out = batch.decode_segments(spark, landed, "cap", RULES, 9129)
    fields = ["channel", "biz_index", "security_id", "money_e5", "bs_flag"]
    assert values(out["ticks"], *fields) == values(derived, *fields)
    assert out["snapshots"].count() == 0


def test_export_columns_and_numbers(spark, landed, derived, tmp_path):
    out = batch.decode_segments(spark, landed, "cap", RULES, 9129, numbered=True)["ticks"]
    tables.write_ticks(out, str(tmp_path / "ticks"), "csv")
    back = spark.read.option("header", True).option("inferSchema", True).csv(str(tmp_path / "ticks"))
    assert back.columns == list(tables.EXPORT_NAMES.values())
    frames = derived.selectExpr("channel", "(biz_index - 1) div 50 AS f").distinct().count()
    found = back.select("OuterSeq", "FrameIdx").distinct()
    assert found.count() == frames and back.count() == derived.count()
    last = back.agg(F.max("FrameIdx")).first()[0]
    assert frames <= last <= 2 * frames


def test_stream_equals_batch_across_triggers(spark, landed, derived, tmp_path):
    """Segments arrive one by one; a frame cut by a trigger continues in the next."""
    folder, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    os.mkdir(folder)
    names = sorted(n for n in os.listdir(landed) if n.endswith(".bin"))
    blobs = [open(f"{landed}/{n}", "rb").read() for n in names]
    half = len(blobs) // 2
    for upto in (1, half):
        for n, data in list(zip(names, blobs))[:upto]:
            with open(f"{folder}/{n}", "wb") as f:
                f.write(data)
        if upto == half:
            with open(f"{folder}/{names[half]}", "wb") as f:
                f.write(blobs[half][: len(blobs[half]) // 2 + 3])
        stream = streaming.decode_stream(spark, folder, "cap", RULES, port=9129)
        streaming.run_available(stream, sink, state, timeout_s=300)
    for n, data in zip(names, blobs):
        with open(f"{folder}/{n}", "wb") as f:
            f.write(data)
    stream = streaming.decode_stream(spark, folder, "cap", RULES, port=9129)
    streaming.run_available(stream, sink, state, timeout_s=300)
    got = ticks.valid_ticks(spark.read.parquet(sink))
    fields = ["channel", "biz_index", "security_id", "money_e5", "bs_flag"]
    assert values(got.filter("dst_ip = '10.2.0.1'"), *fields) == values(derived, *fields)
    assert values(got.filter("dst_ip = '10.2.0.2'"), *fields) == values(derived, *fields)


def test_consumed_segments_are_deleted(spark, landed, tmp_path):
    folder, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    os.mkdir(folder)
    names = sorted(n for n in os.listdir(landed) if n.endswith(".bin"))
    total = segments.read_segments(spark, landed, "cap").count()
    for upto in (2, len(names)):
        for n in names[:upto] if upto == 2 else names[2:]:
            with open(f"{landed}/{n}", "rb") as src, open(f"{folder}/{n}", "wb") as dst:
                dst.write(src.read())
        stream = segments.stream_segments(spark, folder, "cap", delete_after_read=True)
        streaming.run_available(stream, sink, state, timeout_s=300)
    assert spark.read.parquet(sink).count() == total
    assert names[0] not in os.listdir(folder) and names[-1] in os.listdir(folder)


def test_snapshot_dedup_keeps_first_arrival(spark):
    books = fixtures.snapshot_projection(spark, SF)
    frames = fixtures.snapshot_frames(books.coalesce(1)).withColumns(
        {"file": F.lit("f"), "ts_ns": F.lit(1).cast("long"), "dedup": F.lit(True)}
    )
    twice = frames.withColumn("frame_no", F.explode(F.array(*[F.lit(i).cast("long") for i in (2, 1)])))
    kept = batch.snapshots_of(twice)
    assert kept.count() == books.select("security_id", "tick_time").distinct().count()
    assert {r["frame_no"] for r in kept.select("frame_no").distinct().collect()} == {1}
    assert batch.snapshots_of(twice.withColumn("dedup", F.lit(False)), False).count() == 2 * books.count()


def test_vendor_csv_keeps_bad_rows(spark, tmp_path):
    (tmp_path / "v.csv").write_text(
        "BizIndex,Channel,SecurityID,TickTime,Type,BuyOrderNO,SellOrderNO,Price,Qty,TradeMoney,TickBSFlag\n"
        "9172333,3,601106,09:53:50.630,A,0,6000457,6.330,1100,0.000,S\n"
        "oops,3\n"
    )
    rows = tables.read_ticks_csv(spark, str(tmp_path / "v.csv")).cache()
    good = rows.filter(F.col("_corrupt_record").isNull()).first()
    assert (good["biz_index"], str(good["price"]), str(good["money"])) == (9172333, "6.330", "0.00000")
    assert rows.filter(F.col("_corrupt_record").isNotNull()).count() == 1


def test_snapshot_export_view(spark, tmp_path):
    frames = fixtures.snapshot_frames(fixtures.snapshot_projection(spark, SF))
    from quotemill.operators.snapshots import decode_snapshots

    decoded = staged(decode_snapshots(frames), "snapshots")
    tables.write_snapshots(decoded, str(tmp_path / "csv"), "csv")
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.count() == decoded.count()
    row = back.filter("BidPx1 is not null").first()
    assert row["TickTime"][2] == ":" and "." in row["Last"] and row["BidPx10"] == "0.0000"
    assert back.columns[:2] == ["SecID", "TickTime"] and back.columns[-2:] == ["OfferQty10", "RecIdx"] and len(back.columns) == 85
    tables.write_snapshots(decoded, str(tmp_path / "pq"))
    assert spark.read.parquet(str(tmp_path / "pq")).schema["bid_levels"].dataType.simpleString().startswith("array<struct")


def test_stats_and_reconcile_folders(spark, tmp_path):
    df = spark.createDataFrame([("TCP", 3)], "proto string, count long")
    tables.write_stats({"proto_all": df, "proto_matched": df}, str(tmp_path / "stats"))
    assert sorted(os.listdir(tmp_path / "stats")) == ["proto_all", "proto_matched"]
    states = spark.createDataFrame([(1, "miss"), (2, "match")], "k int, status string")
    tables.write_reconcile(states, str(tmp_path / "rec"))
    assert spark.read.parquet(str(tmp_path / "rec")).filter("status = 'miss'").count() == 1


def test_state_has_as_many_partitions_as_cores(spark, landed, tmp_path):
    """Every partition of the state is a task in each batch; and frames are decoded by all cores."""
    sink, state = str(tmp_path / "out"), str(tmp_path / "state")
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "37")
    try:
        stream = streaming.decode_stream(spark, landed, "cap", RULES, port=9129)
        query = streaming.publish_batches(stream, sink, state, {"processingTime": "0 seconds"})
        assert spark.conf.get(key) == "37"
        query.processAllAvailable()
        found = [s["numShufflePartitions"] for p in query.recentProgress for s in p["stateOperators"]]
        query.stop()
    finally:
        spark.conf.set(key, before)
    cores = spark.sparkContext.defaultParallelism
    assert found and set(found) == {cores}
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert plan.index("MapInArrow") < plan.index("RepartitionByExpression") < plan.index("FlatMapGroupsInPandasWithState")


def test_compressed_snapshot_file_has_the_same_rows(spark, tmp_path, monkeypatch):
    from quotemill.operators import snapshots
    from quotemill.plans.queries import book_frames

    monkeypatch.setattr(tables, "FILE_ROWS", 1000)
    books = snapshots.decode_snapshots(book_frames(spark, "/root/testdata/sf0.001")).limit(3000).localCheckpoint()
    plain, small = str(tmp_path / "plain"), str(tmp_path / "small")
    tables.write_snapshots(books, plain, "csv")
    tables.write_snapshots(books, small, "csv", compression="gzip")
    read = lambda folder: spark.read.option("header", True).csv(folder)
    assert read(small).columns == read(plain).columns
    assert sorted(map(tuple, read(small).collect())) == sorted(map(tuple, read(plain).collect())) and read(small).count() == 3000
    size = lambda folder: sum(os.path.getsize(f"{folder}/{n}") for n in os.listdir(folder) if n.startswith("part-"))
    names = [n for n in os.listdir(small) if n.startswith("part-")]
    assert len(names) >= 3 and all(n.endswith(".csv.gz") for n in names) and 4 * size(small) < size(plain)
