"""Operators on small DataFrames against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quotemill.functions.fields import clock_text, fixed_decimal, or_question_mark, tick_time_text
from quotemill.operators import records, routing, traffic
from quotemill.operators.reassembly import (
    classify_segments,
    direction_bytes,
    reassemble_by_offset,
    replay,
)
from quotemill.operators.reconcile import key_set_diff, reconcile, reconcile_summary
from quotemill.operators import scan
from quotemill.session import drop_tables
from quotemill.operators.scan import (
    block_of,
    occurrence_number,
    ordered_scan,
    previous,
    running_count,
    running_last,
    running_max,
    running_sum,
)


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(7)
    rows = [
        (rng.choice("aaab"), i, rng.choice([None, rng.randint(-9, 9)]), rng.randint(0, 5))
        for i in range(600)
    ]
    return spark.createDataFrame(rows, "g string, at long, v int, w int").cache()


def rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize(("hot", "rows_of_a_task"), [(None, 1 << 22), (True, 0), (False, 0), (None, 0), (None, 150)])
def test_ordered_scan_equals_one_window(numbers, monkeypatch, hot, rows_of_a_task):
    """With ordinary groups, large ones, and some of each."""
    monkeypatch.setattr(scan, "HOT_ROWS", rows_of_a_task)
    blocked = numbers.withColumn("b", block_of(F.col("at"), 16))
    got = ordered_scan(
        blocked,
        group=["g"],
        block=["b"],
        order=["at"],
        hot=hot,
        n=running_count(),
        total=running_sum(F.col("w")),
        before=running_sum(F.col("w"), exclusive=True),
        top=running_max(F.col("v")),
        top_before=running_max(F.col("v"), exclusive=True),
        held=running_last(F.col("v")),
        prev=previous(F.col("v")),
    ).drop("b")
    w = Window.partitionBy("g").orderBy("at")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    want = numbers.select(
        "*",
        F.count(F.lit(1)).over(upto),
        F.sum("w").over(upto),
        F.coalesce(F.sum("w").over(earlier), F.lit(0)),
        F.max("v").over(upto),
        F.max("v").over(earlier),
        F.last("v", True).over(upto),
        F.lag("v").over(w),
    )
    assert rows(got) == rows(want)


def test_numbering_without_group(numbers):
    blocked = numbers.withColumn("b", block_of(F.col("at"), 16))
    got = routing.number_frames(blocked, block=["b"], order=["at"])
    assert {(r["at"], r["frame_idx"]) for r in got.collect()} == {(i, i + 1) for i in range(600)}


def test_occurrences_of_hot_key(numbers):
    keyed = numbers.withColumn("b", block_of(F.col("at"), 16)).withColumn("k", F.lit(1))
    for hot in (None, True):
        got = occurrence_number(keyed, keys=["k"], block=["b"], order=["at"], hot=hot)
        assert {(r["at"], r["occurrence"]) for r in got.collect()} == {(i, i + 1) for i in range(600)}


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hash") + plan.count("Exchange range"), plan.count("Exchange Single")


def test_exchanges_of_scans(numbers):
    """One exchange for a lag or an occurrence number; numbering all rows needs no single partition."""
    blocked = numbers.withColumn("b", block_of(F.col("at"), 16))
    lagged = ordered_scan(blocked, group=["g"], block=["b"], order=["at"], prev=previous(F.col("v")))
    assert exchanges(lagged) == (1, 0)
    assert exchanges(occurrence_number(blocked, keys=["g"], block=["b"], order=["at"])) == (1, 0)
    assert exchanges(routing.number_frames(blocked, block=["b"], order=["at"]))[1] == 0


def test_row_numbers_and_running_totals_over_range_partitions(numbers):
    for partitions in (1, 5, 40):
        got = scan.row_numbers(numbers.repartition(7), ["at"], "n", start=3, partitions=partitions)
        assert all(r["n"] == r["at"] + 3 for r in got.collect()) and got.count() == 600
        some = numbers.select("at", "w")
        total, want = 0, {}
        for r in some.orderBy("at").collect():
            want[r["at"]] = total
            total += r["w"]
        summed = scan.totals_before(some.repartition(7), ["at"], "w", "before", partitions)
        assert {r["at"]: r["before"] for r in summed.collect()} == want
    assert scan.row_numbers(numbers.limit(0), ["at"], "n").count() == 0


def test_field_texts(spark):
    df = spark.createDataFrame([(9350630, 95350, -5, ""), (0, 0, 13520, "B")], "t long, c long, p long, s string")
    got = df.select(
        tick_time_text(F.col("t")),
        clock_text(F.col("c")),
        fixed_decimal(F.col("p"), 3).cast("string"),
        or_question_mark(F.col("s")),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("09:35:06.30", "09:53:50", "-0.005", "?"),
        ("00:00:00.00", "00:00:00", "13.520", "B"),
    ]


def stop_bit(value):
    """A number as 7-bit groups, the last one with the stop bit."""
    groups = [value & 0x7F | 0x80]
    while value := value >> 7:
        groups.append(value & 0x7F)
    return bytes(reversed(groups))


def stop_text(text):
    return text[:-1].encode() + bytes([ord(text[-1]) | 0x80])


def test_status_records_read_back_what_was_encoded(spark):
    """Fields are chosen, encoded and expected back; numbers stay outside the letters of a status."""
    rng = random.Random(8)
    cases = []
    for _ in range(400):
        prefix = [rng.choice([0, 5, 1000, 70_000, 2**40]) for _ in range(rng.randint(0, 3))]
        middle = [rng.choice([1, 9, 2**13, 2**62]) for _ in range(rng.randint(0, 2))] + [3]
        status = rng.choice([None, "SUSP", "START", "T"])
        trailer = rng.choice([None, 1, 72])
        sec = f"60088{rng.randint(0, 9)}"
        body = b"".join(map(stop_bit, prefix)) + stop_text(sec) + b"".join(map(stop_bit, middle))
        body += (stop_text(status) if status else b"") + (bytes([trailer]) if trailer is not None else b"")
        cases.append((body, (prefix, sec, middle, status, trailer, False)))
    df = spark.createDataFrame([(i, bytearray(b)) for i, (b, _) in enumerate(cases)], "i int, body binary")
    for r in records.status_records(df).collect():
        got = (r.prefix_ints, r.sec_id, r.mid_ints, r.status, r.trailer, r.overflow)
        assert got == cases[r.i][1], cases[r.i][0].hex()


def test_status_records_by_hand(spark):
    wide = "7f" * 9 + "ff"
    cases = {
        "": ([], None, [], None, None, False),
        "81": ([], None, [], None, None, False),  # no id
        "8182838436303038b83030b081": ([], None, [], None, None, False),  # four numbers before the id
        "3630303838b0": ([], "600880", [], None, None, False),
        "813630303838b083" + "53d4" + "48": ([1], "600880", [3], "ST", 72, False),
        wide + "3630303838b083": ([None], "600880", [3], None, None, True),
        "00" * 12 + "85" + "3630303838b083": ([5], "600880", [3], None, None, False),
    }
    df = spark.createDataFrame([(k, bytearray(bytes.fromhex(k))) for k in cases], "k string, body binary")
    for r in records.status_records(df).collect():
        assert (r.prefix_ints, r.sec_id, r.mid_ints, r.status, r.trailer, r.overflow) == cases[r.k], r.k



FLOW_ROW = (
    "file string, capture_seq long, src_ip string, sport int, dst_ip string, dport int, "
    "tcp_seq long, payload binary, payload_len int"
)


def random_segments(seed, n=400, base=(1 << 32) - 900):
    rng = random.Random(seed)
    data = rng.randbytes(4000)
    out, at = [], 0
    for i in range(n):
        size = rng.choice([1, 5, 9, 30])
        step = rng.random()
        start = max(at - rng.randint(1, 40), 0) if step < 0.2 else at + (rng.randint(1, 20) if step > 0.93 else 0)
        piece = data[start : start + size]
        if not piece:
            break
        out.append((f"f{i // 150}", i * 100, "10.0.0.1", 9129, "10.0.0.2", 5, (base + start) % (1 << 32), bytearray(piece), len(piece)))
        at = max(at, start + size)
    return out


def test_classify_segments_any_block_size(spark):
    packets = random_segments(11)
    want, _ = replay([p[6] for p in packets], [p[8] for p in packets], None)
    df = spark.createDataFrame(packets, FLOW_ROW)
    for block, width in ((300, 1000), (300, 2), (5000, 3), (1 << 30, 1000)):
        got = classify_segments(df, block_bytes=block, width=width).orderBy("file", "capture_seq")
        assert [r["verdict"] for r in got.collect()] == want


def test_reassemble_by_offset(spark):
    packets = random_segments(12)
    first = packets[0][6]
    chunks = {}
    for p in packets:
        offset = (p[6] - first + (1 << 31)) % (1 << 32) - (1 << 31)
        chunks.setdefault(offset, bytes(p[7]))
    want, until, holes = {}, None, 0
    for offset, data in sorted(chunks.items()):
        if until is not None:
            holes += max(offset - until, 0)
            skip = max(until - offset, 0)
            if skip >= len(data):
                continue
            offset, data = offset + skip, data[skip:]
        want[offset] = data
        until = offset + len(data)
    df = spark.createDataFrame(packets, FLOW_ROW)
    for block in (64, 1 << 30):
        got = reassemble_by_offset(df, block_bytes=block).collect()
        assert {r["stream_offset"]: bytes(r["payload"]) for r in got} == want
        assert sum(r["hole_end"] - r["hole_start"] for r in got if r["hole_end"]) == holes


def merge_by_queue(decoded, reference):
    """The ordered two-way pass over one channel: sorted inputs, equal keys pair in order."""
    out, d, r = Counter(), list(decoded), list(reference)
    while d or r:
        if d and (not r or d[0][0] < r[0][0]):
            d.pop(0)
            out["miss"] += 1
        elif r and (not d or r[0][0] < d[0][0]):
            r.pop(0)
            out["ref_remain"] += 1
        else:
            same = d.pop(0)[1] == r.pop(0)[1]
            out["match" if same else "error"] += 1
    return out


def test_reconcile_equals_ordered_merge(spark):
    rng = random.Random(13)
    left, right, want = [], [], Counter()
    for channel in range(40):
        sides = []
        for _ in range(2):
            keys = sorted(rng.randint(0, 12) for _ in range(rng.randint(0, 15)))
            sides.append([(k, rng.randint(0, 2)) for k in keys])
        want += merge_by_queue(*sides)
        for out, side in zip((left, right), sides):
            out += [(channel, k, v, i, i // 4) for i, (k, v) in enumerate(side)]
    ddl = "channel int, biz_index int, v int, at int, block int"
    result = reconcile(
        spark.createDataFrame(left, ddl),
        spark.createDataFrame(right, ddl),
        key=["channel", "biz_index"],
        fields=["v"],
        block=["block"],
        order=["at"],
    )
    got = {r["status"]: r["count"] for r in result.groupBy("status").count().collect()}
    assert got == dict(want)
    s = reconcile_summary(result).first()
    assert (s["matches"], s["errors"], s["miss"]) == (want["match"], want["error"], want["miss"])
    assert s["ref_remain"] == want["ref_remain"] + want["error"]
    assert (s["decoded"], s["reference"]) == (len(left), len(right))


def test_null_fields_compare_equal(spark):
    one = spark.createDataFrame([(1, 1, None, 0, 0)], "channel int, biz_index int, v int, at int, block int")
    r = reconcile(one, one, key=["channel", "biz_index"], fields=["v"], block=["block"], order=["at"])
    assert r.first()["status"] == "match"


def test_key_set_diff(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    got = {(r["side"], r["k"], r["count"]) for r in key_set_diff(a, b, ["k"]).collect()}
    assert got == {("left", 1, 2), ("right", 3, 1)}


def test_histogram_last_edge_is_closed(spark):
    us = 1_000_000
    df = spark.createDataFrame([(s * us,) for s in (5, 6, 70, 125)], "t long")
    got = traffic.relative_histogram(df, "t").orderBy("bucket").collect()
    assert [tuple(r) for r in got] == [(0, 2), (1, 2)]
    one = spark.createDataFrame([(5,)], "t long")
    assert [tuple(r) for r in traffic.relative_histogram(one, "t").collect()] == [(0, 1)]


def test_take_while_and_first_rule(spark):
    df = spark.createDataFrame([(i, i < 4) for i in range(9)], "i int, ok boolean")
    assert {r["i"] for r in routing.take_while(df, F.col("ok"), "i").collect()} == {0, 1, 2, 3}
    every = routing.take_while(df, F.lit(True), "i")
    assert every.count() == 9
    frames = spark.createDataFrame([(9, 5803), (9, 1)], "category_id int, msg_type int")
    rules = [{"category_id": 9, "msg_type": 5803, "output": o} for o in ("a", "b")]
    assert [r["output"] for r in routing.route(frames, rules).collect()] == ["a"]


def test_labels_and_preview(spark):
    bodies = [b"\0\0\0\x08M101xx", b"\0\0\0\x08\x00\x01\xff\x02", b"short"]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(bodies)], "i int, body binary")
    got = {r["label"]: r["count"] for r in traffic.label_histogram(df, F.col("body")).collect()}
    assert got == {"M101": 1, "\\x0001ff02": 1}
    shown = traffic.preview(df, F.col("body"), ["i"], ["i"], n=2, n_bytes=7).collect()
    assert [(r["hex"], r["ascii"]) for r in shown] == [
        ("000000084d3130", "....M10"),
        ("000000080001ff", "......."),
    ]


def test_direction_of_initiator(spark):
    rows_in = [
        ("f", 2, "10.0.0.9", 80, "10.0.0.1", 5000, 0, bytearray(b""), 7),
        ("f", 1, "10.0.0.1", 5000, "10.0.0.9", 80, 0, bytearray(b""), 3),
    ]
    r = direction_bytes(spark.createDataFrame(rows_in, FLOW_ROW), [80]).first()
    assert (r["initiator_ip"], r["sent_bytes"], r["received_bytes"], r["accepted"]) == ("10.0.0.1", 3, 7, True)


def test_payload_crosses_the_network_once(spark):
    """Merging by offset settles everything on narrow rows and joins the payload once."""
    df = spark.createDataFrame(random_segments(12), FLOW_ROW)
    merged = reassemble_by_offset(df.repartition(3), block_bytes=64)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Window [" in plan and not any("payload#" in x for x in plan.splitlines() if "Window [" in x)


def test_named_intermediate_tables_are_dropped(spark, tmp_path):
    spark.range(3).write.option("path", str(tmp_path / "t")).saveAsTable("quotemill_test_table")
    spark.range(3).write.option("path", str(tmp_path / "u")).saveAsTable("other_table")
    drop_tables(spark)
    names = {t.name for t in spark.catalog.listTables()}
    spark.sql("DROP TABLE other_table")
    assert "quotemill_test_table" not in names and "other_table" in names


def test_rows_are_numbered_in_one_exchange(spark):
    """Blocks may be null; the rows themselves are dealt once, for the places in a block and for its first number."""
    from pyspark.sql import functions as F

    from quotemill.operators.scan import number_all

    rows = [(None if i < 50 else i // 100, i, f"row {i}") for i in range(1000)]
    frame = spark.createDataFrame(rows[::-1], "block long, at long, text string").repartition(5)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        numbered = number_all(frame, block=["block"], order=["at"], name="no")
        assert sorted((r.at, r.no, r.text) for r in numbered.collect()) == [(i, i + 1, f"row {i}") for i in range(1000)]
        plan = numbered._jdf.queryExecution().sparkPlan().toString()
        executed = numbered._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    assert "SortMergeJoin" in plan
    wide = [x for x in executed.split("== Initial Plan ==")[-1].splitlines() if "Exchange hashpartitioning" in x and "(_part" not in x]
    assert len(wide) <= 2  # one of the rows, one of the blocks
    assert number_all(frame.limit(0), block=["block"], order=["at"], name="no").count() == 0
