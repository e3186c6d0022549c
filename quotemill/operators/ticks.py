"""Tick decoding and checks.

Frames decode independently, so the job is one ``mapInArrow``. Inside a batch all frames advance
one record per step; every field is then resolved for all records at once.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.functions.fields import fixed_decimal
from quotemill.functions.stopbit import Tokens, copy_nullable, group_starts, last_present, take

TEMPLATE_ID = 5803
# Presence bits, first field highest; every present field is one stop-bit token.
BIT = {
    "template_id": 13,
    "biz_index": 12,
    "channel": 11,
    "security_id": 10,
    "tick_time": 9,
    "action": 8,
    "buy_order_no": 7,
    "sell_order_no": 6,
    "price_e3": 5,
    "qty_e3": 4,
    "money": 3,
    "bs_flag": 2,
}
FIELD_BITS = sum(1 << b for b in BIT.values())
U32 = 0xFFFFFFFF

TICK_FIELDS = [
    T.StructField("rec_idx", T.LongType()),
    T.StructField("pmap", T.LongType()),
    T.StructField("biz_index", T.LongType()),
    T.StructField("channel", T.LongType()),
    T.StructField("security_id", T.StringType()),
    T.StructField("tick_time", T.LongType()),
    T.StructField("action", T.StringType()),
    T.StructField("buy_order_no", T.LongType()),
    T.StructField("sell_order_no", T.LongType()),
    T.StructField("price_e3", T.LongType()),
    T.StructField("qty_e3", T.LongType()),
    T.StructField("money_e5", T.LongType()),
    T.StructField("bs_flag", T.StringType()),
    T.StructField("reject_reason", T.StringType()),
]
TICK_COLUMNS = [f.name for f in TICK_FIELDS]


def walk_records(tok: Tokens, field_bits: int):
    """(frame, record number, pmap token, cut) of every record, sorted by frame.

    ``cut`` marks a record whose fields run past the end of its frame.
    """
    ptr = tok.first.copy()
    live = np.flatnonzero((ptr < tok.last) | tok.trailing)
    rows, pmaps, cuts = [], [], []
    while len(live):
        at = ptr[live]
        has_pmap = at < tok.last[live]
        safe = np.where(has_pmap, at, 0)
        present = tok.value[safe] & field_bits if len(tok.value) else np.zeros(len(live), np.int64)
        after = at + 1 + np.bitwise_count(present)
        cut = ~has_pmap | (after > tok.last[live])
        rows.append(live)
        pmaps.append(np.where(has_pmap, at, -1))
        cuts.append(cut)
        ptr[live] = after
        more = ~cut & ((after < tok.last[live]) | tok.trailing[live])
        live = live[more]
    if not rows:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, np.zeros(0, bool)
    number = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    rows, pmaps, cuts = np.concatenate(rows), np.concatenate(pmaps), np.concatenate(cuts)
    order = np.argsort(rows, kind="stable")
    return rows[order], number[order], pmaps[order], cuts[order]


def decode_payloads(payloads):
    """(frame row, tick columns) for one Arrow column of payloads."""
    tok = Tokens(payloads)
    frame, number, ptok, cut = walk_records(tok, FIELD_BITS)
    start = group_starts(frame)
    row = np.arange(len(frame))
    pmap = tok.numbers(ptok, ptok >= 0)

    def field(name):
        bit = BIT[name]
        earlier = pmap & FIELD_BITS & ~((1 << (bit + 1)) - 1)
        present = ((pmap >> bit) & 1).astype(bool) & ~cut
        return ptok + 1 + np.bitwise_count(earlier), present

    def copied(name):
        token, present = field(name)
        return take(tok.numbers(token, present), last_present(present, start), 0)

    def copied_text(name):
        token, present = field(name)
        seen = last_present(present, start)
        return tok.text(take(token, seen, 0), seen >= 0)

    def defaulted(name):
        token, present = field(name)
        return np.maximum(tok.numbers(token, present) - 1, 0)

    token, present = field("biz_index")
    seen = last_present(present, start)
    biz_index = np.where(
        seen >= 0, take(tok.numbers(token, present), seen, 0) + row - seen, row - start + 1
    )

    token, present = field("tick_time")
    tick_time = copy_nullable(tok.numbers(token, present), present, start) & U32

    action, bs_flag = copied_text("action"), copied_text("bs_flag")
    security_id = copied_text("security_id")
    price, qty, money = defaulted("price_e3"), defaulted("qty_e3"), defaulted("money")
    is_trade = pc.equal(action, "T").to_numpy(zero_copy_only=False)
    is_status = pc.equal(action, "S").to_numpy(zero_copy_only=False)
    money_e5 = np.where(is_trade, money, money * 100)

    wide = np.zeros(len(frame), bool)
    if tok.overflow.any():
        for name in BIT:
            token, present = field(name)
            wide |= present & tok.overflow[np.where(present, token, 0)]

    # 64-bit products wrap, so large factors are compared as Python integers.
    big = np.maximum(price, 1).astype(float) * qty > 2**62
    uneven = price * qty != money_e5 * 10
    for i in np.flatnonzero(is_trade & (big | (money_e5 > 2**59))):
        uneven[i] = int(price[i]) * int(qty[i]) != int(money_e5[i]) * 10

    known_flag = pc.is_in(bs_flag, pa.array(["B", "S", "N"])).to_numpy(zero_copy_only=False)
    reason = np.full(len(frame), None, object)
    for bad, text in [
        (is_trade & uneven, "price_qty_money"),
        (~is_status & ~known_flag, "bs_flag"),
        (pc.binary_length(action).to_numpy() != 1, "action"),
        (pc.binary_length(security_id).to_numpy() != 6, "security_id"),
        (copied("template_id") != TEMPLATE_ID, "template_id"),
        (wide, "overflow"),
        (cut, "truncated"),
    ]:
        reason[bad] = text
    failed = reason != None  # noqa: E711
    # Keep records up to and including the first failing one of each frame.
    fails = np.cumsum(failed)
    before = fails - failed - np.where(start > 0, fails[np.maximum(start - 1, 0)], 0)
    keep = np.flatnonzero(before == 0)
    columns = [
        pa.array(number),
        pa.array(pmap),
        pa.array(biz_index),
        pa.array(copied("channel") & U32),
        security_id,
        pa.array(tick_time),
        action,
        pa.array(defaulted("buy_order_no")),
        pa.array(defaulted("sell_order_no")),
        pa.array(price),
        pa.array(qty),
        pa.array(money_e5),
        bs_flag,
        pa.array(reason, pa.string()),
    ]
    return frame[keep], [c.take(pa.array(keep)) for c in columns]


def decode_ticks(frames: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per record up to the first bad record of each frame, which carries a reason.

    Other columns of ``frames`` pass through unless a tick field has their name. Empty payloads give no rows.
    """
    passed = [f for f in frames.schema.fields if f.name not in (payload, *TICK_COLUMNS)]
    names = [f.name for f in passed]

    def run(batches):
        for batch in batches:
            rows, columns = decode_payloads(batch.column(payload))
            index = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(n).take(index) for n in names] + columns, names + TICK_COLUMNS
            )

    return frames.mapInArrow(run, T.StructType(passed + TICK_FIELDS))


def valid_ticks(ticks: DataFrame) -> DataFrame:
    return ticks.filter(F.col("reject_reason").isNull())


def normalise_money(ticks: DataFrame, wire: str = "money_wire") -> DataFrame:
    """Trades carry money at 10^5, every other action at 10^3."""
    return ticks.withColumn(
        "money_e5",
        F.when(F.col("action") == "T", F.col(wire)).otherwise(F.col(wire) * 100).cast("long"),
    )


def validate_ticks(ticks: DataFrame) -> DataFrame:
    """Add ``reject_reason`` (null when valid), first failing rule wins."""

    def wide(name):
        return F.col(name).cast("decimal(19,0)")

    trade_uneven = (F.col("action") == "T") & (
        (wide("price_e3") * wide("qty_e3")).cast("decimal(38,0)")
        != (wide("money_e5") * F.lit(10)).cast("decimal(38,0)")
    )
    return ticks.withColumn(
        "reject_reason",
        F.when(F.col("template_id") != TEMPLATE_ID, "template_id")
        .when(F.length("security_id") != 6, "security_id")
        .when(F.length("action") != 1, "action")
        .when((F.col("action") != "S") & ~F.col("bs_flag").isin("B", "S", "N"), "bs_flag")
        .when(trade_uneven, "price_qty_money"),
    )


def until_first_bad(df: DataFrame, bad, frame, order) -> DataFrame:
    """Rows of each frame before its first bad row (D9). A frame is bounded, so one window."""
    w = (
        Window.partitionBy(*frame)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        df.withColumn("_bad", F.max(bad.cast("int")).over(w))
        .filter(F.col("_bad") == 0)
        .drop("_bad")
    )

