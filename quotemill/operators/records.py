"""Raw record diagnostics (D13, D14): split by template bytes, then read status records.

Superseded by ``decode_ticks`` for values; kept because it needs no field layout.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.functions.stopbit import binary_array, binary_parts
from quotemill.schemas import schema

RAW_FIELDS = schema("rec_idx long, rec_offset long, pmap binary, tid long, body binary").fields


def stop_bit_number(data: bytes) -> int:
    value = 0
    for b in data:
        value = value << 7 | b & 0x7F
    return value


def find_records(column, tid: bytes, min_gap: int):
    """(row, record index, start, template position, end) over one Arrow column of payloads."""
    data, off = binary_parts(column)
    hit = np.ones(max(len(data) - len(tid) + 1, 0), bool)
    for i, b in enumerate(tid):
        hit &= data[i : len(hit) + i] == b
    at = np.flatnonzero(hit)
    row = np.searchsorted(off, at, "right") - 1
    inside = (at > off[row]) & (at + len(tid) <= off[row + 1])
    at, row = at[inside], row[inside]
    stopped = data[at - 1] >= 0x80
    at, row = at[stopped], row[stopped]
    keep, last = [], (-1, 0)
    for i, (r, p) in enumerate(zip(row.tolist(), at.tolist())):
        if r != last[0] or p - last[1] >= min_gap + 2:
            keep.append(i)
            last = (r, p)
    at, row = at[keep], row[keep]
    new = np.ones(len(row), bool)
    new[1:] = row[1:] != row[:-1]
    # The presence map runs back from the template over bytes without a stop bit.
    stops = np.flatnonzero(data >= 0x80)
    earlier = np.searchsorted(stops, at - 1) - 1
    after_stop = np.where(earlier >= 0, stops[np.maximum(earlier, 0)] + 1, 0) if len(stops) else at
    before = np.roll(at, 1) + 2 if len(at) else at
    floor = np.where(new, off[row], before)
    start = np.minimum(np.maximum(after_stop, floor), at - 1)
    end = np.r_[start[1:], off[-1:]] if len(at) else at
    end = np.where(np.r_[new[1:], True], off[row + 1], end) if len(at) else at
    number = np.arange(len(row)) - np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))
    return data, off, row, number, start, at, end


def split_by_tid(
    frames: DataFrame, tid: bytes = b"\x2d\xab", min_gap: int = 4, payload: str = "payload"
) -> DataFrame:
    """Heuristic split: a template word after a stop bit starts a record's fields."""
    passed = [f for f in frames.schema.fields if f.name != payload]
    names = [f.name for f in passed]
    tid_value, out = stop_bit_number(tid), names + [f.name for f in RAW_FIELDS]

    def run(batches):
        for batch in batches:
            data, off, row, number, start, at, end = find_records(batch.column(payload), tid, min_gap)
            index, body = pa.array(row), at + len(tid)
            yield pa.RecordBatch.from_arrays(
                [batch.column(n).take(index) for n in names]
                + [
                    pa.array(number),
                    pa.array(start - off[row]),
                    binary_array(data, start, at - start),
                    pa.array(np.full(len(row), tid_value)),
                    binary_array(data, body, np.maximum(end - body, 0)),
                ],
                out,
            )

    return frames.mapInArrow(run, T.StructType(passed + RAW_FIELDS))


# Stop-bit tokens and text on the upper-case hex of a body, two digits per byte.
TOKEN = "(?:[0-7][0-9A-F])*[89A-F][0-9A-F]"
SECURITY = "(?:3[0-9]){5}B[0-9]"
TEXT = "(?:[2-6][0-9A-F]|7[0-9A-E])*(?:[A-E][0-9A-F]|F[0-9A-E])"
HEAD = f"^((?:{TOKEN}){{0,3}}?)({SECURITY})(.*)$"
TAIL = f"^((?:[0-9A-F]{{2}})*?)({TEXT})$"


def _tokens(hex_text):
    return F.regexp_extract_all(hex_text, F.lit(rf"\G({TOKEN})"), F.lit(1))


# A stop-bit number of nine bytes has 63 bits; longer ones, leading zero bytes aside, overflow.
WIDE = "^(?:00)*(?!00)(?:[0-9A-F]{2}){10,}$"


def _too_wide(hex_text):
    return F.exists(_tokens(hex_text), lambda t: t.rlike(WIDE))


def _numbers(hex_text):
    tokens = F.transform(_tokens(hex_text), lambda t: F.when(~t.rlike(WIDE), F.right(t, F.lit(18))))

    def number(token):
        at = F.sequence(F.lit(1), F.length(token), F.lit(2))
        return F.aggregate(
            at,
            F.lit(0).cast("long"),
            lambda acc, i: acc * 128
            + F.conv(F.substring(token, i, F.lit(2)), 16, 10).cast("long") % 128,
        )

    return F.transform(tokens, lambda t: F.when(t.isNotNull(), number(t)))


def _text(hex_text):
    """Stop-bit text: the last byte carries the stop bit."""
    size = F.length(hex_text)
    last = F.conv(F.substring(hex_text, size - 1, F.lit(2)), 16, 10).cast("int") % 128
    return F.concat(
        F.unhex(F.substring(hex_text, F.lit(1), size - 2)).cast("string"), F.char(last)
    )


def status_records(raw_records: DataFrame, body: str = "body") -> DataFrame:
    """prefix_ints, sec_id, mid_ints, status, trailer (null where not found) and overflow.

    A number above 63 bits is null in its list and sets ``overflow``. Body: up to three numbers, a six-digit id, numbers, a status text, and maybe one raw byte.
    """
    text = raw_records.withColumn("_hex", F.hex(body))
    found = F.col("_hex").rlike(HEAD)
    text = text.withColumn("_rest", F.when(found, F.regexp_extract("_hex", HEAD, 3)))
    has_trailer = F.substring(F.col("_rest"), F.length("_rest") - 1, F.lit(1)).rlike("[0-7]")
    text = text.withColumn(
        "_trailer", F.when(has_trailer, F.right(F.col("_rest"), F.lit(2)))
    ).withColumn(
        "_core",
        F.when(has_trailer, F.substring(F.col("_rest"), F.lit(1), F.length("_rest") - 2)).otherwise(
            F.col("_rest")
        ),
    )
    ends = F.col("_core").rlike(TAIL)
    none = F.array().cast("array<bigint>")
    middle = F.when(ends, F.regexp_extract("_core", TAIL, 1)).otherwise(F.col("_core"))
    return text.select(
        *raw_records.columns,
        F.when(found, _numbers(F.regexp_extract("_hex", HEAD, 1))).otherwise(none).alias("prefix_ints"),
        F.when(found, _text(F.regexp_extract("_hex", HEAD, 2))).alias("sec_id"),
        F.when(
            found,
            _numbers(middle),
        )
        .otherwise(none)
        .alias("mid_ints"),
        F.when(ends, _text(F.regexp_extract("_core", TAIL, 2))).alias("status"),
        F.conv("_trailer", 16, 10).cast("int").alias("trailer"),
        F.when(found, _too_wide(F.regexp_extract("_hex", HEAD, 1)) | _too_wide(middle)).otherwise(F.lit(False)).alias("overflow"),
    )
