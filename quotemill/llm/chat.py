"""Chat formatting at token level.

A turn is ``[open] role [colon] text [close]``; role and text are encoded separately, and the marks
are reserved ids above the vocabulary, spliced between the segments, so no content can produce them. In
the written form the marks are the control strings of MARKS; inside content the character that a
mark needs is escaped by a backslash, as is a backslash, so no mark stands there, and reading takes the escapes away again. The loss
mask of a turn is the range of its text tokens if the role is LOSS_ROLE. Places in the token stream of a
conversation are prefix sums of segment lengths, in blocks of turns, so a conversation of any length
is spread over tasks.

Turns are ordered by turn, then role, then text, nulls first; null text or role is empty; repeated
rows are turns of their own; a null conversation id is a conversation; an empty table gives an empty
result. Columns named like a result are replaced.
"""

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotemill.llm.wavelet import Encoder

OPEN, COLON, CLOSE = "### ", ": ", " </turn>\n"
MARKS = (OPEN, COLON, CLOSE)
LOSS_ROLE = "assistant"
BLOCK_TURNS = 256
_CONTROL = re.compile(r"[\\#<:]")  # every mark holds one of these
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def reserved(path: str) -> dict[str, int]:
    """Mark -> id, following the vocabulary."""
    first = _encoder(path).tokenizer.get_vocab_size()
    return {m: first + i for i, m in enumerate(MARKS)}


def format_turns(turns: DataFrame, tokenizer_path: str, role: str = "role", text: str = "text") -> DataFrame:
    """``turns`` with ids (binary, little-endian unsigned 32-bit), n_tokens, loss_from and loss_to (inside the turn)."""

    def encode(roles: pa.Array, texts: pa.Array) -> pa.Array:
        coder, marks = _encoder(tokenizer_path), reserved(tokenizer_path)
        open_, colon, close = (np.array([marks[m]], "<u4").tobytes() for m in MARKS)
        names = [r or "" for r in roles.to_pylist()]
        heads = coder.encode([escape(r) for r in names])
        bodies = coder.encode([escape(t or "") for t in texts.to_pylist()])
        ids = [open_ + h + colon + b + close for h, b in zip(heads, bodies, strict=True)]
        total = np.array([len(x) // 4 for x in ids], np.int64)
        # Masks by prefix sums over the segments of a turn: open, role, colon, text, close.
        parts = np.array([[1, len(h) // 4, 1, len(b) // 4] for h, b in zip(heads, bodies, strict=True)], np.int64).reshape(-1, 4)
        ends = np.cumsum(parts, axis=1)
        loss = np.array([r == LOSS_ROLE for r in names], bool)
        first = ends[:, 2]
        last = np.where(loss, ends[:, 3], first)
        return pa.StructArray.from_arrays(
            [pa.array(ids, pa.binary()), pa.array(total), pa.array(first), pa.array(last)], ["ids", "n_tokens", "loss_from", "loss_to"]
        )

    made = F.arrow_udf(encode, "struct<ids:binary,n_tokens:bigint,loss_from:bigint,loss_to:bigint>")(F.col(role), F.col(text))
    names = ("ids", "n_tokens", "loss_from", "loss_to")
    kept = [F.col(f"`{c}`") for c in turns.columns if c not in names]
    return turns.withColumn("_made", made).select(*kept, *[F.col(f"_made.{n}").alias(n) for n in names])


def place_turns(formatted: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``formatted`` with ``at``: tokens of the conversation before each turn, by sums inside and over blocks of turns."""
    block = F.floor(F.col(turn) / BLOCK_TURNS)
    marked = formatted.withColumn("_block", block)
    order = [F.col(turn).asc_nulls_first(), F.col(role).asc_nulls_first(), F.col(text).asc_nulls_first()]
    inside = Window.partitionBy(conv_id, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = marked.withColumn("_local", F.sum("n_tokens").over(inside) - F.col("n_tokens"))
    sums = marked.groupBy(F.col(conv_id).alias("_conv"), F.col("_block").alias("_of")).agg(F.sum("n_tokens").alias("_n"))
    before = Window.partitionBy("_conv").orderBy(F.col("_of").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.select("_conv", "_of", (F.sum("_n").over(before) - F.col("_n")).alias("_before"))
    same = F.col(conv_id).eqNullSafe(F.col("_conv")) & F.col("_block").eqNullSafe(F.col("_of"))
    placed = local.join(sums, same).withColumn("at", F.col("_before") + F.col("_local"))
    return placed.drop("_block", "_local", "_conv", "_of", "_before")


def read_turns(placed: DataFrame, tokenizer_path: str) -> DataFrame:
    """``placed`` with read_role, read_text, loss_text and written_chars, all derived from its ids and mask."""

    def decode(ids: pa.Array, first: pa.Array, last: pa.Array) -> pa.Array:
        tokenizer, marks = _encoder(tokenizer_path).tokenizer, reserved(tokenizer_path)
        rows = [np.frombuffer(x, "<u4") for x in ids.to_pylist()]
        segments, masked = [], []
        for row, a, b in zip(rows, first.to_pylist(), last.to_pylist(), strict=True):
            colon = int(np.flatnonzero(row == marks[COLON])[0])
            if row[0] != marks[OPEN] or row[-1] != marks[CLOSE]:
                raise ValueError("a turn does not start and end with its marks")
            segments += [row[1:colon].tolist(), row[colon + 1 : -1].tolist()]
            masked.append(row[a:b].tolist())
        texts = tokenizer.decode_batch(segments + masked, skip_special_tokens=False)
        n = len(rows)
        plain = [unescape(t) for t in texts]
        written = [len(texts[2 * i]) + len(texts[2 * i + 1]) + sum(map(len, MARKS)) for i in range(n)]
        return pa.StructArray.from_arrays(
            [pa.array(plain[0 : 2 * n : 2], pa.string()), pa.array(plain[1 : 2 * n : 2], pa.string()), pa.array(plain[2 * n :], pa.string()), pa.array(written, pa.int64())],
            ["read_role", "read_text", "loss_text", "written_chars"],
        )

    kind = "struct<read_role:string,read_text:string,loss_text:string,written_chars:bigint>"
    made = F.arrow_udf(decode, kind)(F.col("ids"), F.col("loss_from"), F.col("loss_to"))
    names = ("read_role", "read_text", "loss_text", "written_chars")
    kept = [F.col(f"`{c}`") for c in placed.columns if c not in names]
    return placed.withColumn("_read", made).select(*kept, *[F.col(f"_read.{n}").alias(n) for n in names])


def digest(read: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """One row per conversation. Hashes run over the turns in order, so a conversation streams through one task row by row;
    texts are decoded before, in parallel, and only hash states are held."""
    # A null conversation sorts first and must stay apart from every id.
    ordered = read.select(conv_id, "at", "read_role", "read_text", "loss_text", "written_chars")
    ordered = ordered.repartition(conv_id).sortWithinPartitions(F.col(conv_id).asc_nulls_first(), "at")
    kind = read.schema[conv_id].dataType.simpleString()

    def run(batches):
        here, state = None, None
        rows = []

        def close():
            rows.append((here[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for b in batches:
            rows = []
            for conv, _, role, text, loss, written in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if here != (conv,):
                    if here is not None:
                        close()
                    here, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += written
            yield _digest_rows(rows, b.schema.field(0).type)
        rows = []
        if here is not None:
            close()
            yield _digest_rows(rows, b.schema.field(0).type)

    return ordered.mapInArrow(
        run, f"{conv_id} {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def _digest_rows(rows, id_type):
    cols = list(zip(*rows, strict=True)) if rows else [()] * 6
    types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)
