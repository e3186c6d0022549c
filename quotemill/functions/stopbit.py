"""Stop-bit tokens of a column of byte strings, as arrays (Arrow task side)."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOW7 = np.uint8(0x7F)


def binary_parts(column):
    """(bytes, offsets) of an Arrow binary or string column, offsets starting at 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def slices(data, start, length):
    """Concatenation of data[start:start+length] and its offsets."""
    off = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=off[1:])
    index = np.arange(off[-1]) + np.repeat(np.asarray(start) - off[:-1], length)
    return data[index], off


def binary_array(data, start, length, known=None):
    out, off = slices(data, start, length)
    return _from_buffers(pa.binary(), out, off, known)


def _from_buffers(kind, data, off, known=None):
    array = pa.Array.from_buffers(
        kind, len(off) - 1, [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(data.tobytes())]
    )
    if known is not None:
        array = pc.if_else(pa.array(known), array, pa.scalar(None, kind))
    return array


class Tokens:
    """All tokens of a batch; row r owns tokens first[r]:last[r]."""

    def __init__(self, column):
        self.data, off = binary_parts(column)
        self.row_start, self.row_end = off[:-1], off[1:]
        self.end = np.flatnonzero(self.data & 0x80)
        self.first = np.searchsorted(self.end, self.row_start)
        self.last = np.searchsorted(self.end, self.row_end)
        self.start = np.zeros_like(self.end)
        self.start[1:] = self.end[:-1] + 1
        has = self.first < self.last
        self.start[self.first[has]] = self.row_start[has]
        self.length = self.end - self.start + 1
        consumed = self.row_start.copy()
        consumed[has] = self.end[self.last[has] - 1] + 1
        self.trailing = consumed < self.row_end
        self.value = np.zeros(len(self.end), np.int64)
        for j in range(min(int(self.length.max(initial=0)), 9)):
            live = np.flatnonzero(self.length > j)
            digit = (self.data[self.end[live] - j] & LOW7).astype(np.int64)
            self.value[live] |= digit << (7 * j)
        self.overflow = np.zeros(len(self.end), bool)
        for t in np.flatnonzero(self.length > 9):
            self.overflow[t] = np.any(self.data[self.start[t] : self.end[t] - 8] & LOW7)

    def text(self, token, present):
        """Arrow strings of the tokens; '' where not present."""
        if not len(token):
            return pa.array([], pa.string())
        if not len(self.end):
            return pa.array([""] * len(token), pa.string())
        token = np.where(present, token, 0)
        length = np.where(present, self.length[token], 0)
        data, off = slices(self.data, self.start[token], length)
        return _from_buffers(pa.string(), data & LOW7, off)

    def numbers(self, token, present):
        if not len(self.end):
            return np.zeros(len(token), np.int64)
        return np.where(present, self.value[np.where(present, token, 0)], 0)


def last_present(present, group_start):
    """Index of the latest present row at or before each row within its group, else -1."""
    seen = np.maximum.accumulate(np.where(present, np.arange(len(present)), -1))
    return np.where(seen >= group_start, seen, -1)


def group_starts(group):
    """For rows sorted by group, the index of the first row of each row's group."""
    if not len(group):
        return np.zeros(0, np.int64)
    new = np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(group)), 0))


def take(values, index, default):
    """values[index] with ``default`` where index is -1."""
    return np.where(index >= 0, values[np.maximum(index, 0)], default)


def copy_nullable(wire, present, group_start):
    """Copy with a nullable wire value: an explicit null gives 0 and keeps the dictionary."""
    kept = last_present(present & (wire != 0), group_start)
    return np.where(present & (wire == 0), 0, take(wire, kept, 1) - 1)
