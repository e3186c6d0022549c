"""Packet headers parsed and filtered where packets are read.

With the option ``headers`` a capture source gives the columns of ``parse_packets`` instead of whole
frames; ``ports`` (numbers between commas) and ``side`` ("any" or "src") keep the packets of some ports. They
run on the headers of a batch before its payloads are taken, so other packets never leave the Python worker.

With the option ``push`` the reader also takes the filters that Spark pushes down: comparisons, ``in``
and null tests on header columns, joined by and. Spark 4.1 keeps pushed filters in the source object that
all branches of a DataFrame share, so a second branch with other filters, or none, would lose
rows. The option is therefore for readers that make one plan from the source and write it,
like ``tcp_packets``; the public read functions leave it out.
"""

from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import datasource as ds
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quotemill.operators.packets import HEADER_FIELDS, PACKET_SCHEMA, parse_frames

_COMPARE = {
    ds.EqualTo: pc.equal,
    ds.GreaterThan: pc.greater,
    ds.GreaterThanOrEqual: pc.greater_equal,
    ds.LessThan: pc.less,
    ds.LessThanOrEqual: pc.less_equal,
}
_ORDERED = (T.LongType, T.IntegerType, T.StringType)


class HeaderView:
    """What a source gives for a batch of packets (see the module)."""

    def __init__(self, options):
        self.ports = [int(p) for p in options.get("ports", "").split(",") if p.strip() and int(p)]
        self.side = options.get("side", "any")
        self.payload = options.get("payload", "true") == "true"
        self.parsed = options.get("headers") == "true" or bool(self.ports)
        self.filters = []

    def schema(self) -> T.StructType:
        if not self.parsed:
            return PACKET_SCHEMA
        kept = [f for f in PACKET_SCHEMA.fields if f.name != "frame"]
        return T.StructType(kept + [f for f in HEADER_FIELDS if self.payload or f.name != "payload"])

    def push(self, filters):
        """Take the filters that can be checked on headers; the others go back to Spark."""
        for f in filters:
            if self.parsed and _can_check(f, self.schema()):
                self.filters.append(f)
            else:
                yield f

    def give(self, batches):
        """The batches (file, capture_seq, ts_ns, frame) in this view."""
        if not self.parsed:
            yield from batches
            return
        arrow = to_arrow_schema(self.schema())
        names = [f.name for f in HEADER_FIELDS if f.name != "payload"]
        for batch in batches:
            frames = batch.column("frame")
            plain = [batch.column(c) for c in ("file", "capture_seq", "ts_ns")]
            heads = pa.table([*plain, *parse_frames(frames, with_payload=False)], ["file", "capture_seq", "ts_ns", *names])
            mask = self._mask(heads)
            if mask is not None:
                heads, frames = heads.filter(mask), frames.filter(mask)
            if self.payload and heads.num_rows:
                at = [f.name for f in HEADER_FIELDS].index("payload")
                heads = heads.append_column("payload", pa.chunked_array([parse_frames(frames)[at]]))
            if heads.num_rows:
                yield from heads.select(arrow.names).cast(arrow).combine_chunks().to_batches()

    def _mask(self, heads):
        tests = [_check(f, heads) for f in self.filters]
        if self.ports:
            ends = ["sport"] if self.side == "src" else ["sport", "dport"]
            wanted = pa.array(self.ports, pa.int32())
            tests.append(reduce(pc.or_, [pc.is_in(heads[e], wanted) for e in ends]))
        return pc.fill_null(reduce(pc.and_kleene, tests), False) if tests else None


def _can_check(f, schema) -> bool:
    if isinstance(f, ds.Not):
        return _can_check(f.child, schema)
    column = getattr(f, "attribute", ())
    known = len(column) == 1 and column[0] in schema.names and isinstance(schema[column[0]].dataType, _ORDERED)
    kinds = (*_COMPARE, ds.EqualNullSafe, ds.In, ds.IsNull, ds.IsNotNull, ds.StringStartsWith)
    return known and isinstance(f, kinds)


def _check(f, heads):
    """Three-valued outcome of a filter for every row."""
    if isinstance(f, ds.Not):
        return pc.invert(_check(f.child, heads))
    column = heads[f.attribute[0]]
    if isinstance(f, ds.IsNull):
        return pc.is_null(column)
    if isinstance(f, ds.IsNotNull):
        return pc.is_valid(column)
    if isinstance(f, ds.StringStartsWith):
        return pc.starts_with(column, pattern=f.value)
    if isinstance(f, ds.EqualNullSafe):
        same = pc.is_null(column) if f.value is None else pc.fill_null(pc.equal(column, pa.scalar(f.value, column.type)), False)
        return same
    if isinstance(f, ds.In):
        some = pc.is_in(column, pa.array([v for v in f.value if v is not None], column.type))
        unknown = pc.is_null(column) if None not in f.value else pc.invert(some)
        return pc.if_else(unknown, pa.scalar(None, pa.bool_()), some)
    return _COMPARE[type(f)](column, pa.scalar(f.value, column.type))


class Pushing:
    """A reader that takes pushed filters; only for sources with the option ``push``."""

    def pushFilters(self, filters):
        yield from self.view.push(filters)


def reader_of(kind, options):
    """A reader of class ``kind``, which takes pushed filters if the options say so."""
    if options.get("push") == "true":
        return type(kind.__name__, (Pushing, kind), {})(options)
    return kind(options)
