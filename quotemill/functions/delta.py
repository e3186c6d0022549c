"""Delta-field rehydration as window expressions (D3-D6) and presence maps.

A dictionary lives inside one frame, and a frame is at most 16 MB, so these windows are bounded.
Each value column comes with a presence flag: an absent field differs from an explicit null.
"""

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def _as_list(cols):
    return [cols] if isinstance(cols, (str, Column)) else list(cols)


def _so_far(frame, order):
    return (
        Window.partitionBy(*_as_list(frame))
        .orderBy(*_as_list(order))
        .rowsBetween(Window.unboundedPreceding, 0)
    )


def fast_copy(value: Column, present: Column, frame, order, empty=0) -> Column:
    """Absent means the previous value of the frame, ``empty`` before the first one."""
    kept = F.last(F.when(present, value), ignorenulls=True).over(_so_far(frame, order))
    return F.coalesce(kept, F.lit(empty))


def fast_copy_nullable(value: Column, present: Column, frame, order) -> Column:
    """As copy, but an explicit null gives 0 and leaves the dictionary alone."""
    kept = F.last(F.when(present, value), ignorenulls=True).over(_so_far(frame, order))
    return F.when(present & value.isNull(), 0).otherwise(F.coalesce(kept, F.lit(0)))


def fast_increment(value: Column, present: Column, row, frame, order) -> Column:
    """Absent means previous + 1: the last explicit value plus the rows since it.

    ``row`` numbers the rows of a frame without holes. value - row is constant over a run of
    absent fields, so a copy of that difference is enough; with no explicit value yet, the first
    row of the frame gives 1.
    """
    w = _so_far(frame, order)
    offset = F.last(F.when(present, value - row), ignorenulls=True).over(w)
    return row + F.coalesce(offset, F.lit(1) - F.min(row).over(w))


def fast_default(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def from_nullable(wire: Column) -> Column:
    """Wire value of a nullable field: 0 is null, otherwise one less."""
    return F.when(wire != 0, wire - 1)


def pmap_bits(pmap: Column, n_bits: int) -> Column:
    """Indexes of the set bits, 0 for the first (highest) bit."""
    return F.filter(
        F.sequence(F.lit(0), F.lit(n_bits - 1)),
        lambda i: F.call_function(
            "pmod",
            F.call_function("div", pmap, F.pow(F.lit(2), F.lit(n_bits - 1) - i).cast("long")),
            F.lit(2).cast("long"),
        )
        == 1,
    )
