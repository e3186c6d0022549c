"""States along the blocks of a flow, by a tree of bounded groups.

What a block does to a state is a function of the state it starts with, and such functions compose.
Blocks are numbered in their order, WIDTH neighbours are composed into one row, these again, until
a flow has at most WIDTH rows; the states at the start of those are worked out in order, and on the way
down each group works out the states of its members from its own. No task ever holds or walks more than
WIDTH rows of a flow before it starts anew, however long the flow is, and only the small summaries move.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

import pyarrow as pa

from quotemill.operators.packets import FLOW
from quotemill.operators.scan import row_numbers

WIDTH = 1000
OUT_ROWS = 4096


def _batches(rows, arrow):
    """Arrow batches of row dicts."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == OUT_ROWS:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=arrow)


def over_groups(rows: DataFrame, keys, order, work, out: T.StructType, reverse: bool) -> DataFrame:
    """``work`` (group key, rows as they come) over sorted groups, which a task meets one after the other."""
    arrow = to_arrow_schema(out)
    by = [F.col(c).desc() if reverse else F.col(c) for c in order]

    def run(batches):
        def produced():
            key, held = None, None
            for batch in batches:
                for row in batch.to_pylist():
                    if (here := tuple(row[k] for k in keys)) != key:
                        if held is not None:
                            yield from held.end()
                        key, held = here, work()
                    yield from held.take(row)
            if held is not None:
                yield from held.end()

        yield from _batches(produced(), arrow)

    return rows.repartition(*keys).sortWithinPartitions(*keys, *by).mapInArrow(run, out)


def _composer(keys, names, merge, reverse):
    """One row per group: its members composed."""

    class Composed:
        def __init__(self):
            self.key, self.value = None, None

        def take(self, row):
            if self.value is None:
                self.key = {k: row[k] for k in keys}
                self.value = {n: row[n] for n in names}
            else:
                self.value = merge(row, self.value) if reverse else merge(self.value, row)
            return ()

        def end(self):
            yield self.key | {n: self.value[n] for n in names}

    return Composed


def _walker(keep, states, advance, start):
    """The state before every row of a group, whose own one is in the columns ``states`` with a dash before."""

    class Walk:
        def __init__(self):
            self.state, self.begun = None, False

        def take(self, row):
            if not self.begun:
                own = tuple(row.get(f"_{s}") for s in states)
                self.state, self.begun = own if f"_{states[0]}" in row else start, True
            yield {k: row[k] for k in keep} | dict(zip(states, self.state))
            self.state = advance(self.state, row)

        def end(self):
            return ()

    return Walk


def states_before(
    summaries: DataFrame,
    block: list[str],
    merge,
    advance,
    start: tuple,
    state: T.StructType,
    total: int,
    reverse: bool = False,
    width: int = WIDTH,
) -> DataFrame:
    """``summaries`` with the state (columns ``state``) that each row's flow has before it.

    ``summaries`` has one row per flow and block, of which there are ``total``; it is a written table if that
    is above ``width``. ``merge(a, b)`` composes two neighbouring rows (dicts), ``a`` being the earlier block;
    ``advance(state, row)`` is the state after a row. With ``reverse`` states run from the last block to the first.
    """
    names = [f.name for f in state.fields]
    columns = summaries.columns
    content = [c for c in columns if c not in (*FLOW, *block)]

    def walked(rows, keys, order, keep):
        out = T.StructType([rows.schema[c] for c in keep] + state.fields)
        return over_groups(rows, keys, order, _walker(keep, names, advance, start), out, reverse)

    if total <= width:
        return walked(summaries, FLOW, block, columns)
    numbers = row_numbers(summaries.select(*block).distinct(), block, "number")
    levels = [summaries.join(numbers, block)]
    while total > width:
        total = -(-total // width)
        below = levels[-1].withColumn("group", F.call_function("div", "number", F.lit(width)))
        keys = [*FLOW, "group"]
        out = T.StructType([below.schema[c] for c in (*keys, *content)])
        levels.append(
            over_groups(below, keys, ["number"], _composer(keys, content, merge, reverse), out, reverse)
            .withColumnRenamed("group", "number")
        )
    above = walked(levels[-1], FLOW, ["number"], [*FLOW, "number"])
    for rows in reversed(levels[:-1]):
        own = above.withColumnsRenamed({"number": "group"} | {n: f"_{n}" for n in names})
        member = rows.withColumn("group", F.call_function("div", "number", F.lit(width)))
        last = rows is levels[0]
        keep = columns if last else [*FLOW, "number"]
        above = walked(member.join(own, [*FLOW, "group"]), [*FLOW, "group"], ["number"], keep)
    return above
