"""Helpers shared by the text operators."""

import ctypes
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.session import configure, scratch_dir

# A space or line feed next to white space may be inside one pre-token with it.
_UNSAFE_SPACE = re.compile(r" \s|\s |\n\s|\s\n")
_WIDE_SPACE = re.compile("[\t\r\v\f\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str, row_group_mb: int = 32) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    A writer holds a row group in memory; tables of large values take a smaller one.
    """
    folder = scratch_dir(df.sparkSession, label)
    df.write.option("parquet.block.size", str(row_group_mb << 20)).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def raw_texts(column: pa.Array):
    """UTF-8 bytes of every text; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def space_chunks(text: str):
    """``text`` cut before every single space and around every single line feed, or None where such cuts could split a pre-token.

    The usual byte-level split pattern puts a space only at the start of a token or into a run of
    white space, and a line feed only into such a run, so pre-tokens never cross these cuts.
    """
    doubtful = any(x in text for x in ("  ", " \n", "\n ", "\n\n", " \t", " \r", " \v", " \f", " \x1c", " \x1d", " \x1e", " \x1f"))
    if (doubtful or _WIDE_SPACE.search(text)) and _UNSAFE_SPACE.search(text):
        return None
    out = []
    for line in text.split("\n"):
        head, *rest = line.split(" ")
        out.append(head)
        out += [" " + x for x in rest]
        out.append("\n")
    out.pop()
    return out


class Memo(dict):
    """A dict bounded in bytes, which forgets everything when full. It belongs to the task that makes it.

    ``put`` counts the sizes of key and value and a fixed part for their objects and the entry.
    """

    OBJECTS = 200

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.used = limit, 0

    def put(self, key, value, size: int) -> None:
        self.used += size + self.OBJECTS
        if self.used > self.limit:
            self.clear()
            self.used = size + self.OBJECTS
        self[key] = value


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, text: str, limit: int):
    """Parts of a batch whose texts hold about ``limit`` bytes each (at least one row)."""
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
    sizes = np.array([0 if x is None else x for x in pa.compute.binary_length(column).to_pylist()], dtype=np.int64)
    group = (np.cumsum(sizes) - sizes) // limit
    cuts = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(sizes)], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def release() -> None:
    """Give freed memory back to the system at the end of a task.

    Python workers live on between tasks, and what they keep counts for their executor while others need it.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores added as it takes to differ from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
