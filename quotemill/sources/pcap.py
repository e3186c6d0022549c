"""pcap files.

A pcap file has no sync marks, so a split needs a record start. Every task looks for a place after
its split point where a run of record headers is plausible, does the same for the next split
point, and checks that its own record chain lands exactly there. The first split starts at a known
record, so if all checks pass all starts are right; if one fails the job stops and says so, and
``split_bytes=0`` reads the file in one piece. The driver only lists files.
"""

import struct

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quotemill.sources.files import Blocks, resolve, sizes
from quotemill.sources.headers import HeaderView, reader_of
from quotemill.sources.segments import header_options, packet_batches

GLOBAL_BYTES, RECORD_BYTES = 24, 16
# Magic numbers, microsecond and nanosecond.
MAGIC_US, MAGIC_NS = 0xA1B2C3D4, 0xA1B23C4D
SPLIT_BYTES = 128 << 20
PROBE_BYTES = 64 << 10
WINDOW_BYTES = 1 << 20
PROBE_RECORDS = 12
# Longest run of PROBE_RECORDS records, read past the end of a split when needed.
MAX_RECORD = 262144
TAIL_BYTES = PROBE_RECORDS * (MAX_RECORD + RECORD_BYTES)
DAY = 86400


def layout(head):
    """(endian, nanoseconds) from the first four bytes."""
    for endian in "<>":
        magic = struct.unpack(endian + "I", head[:4])[0]
        if magic in (MAGIC_US, MAGIC_NS):
            return endian, magic == MAGIC_NS
    return ">", False


def _candidates(data, endian, nanos):
    """Offsets whose 16 bytes look like a record header, for all offsets at once."""
    raw = np.frombuffer(data, np.uint8).astype(np.uint32)
    n = len(raw) - RECORD_BYTES + 1

    def field(at):
        order = range(4) if endian == "<" else range(3, -1, -1)
        return sum((raw[at + k : at + k + n] << np.uint32(8 * i)) for i, k in enumerate(order))

    sec, frac, caplen, origlen = (field(4 * i) for i in range(4))
    return np.flatnonzero(
        (sec > 0) & (frac < (10**9 if nanos else 10**6)) & (caplen <= origlen) & (origlen <= MAX_RECORD)
    )


def _record_start(data, span, record, endian, nanos):
    """First offset below ``span`` that starts PROBE_RECORDS header-like places in a row.

    Times of neighbours are within DAY; how far they are from the start of the file does not matter.
    Empty records are allowed, all-zero headers are not.
    """
    if len(data) < RECORD_BYTES:
        return None
    found = _candidates(data, endian, nanos)
    likely = set(found.tolist())
    for at in found[: np.searchsorted(found, min(span, len(data) - RECORD_BYTES))].tolist():
        pos, last = at, None
        for _ in range(PROBE_RECORDS):
            if pos not in likely:
                break
            sec, _, caplen, _ = record.unpack_from(data, pos)
            if last is not None and abs(sec - last) > DAY:
                break
            pos, last = pos + RECORD_BYTES + caplen, sec
        else:
            return at
    return None


class PcapPart(InputPartition):
    def __init__(self, path, name, number, size):
        self.path, self.name, self.number, self.size = path, name, number, size


class PcapReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.split = int(options.get("split_bytes", SPLIT_BYTES))
        self.view = HeaderView(options)

    def partitions(self):
        found, base = sizes(self.path)
        parts = []
        for name, size in sorted(found.items()):
            if name.startswith((".", "_")) or size < GLOBAL_BYTES:
                continue
            splits = -(-size // self.split) if self.split else 1
            parts += [PcapPart(f"{base}/{name}", name, n, size) for n in range(splits)]
        return parts or [PcapPart(None, None, 0, 0)]

    def read(self, part):
        return self.view.give(packet_batches(self._records(part))) if part.name else iter(())

    def _start(self, f, number, record, endian, nanos):
        """First record of a split, None when the split has none."""
        if number == 0:
            return GLOBAL_BYTES
        point = number * self.split
        f.seek(point)
        data = f.read(PROBE_BYTES)
        at = _record_start(data, min(len(data), self.split), record, endian, nanos)
        done = 0
        # A start whose run of records is longer than the first probe: windows of fixed size, one by one.
        while at is None and done < self.split:
            f.seek(point + done)
            data = f.read(WINDOW_BYTES + TAIL_BYTES)
            span = min(WINDOW_BYTES, self.split - done)
            at = _record_start(data, span, record, endian, nanos)
            if at is not None:
                return point + done + at
            if len(data) < WINDOW_BYTES:
                return None
            done += WINDOW_BYTES
        return None if at is None else point + at

    def _records(self, part):
        store, _ = resolve(self.path)
        with store.open_input_file(part.path) as f:
            head = f.read(GLOBAL_BYTES + RECORD_BYTES)
            endian, nanos = layout(head)
            record = struct.Struct(endian + "IIII")
            if len(head) < GLOBAL_BYTES + RECORD_BYTES:
                return
            start = self._start(f, part.number, record, endian, nanos)
            if start is None:
                return
            stop, last = None, part.size // self.split if self.split else 0
            for number in range(part.number + 1, last + 1):
                stop = self._start(f, number, record, endian, nanos)
                if stop is not None:
                    break
        blocks = Blocks(store, part.path, start, stop or part.size)
        pos = start
        try:
            while (head := blocks.take(RECORD_BYTES)) is not None:
                sec, frac, caplen, _orig = record.unpack(head)
                frame = blocks.take(caplen)
                if frame is None:
                    break
                yield part.name, pos, sec * 10**9 + frac * (1 if nanos else 1000), frame
                pos += RECORD_BYTES + caplen
        finally:
            blocks.close()
        if stop is not None and pos != stop:
            raise ValueError(
                f"{part.name}: records of the split at byte {start} end at {pos}, not at "
                f"{stop}; read this file with split_bytes=0"
            )


class PcapSource(DataSource):
    @classmethod
    def name(cls):
        return "pcap"

    def schema(self):
        return HeaderView(self.options).schema()

    def reader(self, schema):
        return reader_of(PcapReader, self.options)


def read_pcap(
    spark: SparkSession,
    path: str,
    port: int | None = None,
    split_bytes: int = SPLIT_BYTES,
    headers: bool = False,
    payload: bool = True,
) -> DataFrame:
    """Packets of one pcap file or of all files in a folder.

    With ``headers`` or ``port`` headers are parsed where the file is read, and only packets from or to
    the port leave the reader.
    """
    spark.dataSource.register(PcapSource)
    reader = spark.read.format("pcap").option("split_bytes", str(split_bytes)).option("path", path)
    return reader.options(**header_options(headers, port or (), payload)).load()
