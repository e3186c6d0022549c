"""Rotating capture segments ``<prefix>_%06d.bin``: batch read, stream read and write.

A record is a 20-byte little-endian header (magic, version, link type, time, length) and the
packet. ``capture_seq`` is the byte position of the record in its segment: unique and ordered
within a file, and the same however the read is split.
"""

import json
import struct
import uuid
import warnings

import pyarrow as pa
from pyarrow.fs import FileType
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

from quotemill.sources.files import Blocks, resolve, sizes
from quotemill.sources.headers import HeaderView, reader_of

RECORD = struct.Struct("<IHHQI")
# Fixed values of the record header.
MAGIC, VERSION, LINK_ETHERNET, MAX_PACKET = 0x31425353, 1, 1, 65535
SEGMENT_BYTES = 256 << 20
BATCH_BYTES = 16 << 20
MICRO_BATCH_BYTES = 256 << 20
PACKET_ARROW = pa.schema(
    [
        ("file", pa.string()),
        ("capture_seq", pa.int64()),
        ("ts_ns", pa.int64()),
        ("frame", pa.binary()),
    ]
)


def segment_name(prefix, number):
    return f"{prefix}_{number:06d}.bin"


def segment_numbers(folder, prefix):
    """{number: size} of the segments that are there."""
    found, _ = sizes(folder)
    head = f"{prefix}_"
    return {
        int(n[len(head) : -4]): size
        for n, size in found.items()
        if n.startswith(head) and n.endswith(".bin") and n[len(head) : -4].isdigit()
    }


def no_hole(numbers, prefix, holes):
    """The sorted numbers up to the first hole, all of them (``holes`` = "skip"), or an error ("error")."""
    whole = [n for i, n in enumerate(numbers) if n == numbers[0] + i]
    if len(whole) == len(numbers) or holes == "skip":
        return numbers
    message = f"segments of {prefix} are missing from number {whole[-1] + 1} on"
    if holes == "error":
        raise ValueError(message)
    warnings.warn(message, stacklevel=2)
    return whole


def packet_batches(records):
    """Arrow batches of (file, capture_seq, ts_ns, frame) rows, bounded by bytes."""
    rows, size = [], 0
    for row in records:
        rows.append(row)
        size += len(row[3])
        if size >= BATCH_BYTES or len(rows) >= 65536:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), PACKET_ARROW.types)], schema=PACKET_ARROW
    )


def read_records(folder, name, start, end):
    """Records of one segment that end after byte ``start`` and not after ``end``.

    A bad header or a cut record ends the segment. Ranges that meet share no record and lose none,
    wherever they meet; what lies before ``start`` is walked over.
    """
    store, base = resolve(folder)
    blocks = Blocks(store, f"{base}/{name}", 0, end)
    pos = 0
    try:
        while (head := blocks.take(RECORD.size)) is not None:
            magic, version, _link, ts_ns, length = RECORD.unpack(head)
            if magic != MAGIC or version != VERSION or length > MAX_PACKET:
                return
            packet = blocks.take(length)
            if packet is None:
                return
            if pos + RECORD.size + length > start:
                yield name, pos, ts_ns, packet
            pos += RECORD.size + length
    finally:
        blocks.close()


def record_walk(folder, name):
    """(records, end of the last whole record, size) of one segment."""
    store, base = resolve(folder)
    size = store.get_file_info(f"{base}/{name}").size
    records, end = 0, 0
    for _, pos, _, packet in read_records(folder, name, 0, size):
        records, end = records + 1, pos + RECORD.size + len(packet)
    return records, end, size


class SegmentPart(InputPartition):
    def __init__(self, name, start, end):
        self.name, self.start, self.end = name, start, end


class SegmentReader(DataSourceReader):
    """Segments from the lowest number that is there; earlier ones may have been read and removed.

    At a hole in the numbers reading fails (``holes`` = "error"), stops there with a warning ("stop") or
    goes on ("skip"); ``segment_report`` lists what lies behind a hole.
    """

    def __init__(self, options):
        self.folder, self.prefix = options["path"], options["prefix"]
        self.holes = options.get("holes", "error")
        self.view = HeaderView(options)

    def partitions(self):
        found = segment_numbers(self.folder, self.prefix)
        numbers = no_hole(sorted(found), self.prefix, self.holes)
        parts = [SegmentPart(segment_name(self.prefix, n), 0, found[n]) for n in numbers]
        return parts or [SegmentPart(None, 0, 0)]

    def read(self, part):
        if part.name is None:
            return iter(())
        return self.view.give(packet_batches(read_records(self.folder, part.name, part.start, part.end)))


class SegmentStreamReader(DataSourceStreamReader):
    """Offset = (segment number, byte), (0, 0) before the first segment.

    A micro-batch takes at most ``max_batch_bytes``, from the lowest segment that was there at the start, over
    segment borders and up to the size the open one has by then. Any byte is a good offset: a record
    belongs to the batch in which it ends. So the driver lists files and never opens one, and tasks
    find the records. A hole in the numbers and a start segment that is gone fail the query, or are
    passed over with ``holes`` = "skip". With ``delete_after_read`` a segment is removed once a later one
    has been committed.

    Spark asks for the latest offset without saying where the query stands, so that is read from
    ``checkpoint``; where none is given, the first batch after a start takes all there is.
    """

    def __init__(self, options):
        self.folder, self.prefix = options["path"], options["prefix"]
        self.delete = options.get("delete_after_read") == "true"
        self.holes = options.get("holes", "error")
        self.limit = int(options.get("max_batch_bytes", 0))
        self.view = HeaderView(options)
        self.planned = (checkpointed(options["checkpoint"]) or (0, 0)) if "checkpoint" in options else None

    def initialOffset(self):
        return {"segment": 0, "pos": 0}

    def _from(self, start):
        """[(number, first byte, size)] of the segments at and behind an offset, up to a hole."""
        number, pos = start
        found = segment_numbers(self.folder, self.prefix)
        numbers = sorted(n for n in found if n >= number)
        if number and number not in found and self.holes != "skip":
            raise ValueError(f"segment {number} of {self.prefix} is gone, which was read up to byte {pos}")
        return [(n, pos if n == number else 0, found[n]) for n in no_hole(numbers, self.prefix, self.holes)]

    def latestOffset(self):
        start = self.planned or (0, 0)
        end, left = start, self.limit if self.limit and self.planned else None
        for number, lo, size in self._from(start):
            if left is not None and size - lo > left:
                end = (number, lo + left)
                break
            end = (number, max(lo, size))
            left = None if left is None else left - (end[1] - lo)
        self.planned = end
        return {"segment": end[0], "pos": end[1]}

    def partitions(self, start, end):
        first, last = ((o["segment"], o["pos"]) for o in (start, end))
        self.planned = max(self.planned or last, last)
        parts = []
        for number, lo, size in self._from(first) if first < last else ():
            hi = last[1] if number == last[0] else size
            if number <= last[0] and hi > lo:
                parts.append(SegmentPart(segment_name(self.prefix, number), lo, hi))
        return parts

    def read(self, part):
        return self.view.give(packet_batches(read_records(self.folder, part.name, part.start, part.end)))

    def commit(self, end):
        if not self.delete:
            return
        store, base = resolve(self.folder)
        for number in segment_numbers(self.folder, self.prefix):
            if number < end["segment"]:
                store.delete_file(f"{base}/{segment_name(self.prefix, number)}")


def checkpointed(folder):
    """(segment, byte) that a query with this checkpoint folder has planned last, or None.

    Spark writes one file per batch to ``offsets``: a version, a line of settings, and one line per source.
    """
    found, base = sizes(f"{folder.rstrip('/')}/offsets")
    batches = sorted((int(n), n) for n in found if n.isdigit())
    if not batches:
        return None
    store, _ = resolve(folder)
    with store.open_input_stream(f"{base}/{batches[-1][1]}") as f:
        lines = f.read().decode().splitlines()
    for line in lines[2:]:
        offset = json.loads(line) if line.startswith("{") else {}
        if {"segment", "pos"} <= set(offset):
            return offset["segment"], offset["pos"]
    return None


class WrittenParts(WriterCommitMessage):
    def __init__(self, partition, names, records, dropped):
        self.partition, self.names = partition, names
        self.records, self.dropped = records, dropped


class SegmentWriter(DataSourceArrowWriter):
    """Tasks write rotating files under private names; commit numbers them in partition order."""

    def __init__(self, options):
        self.folder, self.prefix = options["path"], options["prefix"]
        self.limit = int(options.get("max_bytes", SEGMENT_BYTES))

    def write(self, batches):
        store, base = resolve(self.folder)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        names, out, used, records, dropped = [], None, 0, 0, 0
        for batch in batches:
            for ts_ns, frame in zip(
                batch.column("ts_ns").to_pylist(), batch.column("frame").to_pylist()
            ):
                if len(frame) > MAX_PACKET:
                    dropped += 1
                    continue
                size = RECORD.size + len(frame)
                if out is None or used + size > self.limit:
                    if out is not None:
                        out.close()
                    names.append(f".{self.prefix}-{task.partitionId()}-{uuid.uuid4().hex}.part")
                    out, used = store.open_output_stream(f"{base}/{names[-1]}"), 0
                out.write(RECORD.pack(MAGIC, VERSION, LINK_ETHERNET, ts_ns, len(frame)))
                out.write(frame)
                used += size
                records += 1
        if out is not None:
            out.close()
        return WrittenParts(task.partitionId(), names, records, dropped)

    def commit(self, messages):
        """Numbers go on from the highest segment there; packets too long for a record are counted."""
        store, base = resolve(self.folder)
        written = sorted((m for m in messages if m), key=lambda m: m.partition)
        number = max(segment_numbers(self.folder, self.prefix), default=0) + 1
        for message in written:
            for name in message.names:
                target = f"{base}/{segment_name(self.prefix, number)}"
                if store.get_file_info(target).type != FileType.NotFound:
                    raise FileExistsError(target)
                store.move(f"{base}/{name}", target)
                number += 1
        report = {"records": sum(m.records for m in written), "dropped": sum(m.dropped for m in written)}
        with store.open_output_stream(f"{base}/{self.prefix}.write-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(report).encode())

    def abort(self, messages):
        store, base = resolve(self.folder)
        for message in messages:
            for name in message.names if message else ():
                store.delete_file(f"{base}/{name}")


class SegmentSource(DataSource):
    @classmethod
    def name(cls):
        return "capseg"

    def schema(self):
        return HeaderView(self.options).schema()

    def reader(self, schema):
        return reader_of(SegmentReader, self.options)

    def streamReader(self, schema):
        return SegmentStreamReader(self.options)

    def writer(self, schema, overwrite):
        return SegmentWriter(self.options)


def header_options(headers: bool, ports, payload: bool = True, side: str = "any") -> dict[str, str]:
    """Options of a capture source that parses and filters headers where it reads (see ``headers``)."""
    wanted = [ports] if isinstance(ports, int) else list(ports or ())
    return {
        "headers": str(headers).lower(),
        "ports": ",".join(str(p) for p in wanted if p),
        "payload": str(payload).lower(),
        "side": side,
    }


def read_segments(
    spark: SparkSession,
    folder: str,
    prefix: str,
    holes: str = "error",
    headers: bool = False,
    ports=(),
    payload: bool = True,
    side: str = "any",
) -> DataFrame:
    """Packets of all segments; with ``headers`` (or ``ports``) parsed, and only those of the ports."""
    spark.dataSource.register(SegmentSource)
    reader = spark.read.format("capseg").option("path", folder).option("prefix", prefix)
    return reader.option("holes", holes).options(**header_options(headers, ports, payload, side)).load()


def segment_report(spark: SparkSession, folder: str, prefix: str) -> DataFrame:
    """(file, records, whole_bytes, lost_bytes, behind_hole) of each segment.

    What follows a bad or cut record is lost; a hole in the numbers fails a read that does not allow it.
    """
    numbers = sorted(segment_numbers(folder, prefix))
    names = [segment_name(prefix, n) for n in numbers]
    behind = {segment_name(prefix, n) for i, n in enumerate(numbers) if n != numbers[0] + i}
    listed = spark.createDataFrame([(n,) for n in names], "file string")

    def walk(batches):
        for b in batches:
            rows = [(n, *record_walk(folder, n)) for n in b.column(0).to_pylist()]
            cols = list(zip(*rows)) if rows else [(), (), (), ()]
            lost = [size - end for size, end in zip(cols[3], cols[2])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), *[pa.array(c, pa.int64()) for c in (cols[1], cols[2], lost)], pa.array([n in behind for n in cols[0]], pa.bool_())],
                ["file", "records", "whole_bytes", "lost_bytes", "behind_hole"],
            )

    spread = listed.repartition(max(len(names), 1), "file")
    return spread.mapInArrow(walk, "file string, records long, whole_bytes long, lost_bytes long, behind_hole boolean")


def write_report(spark: SparkSession, folder: str, prefix: str) -> DataFrame:
    """One row per finished write: records written and packets dropped as too long for a record."""
    files = f"{folder.rstrip('/')}/{prefix}.write-*.json"
    return spark.read.schema("records long, dropped long").json(files)


def stream_segments(
    spark: SparkSession,
    folder: str,
    prefix: str,
    delete_after_read: bool = False,
    max_batch_bytes: int = MICRO_BATCH_BYTES,
    checkpoint: str | None = None,
    holes: str = "error",
    headers: bool = False,
    ports=(),
) -> DataFrame:
    """Packets of landed and growing segments, ``max_batch_bytes`` of them per micro-batch.

    Give the query's ``checkpoint`` folder: the first batch after a start is bounded only with it. Use
    ``run_available`` or an interval trigger: Spark's available-now trigger plans a single batch.
    """
    spark.dataSource.register(SegmentSource)
    reader = (
        spark.readStream.format("capseg")
        .option("path", folder)
        .option("prefix", prefix)
        .option("delete_after_read", str(delete_after_read).lower())
        .option("max_batch_bytes", str(max_batch_bytes))
        .option("holes", holes)
        .options(**header_options(headers, ports))
    )
    return (reader.option("checkpoint", checkpoint) if checkpoint else reader).load()


def write_segments(
    packets: DataFrame, folder: str, prefix: str, max_bytes: int = SEGMENT_BYTES
) -> None:
    """Write packets in capture order (time, then position) to numbered segments."""
    spark = packets.sparkSession
    spark.dataSource.register(SegmentSource)
    order = ["ts_ns", "file", "capture_seq"]
    (
        packets.select("file", "capture_seq", "ts_ns", "frame")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.format("capseg")
        .mode("append")
        .option("prefix", prefix)
        .option("max_bytes", str(max_bytes))
        .save(folder)
    )
