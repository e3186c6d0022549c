"""URL rules in a sorted digest array.

A rule is a host and the start of a path with a verdict, like ``block net/`` or
``allow example.net/en/``. It fits its host and all subdomains where the path of the URL starts with the
rule's; the longest fitting rule wins, of equally long ones that with the longer host. A URL
that no rule fits gets ``default``.

``build_index`` writes the rules of a table, of any size, as files of a shared folder. A file holds one
range of 64-bit xxhash digests: the sorted digests, where each entry begins, and the entries in full.
There are two kinds: one per host, with the lengths of its paths, and one per rule with its verdict.
Entries are dealt to files by their own digest, about FILE_ROWS each, so a host with very many rules is spread
too. A file gets its name when it is complete; a task that runs again writes the same bytes.

``judge_urls`` maps these files into memory, so a task reads only the pages its binary searches
touch, and an index need not fit into memory. URLs are not shuffled. A batch looks up the distinct ends
of its hosts that are no longer than the longest rule's, all at a time; where a host is known, the
starts of the path of the lengths it names, whose digests come from one pass over the path. Every hit is compared with the stored string, so equal digests
of other strings do no harm. Mapping needs a folder that executors see as files, a mount shared by them; other
stores are refused.

Null URLs and URLs without ``://`` have empty host and path and get the default. An empty rule table
makes an empty index. Rules with a null part or an empty host, and all but the last verdict (by name) of a
rule stated more than once, are left out. URL rows are judged one by one, repeated ones too. All columns
come back as they are; the result is one struct, named ``into``, with underscores added where an own
column has that name.
"""

import mmap
import os
import uuid
from array import array
from collections.abc import Callable, Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import ascii_lower, free_name
from quotemill.session import configure, scratch_dir

FILE_ROWS = 1 << 20
FILES = 1 << 12
URLS_AT_ONCE = 1 << 10
SEED = 42  # Spark's xxhash64 has this one
SIGN = -1 << 63
ALLOW, BLOCK = "allow", "block"
FOUND = "struct<rule:string,verdict:string>"
HOST, RULE = b"h", b"r"


def split_url(url):
    """Host and path columns of a URL column."""
    after = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    host = F.regexp_extract(after, r"(?s)\A([^/?#]*)", 1)
    rest = F.substring(after, F.length(host) + 1, F.length(after))
    path = F.regexp_extract(rest, r"(?s)\A([^?#]*)", 1)
    return F.when(has, ascii_lower(host)).otherwise(""), F.when(has, path).otherwise("")


def _local(folder: str) -> str:
    """The path of a folder that executors see as files."""
    parsed = urlparse(folder)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"an index is mapped into memory and needs a shared folder seen as files, not {folder}")
    return unquote(parsed.path) if parsed.scheme else folder


class FileWriter:
    """A digest array; readers see the file whole or not at all."""

    def __init__(self):
        self.digests, self.starts, self.text = array("Q"), array("Q", [0]), bytearray()

    def add(self, digest: int, key: bytes, value: bytes) -> None:
        """Entries come sorted by digest."""
        self.digests.append(digest)
        for part in (key, value):
            self.text += part
            self.starts.append(len(self.text))

    def save(self, path: str) -> None:
        temporary = f"{path}.{uuid.uuid4().hex}"
        with open(temporary, "wb") as out:
            out.write(array("Q", [len(self.digests)]).tobytes())
            self.digests.tofile(out)
            self.starts.tofile(out)
            out.write(self.text)
            out.flush()
            os.fsync(out.fileno())
        os.replace(temporary, path)


class DigestFile:
    """A mapped digest array."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        n = int(np.frombuffer(self.map, np.uint64, 1)[0])
        self.digest = np.frombuffer(self.map, np.uint64, n, 8)
        self.starts = np.frombuffer(self.map, np.uint64, 2 * n + 1, 8 + 8 * n)
        self.base = 8 + 8 * n + 8 * (2 * n + 1)

    def _part(self, i: int) -> bytes:
        a, b = int(self.starts[i]), int(self.starts[i + 1])
        return self.map[self.base + a : self.base + b]

    def lookup(self, digest: np.ndarray, key: Callable[[int], bytes]):
        """(number, value) of every digest whose key, made on demand, is stored."""
        at = np.searchsorted(self.digest, digest)
        for i in np.flatnonzero(self.digest[np.minimum(at, len(self.digest) - 1)] == digest).tolist():
            j, own = int(at[i]), key(i)
            while j < len(self.digest) and self.digest[j] == digest[i]:
                if self._part(2 * j) == own:
                    yield i, self._part(2 * j + 1)
                    break
                j += 1


class Index:
    """The files of an index, mapped when a digest of their range is first looked up.

    ``files``: (least digest, path), sorted. Fewer than 64 ``bits`` of a digest are for tests of collisions.
    """

    def __init__(self, files: list[tuple[int, str]], longest_host: int, bits: int = 64):
        self.files, self.longest_host, self.shift = files, longest_host, np.uint64(64 - bits)
        self.low = np.array([a for a, _ in files], np.uint64)
        self.open: dict[int, DigestFile] = {}

    def lookup(self, digests: list[int], key: Callable[[int], bytes]) -> dict[int, bytes]:
        """The values of the keys that are stored, by number."""
        out: dict[int, bytes] = {}
        if not digests or not self.files:
            return out
        digest = np.array(digests, np.uint64) >> self.shift
        of = np.searchsorted(self.low, digest, "right") - 1
        for f in np.unique(of[of >= 0]).tolist():
            if f not in self.open:
                self.open[f] = DigestFile(self.files[f][1])
            some = np.flatnonzero(of == f)
            for i, value in self.open[f].lookup(digest[some], lambda i, some=some: key(int(some[i]))):
                out[int(some[i])] = value
        return out


def host_ends(host: bytes, longest: int) -> list[bytes]:
    """The host and its parent domains of at most ``longest`` bytes, longest first."""
    out = [host] if len(host) <= longest else []
    at = host.find(b".", max(0, len(host) - longest - 1))
    while at >= 0:
        out.append(host[at + 1 :])
        at = host.find(b".", at + 1)
    return out


def _head(host: bytes) -> bytes:
    """What the key of a rule begins with: the length of the host tells it from the path."""
    return RULE + len(host).to_bytes(4, "big") + host


def judge_some(index: Index, hosts: list[bytes], paths: list[bytes]) -> list[tuple[str, str] | None]:
    """(rule, verdict) for every URL, None where no rule fits."""
    ends = {h: host_ends(h, index.longest_host) for h in set(hosts)}
    wanted = sorted({e for all_of in ends.values() for e in all_of if e})
    digest = [xxhash.xxh64_intdigest(HOST + e, SEED) for e in wanted]
    known = index.lookup(digest, lambda i: HOST + wanted[i])
    lengths = {wanted[i]: [int(x) for x in value.split(b",")] for i, value in known.items()}
    tries, digest = [], []  # (length, length of the host, URL, host of the rule, length of its path)
    for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
        for e in ends[host]:
            sizes = lengths.get(e, ())
            if sizes:
                running, done = xxhash.xxh64(_head(e), SEED), 0
                for n in sizes:
                    if n > len(path):
                        break
                    running.update(path[done:n])
                    done = n
                    tries.append((len(e) + n, len(e), i, e, n))
                    digest.append(running.intdigest())
    hits = index.lookup(digest, lambda t: _head(tries[t][3]) + paths[tries[t][2]][: tries[t][4]])
    out: list[tuple[str, str] | None] = [None] * len(hosts)
    for t in sorted(hits, key=lambda t: tries[t][:2]):  # the longest comes last
        _, _, i, e, n = tries[t]
        out[i] = ((e + paths[i][:n]).decode(), hits[t].decode())
    return out


def entries(rules: DataFrame, bits: int = 64) -> DataFrame:
    """Rows (range, key, value, size) of an index: ``range`` sorts like the unsigned digest of ``key``."""
    host, path, verdict = (F.col(c).cast("string") for c in ("host", "path", "verdict"))
    good = rules.select(ascii_lower(host).alias("host"), path.alias("path"), verdict.alias("verdict")).dropna().filter("host != ''")
    good = good.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    size = F.octet_length("host")
    head = F.concat(F.lit(RULE), F.unhex(F.lpad(F.hex(size.cast("long")), 8, "0")))
    single = good.select(F.concat(head, F.encode("host", "UTF-8"), F.encode("path", "UTF-8")).alias("key"), F.encode("verdict", "UTF-8").alias("value"), size.alias("size"))
    sizes = good.select("host", F.octet_length("path").alias("n")).distinct().groupBy("host").agg(F.array_sort(F.collect_list("n")).alias("n"))
    listed = F.encode(F.array_join(F.col("n").cast("array<string>"), ","), "UTF-8")
    per_host = sizes.select(F.concat(F.lit(HOST), F.encode("host", "UTF-8")).alias("key"), listed.alias("value"), size.alias("size"))
    digest = F.xxhash64("key") if bits == 64 else F.shiftrightunsigned(F.xxhash64("key"), 64 - bits)
    return single.unionAll(per_host).select(digest.bitwiseXOR(F.lit(SIGN)).alias("range"), "key", "value", "size")


def build_index(rules: DataFrame, folder: str | None = None, bits: int = 64) -> tuple[str, int]:
    """Write ``rules`` (host, path, verdict) as an index; returns its folder and the length of its longest host."""
    spark = configure(rules.sparkSession)
    folder = folder or scratch_dir(spark, "url-rules")
    local = _local(folder)
    held = entries(rules, bits)
    size = held.agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("longest")).first()
    files = max(1, min(FILES, -(-size["n"] // FILE_ROWS)))
    ordered = held.drop("size").repartitionByRange(files, "range").sortWithinPartitions("range", "key")

    def write(batches):
        out = FileWriter()
        for batch in batches:
            for row in batch.to_pylist():
                out.add(row["range"] - SIGN, row["key"], row["value"])
        if out.digests:
            os.makedirs(local, exist_ok=True)
            out.save(os.path.join(local, f"{out.digests[0]:016x}.digests"))
        yield pa.RecordBatch.from_arrays([pa.array([len(out.digests)])], ["entries"])

    ordered.mapInArrow(write, "entries long").agg(F.sum("entries")).collect()
    return folder, size["longest"] or 0


def open_index(folder: str, longest_host: int, bits: int = 64) -> Index:
    """The index of a folder, with no more in memory than the names of its files."""
    local = _local(folder)
    names = sorted(x for x in os.listdir(local) if x.endswith(".digests")) if os.path.isdir(local) else []
    return Index([(int(x.split(".")[0], 16), os.path.join(local, x)) for x in names], longest_host, bits)


def judge_urls(
    pages: DataFrame, index: tuple[str, int], url: str = "url", default: str = ALLOW, into: str = "judged", bits: int = 64
) -> DataFrame:
    """``pages`` with a struct of host, path, rule (null where none fits) and verdict."""
    configure(pages.sparkSession)
    folder, longest = index
    host, path = split_url(F.col(url).cast("string"))

    def judge(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        opened = open_index(folder, longest, bits)
        for hosts, paths in batches:
            found = []
            for a in range(0, len(hosts), URLS_AT_ONCE):
                some = [[x.encode() for x in c.slice(a, URLS_AT_ONCE).to_pylist()] for c in (hosts, paths)]
                found += judge_some(opened, *some)
            rule = pa.array([None if f is None else f[0] for f in found], pa.string())
            verdict = pa.array([default if f is None else f[1] for f in found], pa.string())
            yield pa.StructArray.from_arrays([rule, verdict], ["rule", "verdict"])

    name = free_name(pages, into)
    cut = pages.withColumn(name, F.struct(host.alias("host"), path.alias("path")))
    told = free_name(cut, "told")
    found = F.arrow_udf(judge, FOUND)(F.col(f"{name}.host"), F.col(f"{name}.path"))
    both = F.struct(f"{name}.host", f"{name}.path", f"{told}.rule", f"{told}.verdict")
    return cut.withColumn(told, found).select(*pages.columns, both.alias(name))
