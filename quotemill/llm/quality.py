"""Quality rules with adaptive thresholds.

Every document gets counts that do not depend on others, fixed base rules reject the hopeless ones,
and the rest is judged against its own language and source. Per (language, source) and measure a
log-linear histogram is kept: values are integers, a bucket is a power of two cut into
2**SKETCH_BITS equal parts, so a sketch has at most 64 * 2**SKETCH_BITS buckets whatever the input,
two sketches merge by adding counts, a quantile is exact within 1 / 2**SKETCH_BITS of its value, and
the result does not depend on how the rows are split. A threshold is
``median + FENCE * max(upper quantile - median, width)``: it moves with what is normal in the group, up and
down, and there are no fixed cutoffs. The width per measure is the least spread that counts as one,
as groups in which nearly all documents have the same value must not lose their tail. Groups under
MIN_GROUP documents use the sketch of all documents.

Null text has no words and fails the base rules; null language or source is a group of its own;
repeated rows are judged row by row; an empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import free_name
from quotemill.session import configure

SKETCH_BITS = 5
MIN_GROUP = 50
UPPER = 0.75
FENCE = 3
SYMBOLS = b"#*$%&|<>"
# measure -> the least spread of a group that counts, in thousandths (word_len: of a character)
WIDTHS = {
    "symbol_rate": 20,
    "dup_line_rate": 130,
    "repeat_rate": 80,
    "upper_rate": 50,
    "word_len": 500,
    "short_word_rate": 60,
}
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long, n_letters long, n_lines long, n_short long"

_SPACE_OUT = bytes(i for i in range(256) if i not in SYMBOLS)
_UPPER_OUT = bytes(i for i in range(256) if not 65 <= i <= 90)
_ASCII_OUT = bytes(i for i in range(256) if not (65 <= i <= 90 or 97 <= i <= 122))
_TAIL = bytes(range(0x80, 0xC0))


def _repeated(words: list[bytes]) -> int:
    """Words covered by a 3-word window that occurs at least twice."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    v = len(number)
    pair = np.unique(ids[:-1] * v + ids[1:], return_inverse=True)[1]
    _, window, count = np.unique(pair[:-1] * v + ids[2:], return_inverse=True, return_counts=True)
    hit = count[window] > 1
    cover = np.zeros(n, bool)
    for k in range(3):
        cover[k : n - 2 + k] |= hit
    return int(cover.sum())


def measure(data: bytes) -> tuple[int, ...]:
    """The counts of one text, in the order of COUNTS."""
    words = data.split()
    joined = b"".join(words)
    word_chars = len(joined) - len(joined.translate(None, bytes(set(range(256)) - set(_TAIL))))
    seen, dup, lines = set(), 0, 0
    for line in data.split(b"\n"):
        if not line.strip():
            continue
        lines += 1
        if line in seen:
            dup += 1
        seen.add(line)
    return (
        len(words),
        word_chars,
        len(data.translate(None, _SPACE_OUT)),
        dup,
        _repeated(words),
        len(data.translate(None, _UPPER_OUT)),
        len(data.translate(None, _ASCII_OUT)),
        lines,
        sum(len(w) <= 3 for w in words),
    )


def document_counts(docs: DataFrame, text: str = "text", into: str = "m") -> DataFrame:
    """``docs`` with a struct ``into`` of the counts (see COUNTS)."""

    def count(column: pa.Array) -> pa.Array:
        rows = [measure(x or b"") for x in column.cast(pa.binary()).to_pylist()]
        names = [c.split()[0] for c in COUNTS.split(", ")]
        data = np.array(rows, np.int64).reshape(len(rows), len(names))
        return pa.StructArray.from_arrays([pa.array(data[:, i]) for i in range(len(names))], names)

    return docs.withColumn(into, F.arrow_udf(count, f"struct<{COUNTS.replace(' long', ':bigint')}>")(F.col(text)))


def _rate(part: str, whole: str, counts: str = "m"):
    share = F.floor(F.col(f"{counts}.{part}") * 1000 / F.col(f"{counts}.{whole}"))
    return F.when(F.col(f"{counts}.{whole}") > 0, share).otherwise(0).cast("long")


# measure -> the counts whose ratio it is
RATES = {
    "symbol_rate": ("n_symbols", "word_chars"),
    "dup_line_rate": ("n_dup_lines", "n_lines"),
    "repeat_rate": ("n_repeat_words", "n_words"),
    "upper_rate": ("n_upper", "n_letters"),
    "word_len": ("word_chars", "n_words"),
    "short_word_rate": ("n_short", "n_words"),
}


def measures() -> dict:
    """Whole-number measures of a counted document."""
    return {n: _rate(part, whole) for n, (part, whole) in RATES.items()}


def bucket(value, bits: int = SKETCH_BITS):
    """Bucket of a whole number >= 0; buckets keep the order of values."""
    shift = F.greatest(F.length(F.bin(value)) - (bits + 1), F.lit(0))
    return F.call_function("shiftright", value, shift).cast("long") + F.call_function("shiftleft", shift.cast("long"), F.lit(bits))


def bucket_low(b, bits: int = SKETCH_BITS):
    """Smallest value of a bucket."""
    shift = F.greatest(F.call_function("shiftright", b, F.lit(bits)) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", b - F.call_function("shiftleft", shift.cast("long"), F.lit(bits)), shift)


def sketches(counted: DataFrame, groups: list[str], names=None) -> DataFrame:
    """One row per group, measure and bucket with its count; sketches merge by adding counts."""
    names = names or list(measures())
    values = F.array(*[F.struct(F.lit(n).alias("measure"), bucket(measures()[n]).alias("bucket")) for n in names])
    return counted.select(*groups, F.explode(values).alias("x")).groupBy(*groups, "x.measure", "x.bucket").agg(F.count(F.lit(1)).alias("n"))


def thresholds(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """Threshold per group and measure. A group has at most 64 * 2**SKETCH_BITS rows here."""
    cells = F.array_sort(F.collect_list(F.struct("bucket", "n")))
    held = sketch.groupBy(*groups, "measure").agg(cells.alias("cells"), F.sum("n").alias("docs"))
    running = F.aggregate(
        "cells",
        F.struct(F.lit(0).cast("long").alias("seen"), F.lit(-1).cast("long").alias("mid"), F.lit(-1).cast("long").alias("top")),
        lambda a, x: F.struct(
            (a["seen"] + x["n"]).alias("seen"),
            F.when((a["mid"] < 0) & ((a["seen"] + x["n"]) * 2 >= F.col("docs")), x["bucket"]).otherwise(a["mid"]).alias("mid"),
            F.when((a["top"] < 0) & ((a["seen"] + x["n"]) >= F.col("docs") * UPPER), x["bucket"]).otherwise(a["top"]).alias("top"),
        ),
    )
    held = held.withColumn("q", running)
    median = bucket_low(F.col("q.mid"))
    width = F.create_map(*[F.lit(x) for n, w in WIDTHS.items() for x in (n, w)])[F.col("measure")]
    threshold = median + FENCE * F.greatest(bucket_low(F.col("q.top")) - median, width.cast("long"))
    return held.select(*groups, "measure", "docs", threshold.alias("threshold"))


def adaptive_limits(counted: DataFrame, lang: str, source: str) -> DataFrame:
    """One row per (language, source) with a column ``max_<measure>`` per measure."""
    groups = ["_lang", "_source"]
    sketch = sketches(counted.withColumns({"_lang": F.col(lang), "_source": F.col(source)}), groups)
    own = thresholds(sketch, groups)
    merged = thresholds(sketch.groupBy("measure", "bucket").agg(F.sum("n").alias("n")), [])
    both = own.join(F.broadcast(merged.select("measure", F.col("threshold").alias("overall"))), "measure")  # one row per measure
    value = F.when(F.col("docs") >= MIN_GROUP, F.col("threshold")).otherwise(F.col("overall"))
    return both.groupBy(*groups).agg(*[F.max(F.when(F.col("measure") == n, value)).alias(f"max_{n}") for n in WIDTHS])


OWN = "_judged"


def _judged(docs: DataFrame, text: str, lang: str, source: str) -> tuple[DataFrame, str]:
    """``docs`` and one struct, under a name of its own: counts ``m``, base_failed, failed, kept."""
    own, group, limit, over = (free_name(docs, n) for n in (OWN, "_group", "_limits", "_over"))
    counted = document_counts(docs.select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text")), "text")
    limits = adaptive_limits(counted.drop("text"), "lang", "source")
    named = limits.select(
        F.struct("_lang", "_source").alias(group), F.struct(*[f"max_{n}" for n in WIDTHS]).alias(limit)
    )
    same = F.col(lang).eqNullSafe(F.col(f"{group}._lang")) & F.col(source).eqNullSafe(F.col(f"{group}._source"))
    joined = document_counts(docs, text, over).join(named, same, "left")
    measured = {n: _rate(a, b, over) for n, (a, b) in RATES.items()}
    failed = F.array_compact(F.array(*[F.when(v > F.col(f"{limit}.max_{n}"), F.lit(n)) for n, v in measured.items()]))
    bad = (F.col(f"{over}.n_words") < 50) | (100 * F.col(f"{over}.n_repeat_words") > 50 * F.col(f"{over}.n_words"))
    verdict = F.struct(F.col(over).alias("m"), bad.alias("base_failed"), failed.alias("failed"), (~bad & (F.size(failed) == 0)).alias("kept"))
    return joined.select(*docs.columns, verdict.alias(own)), own


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``docs`` with ``m`` (the counts), ``base_failed``, ``failed`` (measures over their threshold) and ``kept``.

    Texts are read twice and never shuffled: once for the sketches, once for the verdict. Columns of the input come
    back as they are; where one has the name of a result, the result takes the name with underscores added.
    """
    configure(docs.sparkSession)
    judged, own = _judged(docs, text, lang, source)
    return judged.select(*docs.columns, *[F.col(f"{own}.{n}").alias(free_name(docs, n)) for n in ("m", "base_failed", "failed", "kept")])


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns only, whatever their names."""
    configure(docs.sparkSession)
    judged, own = _judged(docs, "text", "lang", "source")
    return judged.filter(f"{own}.kept").select(*docs.columns)
