"""Traffic statistics (A1-A22, P5, P8, P9). Run these on headers without payload."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from quotemill.functions.predicates import has_prefix, is_noise

CONVERSATION = ["src_ip", "sport", "dst_ip", "dport", "ip_proto"]


def count_by(df: DataFrame, keys, n: int | None = None, name: str = "count") -> DataFrame:
    """Rows per key; with ``n`` the largest ones, keys breaking ties."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return counts if n is None else top_n(counts, [F.col(name).desc(), *keys], n)


def top_n(df: DataFrame, by, n: int) -> DataFrame:
    return df.orderBy(*by).limit(n)


def with_name(df: DataFrame, key: str, names, default: str = "unknown") -> DataFrame:
    """Add ``name``. Fixed dictionaries become a map literal, tables a left join."""
    if isinstance(names, dict):
        pairs = [F.lit(x) for kv in names.items() for x in kv]
        found = F.try_element_at(F.create_map(*pairs), F.col(key).cast("int"))
        return df.withColumn("name", F.coalesce(found, F.lit(default)))
    return df.join(names.select(key, "name"), key, "left").withColumn(
        "name", F.coalesce("name", F.lit(default))
    )


def endpoint_counts(df: DataFrame) -> DataFrame:
    """Packets per source and per destination endpoint, from one scan."""
    ends = F.array(
        F.struct(F.lit("src").alias("side"), F.col("src_ip").alias("ip"), F.col("sport").alias("port")),
        F.struct(F.lit("dst").alias("side"), F.col("dst_ip").alias("ip"), F.col("dport").alias("port")),
    )
    return count_by(df.select(F.inline(ends)), ["side", "ip", "port"])


def per_minute(df: DataFrame, ts: str, nbytes: str, tz: str) -> DataFrame:
    minute = F.date_format(F.from_utc_timestamp(ts, tz), "yyyy-MM-dd HH:mm")
    return df.groupBy(minute.alias("minute")).agg(
        F.count(F.lit(1)).alias("count"), F.sum(nbytes).alias("bytes")
    )


def prefix_hits(df: DataFrame, payload, magic: bytes) -> DataFrame:
    hit = has_prefix(payload, magic)
    return df.agg(F.count_if(hit).alias("hits"), F.count_if(~hit).alias("misses"))


def totals(df: DataFrame, matched, nbytes: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("packets"),
        F.count_if(matched).alias("matched"),
        F.sum(nbytes).alias("payload_bytes"),
    )


def time_span(df: DataFrame, ts: str, tz: str) -> DataFrame:
    """First and last time as local text."""

    def local(c):
        return F.date_format(F.from_utc_timestamp(c, tz), "yyyy-MM-dd HH:mm:ss.SSSSSS")

    return df.agg(local(F.min(ts)).alias("first_time"), local(F.max(ts)).alias("last_time"))


def flow_stats(df: DataFrame, ts_us: str = "ts_us", nbytes: str = "payload_len") -> DataFrame:
    """Per five-tuple: packets, bytes, first and last time, duration and average rate."""
    flows = df.groupBy(*CONVERSATION).agg(
        F.count(F.lit(1)).alias("pkts"),
        F.sum(nbytes).alias("bytes"),
        F.min(ts_us).alias("first_us"),
        F.max(ts_us).alias("last_us"),
    )
    lasted = F.col("last_us") - F.col("first_us")
    # Bytes of a flow times a million exceed 63 bits from 9.2 TB on.
    rate = F.call_function("div", F.col("bytes").cast("decimal(19,0)") * F.lit(1_000_000).cast("decimal(7,0)"), lasted.cast("decimal(19,0)"))
    return flows.withColumn("duration_us", lasted).withColumn(
        "avg_bps", F.when(lasted > 0, rate).otherwise(F.lit(0)).cast("long")
    )


def with_noise(flows: DataFrame) -> DataFrame:
    return flows.withColumn(
        "noise", is_noise(F.col("src_ip"), F.col("sport"), F.col("dst_ip"), F.col("dport"))
    )


def noise_split(flows: DataFrame) -> DataFrame:
    return with_noise(flows).agg(
        F.count(F.lit(1)).alias("flows"),
        F.count_if("noise").alias("noise_flows"),
        F.count_if(~F.col("noise")).alias("business_flows"),
    )


def business_flows(flows: DataFrame, n: int = 10) -> DataFrame:
    """Largest flows that are not noise."""
    kept = with_noise(flows).filter(~F.col("noise")).drop("noise")
    return top_n(kept, [F.col("bytes").desc(), *CONVERSATION], n)


def target_flow_rows(packets: DataFrame, flows: DataFrame) -> DataFrame:
    """Packets to or from the port of the largest business flow (one-row lookup)."""
    port = business_flows(flows, 1).select("dport").scalar()
    return packets.filter((F.col("dport") == port) | (F.col("sport") == port))


def relative_histogram(df: DataFrame, ts_us: str, width_s: int = 60) -> DataFrame:
    """Rows per bucket since the first row, empty buckets included.

    As in a histogram with closed last edge, a last row exactly on an edge counts in the bucket
    before it.
    """
    width = width_s * 1_000_000
    first = df.agg(F.min(ts_us)).scalar()
    lasted = df.agg((F.max(ts_us) - F.min(ts_us)).alias("d")).scalar()

    def div(a):
        return F.call_function("div", a, F.lit(width))

    top = F.greatest(div(lasted + F.lit(width - 1)) - 1, F.lit(0))
    counts = (
        df.withColumn("bucket", F.least(div(F.col(ts_us) - first), top))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    last = counts.agg(F.max("bucket").alias("m"))
    every = last.select(F.explode(F.sequence(F.lit(0).cast("long"), "m")).alias("bucket"))
    return every.join(counts, "bucket", "left").select(
        "bucket", F.coalesce("count", F.lit(0)).cast("long").alias("count")
    )


def channel_stats(frames: DataFrame, keys=("type", "subtype")) -> DataFrame:
    """Frames, bytes and inflate results per channel."""
    return frames.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("frames"),
        F.sum("length").alias("bytes"),
        F.count_if("zip_ok").alias("zip_ok"),
        F.count_if("bad_inflate").alias("zip_fail"),
    )


def label_text(body):
    """Bytes 5 to 8 of a body as text, or as \\x hex when not printable; null when too short."""
    label = F.substring(body, 5, 4)
    text = F.hex(label)
    printable = text.rlike("^(?:[2-6][0-9A-F]|7[0-9A-E]){4}$")
    return F.when(
        F.octet_length(body) >= 8,
        F.when(printable, label.cast("string")).otherwise(F.concat(F.lit("\\x"), F.lower(text))),
    )


def label_histogram(df: DataFrame, body, keys=()) -> DataFrame:
    labelled = df.withColumn("label", label_text(body)).filter(F.col("label").isNotNull())
    return count_by(labelled, [*keys, "label"])


def value_histograms(df: DataFrame, columns, n: int = 20) -> DataFrame:
    """(field, value, count): the n most frequent values of each column, nulls included, bytes as hex."""
    binary = {f.name for f in df.schema.fields if f.dataType == BinaryType()}
    text = {c: F.hex(c) if c in binary else F.col(c).cast("string") for c in columns}
    long = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("field"), text[c].alias("value"))
                    for c in columns
                ]
            )
        )
    )
    counts = count_by(long, ["field", "value"])
    rank = F.row_number().over(
        Window.partitionBy("field").orderBy(F.col("count").desc(), F.col("value").asc_nulls_first())
    )
    return counts.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def preview(df: DataFrame, payload, keys, order, n: int = 20, n_bytes: int = 64) -> DataFrame:
    """First n rows by ``order`` with their first bytes as hex and printable text."""
    head = F.substring(payload, 1, n_bytes)
    # One character per byte, then everything outside printable ASCII becomes a dot.
    text = F.regexp_replace(F.decode(head, "ISO-8859-1"), "[^\\x20-\\x7e]", ".")
    return top_n(df, order, n).select(*keys, F.lower(F.hex(head)).alias("hex"), text.alias("ascii"))


def sample_where(df: DataFrame, pred, n: int, order) -> DataFrame:
    """First n matching rows by ``order``."""
    return top_n(df.filter(pred), order, n)


def utf16_text(payload):
    """Little-endian UTF-16 text of a payload, as the heartbeat samples carry."""
    return F.decode(payload, "UTF-16LE")
