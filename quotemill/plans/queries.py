"""Registered queries: name -> job over a table folder, with the SQL that checks it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.functions import delta, fields, predicates
from quotemill.operators import (
    checks,
    framing,
    packets,
    reassembly,
    reconcile,
    records,
    routing,
    snapshots,
    ticks,
    traffic,
)
from quotemill.operators.scan import block_of
from quotemill.plans import batch, fixtures, jobs, reports
from quotemill.plans import sqltext as sql
from quotemill.plans.fixtures import table
from quotemill.session import configure, scratch_dir, staged
from quotemill.sources import pcap, segments, tables
from quotemill.streaming import decode as streaming

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TZ = "Asia/Shanghai"
TICK_FIELDS = sql.TICK_FIELDS.split(", ")
LINE_ORDER = sql.LINE_ORDER.split(", ")
SMALL_BLOCK = 64 << 10
STREAM_BATCH = 16 << 20


def query(oracle: str | None = None):
    def register(job):
        def run(spark, sf_dir):
            return job(configure(spark), sf_dir)

        QUERIES[job.__name__] = run
        if oracle:
            ORACLES[job.__name__] = oracle
        return job

    return register


def traffic_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(*_split(sql.TRAFFIC_SPARK))
    return rows.withColumns({"file": F.lit("memory"), "capture_seq": F.col("event_id")})


def _split(text):
    """Top-level comma split of a select list."""
    parts, depth, start = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "(") - (c == ")")
        if c == "," and depth == 0:
            parts.append(text[start:i])
            start = i + 1
    return [*parts, text[start:]]


def delta_rows(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "*",
        "event_id div 50 as frame",
        "cast(get_json_object(props, '$.k') as bigint) as k",
        "event_id % 3 = 0 as present",
    )


# ---- capture files, written once per session and table folder ----------------------------------

_captures: dict[tuple, str] = {}


def capture(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Folder with a capture derived from ``events``; packets are written, then read back."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _captures:
        folder = scratch_dir(spark, kind)
        derived = fixtures.tick_projection(spark, sf_dir)
        if kind == "v1":
            blobs = fixtures.v1_blobs(derived)
            made = fixtures.capture_packets(blobs, copies=1, faults=True, port=5261)
        else:
            blobs = fixtures.step_blobs(fixtures.tick_frames(derived))
            made = fixtures.capture_packets(blobs, copies=2, faults=True)
        segments.write_segments(made, folder, "cap", max_bytes=4 << 20)
        _captures[key] = folder
    return _captures[key]


def captured(spark, sf_dir):
    return segments.read_segments(spark, capture(spark, sf_dir, "step"), "cap")


def once(spark, sf_dir, name, make):
    """A written table shared by the queries of a session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _tables:
        _tables[key] = make()
    return _tables[key]


_tables: dict[tuple, DataFrame] = {}


def captured_tcp(spark, sf_dir):
    return once(spark, sf_dir, "step", lambda: batch.landed_tcp(spark, capture(spark, sf_dir, "step"), "cap", 9129))


def step_events(spark, sf_dir):
    """Frames, parts and lost bytes of the capture, cut once."""

    def make():
        return framing.cut_events(captured_tcp(spark, sf_dir), framing.StepFrames, SMALL_BLOCK)

    return once(spark, sf_dir, "step-events", make)


RULES = [
    {"category_id": 9, "msg_type": 5803, "output": "ticks", "dedup": True},
    {"category_id": 6, "msg_type": 3202, "output": "snapshots", "dedup": True},
]


# ---- decoding -----------------------------------------------------------------------------------


@query(sql.with_(sql.TICKS, f"SELECT {sql.TICK_FIELDS} FROM ticks"))
def ticks_roundtrip(spark, sf_dir):
    """Two copies of every frame, decoded, first arrival kept."""
    frames = fixtures.tick_frames(fixtures.tick_projection(spark, sf_dir))
    twice = frames.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    decoded = ticks.valid_ticks(ticks.decode_ticks(twice.select("copy", "frame_no", "payload")))
    first = routing.first_arrival(
        decoded, ["channel", "biz_index"], ["copy", "frame_no", "rec_idx"]
    )
    return first.select(*TICK_FIELDS)


@query(sql.with_(sql.TICKS, f"SELECT {sql.TICK_FIELDS} FROM ticks"))
def capture_ticks(spark, sf_dir):
    """The whole batch pipeline: segments to packets, frames, routing, ticks, first arrival."""
    folder = capture(spark, sf_dir, "step")
    outputs = batch.decode_segments(spark, folder, "cap", RULES, 9129, SMALL_BLOCK)
    return outputs["ticks"].select(*TICK_FIELDS)


@query(
    sql.with_(
        sql.TICKS,
        """
        , flawed AS (
          SELECT biz_index, channel, (biz_index - 1) // 50 AS frame_no,
            (action <> 'S' AND event_id % 97 = 0) OR (action = 'T' AND event_id % 53 = 0) AS bad,
            CASE WHEN action <> 'S' AND event_id % 97 = 0 THEN 'bs_flag' ELSE 'price_qty_money' END AS why
          FROM ticks),
        counted AS (
          SELECT *, sum(CAST(bad AS INT)) OVER (
            PARTITION BY channel, frame_no ORDER BY biz_index) AS seen FROM flawed)
        SELECT channel, biz_index, CASE WHEN bad THEN why END AS reject_reason
        FROM counted WHERE seen = 0 OR (bad AND seen = 1)
        """,
    )
)
def ticks_stop_at_bad(spark, sf_dir):
    """D8, D9 on the wire: a bad record ends its frame and leaves a reason."""
    good = fixtures.tick_projection(spark, sf_dir)
    bad_flag = (F.col("action") != "S") & (F.col("event_id") % 97 == 0)
    bad_money = (F.col("action") == "T") & (F.col("event_id") % 53 == 0)
    flawed = good.withColumn("bs_flag", F.when(bad_flag, "X").otherwise(F.col("bs_flag"))).withColumn(
        "money_e5", F.when(bad_money, F.col("money_e5") + 1).otherwise(F.col("money_e5"))
    )
    decoded = ticks.decode_ticks(fixtures.tick_frames(flawed).select("payload"))
    return decoded.select("channel", "biz_index", "reject_reason")


def book_text(levels):
    def level(v):
        return F.concat_ws(":", v["price"], v["qty"], v["num_orders"], F.array_join(v["orders"], "/"))

    return F.array_join(F.transform(levels, level), ";")


_SNAPSHOT_SCALARS = (
    "security_id, tick_time, data_status, image_status, open_px, last_px, iopv, num_trades, "
    "total_volume, instrument_status, trading_phase_code"
)


def _book_sql(count, sign):
    return (
        f"array_to_string(list_transform(range(1, {count} + 1), lambda i: concat_ws(':', "
        f"px {sign} i * 10, lot * i, i % 3, array_to_string(list_transform(range(1, i % 3 + 1), "
        f"lambda j: lot * j), '/'))), ';')"
    )


@query(
    sql.with_(
        sql.SNAPSHOTS,
        f"""
        SELECT {_SNAPSHOT_SCALARS}, CAST(0 AS BIGINT) AS close_px, {_book_sql('n', '-')} AS bid_book,
          {_book_sql('n % 3', '+')} AS offer_book FROM book
        """,
    )
)
def snapshots_roundtrip(spark, sf_dir):
    """One snapshot per line with levels and order queues."""
    frames = fixtures.snapshot_frames(fixtures.snapshot_projection(spark, sf_dir))
    decoded = snapshots.valid_snapshots(snapshots.decode_snapshots(frames))
    return decoded.select(
        *_SNAPSHOT_SCALARS.split(", "),
        "close_px",
        book_text("bid_levels").alias("bid_book"),
        book_text("offer_levels").alias("offer_book"),
    )


@query(
    sql.with_(
        sql.DELTA,
        """
        SELECT event_id, coalesce(last_value(CASE WHEN present THEN k END IGNORE NULLS) OVER w, 0) AS k_copy,
          coalesce(last_value(CASE WHEN present THEN event_type END IGNORE NULLS) OVER w, '') AS type_copy
        FROM delta WINDOW w AS (PARTITION BY frame ORDER BY event_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        """,
    )
)
def ffill_copy(spark, sf_dir):
    rows = delta_rows(spark, sf_dir)
    return rows.select(
        "event_id",
        delta.fast_copy(F.col("k"), F.col("present"), "frame", "event_id").alias("k_copy"),
        delta.fast_copy(F.col("event_type"), F.col("present"), "frame", "event_id", "").alias("type_copy"),
    )


@query(
    sql.with_(
        sql.DELTA,
        """
        , wire AS (SELECT *, CASE WHEN k % 5 <> 0 THEN k END AS v FROM delta)
        SELECT event_id, CASE WHEN present AND v IS NULL THEN 0 ELSE
          coalesce(last_value(CASE WHEN present THEN v END IGNORE NULLS) OVER w, 0) END AS k_copy
        FROM wire WINDOW w AS (PARTITION BY frame ORDER BY event_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        """,
    )
)
def ffill_copy_null(spark, sf_dir):
    rows = delta_rows(spark, sf_dir).withColumn("v", F.when(F.col("k") % 5 != 0, F.col("k")))
    return rows.select(
        "event_id",
        delta.fast_copy_nullable(F.col("v"), F.col("present"), "frame", "event_id").alias("k_copy"),
    )


@query(
    sql.with_(
        sql.DELTA,
        """
        , runs AS (
          SELECT *, sum(CAST(present AS INT)) OVER (PARTITION BY frame ORDER BY event_id) AS run FROM delta),
        placed AS (
          SELECT *, row_number() OVER (PARTITION BY frame, run ORDER BY event_id) AS nth,
            first_value(k) OVER (PARTITION BY frame, run ORDER BY event_id) AS start_k FROM runs)
        SELECT event_id, CASE WHEN run = 0 THEN nth ELSE start_k + nth - 1 END AS k_increment FROM placed
        """,
    )
)
def ffill_increment(spark, sf_dir):
    return delta_rows(spark, sf_dir).select(
        "event_id",
        delta.fast_increment(
            F.col("k"), F.col("present"), F.col("event_id"), "frame", "event_id"
        ).alias("k_increment"),
    )


@query(
    sql.with_(
        sql.DELTA,
        """
        SELECT event_id, CASE WHEN present THEN k ELSE 0 END AS k_default,
          CASE WHEN present AND k <> 0 THEN k - 1 ELSE 0 END AS k_nullable FROM delta
        """,
    )
)
def default_zero(spark, sf_dir):
    explicit = F.when(F.col("present"), F.col("k"))
    return delta_rows(spark, sf_dir).select(
        "event_id",
        delta.fast_default(explicit).alias("k_default"),
        delta.fast_default(delta.from_nullable(explicit)).alias("k_nullable"),
    )


@query(
    sql.with_(
        sql.DELTA,
        """
        SELECT event_id, CASE event_type WHEN 'purchase' THEN k * 1000 ELSE k * 100000 END AS money_e5
        FROM delta
        """,
    )
)
def tick_money(spark, sf_dir):
    rows = delta_rows(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_type") == "purchase", "T").otherwise("A").alias("action"),
        (F.col("k") * 1000).alias("money_wire"),
    )
    return ticks.normalise_money(rows).select("event_id", "money_e5")


_FLAWED_SQL = """
    , flawed AS (
      SELECT event_id, action, price_e3, qty_e3, 5803 + CAST(event_id % 211 = 0 AS INT) AS template_id,
        CASE WHEN event_id % 101 = 0 THEN security_id || '0' ELSE security_id END AS security_id,
        CASE WHEN event_id % 97 = 0 THEN 'X' ELSE bs_flag END AS bs_flag,
        money_e5 + CAST(event_id % 53 = 0 AS INT) AS money_e5 FROM ticks),
    checked AS (
      SELECT event_id, CASE WHEN template_id <> 5803 THEN 'template_id'
        WHEN length(security_id) <> 6 THEN 'security_id' WHEN length(action) <> 1 THEN 'action'
        WHEN action <> 'S' AND bs_flag NOT IN ('B', 'S', 'N') THEN 'bs_flag'
        WHEN action = 'T' AND price_e3 * qty_e3 <> money_e5 * 10 THEN 'price_qty_money' END AS reject_reason
      FROM flawed)
"""


def _flawed(spark, sf_dir):
    rows = fixtures.tick_projection(spark, sf_dir)
    e = F.col("event_id")
    return rows.withColumns(
        {
            "template_id": F.lit(5803) + (e % 211 == 0).cast("int"),
            "security_id": F.when(e % 101 == 0, F.concat("security_id", F.lit("0"))).otherwise(
                F.col("security_id")
            ),
            "bs_flag": F.when(e % 97 == 0, "X").otherwise(F.col("bs_flag")),
            "money_e5": F.col("money_e5") + (e % 53 == 0).cast("long"),
        }
    )


@query(sql.with_(sql.TICKS, _FLAWED_SQL + "SELECT event_id, reject_reason FROM checked"))
def tick_rejects(spark, sf_dir):
    return ticks.validate_ticks(_flawed(spark, sf_dir)).select("event_id", "reject_reason")


@query(
    sql.with_(
        sql.TICKS,
        _FLAWED_SQL
        + """
        , seen AS (SELECT event_id, max(CASE WHEN reject_reason IS NULL THEN 0 ELSE 1 END) OVER (
          PARTITION BY event_id // 50 ORDER BY event_id) AS bad FROM checked)
        SELECT event_id FROM seen WHERE bad = 0
        """,
    )
)
def until_first_bad(spark, sf_dir):
    rows = ticks.validate_ticks(_flawed(spark, sf_dir)).withColumn("frame", block_of(F.col("event_id"), 50))
    kept = ticks.until_first_bad(rows, F.col("reject_reason").isNotNull(), ["frame"], ["event_id"])
    return kept.select("event_id")


@query(
    sql.with_(
        sql.SNAPSHOTS,
        """
        SELECT l_orderkey, security_id, side, i AS level, price, lot * i AS qty, i % 3 AS num_orders
        FROM levels
        """,
    )
)
def book_levels(spark, sf_dir):
    return snapshots.book_levels(
        fixtures.snapshot_projection(spark, sf_dir), ["l_orderkey", "security_id"]
    )


@query(
    sql.with_(
        sql.SNAPSHOTS,
        """
        SELECT l_orderkey, security_id, side, i AS level, j AS position, lot * j AS order_qty
        FROM levels, range(1, 3) AS u(j) WHERE j <= i % 3
        """,
    )
)
def book_orders(spark, sf_dir):
    return snapshots.book_orders(
        fixtures.snapshot_projection(spark, sf_dir), ["l_orderkey", "security_id"]
    )


def _wide_sql():
    out = []
    for side, count, sign in (("bid", "n", "-"), ("offer", "n % 3", "+")):
        for i in range(1, 11):
            out.append(f"CASE WHEN {count} >= {i} THEN px {sign} {i * 10} ELSE 0 END AS {side}_px_{i}")
            out.append(f"CASE WHEN {count} >= {i} THEN lot * {i} ELSE 0 END AS {side}_qty_{i}")
    return ", ".join(out)


@query(sql.with_(sql.SNAPSHOTS, f"SELECT l_orderkey, security_id, {_wide_sql()} FROM book"))
def book_wide(spark, sf_dir):
    books = fixtures.snapshot_projection(spark, sf_dir).select(
        "l_orderkey", "security_id", "bid_levels", "offer_levels"
    )
    return snapshots.book_wide(books)


@query(sql.with_(sql.TICKS, "SELECT count(*) AS records FROM ticks WHERE action = 'S'"))
def tid_split(spark, sf_dir):
    frames = fixtures.status_frames(fixtures.tick_projection(spark, sf_dir))
    return records.split_by_tid(frames).agg(F.count(F.lit(1)).alias("records"))


@query(
    sql.with_(
        sql.TICKS,
        """
        SELECT concat_ws(',', biz_index, channel) AS prefix_ints, security_id AS sec_id,
          CASE WHEN tick_time = 0 THEN '83' ELSE concat_ws(',', tick_time + 1, 83) END AS mid_ints,
          bs_flag AS status, CAST(NULL AS INT) AS trailer
        FROM ticks WHERE action = 'S'
        """,
    )
)
def status_records(spark, sf_dir):
    frames = fixtures.status_frames(fixtures.tick_projection(spark, sf_dir))
    found = records.status_records(records.split_by_tid(frames))
    return found.select(
        F.array_join("prefix_ints", ",").alias("prefix_ints"),
        "sec_id",
        F.array_join("mid_ints", ",").alias("mid_ints"),
        "status",
        "trailer",
    )


@query(
    """
    SELECT event_id, array_to_string(list_filter(range(0, 14),
      lambda i: (user_id * 131 + event_id) % 16384 // CAST(pow(2, 13 - i) AS BIGINT) % 2 = 1), ',') AS bits
    FROM events
    """
)
def pmap_bits(spark, sf_dir):
    pmap = (F.col("user_id") * 131 + F.col("event_id")) % 16384
    return table(spark, sf_dir, "events").select(
        "event_id", F.array_join(delta.pmap_bits(pmap, 14), ",").alias("bits")
    )


# ---- projections and filters --------------------------------------------------------------------


@query(sql.with_(sql.TRAFFIC, "SELECT event_id, sport, dport FROM traffic WHERE sport IN (5261, 40007) OR dport IN (5261, 40007)"))
def port_filter(spark, sf_dir):
    rows = predicates.filter_ports(traffic_rows(spark, sf_dir), [5261, 40007])
    return rows.select("event_id", "sport", "dport")


@query(sql.with_(sql.TRAFFIC, f"SELECT {sql.PROTOCOL_CLASS} AS proto, count(*) AS count FROM traffic GROUP BY 1"))
def class_counts(spark, sf_dir):
    proto = predicates.protocol_class(F.col("eth_type"), F.col("ip_proto"))
    return traffic.count_by(traffic_rows(spark, sf_dir).withColumn("proto", proto), ["proto"])


@query(
    sql.with_(
        sql.TRAFFIC,
        f"""
        SELECT {sql.PROTOCOL_CLASS} AS proto, count(*) AS count FROM traffic
        WHERE eth_type = 2048 AND (sport = 5261 OR dport = 5261) GROUP BY 1
        """,
    )
)
def class_counts_matched(spark, sf_dir):
    rows = traffic_rows(spark, sf_dir).filter(F.col("eth_type") == predicates.ETH_IPV4)
    proto = predicates.protocol_class(F.col("eth_type"), F.col("ip_proto"))
    matched = predicates.filter_ports(rows, [5261]).withColumn("proto", proto)
    return traffic.count_by(matched, ["proto"])


@query(
    """
    SELECT n_nationkey, n_name, coalesce(r_name, 'unknown') AS name
    FROM nation LEFT JOIN (SELECT * FROM region WHERE r_regionkey <> 2) ON n_regionkey = r_regionkey
    """
)
def name_lookup(spark, sf_dir):
    names = (
        table(spark, sf_dir, "region")
        .filter(F.col("r_regionkey") != 2)
        .select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("name"))
    )
    named = traffic.with_name(table(spark, sf_dir, "nation"), "n_regionkey", names)
    return named.select("n_nationkey", "n_name", "name")


@query(
    sql.with_(
        sql.FLOWS,
        """
        SELECT count(*) AS flows, count(*) FILTER (noise) AS noise_flows,
          count(*) FILTER (NOT noise) AS business_flows FROM noisy
        """,
    )
)
def noise_split(spark, sf_dir):
    return traffic.noise_split(traffic.flow_stats(traffic_rows(spark, sf_dir)))


@query(
    """
    SELECT count(*) FILTER (text LIKE 'The %') AS hits, count(*) FILTER (text NOT LIKE 'The %') AS misses
    FROM documents WHERE strlen(text) >= 4
    """
)
def prefix_hits(spark, sf_dir):
    text = F.col("text").cast("binary")
    return traffic.prefix_hits(table(spark, sf_dir, "documents"), text, b"The ")


@query(
    """
    SELECT doc_id, lower(substr(hex(encode(text)), 1, 128)) AS hex FROM documents
    WHERE source = (SELECT min(source) FROM documents) ORDER BY doc_id LIMIT 20
    """
)
def text_preview(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    first = docs.agg(F.min("source")).scalar()
    rows = docs.filter(F.col("source") == first)
    shown = traffic.preview(rows, F.col("text").cast("binary"), ["doc_id"], ["doc_id"])
    return shown.select("doc_id", "hex")


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'error' ORDER BY event_id LIMIT 5")
def sample_errors(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    kept = traffic.sample_where(rows, F.col("event_type") == "error", 5, ["event_id"])
    return kept.select("event_id", "user_id", "value")


@query(
    """
    SELECT event_id, strftime(ts, '%H:%M:%S') || '.' ||
      lpad(CAST(date_part('microseconds', ts) % 1000000 // 10000 AS VARCHAR), 2, '0') AS tick_time
    FROM events
    """
)
def tick_time_fmt(spark, sf_dir):
    rows = fixtures.tick_projection(spark, sf_dir)
    return rows.select("event_id", fields.tick_time_text(F.col("tick_time")).alias("tick_time"))


@query(
    """
    SELECT l_orderkey, l_linenumber,
      CAST(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) - 5000000 AS DECIMAL(18, 0)) / 1000
        AS DECIMAL(18, 3))::VARCHAR AS price FROM lineitem
    """
)
def fixed_decimal(spark, sf_dir):
    scaled = F.round(F.col("l_extendedprice") * 100).cast("long") - 5000000
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", fields.fixed_decimal(scaled, 3).cast("string").alias("price")
    )


@query("SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%H:%M:%S.%g') AS local_time FROM events")
def local_time_fmt(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", fields.local_time_text(F.col("ts").cast("timestamp"), TZ).alias("local_time")
    )


@query(
    """
    SELECT doc_id, quality FROM labels JOIN documents USING (doc_id)
    WHERE (quality = 1 AND NOT text LIKE 'The %') OR (quality = 0 AND text LIKE 'The %')
    """
)
def flag_mismatch(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    starts = F.col("text").startswith("The ")
    body = F.when(starts, F.lit(bytearray(framing.ZIP_HEADER))).otherwise(F.col("text").cast("binary"))
    rows = docs.withColumn("body", body)
    return framing.flag_mismatch(rows, "quality", "body").select("doc_id", "quality")


# ---- capture path -------------------------------------------------------------------------------

_PACKETS = """
    kinds AS (
      SELECT event_id, event_type, user_id % 4 + 1 AS channel, event_type = 'signup' AS is_udp,
        event_id >= 100 AND event_type = 'error' AND event_id % 5 = 0 AS repeated
      FROM events),
    sent AS (
      SELECT *, CASE WHEN repeated THEN 3 ELSE length(event_type) * 3 + event_id % 7 END AS size
      FROM kinds),
    skips AS (
      SELECT *, CASE WHEN event_id >= 100 AND NOT repeated AND event_id % 31 = 0 THEN 500 ELSE 0 END AS skip
      FROM sent),
    placed AS (
      SELECT *, coalesce(sum(CASE WHEN is_udp OR repeated THEN 0 ELSE size + skip END) OVER (
        PARTITION BY channel ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sent_before
      FROM skips),
    wire AS (
      SELECT *, CAST((4294962296 + sent_before + CASE WHEN repeated THEN -size ELSE skip END) % 4294967296 AS BIGINT)
        AS tcp_seq FROM placed)"""
_CLOCK = "1768354200000000000 + event_id * 1000"


def event_capture(spark, sf_dir, kind):
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _captures:
        folder = scratch_dir(spark, kind)
        made = fixtures.event_packets(spark, sf_dir)
        if kind == "pcap":
            fixtures.write_pcap(made, folder)
        else:
            segments.write_segments(made, folder, "ev", max_bytes=4 << 20)
        _captures[key] = folder
    return _captures[key]


def event_segments(spark, sf_dir):
    return segments.read_segments(spark, event_capture(spark, sf_dir, "event-segments"), "ev")


def event_tcp(spark, sf_dir):
    return once(spark, sf_dir, "event-tcp", lambda: batch.tcp_table(event_segments(spark, sf_dir)))


_CAPTURE_SQL = sql.with_(
    _PACKETS,
    f"""
    SELECT {_CLOCK} AS ts_ns, greatest(60, CASE WHEN is_udp THEN 42 + size ELSE 54 + size + event_id % 3 * 4 END)
      AS n_bytes FROM wire
    """,
)


@query(_CAPTURE_SQL)
def pcap_roundtrip(spark, sf_dir):
    """Packet times and sizes of pcap files, read in splits."""
    found = pcap.read_pcap(spark, event_capture(spark, sf_dir, "pcap"), split_bytes=SMALL_BLOCK)
    return found.select("ts_ns", F.octet_length("frame").cast("long").alias("n_bytes"))


@query(_CAPTURE_SQL)
def segment_roundtrip(spark, sf_dir):
    """Packet times and sizes of rotating segments."""
    found = event_segments(spark, sf_dir)
    return found.select("ts_ns", F.octet_length("frame").cast("long").alias("n_bytes"))


@query(
    sql.with_(
        _PACKETS,
        f"""
        SELECT {_CLOCK} AS ts_ns, 2048 AS eth_type, CASE WHEN is_udp THEN 17 ELSE 6 END AS ip_proto,
          '10.3.0.' || channel AS src_ip, CASE WHEN is_udp THEN 7001 ELSE 7000 END AS sport,
          '10.4.0.1' AS dst_ip, CASE WHEN is_udp THEN 1985 ELSE 51000 END AS dport,
          CASE WHEN NOT is_udp THEN tcp_seq END AS tcp_seq, CAST(size AS INTEGER) AS payload_len
        FROM wire
        """,
    )
)
def packet_headers(spark, sf_dir):
    """Headers behind zero to two VLAN tags; padding is not payload."""
    parsed = packets.parse_packets(event_segments(spark, sf_dir), with_payload=False)
    return parsed.select(
        "ts_ns", "eth_type", "ip_proto", "src_ip", "sport", "dst_ip", "dport", "tcp_seq", "payload_len"
    )


@query(
    sql.with_(
        _PACKETS,
        f"""
        SELECT {_CLOCK} AS ts_ns, '10.3.0.' || channel AS src_ip, 7000 AS sport, tcp_seq, CAST(size AS INTEGER) AS payload_len
        FROM wire WHERE NOT is_udp AND size > 15
        """,
    )
)
def pushed_headers(spark, sf_dir):
    """Ports and header filters checked where pcap files and segments are read."""
    found = [
        batch.tcp_source(spark, "capseg", event_capture(spark, sf_dir, "event-segments"), 7000, prefix="ev"),
        batch.tcp_source(spark, "pcap", event_capture(spark, sf_dir, "pcap"), 7000, split_bytes=str(SMALL_BLOCK)),
    ]
    columns = ["ts_ns", "src_ip", "sport", "tcp_seq", "payload_len"]
    a, b = (f.filter("payload_len > 15").select(*columns) for f in found)
    return a.intersectAll(b)


@query(
    sql.with_(
        _PACKETS,
        f"""
        SELECT {_CLOCK} AS ts_ns, tcp_seq, CASE
          WHEN row_number() OVER (PARTITION BY channel ORDER BY event_id) = 1 THEN 'init'
          WHEN repeated THEN 'retransmit' WHEN skip > 0 THEN 'gap' ELSE 'in_order' END AS verdict
        FROM wire WHERE NOT is_udp
        """,
    )
)
def segment_classes(spark, sf_dir):
    """R1 with repeats, gaps and a sequence wrap, across many blocks of each flow."""
    rows = event_tcp(spark, sf_dir).drop("payload")
    found = reassembly.classify_segments(rows, block_bytes=SMALL_BLOCK)
    return found.select("ts_ns", "tcp_seq", "verdict")


@query(
    sql.with_(
        _PACKETS,
        f"""
        , seen AS (
          SELECT '10.3.0.' || channel AS src, CASE WHEN is_udp THEN 7001 ELSE 7000 END AS sport, size,
            CASE WHEN is_udp THEN 'UDP' ELSE 'TCP' END AS proto, make_timestamp(({_CLOCK}) // 1000) AS ts
          FROM wire)
        SELECT 'src_ip_port' AS stat, src || ':' || sport AS key, count(*) AS count, 0 AS bytes
        FROM seen WHERE sport = 7000 GROUP BY ALL
        UNION ALL SELECT 'dst_ip_port', '10.4.0.1:51000', count(*), 0 FROM seen WHERE sport = 7000
        UNION ALL SELECT 'proto_all', proto, count(*), 0 FROM seen GROUP BY ALL
        UNION ALL SELECT 'proto_matched', proto, count(*), 0 FROM seen WHERE sport = 7000 GROUP BY ALL
        UNION ALL SELECT 'per_minute', strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M'), count(*),
          CAST(sum(size) AS BIGINT) FROM seen WHERE sport = 7000 GROUP BY ALL
        UNION ALL SELECT 'magic', 'misses', count(*) FILTER (size >= 4), 0 FROM seen WHERE sport = 7000
        """,
    )
)
def capture_stats(spark, sf_dir):
    """The statistics tables of a capture, written and read back."""
    stats = batch.traffic_tables(event_segments(spark, sf_dir), [51000], TZ)
    folder = scratch_dir(spark, "stats")
    tables.write_stats(stats, folder, "parquet")

    def back(name, key, bytes_=F.lit(0)):
        return spark.read.parquet(f"{folder}/{name}").select(
            F.lit(name).alias("stat"), key.alias("key"), "count", bytes_.cast("long").alias("bytes")
        )

    end = F.concat_ws(":", "ip", "port")
    magic = spark.read.parquet(f"{folder}/magic").select(
        F.lit("magic").alias("stat"), F.lit("misses").alias("key"),
        F.col("misses").alias("count"), F.lit(0).cast("long").alias("bytes"),
    )
    return reconcile.concat(
        back("src_ip_port", end),
        back("dst_ip_port", end),
        back("proto_all", F.col("proto")),
        back("proto_matched", F.col("proto")),
        back("per_minute", F.col("minute"), F.col("bytes")),
        magic,
    )


@query(
    sql.with_(
        """
        spans AS (
          SELECT event_id, user_id % 4 AS flow, event_id // 3 * 20 AS start, 10 + event_id * 7 % 25 AS n
          FROM events),
        firsts AS (
          SELECT * FROM spans QUALIFY row_number() OVER (PARTITION BY flow, start ORDER BY event_id) = 1),
        covered AS (
          SELECT *, max(start + n) OVER (PARTITION BY flow ORDER BY start
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS until FROM firsts)
        """,
        """
        SELECT event_id, flow, start, greatest(coalesce(until - start, 0), 0) AS skip,
          CASE WHEN until < start THEN until END AS hole_start,
          CASE WHEN until < start THEN start END AS hole_end
        FROM covered WHERE greatest(coalesce(until - start, 0), 0) < n
        """,
    )
)
def offset_merge(spark, sf_dir):
    """R2: first copy wins, overlaps trimmed, holes reported."""
    e = F.col("event_id")
    spans = table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("user_id") % 4).alias("flow"),
        (block_of(e, 3) * 20).alias("start"),
        (F.lit(10) + e * 7 % 25).alias("n"),
    )
    merged = reassembly.merge_intervals(
        spans, group=["flow"], start="start", length="n", order=["event_id"], block_width=4096
    )
    return merged.select("event_id", "flow", "start", "skip", "hole_start", "hole_end")


@query(
    sql.with_(
        _PACKETS,
        """
        SELECT '10.3.0.' || channel AS src_ip, CAST(sum(size) AS BIGINT) AS n_bytes,
          CAST(sum(skip) AS BIGINT) AS hole_bytes FROM wire WHERE NOT is_udp AND NOT repeated GROUP BY 1
        """,
    )
)
def offset_reassembly(spark, sf_dir):
    """R2 on packets: bytes kept and bytes missing per flow, numbers unwrapped past 2^32."""
    rows = event_tcp(spark, sf_dir)
    merged = reassembly.reassemble_by_offset(rows, block_bytes=SMALL_BLOCK)
    hole = F.col("hole_end") - F.col("hole_start")
    return merged.groupBy("src_ip").agg(
        F.sum(F.octet_length("payload").cast("long")).alias("n_bytes"),
        F.sum(F.coalesce(hole, F.lit(0))).alias("hole_bytes"),
    )


@query(
    sql.with_(
        sql.FRAMES,
        """
        SELECT concat('10.1.0.', channel) AS src_ip, 9129 AS sport, concat('10.2.0.', copy) AS dst_ip,
          CAST(50000 + channel AS INTEGER) AS dport, msg_seq_id, CAST(9 AS BIGINT) AS category_id,
          CAST(5803 AS BIGINT) AS msg_type, sending_time,
          CASE WHEN frame_no % 11 = 3 THEN 'ODD' ELSE 'VDE' END AS sender, 'VSS' AS target
        FROM frames, range(1, 3) AS t(copy)
        """,
    )
)
def frames_roundtrip(spark, sf_dir):
    """R1, R3, R4 across block boundaries, with repeats, gaps, junk and a sequence wrap."""
    frames = framing.cut_step_frames(captured_tcp(spark, sf_dir), block_bytes=SMALL_BLOCK)
    return frames.select(
        "src_ip", "sport", "dst_ip", "dport", "msg_seq_id", "category_id", "msg_type",
        "sending_time", "sender", "target",
    )


@query(
    sql.with_(
        sql.FRAMES,
        """
        SELECT concat('10.1.0.', channel) AS src_ip, concat('10.2.0.', copy) AS dst_ip, 'junk' AS kind,
          count(*) * 37 AS n_bytes
        FROM groups, range(1, 3) AS t(copy) WHERE group_no % 3 = 1 GROUP BY channel, copy
        """,
    )
)
def resync_report(spark, sf_dir):
    """Bytes skipped between frames."""
    return (
        framing.resync_report(step_events(spark, sf_dir))
        .groupBy("src_ip", "dst_ip", "kind")
        .agg(F.sum("n_bytes").alias("n_bytes"))
    )


@query(
    sql.with_(
        sql.FRAMES,
        """
        SELECT concat('10.1.0.', channel) AS src_ip, 9129 AS sport, concat('10.2.0.', copy) AS dst_ip,
          CAST(50000 + channel AS INTEGER) AS dport, CAST(count(*) * 37 AS BIGINT) AS lost_bytes
        FROM groups, range(1, 3) AS t(copy) WHERE group_no % 3 = 1 GROUP BY channel, copy
        """,
    )
)
def lost_bytes(spark, sf_dir):
    """Lost bytes per flow, read from the same cut as the frames."""
    return framing.lost_bytes(framing.resync_report(step_events(spark, sf_dir)))


@query(
    sql.with_(
        sql.FRAMES,
        """
        SELECT msg_seq_id, 'ODD' AS sender FROM frames, range(1, 3) AS t(copy) WHERE frame_no % 11 = 3
        """,
    )
)
def envelope_check(spark, sf_dir):
    frames = framing.whole_frames(step_events(spark, sf_dir), framing.StepFrames)
    return framing.envelope_issues(frames).select("msg_seq_id", "sender")


def v1_frames(spark, sf_dir, want=None):
    found = segments.read_segments(spark, capture(spark, sf_dir, "v1"), "cap")

    def make():
        parsed = predicates.filter_ports(packets.parse_packets(found), [5261], side="src")
        return staged(packets.tcp_with_payload(parsed), "v1-packets")

    return framing.cut_v1_frames(once(spark, sf_dir, "v1", make), want, block_bytes=SMALL_BLOCK)


@query(
    sql.with_(
        sql.FRAMES,
        """
        SELECT concat('10.1.0.', channel) AS src_ip, CAST(9 AS BIGINT) AS type, CAST(5803 AS BIGINT) AS subtype,
          frame_no + 1 AS seq,
          frame_no % 2 AS compressed, frame_no % 2 = 1 AS zip_ok, records FROM frames
        UNION ALL
        SELECT concat('10.1.0.', channel), 6, 3115, frame_no // 4 + 1, 0, false, 0
        FROM frames WHERE frame_no % 4 = 0
        """,
    )
)
def v1_frames_roundtrip(spark, sf_dir):
    """Both channels; record counts come from the inflated bodies."""
    frames = framing.inflate_body(v1_frames(spark, sf_dir))
    keys = ["src_ip", "type", "subtype", "seq", "compressed", "zip_ok"]
    tick_rows = (
        ticks.valid_ticks(
            ticks.decode_ticks(
                frames.filter(F.col("subtype") == 5803).select(*keys, "body"), payload="body"
            )
        )
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("records"))
    )
    beats = frames.filter(F.col("subtype") == 3115).select(
        *keys, F.lit(0).cast("long").alias("records")
    )
    return tick_rows.unionByName(beats)


@query(sql.with_(sql.TICKS, f"SELECT {sql.TICK_FIELDS} FROM ticks"))
def v1_ticks(spark, sf_dir):
    """One channel, filtered before inflating, decoded."""
    bodies = framing.inflate_body(v1_frames(spark, sf_dir, want=(9, 5803)))
    decoded = ticks.decode_ticks(bodies.filter(~F.col("bad_inflate")).select("body"), payload="body")
    return ticks.valid_ticks(decoded).select(*TICK_FIELDS)


@query(
    sql.with_(
        sql.TRAFFIC,
        """
        , sides AS (
          SELECT event_id, payload_len AS n,
            CASE WHEN event_id % 2 = 0 THEN src_ip ELSE dst_ip END AS a_ip,
            CASE WHEN event_id % 2 = 0 THEN sport ELSE dport END AS a_port,
            CASE WHEN event_id % 2 = 0 THEN dst_ip ELSE src_ip END AS b_ip,
            CASE WHEN event_id % 2 = 0 THEN dport ELSE sport END AS b_port
          FROM traffic),
        conns AS (
          SELECT *, first_value(a_ip) OVER w AS i_ip, first_value(a_port) OVER w AS i_port,
            first_value(b_ip) OVER w AS r_ip, first_value(b_port) OVER w AS r_port
          FROM sides WINDOW w AS (PARTITION BY least(a_ip, b_ip), greatest(a_ip, b_ip),
            CASE WHEN a_ip <= b_ip THEN a_port ELSE b_port END,
            CASE WHEN a_ip <= b_ip THEN b_port ELSE a_port END ORDER BY event_id))
        SELECT i_ip AS initiator_ip, i_port AS initiator_port, r_ip AS responder_ip,
          r_port AS responder_port,
          CAST(sum(CASE WHEN a_ip = i_ip THEN n ELSE 0 END) AS BIGINT) AS sent_bytes,
          CAST(sum(CASE WHEN a_ip = i_ip THEN 0 ELSE n END) AS BIGINT) AS received_bytes,
          bool_or(a_port = 5261 OR b_port = 5261) AS accepted
        FROM conns GROUP BY 1, 2, 3, 4
        """,
    )
)
def direction_bytes(spark, sf_dir):
    """Odd packets travel the other way."""
    rows = traffic_rows(spark, sf_dir)
    even = F.col("event_id") % 2 == 0

    def swap(a, b):
        return F.when(even, F.col(a)).otherwise(F.col(b))

    turned = rows.select(
        "file",
        "capture_seq",
        "payload_len",
        swap("src_ip", "dst_ip").alias("src_ip"),
        swap("sport", "dport").cast("long").alias("sport"),
        swap("dst_ip", "src_ip").alias("dst_ip"),
        swap("dport", "sport").cast("long").alias("dport"),
    )
    return reassembly.direction_bytes(turned, [5261])


# ---- routing, dedup, numbering ------------------------------------------------------------------

_ROUTE_RULES = [
    {"category_id": 9, "msg_type": 5803, "output": "ticks"},
    {"category_id": 6, "msg_type": 3202, "output": "snapshots", "dedup": False},
    {"category_id": 9, "msg_type": 5803, "output": "shadowed"},
]


@query(
    """
    SELECT event_id, CASE event_type WHEN 'view' THEN 0 ELSE 1 END AS rule,
      CASE event_type WHEN 'view' THEN 'ticks' ELSE 'snapshots' END AS output, event_type = 'view' AS dedup
    FROM events WHERE event_type IN ('view', 'click')
    """
)
def route_types(spark, sf_dir):
    kind = F.col("event_type")
    frames = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "view", 9).when(kind == "click", 6).otherwise(4).alias("category_id"),
        F.when(kind == "view", 5803).when(kind == "click", 3202).otherwise(2301).alias("msg_type"),
    )
    return routing.route(frames, _ROUTE_RULES).select("event_id", "rule", "output", "dedup")


@query(
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS shipped
    FROM lineitem QUALIFY row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber ORDER BY {sql.LINE_ORDER}) = 1
    """
)
def dedup_ticks(spark, sf_dir):
    first = routing.first_arrival(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER
    )
    return first.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
    )


@query(
    """
    SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (
      PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id) = 1
    """
)
def dedup_snapshots(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("slot", F.date_trunc("hour", "ts"))
    first = routing.first_arrival(rows, ["user_id", "slot"], ["event_id"])
    return first.select("event_id", "user_id", "event_type")


@query(
    """
    SELECT event_id, row_number() OVER (ORDER BY event_id) AS frame_idx,
      row_number() OVER (PARTITION BY event_id // 50 ORDER BY event_id) - 1 AS rec_idx
    FROM events WHERE event_type = 'purchase'
    """
)
def frame_numbering(spark, sf_dir):
    rows = (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == "purchase")
        .select("event_id", block_of(F.col("event_id")).alias("block"), block_of(F.col("event_id"), 50).alias("frame"))
    )
    numbered = routing.number_frames(rows, block=["block"], order=["event_id"])
    return routing.number_records(numbered, ["frame"], ["event_id"]).select(
        "event_id", "frame_idx", "rec_idx"
    )


@query(
    """
    SELECT event_id, user_id FROM events
    WHERE user_id % 4 = (SELECT user_id % 4 FROM events ORDER BY event_id LIMIT 1)
    """
)
def first_group_only(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("flow", F.col("user_id") % 4)
    return routing.first_group_only(rows, ["flow"], ["event_id"]).select("event_id", "user_id")


@query(
    """
    SELECT event_id, value FROM events
    WHERE event_id < (SELECT coalesce(min(event_id), 9223372036854775807) FROM events WHERE value >= 200)
    """
)
def take_while(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "value")
    return routing.take_while(rows, F.col("value") < 200, "event_id")


# ---- statistics ---------------------------------------------------------------------------------


@query(
    sql.with_(
        sql.TRAFFIC,
        """
        SELECT 'src' AS side, src_ip AS ip, CAST(sport AS BIGINT) AS port, count(*) AS count
        FROM traffic GROUP BY ALL
        UNION ALL SELECT 'dst', dst_ip, dport, count(*) FROM traffic GROUP BY ALL
        """,
    )
)
def endpoint_counts(spark, sf_dir):
    rows = traffic_rows(spark, sf_dir).withColumn("dport", F.col("dport").cast("long"))
    return traffic.endpoint_counts(rows)


@query(
    sql.with_(
        sql.TRAFFIC,
        """
        SELECT strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M') AS minute, count(*) AS count,
          CAST(sum(payload_len) AS BIGINT) AS bytes FROM traffic GROUP BY 1
        """,
    )
)
def per_minute(spark, sf_dir):
    rows = traffic_rows(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    return traffic.per_minute(rows, "ts", "payload_len", TZ)


@query(
    sql.with_(
        sql.TRAFFIC,
        """
        SELECT count(*) AS packets, count(*) FILTER (sport = 5261 OR dport = 5261) AS matched,
          CAST(sum(payload_len) AS BIGINT) AS payload_bytes FROM traffic
        """,
    )
)
def totals(spark, sf_dir):
    matched = predicates.port_match(5261, F.col("sport"), F.col("dport"))
    return traffic.totals(traffic_rows(spark, sf_dir), matched, "payload_len")


@query(
    sql.with_(
        sql.TRAFFIC,
        """
        , both_types AS (
          (SELECT 'eth_type' AS field, eth_type AS code, count(*) AS count FROM traffic GROUP BY 2
           ORDER BY 3 DESC, 2 LIMIT 10)
          UNION ALL
          (SELECT 'ip_proto', ip_proto, count(*) FROM traffic WHERE eth_type = 2048 GROUP BY 2
           ORDER BY 3 DESC, 2 LIMIT 10))
        SELECT field, code, count, CASE WHEN field = 'eth_type' THEN
          CASE code WHEN 2048 THEN 'IPv4' WHEN 34525 THEN 'IPv6' WHEN 2054 THEN 'ARP' ELSE 'unknown' END
          ELSE CASE code WHEN 6 THEN 'TCP' WHEN 17 THEN 'UDP' WHEN 1 THEN 'ICMP'
            WHEN 112 THEN 'VRRP/CARP' ELSE 'unknown' END END AS name
        FROM both_types
        """,
    )
)
def top_types(spark, sf_dir):
    rows = traffic_rows(spark, sf_dir)

    def top(df, field, names):
        counted = traffic.count_by(df.select(F.col(field).alias("code")), ["code"], 10)
        return traffic.with_name(counted, "code", names).withColumn("field", F.lit(field))

    eth = top(rows, "eth_type", predicates.ETH_NAMES)
    ip = top(
        rows.filter(F.col("eth_type") == predicates.ETH_IPV4), "ip_proto", predicates.IP_PROTO_NAMES
    )
    return eth.unionByName(ip)


@query(
    sql.with_(
        sql.TRAFFIC,
        "SELECT ip_proto, dport, count(*) AS count FROM traffic GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 15",
    )
)
def top_ports(spark, sf_dir):
    return traffic.count_by(traffic_rows(spark, sf_dir), ["ip_proto", "dport"], 15)


@query(
    """
    SELECT l_suppkey, l_linenumber, l_returnflag, l_linestatus, count(*) AS count FROM lineitem
    GROUP BY 1, 2, 3, 4 ORDER BY 5 DESC, 1, 2, 3, 4 LIMIT 10
    """
)
def top_conversations(spark, sf_dir):
    keys = ["l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    return traffic.count_by(table(spark, sf_dir, "lineitem"), keys, 10)


_RATE = "CASE WHEN last_us > first_us THEN bytes * 1000000 // (last_us - first_us) ELSE 0 END AS avg_bps"


@query(
    sql.with_(
        sql.FLOWS,
        f"""
        SELECT src_ip, sport, dst_ip, dport, ip_proto, pkts, bytes, first_us, last_us,
          last_us - first_us AS duration_us, {_RATE} FROM flows
        """,
    )
)
def flow_stats(spark, sf_dir):
    return traffic.flow_stats(traffic_rows(spark, sf_dir))


@query(
    sql.with_(
        sql.FLOWS,
        """
        SELECT src_ip, sport, dst_ip, dport, ip_proto, pkts, bytes FROM flows
        ORDER BY bytes DESC, src_ip, sport, dst_ip, dport, ip_proto LIMIT 15
        """,
    )
)
def top_flows(spark, sf_dir):
    flows = traffic.flow_stats(traffic_rows(spark, sf_dir))
    top = traffic.top_n(flows, [F.col("bytes").desc(), *traffic.CONVERSATION], 15)
    return top.select(*traffic.CONVERSATION, "pkts", "bytes")


@query(
    sql.with_(
        sql.FLOWS,
        """
        SELECT src_ip, sport, dst_ip, dport, ip_proto, pkts, bytes FROM noisy WHERE NOT noise
        ORDER BY bytes DESC, src_ip, sport, dst_ip, dport, ip_proto LIMIT 10
        """,
    )
)
def business_flows(spark, sf_dir):
    top = traffic.business_flows(traffic.flow_stats(traffic_rows(spark, sf_dir)))
    return top.select(*traffic.CONVERSATION, "pkts", "bytes")


@query(
    sql.with_(
        sql.FLOWS,
        """
        , target AS (SELECT dport FROM noisy WHERE NOT noise
          ORDER BY bytes DESC, src_ip, sport, dst_ip, dport, ip_proto LIMIT 1)
        SELECT event_id, sport, dport FROM traffic
        WHERE dport = (SELECT dport FROM target) OR sport = (SELECT dport FROM target)
        """,
    )
)
def target_flow_rows(spark, sf_dir):
    rows = traffic_rows(spark, sf_dir)
    found = traffic.target_flow_rows(rows, traffic.flow_stats(rows))
    return found.select("event_id", "sport", "dport")


@query(
    """
    WITH t AS (SELECT epoch_us(ts) AS us FROM events),
    edge AS (SELECT min(us) AS lo, max(us) AS hi FROM t),
    counted AS (
      SELECT least((us - lo) // 60000000, greatest((hi - lo + 59999999) // 60000000 - 1, 0)) AS bucket,
        count(*) AS count FROM t, edge GROUP BY 1)
    SELECT b AS bucket, coalesce(count, 0) AS count
    FROM (SELECT unnest(range(0, (SELECT max(bucket) FROM counted) + 1)) AS b) LEFT JOIN counted ON bucket = b
    """
)
def relative_histogram(spark, sf_dir):
    return traffic.relative_histogram(traffic_rows(spark, sf_dir).select("ts_us"), "ts_us")


@query(
    """
    SELECT strftime(min(ts) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS first_time,
      strftime(max(ts) + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS last_time FROM events
    """
)
def time_span(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    return traffic.time_span(rows, "ts", TZ)


@query(
    sql.with_(
        sql.DELTA,
        """
        SELECT user_id % 4 AS flow, event_type AS type, k % 5 AS subtype, count(*) AS frames,
          CAST(sum(CAST(round(value * 10) AS BIGINT)) AS BIGINT) AS bytes,
          count(*) FILTER (present AND k % 2 = 0) AS zip_ok,
          count(*) FILTER (present AND k % 2 = 1) AS zip_fail
        FROM delta GROUP BY 1, 2, 3
        """,
    )
)
def channel_stats(spark, sf_dir):
    frames = delta_rows(spark, sf_dir).select(
        (F.col("user_id") % 4).alias("flow"),
        F.col("event_type").alias("type"),
        (F.col("k") % 5).alias("subtype"),
        F.round(F.col("value") * 10).cast("long").alias("length"),
        (F.col("present") & (F.col("k") % 2 == 0)).alias("zip_ok"),
        (F.col("present") & (F.col("k") % 2 == 1)).alias("bad_inflate"),
    )
    return traffic.channel_stats(frames, ("flow", "type", "subtype"))


@query(
    """
    WITH t AS (SELECT substr(hex(encode(text)), 9, 8) AS h FROM documents WHERE strlen(text) >= 8)
    SELECT CASE WHEN regexp_full_match(h, '([2-6][0-9A-F]|7[0-9A-E]){4}') THEN decode(unhex(h))
      ELSE '\\x' || lower(h) END AS label, count(*) AS count FROM t GROUP BY 1
    """
)
def label_histogram(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("text").cast("binary").alias("body"))
    return traffic.label_histogram(rows, F.col("body"))


@query(
    sql.with_(
        sql.DELTA,
        """
        , long AS (
          SELECT 'event_type' AS field, event_type AS value FROM delta
          UNION ALL SELECT 'k', CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END FROM delta
          UNION ALL SELECT 'user_id', CAST(user_id AS VARCHAR) FROM delta),
        counted AS (SELECT field, value, count(*) AS count FROM long GROUP BY 1, 2)
        SELECT field, value, count FROM counted QUALIFY row_number() OVER (
          PARTITION BY field ORDER BY count DESC, value ASC NULLS FIRST) <= 20
        """,
    )
)
def value_histograms(spark, sf_dir):
    rows = delta_rows(spark, sf_dir).select(
        "event_type", F.when(F.col("k") % 10 != 0, F.col("k")).alias("k"), "user_id"
    )
    return traffic.value_histograms(rows, ["event_type", "k", "user_id"])


@query("SELECT event_type, user_id % 4 AS subtype, count(*) AS count FROM events GROUP BY 1, 2")
def type_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 4).alias("subtype"))
    return traffic.count_by(rows, ["event_type", "subtype"])


# ---- sequence checks and samples ----------------------------------------------------------------


def with_line_blocks(lines):
    """Add a block column that coarsens the line order: the month of shipping."""
    return lines.withColumn("block_month", F.trunc("l_shipdate", "month"))


LINE_BLOCK = ["block_month"]


@query(
    f"""
    WITH t AS (
      SELECT l_orderkey, l_linenumber, l_partkey, lag(l_linenumber) OVER (
        PARTITION BY l_orderkey ORDER BY {sql.LINE_ORDER}, l_linenumber) AS previous_seq
      FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, previous_seq FROM t WHERE l_linenumber <> previous_seq + 1
    """
)
def seq_gaps(spark, sf_dir):
    """Lines of an order in shipping order."""
    found = checks.sequence_gaps(
        with_line_blocks(table(spark, sf_dir, "lineitem")),
        group=["l_orderkey"],
        seq="l_linenumber",
        block=LINE_BLOCK,
        order=[*LINE_ORDER, "l_linenumber"],
    )
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "previous_seq")


@query(
    """
    SELECT event_id, event_type, value > 300 AS is_session FROM events QUALIFY row_number() OVER (
      PARTITION BY event_type, value > 300 ORDER BY event_id) <= CASE WHEN value > 300 THEN 1 ELSE 5 END
    """
)
def sample_per_group(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("is_session", F.col("value") > 300)
    rows = rows.withColumn("sample_class", F.when(F.col("is_session"), "session").otherwise("plain"))
    kept = checks.sample_per_group(rows, ["event_type"], ["event_id"], {"plain": 5, "session": 1})
    return kept.select("event_id", "event_type", "is_session")


# ---- comparison ---------------------------------------------------------------------------------


def reconciled(spark, sf_dir):
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    lines = with_line_blocks(table(spark, sf_dir, "lineitem")).select(
        *LINE_ORDER,
        *LINE_BLOCK,
        F.col("l_orderkey").alias("channel"),
        F.col("l_linenumber").cast("long").alias("biz_index"),
        F.col("l_partkey").cast("string").alias("security_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("tick_second"),
        F.col("l_returnflag").alias("action"),
        F.col("l_suppkey").alias("buy_order_no"),
        F.col("l_quantity").cast("long").alias("sell_order_no"),
        cents.alias("price"),
        F.col("l_quantity").cast("long").alias("qty"),
        F.round(F.col("l_tax") * 100).cast("long").alias("money"),
        F.col("l_linestatus").alias("bs_flag"),
    )
    price, index = F.col("price"), F.col("biz_index")
    reference = lines.withColumns(
        {
            "price": F.when(F.col("l_partkey") % 37 == 0, price + 1).otherwise(price),
            "biz_index": F.when(F.col("l_suppkey") % 41 == 0, index + 100).otherwise(index),
        }
    )
    return reconcile.reconcile(
        lines, reference, key=["channel", "biz_index"], block=LINE_BLOCK, order=LINE_ORDER
    )


@query(
    sql.with_(
        sql.RECONCILE,
        "SELECT channel, biz_index, occurrence, status, decoded_price, reference_price FROM compared",
    )
)
def reconcile_rows(spark, sf_dir):
    return reconciled(spark, sf_dir).select(
        "channel", "biz_index", "occurrence", "status",
        F.col("decoded.price").alias("decoded_price"),
        F.col("reference.price").alias("reference_price"),
    )


@query(
    sql.with_(
        sql.RECONCILE,
        """
        SELECT count(*) FILTER (status = 'match') AS matches, count(*) FILTER (status = 'error') AS errors,
          count(*) FILTER (status = 'miss') AS miss,
          count(*) FILTER (status IN ('ref_remain', 'error')) AS ref_remain,
          count(*) FILTER (status IN ('match', 'error', 'miss')) AS decoded,
          count(*) FILTER (status IN ('match', 'error', 'ref_remain')) AS reference FROM compared
        """,
    )
)
def reconcile_summary(spark, sf_dir):
    return reconcile.reconcile_summary(reconciled(spark, sf_dir))


@query(
    """
    SELECT doc_id, count(*) AS count FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1
    """
)
def keys_only_left(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return reconcile.key_difference(docs, labels, ["doc_id"])


@query(
    """
    SELECT l_partkey AS key, count(*) AS count FROM lineitem
    WHERE l_partkey NOT IN (SELECT l_suppkey FROM lineitem) GROUP BY 1
    """
)
def keys_only_right(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    parts = lines.select(F.col("l_partkey").alias("key"))
    supps = lines.select(F.col("l_suppkey").alias("key"))
    both = reconcile.key_set_diff(supps, parts, ["key"])
    return both.filter(F.col("side") == "right").select("key", "count")


@query(
    """
    WITH a AS (SELECT user_id % 3 AS u, row_number() OVER (ORDER BY event_id) AS frame_idx
      FROM events WHERE event_type = 'purchase'),
    b AS (SELECT user_id % 3 AS u, row_number() OVER (ORDER BY event_id) AS frame_idx
      FROM events WHERE event_type = 'view')
    SELECT frame_idx, a.u = b.u AS same FROM a JOIN b USING (frame_idx)
    """
)
def positional_match(spark, sf_dir):
    def side(kind):
        rows = (
            table(spark, sf_dir, "events")
            .filter(F.col("event_type") == kind)
            .select("event_id", (F.col("user_id") % 3).alias("u"), block_of(F.col("event_id")).alias("block"))
        )
        return routing.number_frames(rows, block=["block"], order=["event_id"])

    return reconcile.positional_match(side("purchase"), side("view"), ["u"]).select("frame_idx", "same")


@query(
    """
    SELECT date_diff('day', o_orderdate, l_shipdate) AS diff, count(*) AS count
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5
    """
)
def time_diff_hist(spark, sf_dir):
    def days(c):
        return F.datediff(F.col(c), F.lit("1970-01-01")).cast("long")

    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), days("l_shipdate").alias("ta")
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), days("o_orderdate").alias("tb")
    )
    return reconcile.time_diff_histogram(lines, orders, id="id", ta="ta", tb="tb", order=["tb"])


@query("SELECT event_id, user_id % 2 AS part FROM events")
def union_flows(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 2).alias("part"))
    return reconcile.concat(*[rows.filter(F.col("part") == p) for p in (0, 1)])


# ---- tables -------------------------------------------------------------------------------------


@query(
    sql.with_(
        sql.TICKS,
        """
        SELECT biz_index, channel, security_id, price_e3 AS price_e3, qty_e3, money_e5, action, bs_flag
        FROM ticks
        """,
    )
)
def ticks_csv_roundtrip(spark, sf_dir):
    """Ticks written as CSV and read back; decimals come back exact."""
    folder = scratch_dir(spark, "ticks-csv")
    tables.write_ticks(fixtures.tick_projection(spark, sf_dir), folder, "csv")
    back = tables.read_ticks_csv(spark, folder).filter(F.col("_corrupt_record").isNull())
    return back.select(
        "biz_index",
        F.col("channel").cast("long").alias("channel"),
        "security_id",
        (F.col("price") * 1000).cast("long").alias("price_e3"),
        (F.col("qty") * 1000).cast("long").alias("qty_e3"),
        (F.col("money") * 100000).cast("long").alias("money_e5"),
        "action",
        "bs_flag",
    )


@query(
    sql.with_(
        sql.TICKS,
        """
        SELECT biz_index, channel, security_id,
          lpad(CAST(tick_time // 1000000 AS VARCHAR), 2, '0') || ':' ||
          lpad(CAST(tick_time // 10000 % 100 AS VARCHAR), 2, '0') || ':' ||
          lpad(CAST(tick_time // 100 % 100 AS VARCHAR), 2, '0') || '.' ||
          lpad(CAST(tick_time % 100 AS VARCHAR), 2, '0') AS tick_time,
          CASE WHEN event_id % 19 = 0 THEN '?' ELSE bs_flag END AS bs_flag,
          CAST(CAST(money_e5 AS DECIMAL(18, 0)) / 100000 AS DECIMAL(20, 5))::VARCHAR AS money
        FROM ticks
        """,
    )
)
def ticks_export(spark, sf_dir):
    """Typed export through Parquet; empty text is shown as a question mark."""
    rows = fixtures.tick_projection(spark, sf_dir)
    blank = rows.withColumn("bs_flag", F.when(F.col("event_id") % 19 != 0, F.col("bs_flag")).otherwise(""))
    folder = scratch_dir(spark, "ticks-export")
    tables.write_ticks(blank, folder)
    return spark.read.parquet(folder).select(
        "biz_index", "channel", "security_id", "tick_time", "bs_flag", F.col("money").cast("string").alias("money")
    )


# ---- streaming ----------------------------------------------------------------------------------


@query(sql.with_(sql.TICKS, f"SELECT {sql.TICK_FIELDS} FROM ticks"))
def stream_ticks(spark, sf_dir):
    """Segments streamed to a Parquet sink, then first arrival."""
    folder = capture(spark, sf_dir, "step")
    sink, checkpoint = scratch_dir(spark, "stream-ticks"), scratch_dir(spark, "stream-state")
    stream = streaming.decode_stream(
        spark, folder, "cap", RULES, port=9129, checkpoint=checkpoint, max_batch_bytes=STREAM_BATCH
    )
    streaming.run_available(stream, sink, checkpoint)
    landed = ticks.valid_ticks(spark.read.parquet(sink))
    first = routing.first_arrival(
        landed, ["channel", "biz_index"], ["ts_ns", "frame_no", "rec_idx", "dst_ip"]
    )
    return first.select(*TICK_FIELDS)


@query(
    sql.with_(
        sql.FRAMES,
        """
        , counted AS (
          SELECT 'frame' AS kind, count(*) AS n, 0 AS n_bytes FROM frames
          UNION ALL
          SELECT 'junk', count(*), count(*) * 37 FROM groups WHERE group_no % 3 = 1
          UNION ALL
          SELECT 'gap', count(*), 0 FROM groups g WHERE group_no % 5 = 4 AND EXISTS (
            SELECT 1 FROM groups h WHERE h.channel = g.channel AND h.group_no = g.group_no + 1))
        SELECT kind, n * 2 AS n, CAST(n_bytes * 2 AS BIGINT) AS n_bytes FROM counted WHERE n > 0
        """,
    )
)
def stream_frames(spark, sf_dir):
    """Frames, gaps and skipped bytes of the streamed capture."""
    folder = capture(spark, sf_dir, "step")
    sink, checkpoint = scratch_dir(spark, "stream-frames"), scratch_dir(spark, "stream-state")
    landed = segments.stream_segments(
        spark, folder, "cap", checkpoint=checkpoint, max_batch_bytes=STREAM_BATCH, headers=True, ports=9129
    )
    events = streaming.frame_stream(landed, 9129)
    streaming.run_available(events.drop("payload"), sink, checkpoint)
    counted = spark.read.parquet(sink).filter(F.col("kind").isin("frame", "gap", "junk"))
    size = F.when(F.col("kind") == "junk", F.col("n_bytes")).otherwise(0)
    return counted.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.sum(size).cast("long").alias("n_bytes")
    )


@query(
    sql.with_(
        _PACKETS,
        f"""
        , seen AS (
          SELECT *, row_number() OVER (PARTITION BY channel ORDER BY event_id) AS place FROM wire WHERE NOT is_udp)
        SELECT CASE WHEN repeated THEN 'retransmit' ELSE 'gap' END AS kind, {_CLOCK} AS ts_ns,
          '10.3.0.' || channel AS src_ip, CAST(size AS BIGINT) AS n_bytes
        FROM seen WHERE place > 1 AND (repeated OR skip > 0)
        """,
    )
)
def stream_late(spark, sf_dir):
    """T4: repeated segments and gaps of a stream of many micro-batches, each with its time and size."""
    folder = event_capture(spark, sf_dir, "event-segments")
    sink, checkpoint = scratch_dir(spark, "stream-late"), scratch_dir(spark, "stream-state")
    size = sum(segments.segment_numbers(folder, "ev").values())
    landed = segments.stream_segments(
        spark, folder, "ev", checkpoint=checkpoint, max_batch_bytes=size // 3 + 1, headers=True
    )
    streaming.run_available(streaming.frame_stream(landed).drop("payload"), sink, checkpoint)
    late = spark.read.parquet(sink).filter(F.col("kind").isin("retransmit", "gap"))
    return late.select("kind", "ts_ns", "src_ip", "n_bytes")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, sf_dir):
    """Keys kept once; the watermark is longer than the table."""
    schema = table(spark, sf_dir, "events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp"))
    sink, checkpoint = scratch_dir(spark, "stream-dedup"), scratch_dir(spark, "stream-state")
    kept = streaming.dedup_stream(rows, ["user_id", "event_type"], "ts", "400 days")
    streaming.run_available(kept.select("user_id", "event_type"), sink, checkpoint)
    return spark.read.parquet(sink)


# ---- data that used to be lost or to abort ------------------------------------------------------


@query(
    """
    WITH t AS (SELECT *, lag(l_linenumber) OVER (PARTITION BY l_shipmode_null ORDER BY l_shipdate, l_orderkey, l_linenumber) AS previous_seq
      FROM (SELECT *, CASE WHEN l_returnflag = 'A' THEN 'A' END AS l_shipmode_null FROM lineitem))
    SELECT l_shipmode_null AS flag, l_orderkey, l_linenumber, previous_seq FROM t WHERE l_linenumber <> previous_seq + 1
    """
)
def seq_gaps_null(spark, sf_dir):
    """A null group runs through its blocks like any other."""
    rows = table(spark, sf_dir, "lineitem").withColumns(
        {
            "flag": F.when(F.col("l_returnflag") == "A", F.lit("A")),
            "month": F.trunc("l_shipdate", "month"),
        }
    )
    found = checks.sequence_gaps(
        rows, group=["flag"], seq="l_linenumber", block=["month"], order=["l_shipdate", "l_orderkey", "l_linenumber"]
    )
    return found.select("flag", "l_orderkey", "l_linenumber", "previous_seq")


@query(
    sql.with_(
        sql.FLOWS,
        """
        SELECT src_ip, sport, dst_ip, dport, ip_proto, pkts, CAST(bytes AS BIGINT) * 100000000 AS bytes,
          CAST(CASE WHEN last_us > first_us
            THEN CAST(bytes AS HUGEINT) * 100000000 * 1000000 // (last_us - first_us) ELSE 0 END AS BIGINT) AS avg_bps
        FROM flows
        """,
    )
)
def flow_stats_large(spark, sf_dir):
    """Flows of many terabytes."""
    rows = traffic_rows(spark, sf_dir)
    rows = rows.withColumn("payload_len", F.col("payload_len") * F.lit(100_000_000).cast("long"))
    return traffic.flow_stats(rows).select(*traffic.CONVERSATION, "pkts", "bytes", "avg_bps")


@query(
    """
    SELECT event_id, event_id % 3 = 0 AS overflow, CASE WHEN event_id % 3 <> 0 THEN event_id % 128 END AS first_number,
      '600880' AS sec_id FROM events
    """
)
def status_overflow(spark, sf_dir):
    """A number above 63 bits is flagged, and its record stays."""
    number = F.lpad(F.hex(F.col("event_id") % 128 + 128), 2, "0")
    wide = F.when(F.col("event_id") % 3 == 0, F.repeat(F.lit("7F"), 9)).otherwise("")
    body = F.unhex(F.concat(wide, number, F.lit("3630303838B0"), F.lit("83")))
    rows = table(spark, sf_dir, "events").select("event_id", body.alias("body"))
    found = records.status_records(rows)
    return found.select("event_id", "overflow", F.get("prefix_ints", F.lit(0)).alias("first_number"), "sec_id")


@query(
    """
    SELECT event_id % 2 AS part, count(*) AS n FROM events GROUP BY 1
    """
)
def segment_append(spark, sf_dir):
    """A second write goes on after the segments of the first."""
    folder = scratch_dir(spark, "appended")
    rows = table(spark, sf_dir, "events").select(
        F.lit("memory").alias("file"),
        F.col("event_id").alias("capture_seq"),
        F.col("event_id").alias("ts_ns"),
        F.encode(F.concat_ws("-", F.lit("packet"), F.col("event_id") % 2), "UTF-8").alias("frame"),
    )
    for part in (0, 1):
        segments.write_segments(rows.filter(F.col("capture_seq") % 2 == part), folder, "cap", max_bytes=64 << 10)
    back = segments.read_segments(spark, folder, "cap")
    part = F.substring_index(F.decode("frame", "UTF-8"), "-", -1).cast("long")
    return back.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))


@query(
    sql.with_(
        sql.TICKS,
        """
        SELECT count(*) FILTER (event_id % 7 <> 0 AND event_id % 11 <> 0) AS matches,
          count(*) FILTER (event_id % 7 <> 0 AND event_id % 11 = 0) AS errors,
          count(*) FILTER (event_id % 7 = 0) AS miss,
          count(*) FILTER (event_id % 7 <> 0 AND event_id % 11 = 0) AS ref_remain,
          count(*) AS decoded, count(*) FILTER (event_id % 7 <> 0) AS reference FROM ticks
        """,
    )
)
def verify_ticks(spark, sf_dir):
    """Decoded ticks against a vendor file that lacks rows and has other prices."""
    made = fixtures.tick_projection(spark, sf_dir)
    decoded = ticks.valid_ticks(ticks.decode_ticks(fixtures.tick_frames(made)))
    price = F.when(F.col("event_id") % 11 == 0, F.col("price_e3") + 1).otherwise(F.col("price_e3"))
    folder = scratch_dir(spark, "vendor")
    tables.write_ticks(made.filter(F.col("event_id") % 7 != 0).withColumn("price_e3", price), folder, "csv")
    return jobs.verify_to(decoded, tables.read_ticks_csv(spark, folder), scratch_dir(spark, "verified"))


@query(sql.with_(sql.TICKS, f"SELECT {sql.TICK_FIELDS} FROM ticks"))
def stream_ticks_deduped(spark, sf_dir):
    """Every tick is captured twice and leaves the stream once."""
    folder = capture(spark, sf_dir, "step")
    sink, checkpoint = scratch_dir(spark, "stream-deduped"), scratch_dir(spark, "stream-state")
    stream = streaming.decode_stream(spark, folder, "cap", RULES, port=9129, dedup_delay="400 days")
    streaming.run_available(stream.select(*TICK_FIELDS), sink, checkpoint)
    return spark.read.parquet(sink)


# ---- reports over captures ----------------------------------------------------------------------


@query(
    sql.with_(
        _PACKETS,
        f"""
        , seen AS (
          SELECT '10.3.0.' || channel AS src_ip, CASE WHEN is_udp THEN 7001 ELSE 7000 END AS sport,
            CASE WHEN is_udp THEN 1985 ELSE 51000 END AS dport, is_udp, size, ({_CLOCK}) // 1000 AS ts_us FROM wire)
        SELECT 'flow' AS item, src_ip || ':' || sport || '>' || dport AS key, count(*) AS n,
          CAST(sum(size) AS BIGINT) AS bytes, CAST(max(ts_us) - min(ts_us) AS BIGINT) AS lasted, is_udp AS noise
        FROM seen GROUP BY src_ip, sport, dport, is_udp
        UNION ALL SELECT 'business', src_ip || ':' || sport || '>' || dport, count(*), CAST(sum(size) AS BIGINT),
          CAST(max(ts_us) - min(ts_us) AS BIGINT), false FROM seen WHERE NOT is_udp GROUP BY src_ip, sport, dport
        UNION ALL SELECT 'noise', NULL, count(DISTINCT src_ip || sport), count(DISTINCT src_ip) FILTER (is_udp), NULL, NULL FROM seen
        UNION ALL SELECT 'rate', '0', count(*), NULL, NULL, NULL FROM seen WHERE NOT is_udp
        """,
    )
)
def recon_tables(spark, sf_dir):
    """Flows, noise, business flows and packet rate of a capture's packets."""
    found = reports.reconnaissance(event_segments(spark, sf_dir))
    none = F.lit(None).cast("long")

    def flow_rows(item, rows, noise):
        key = F.concat("src_ip", F.lit(":"), "sport", F.lit(">"), "dport")
        return rows.select(
            F.lit(item).alias("item"), key.alias("key"), F.col("pkts").alias("n"), "bytes", F.col("duration_us").alias("lasted"), noise.alias("noise")
        )

    unknown = F.lit(None).cast("boolean").alias("noise")
    noise = found["noise"].select(F.lit("noise"), F.lit(None).cast("string"), "flows", "noise_flows", none, unknown)
    rate = found["rate"].select(F.lit("rate"), F.col("bucket").cast("string"), "count", none, none, unknown)
    flows = flow_rows("flow", found["flows"], F.col("noise"))
    return flows.unionAll(flow_rows("business", found["business"], F.lit(False))).unionAll(noise).unionAll(rate)


@query(
    sql.with_(
        _PACKETS,
        f"""
        SELECT 7000 AS sport, 51000 AS dport, CAST(size AS INTEGER) AS payload_len,
          repeat('78', CAST(size AS INTEGER)) AS hex, repeat('x', CAST(size AS INTEGER)) AS ascii
        FROM wire WHERE NOT is_udp ORDER BY event_id LIMIT 20
        """,
    )
)
def recon_preview(spark, sf_dir):
    """The first payloads of the largest business flow's port, as hex and as text."""
    return reports.reconnaissance(event_segments(spark, sf_dir))["preview"]


@query(
    """
    SELECT doc_id AS capture_seq, substr(text, 1, 24) AS text FROM documents
    WHERE doc_id % 3 = 1 AND strlen(text) > 200 ORDER BY doc_id LIMIT 5
    """
)
def heartbeat_samples(spark, sf_dir):
    """The first frames of a link type with their UTF-16 text; other frames lie between them."""
    link = F.when(F.col("doc_id") % 3 == 1, F.lit(bytearray(b"\x88\x6d"))).otherwise(F.lit(bytearray(b"\x08\x06")))
    rows = table(spark, sf_dir, "documents").filter(F.octet_length("text") > 200).select(
        F.lit("memory").alias("file"),
        F.col("doc_id").alias("capture_seq"),
        F.col("doc_id").alias("ts_ns"),
        F.concat(F.lit(bytearray(12)), link, F.encode(F.substring("text", 1, 200), "UTF-16LE")).alias("frame"),
    )
    return reports.link_samples(rows).select("capture_seq", "text")


@query(
    sql.with_(
        sql.FRAMES,
        """
        , beats AS (SELECT * FROM frames WHERE frame_no % 4 = 0)
        SELECT 'frames 9/5803' AS item, count(*) AS n FROM frames
        UNION ALL SELECT 'zip_ok 9/5803', count(*) FROM frames WHERE frame_no % 2 = 1
        UNION ALL SELECT 'frames 6/3115', count(*) FROM beats
        UNION ALL SELECT 'zip_ok 6/3115', 0
        UNION ALL SELECT 'bytes 6/3115', count(*) * 58 FROM beats
        UNION ALL SELECT 'label 6/3115 M101', count(*) FROM beats
        UNION ALL SELECT 'sample 6/3115 M101', least(2, count(*)) FROM beats
        UNION ALL SELECT 'samples 9/5803', least(5, count(*)) FROM frames
        UNION ALL SELECT 'lost 10.1.0.' || channel, count(*) * 37 FROM groups WHERE group_no % 3 = 1 GROUP BY channel
        UNION ALL SELECT 'gaps', 0
        UNION ALL SELECT 'mismatches', 0
        """,
    )
)
def frame_report(spark, sf_dir):
    """A17 to A19, W1, W2, P14 over the 40-byte frames of a capture."""

    def make():
        found = segments.read_segments(spark, capture(spark, sf_dir, "v1"), "cap", ports=5261, side="src")
        return staged(packets.tcp_with_payload(found), "v1-packets")

    found = reports.frame_report(once(spark, sf_dir, "v1", make), block_bytes=SMALL_BLOCK)
    channel = F.concat("type", F.lit("/"), "subtype")

    def rows(name, frame, text, n):
        return frame.select(text.alias("item"), n.cast("long").alias("n"))

    def named(prefix, *more):
        return F.concat(F.lit(prefix + " "), channel, *more)

    stats, samples = found["channels"], found["samples"].groupBy("type", "subtype", "sample_class").count()
    parts = [
        rows("frames", stats, named("frames"), F.col("frames")),
        rows("zip", stats, named("zip_ok"), F.col("zip_ok")),
        rows("bytes", stats.filter("subtype = 3115"), named("bytes"), F.col("bytes")),
        rows("labels", found["labels"].filter("label = 'M101'"), named("label", F.lit(" "), F.col("label")), F.col("count")),
        rows("beats", samples.filter("sample_class = 'beat'"), named("sample", F.lit(" M101")), F.col("count")),
        rows("samples", samples.filter("sample_class = 'frame'"), named("samples"), F.col("count")),
        rows("lost", found["lost"], F.concat(F.lit("lost "), "src_ip"), F.col("lost_bytes")),
        rows("gaps", found["gaps"].agg(F.count(F.lit(1)).alias("n")), F.lit("gaps"), F.col("n")),
        rows("mismatches", stats.agg(F.sum("mismatches").alias("n")), F.lit("mismatches"), F.col("n")),
    ]
    return reconcile.concat(*parts)


@query(
    sql.with_(
        sql.TICKS,
        """
        , s AS (SELECT *, row_number() OVER (ORDER BY channel, biz_index) AS place FROM ticks WHERE action = 'S'),
        kept AS (
          SELECT * REPLACE (CASE WHEN biz_index % 11 = 0 THEN 'X' ELSE bs_flag END AS bs_flag)
          FROM s WHERE biz_index % 7 <> 0),
        v AS (SELECT * EXCLUDE (place), row_number() OVER (ORDER BY channel, biz_index) AS place FROM kept)
        SELECT 'left' AS item, security_id || ' ' || bs_flag AS key, count(*) AS n FROM s
        WHERE (security_id, bs_flag) NOT IN (SELECT (security_id, bs_flag) FROM v) GROUP BY ALL
        UNION ALL SELECT 'right', security_id || ' ' || bs_flag, count(*) FROM v
        WHERE (security_id, bs_flag) NOT IN (SELECT (security_id, bs_flag) FROM s) GROUP BY ALL
        UNION ALL SELECT 'place', CASE WHEN s.bs_flag = v.bs_flag THEN 'same' ELSE 'other' END, count(*)
        FROM s JOIN v USING (place) GROUP BY ALL
        """,
    )
)
def status_check(spark, sf_dir):
    """X1, J3, E5 over status records read back from frames, against a vendor's with gaps and changes."""
    made = fixtures.tick_projection(spark, sf_dir).filter("action = 'S'")
    found = records.status_records(records.split_by_tid(fixtures.status_frames(made)))
    decoded = staged(
        found.select(
            F.col("sec_id").alias("security_id"),
            F.col("status").alias("bs_flag"),
            F.get("prefix_ints", F.lit(1)).alias("channel"),
            F.get("prefix_ints", F.lit(0)).alias("biz_index"),
            F.lit("").alias("tick_time"),
        ),
        "status",
    )
    flag = F.when(F.col("biz_index") % 11 == 0, "X").otherwise(F.col("bs_flag"))
    vendor = made.filter("biz_index % 7 <> 0").select("security_id", flag.alias("bs_flag"), "channel", "biz_index", F.lit("").alias("tick_time"))
    tables_ = reports.status_check(decoded, vendor, block=["channel"], order=["channel", "biz_index"])
    sets = tables_["sets"].select(F.col("side").alias("item"), F.concat_ws(" ", "security_id", "bs_flag").alias("key"), F.col("count").alias("n"))
    places = tables_["places"].groupBy(F.when(F.col("same"), "same").otherwise("other").alias("key")).count()
    return sets.unionAll(places.select(F.lit("place"), "key", "count"))


@query(
    sql.with_(
        sql.TICKS,
        """
        SELECT 'pmap' AS field, '7E84' AS value, count(*) AS count FROM ticks WHERE action = 'S'
        UNION ALL SELECT 'tid', '5803', count(*) FROM ticks WHERE action = 'S'
        UNION ALL SELECT 'status', bs_flag, count(*) FROM ticks WHERE action = 'S' GROUP BY bs_flag
        """,
    )
)
def pmap_histogram(spark, sf_dir):
    """Presence maps (as hex), templates and statuses of split records."""
    frames = fixtures.status_frames(fixtures.tick_projection(spark, sf_dir))
    return traffic.value_histograms(records.status_records(records.split_by_tid(frames)), ["pmap", "tid", "status"])


def _clock_sql(c):
    return " || ':' || ".join(f"lpad(CAST({c} // {d} % 100 AS VARCHAR), 2, '0')" for d in (10000, 100, 1))


def _px_sql(c):
    return f"CAST(CAST(({c}) AS DECIMAL(18, 0)) / 10000 AS DECIMAL(20, 4))::VARCHAR"


def book_frames(spark, sf_dir):
    """Frames of 20 snapshots each, with numbers as a capture gives them."""

    def make():
        framed = fixtures.snapshot_frames(fixtures.snapshot_projection(spark, sf_dir))
        return staged(framed.withColumn("frame_no", F.monotonically_increasing_id()), "book-frames")

    return once(spark, sf_dir, "book-frames", make)


@query(
    sql.with_(
        sql.SNAPSHOTS,
        f"""
        SELECT security_id AS "SecID", {_clock_sql('tick_time')} AS "TickTime", CAST(data_status AS VARCHAR) AS "DataStatus",
          CAST(image_status AS VARCHAR) AS "ImageStatus", instrument_status AS "InstrStatus", trading_phase_code AS "Phase",
          {_px_sql('open_px')} AS "Open", {_px_sql('last_px')} AS "Last", '0.0000' AS "Close", CAST(num_trades AS VARCHAR) AS "NumTrades",
          CAST(total_volume AS VARCHAR) AS "TotalVol", {_px_sql('iopv')} AS "IOPV", {_px_sql('px - 10')} AS "BidPx1",
          CAST(lot AS VARCHAR) AS "BidQty1", {_px_sql('CASE WHEN n % 3 > 0 THEN px + 10 ELSE 0 END')} AS "OfferPx1",
          CASE WHEN n % 3 > 0 THEN CAST(lot AS VARCHAR) ELSE '0' END AS "OfferQty1", 'true' AS placed
        FROM book
        """,
    )
)
def snapshots_export(spark, sf_dir):
    """The snapshot file with outer numbers, frame and record places, written and read back."""
    framed = book_frames(spark, sf_dir)
    numbered = routing.number_frames(
        framed.withColumn("_block", block_of(F.col("frame_no"))), block=["_block"], order=["frame_no"]
    ).withColumn("outer_seq", F.col("frame_no"))
    folder = scratch_dir(spark, "snapshot-file")
    tables.write_snapshots(snapshots.decode_snapshots(numbered), folder, "csv", compression="gzip")
    back = spark.read.option("header", True).csv(folder)
    frames = framed.agg(F.count(F.lit(1))).scalar()
    places = F.col("FrameIdx").cast("long").between(1, frames) & F.col("RecIdx").cast("long").between(0, 19) & F.col("OuterSeq").isNotNull()
    wanted = "SecID TickTime DataStatus ImageStatus InstrStatus Phase Open Last Close NumTrades TotalVol IOPV BidPx1 BidQty1 OfferPx1 OfferQty1"
    return back.select(*wanted.split(), places.cast("string").alias("placed"))


@query(sql.with_(sql.SNAPSHOTS, f"SELECT {_SNAPSHOT_SCALARS}, n AS depth FROM book"))
def stream_snapshots(spark, sf_dir):
    """Snapshots decoded from their own frames in a stream of segments."""
    framed = book_frames(spark, sf_dir).select(
        "category_id", "msg_type", "payload", "frame_no",
        (F.col("frame_no") % 4 + 1).alias("channel"),
        F.call_function("div", "frame_no", F.lit(32)).alias("group_no"),
        F.col("frame_no").alias("msg_seq_id"),
        F.lit("20260114-09:30:00").alias("sending_time"),
    )
    folder = scratch_dir(spark, "book-capture")
    made = fixtures.capture_packets(fixtures.step_blobs(framed, faults=False), copies=1, faults=True)
    segments.write_segments(made, folder, "cap", max_bytes=4 << 20)
    sink, checkpoint = scratch_dir(spark, "stream-books"), scratch_dir(spark, "stream-state")
    stream = streaming.decode_stream(
        spark, folder, "cap", RULES, port=9129, output="snapshots", checkpoint=checkpoint, max_batch_bytes=STREAM_BATCH
    )
    streaming.run_available(stream, sink, checkpoint)
    found = snapshots.valid_snapshots(spark.read.parquet(sink))
    return found.select(*_SNAPSHOT_SCALARS.split(", "), F.size("bid_levels").cast("long").alias("depth"))
