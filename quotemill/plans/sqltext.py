"""Shared SQL: the same projections as the Spark jobs, in the dialect of the checking engine."""

from textwrap import dedent

TICKS = dedent("""\
    numbered AS (
      SELECT *, user_id % 4 + 1 AS channel,
        row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS biz_index,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
      FROM events),
    base AS (
      SELECT event_id, ts, channel, biz_index,
        CAST(600000 + user_id % 100000 AS VARCHAR) AS security_id,
        CAST(hour(ts) * 1000000 + minute(ts) * 10000
          + date_part('microseconds', ts) // 10000 AS BIGINT) AS tick_time,
        CASE event_type WHEN 'view' THEN 'D' WHEN 'click' THEN 'A' WHEN 'purchase' THEN 'T'
          WHEN 'error' THEN 'C' ELSE 'S' END AS action,
        CASE WHEN event_type = 'signup' THEN 0 ELSE CAST(round(value * 1000) AS BIGINT) END AS price_e3,
        CASE WHEN event_type = 'signup' THEN 0 ELSE k * 1000 END AS qty_e3,
        CASE WHEN event_type = 'signup'
          THEN CASE event_id % 3 WHEN 0 THEN 'SUSP' WHEN 1 THEN 'OCALL' ELSE 'START' END
          ELSE CASE event_id % 3 WHEN 0 THEN 'B' WHEN 1 THEN 'S' ELSE 'N' END END AS bs_flag
      FROM numbered),
    ticks AS (
      SELECT *,
        CASE WHEN action = 'T' THEN price_e3 * qty_e3 // 10 ELSE 0 END AS money_e5,
        CASE WHEN action <> 'S' AND (bs_flag IN ('B', 'N') OR action = 'T')
          THEN event_id + 1 ELSE 0 END AS buy_order_no,
        CASE WHEN action <> 'S' AND (bs_flag = 'S' OR action = 'T')
          THEN event_id + 2 ELSE 0 END AS sell_order_no
      FROM base)""")

TICK_FIELDS = (
    "biz_index, channel, security_id, tick_time, action, buy_order_no, sell_order_no, "
    "price_e3, qty_e3, money_e5, bs_flag"
)

# Traffic columns; {div} is integer division, {k} the JSON number, {us} the time in microseconds.
TRAFFIC_COLUMNS = dedent("""\
    event_id,
    {us} AS ts_us,
    ts,
    CASE event_id % 10 WHEN 0 THEN 34525 WHEN 1 THEN 2054 ELSE 2048 END AS eth_type,
    CASE event_type WHEN 'view' THEN 6 WHEN 'click' THEN 6 WHEN 'purchase' THEN 17
      WHEN 'error' THEN 1 ELSE 112 END AS ip_proto,
    concat('10.0.', CAST(user_id {div} 250 AS {text}), '.', CAST(user_id % 250 + 1 AS {text})) AS src_ip,
    40000 + user_id % 1000 AS sport,
    CASE {k} % 5 WHEN 0 THEN '224.0.0.102' WHEN 1 THEN '239.1.1.1' WHEN 2 THEN '255.255.255.255'
      WHEN 3 THEN '172.16.0.9' ELSE '172.16.0.10' END AS dst_ip,
    CASE {k} % 4 WHEN 0 THEN 5261 WHEN 1 THEN 9129 WHEN 2 THEN 1985 ELSE 123 END AS dport,
    CAST(round(value * 10) AS BIGINT) AS payload_len""")
_CHECK = dict(
    us="epoch_us(ts)",
    div="//",
    text="VARCHAR",
    k="CAST(json_extract_string(props, '$.k') AS BIGINT)",
)
_SPARK = dict(
    us="unix_micros(cast(ts as timestamp))",
    div="div",
    text="STRING",
    k="cast(get_json_object(props, '$.k') as bigint)",
)
TRAFFIC = f"traffic AS (SELECT {TRAFFIC_COLUMNS.format(**_CHECK)} FROM events)"
TRAFFIC_SPARK = TRAFFIC_COLUMNS.format(**_SPARK)
FLOWS = TRAFFIC + dedent("""\
    , flows AS (
      SELECT src_ip, sport, dst_ip, dport, ip_proto, count(*) AS pkts,
        CAST(sum(payload_len) AS BIGINT) AS bytes, min(ts_us) AS first_us, max(ts_us) AS last_us
      FROM traffic GROUP BY ALL),
    noisy AS (
      SELECT *, (sport IN (67, 68, 137, 138, 139, 5353, 5355, 1985, 1900, 123)
        OR dport IN (67, 68, 137, 138, 139, 5353, 5355, 1985, 1900, 123)
        OR src_ip IN ('224.0.0.102', '224.0.0.251', '224.0.0.252', '239.255.255.250')
        OR dst_ip IN ('224.0.0.102', '224.0.0.251', '224.0.0.252', '239.255.255.250')
        OR dst_ip LIKE '255.%' OR src_ip = '0.0.0.0') AS noise
      FROM flows)""")

PROTOCOL_CLASS = dedent("""\
    CASE WHEN eth_type = 2048 AND ip_proto = 6 THEN 'TCP'
      WHEN eth_type = 2048 AND ip_proto = 17 THEN 'UDP'
      WHEN eth_type = 2048 AND ip_proto = 1 THEN 'ICMP'
      WHEN eth_type = 2048 THEN 'IPv4-other'
      WHEN eth_type = 34525 THEN 'IPv6'
      WHEN eth_type IS NOT NULL THEN 'Eth-other' ELSE 'other' END""")

LINE_ORDER = (
    "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus"
)

# Both sides of the comparison: some reference prices differ, some keys are on one side only.
RECONCILE = dedent(f"""\
    lines AS (
      SELECT *, CAST(l_orderkey AS BIGINT) AS channel, CAST(l_linenumber AS BIGINT) AS biz_index,
        CAST(l_partkey AS VARCHAR) AS security_id, strftime(l_shipdate, '%Y-%m-%d') AS tick_second,
        l_returnflag AS action, l_suppkey AS buy_order_no, CAST(l_quantity AS BIGINT) AS sell_order_no,
        CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(l_quantity AS BIGINT) AS qty,
        CAST(round(l_tax * 100) AS BIGINT) AS money, l_linestatus AS bs_flag
      FROM lineitem),
    d AS (
      SELECT *, cents AS price, row_number() OVER (
        PARTITION BY channel, biz_index ORDER BY {LINE_ORDER}) AS occurrence
      FROM lines),
    moved AS (
      SELECT * REPLACE (CASE WHEN l_suppkey % 41 = 0 THEN biz_index + 100 ELSE biz_index END AS biz_index)
      FROM lines),
    r AS (
      SELECT *, CASE WHEN l_partkey % 37 = 0 THEN cents + 1 ELSE cents END AS price,
        row_number() OVER (PARTITION BY channel, biz_index ORDER BY {LINE_ORDER}) AS occurrence
      FROM moved),
    compared AS (
      SELECT channel, biz_index, occurrence, d.price AS decoded_price, r.price AS reference_price,
        CASE WHEN r.price IS NULL THEN 'miss' WHEN d.price IS NULL THEN 'ref_remain'
          WHEN d.security_id = r.security_id AND d.tick_second = r.tick_second
            AND d.action = r.action AND d.buy_order_no = r.buy_order_no
            AND d.sell_order_no = r.sell_order_no AND d.price = r.price AND d.qty = r.qty
            AND d.money = r.money AND d.bs_flag = r.bs_flag THEN 'match'
          ELSE 'error' END AS status
      FROM d FULL OUTER JOIN r USING (channel, biz_index, occurrence))""")

# Which delta fields are present: shared by the rehydration queries.
DELTA = dedent("""\
    delta AS (
      SELECT *, event_id // 50 AS frame, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        event_id % 3 = 0 AS present
      FROM events)""")

SNAPSHOTS = dedent("""\
    lines AS (
      SELECT *, CAST(l_linenumber AS BIGINT) AS n,
        CAST(round(l_extendedprice * 100) AS BIGINT) AS px, CAST(l_quantity AS BIGINT) * 100 AS lot
      FROM lineitem),
    book AS (
      SELECT l_orderkey, lpad(CAST(l_partkey % 1000000 AS VARCHAR), 6, '0') AS security_id,
        90000 + l_suppkey % 60 * 100 + n AS tick_time, n % 3 AS data_status,
        l_suppkey % 2 + 1 AS image_status, px - n AS open_px, px AS last_px, l_suppkey % 4 AS iopv,
        l_partkey AS num_trades, lot * n AS total_volume, l_returnflag AS instrument_status,
        l_linestatus || 'T' AS trading_phase_code, n, px, lot
      FROM lines),
    levels AS (
      SELECT *, 'bid' AS side, px - i * 10 AS price FROM book, range(1, 8) AS t(i) WHERE i <= n
      UNION ALL
      SELECT *, 'offer' AS side, px + i * 10 AS price FROM book, range(1, 8) AS t(i) WHERE i <= n % 3)""")

FRAMES = TICKS + dedent("""\
    , placed AS (SELECT *, (biz_index - 1) // 50 AS frame_no FROM ticks),
    frames AS (
      SELECT channel, frame_no, frame_no // 8 AS group_no, channel * 1000000000 + frame_no AS msg_seq_id,
        count(*) AS records, strftime(min(ts), '%Y%m%d-%H:%M:%S') AS sending_time
      FROM placed GROUP BY channel, frame_no),
    groups AS (SELECT channel, group_no, count(*) AS n_frames FROM frames GROUP BY ALL)""")


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{dedent(body)}"
