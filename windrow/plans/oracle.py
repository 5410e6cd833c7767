"""The queries of the catalog as SQL over the same tables, for checking."""

from __future__ import annotations

_SALES = """
    SELECT l_suppkey AS store_id, l_partkey AS product_id,
           CAST(l_extendedprice AS DECIMAL(18, 2)) AS amount, l_shipdate AS ts
    FROM lineitem
"""

_NET_SALES = """
    SELECT l_suppkey AS store_id, l_shipdate AS ts,
           CAST(CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2))) AS DECIMAL(18, 4))
                * (1 + CAST(l_tax AS DECIMAL(4, 2))) AS DECIMAL(18, 6)) AS amount
    FROM lineitem
"""

_SALES_SLIDING = """
    SELECT time_bucket(INTERVAL 5 DAY, ts, TIMESTAMP '1970-01-03') - j * INTERVAL 5 DAY AS window_start,
           {key}, amount
    FROM ({sales}), (SELECT unnest([0, 1]) AS j)
"""


def _sliding(key: str, as_key: str | None = None, sales: str = _SALES, shown: str = "CAST(sum(amount) AS DOUBLE)") -> str:
    rows = _SALES_SLIDING.format(key=key, sales=sales)
    return f"""
        SELECT window_start, window_start + INTERVAL 10 DAY AS window_end,
               {as_key or key} AS {key},
               {shown} AS sum_amount, count(*) AS tran_count
        FROM ({rows}) GROUP BY window_start, {key}
    """


def _rollup(totals: str) -> str:
    return f"""
        SELECT ws AS window_start, ws + INTERVAL 5 DAY AS window_end,
               CAST(sum(tran_count) AS BIGINT) AS tran_count,
               CAST(sum(sum_amount) AS DOUBLE) AS sum_amount
        FROM (SELECT time_bucket(INTERVAL 5 DAY, window_end - INTERVAL 1 MICROSECOND,
                                 TIMESTAMP '1970-01-01') AS ws, tran_count, sum_amount
              FROM ({totals}))
        GROUP BY ws
    """


_TRANSACTIONS = """
    SELECT CAST(event_id AS INTEGER) AS transaction_id, CAST(user_id AS INTEGER) AS customer_id,
           CAST(user_id % 20 + 1 AS INTEGER) AS store_id, CAST(value AS FLOAT) AS price,
           CAST(event_id % 50 + 1 AS INTEGER) AS product_id,
           strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H:%M:%S') AS time,
           epoch_us(ts) // 1000 AS timestamp
    FROM events
"""

_LINES = r"""
    SELECT doc_id, pos - 1 AS pos, line, ts FROM (
        SELECT doc_id, ts, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos,
               len(parts) AS n
        FROM (SELECT doc_id, TIMESTAMP '2024-01-01' + to_seconds(doc_id) AS ts,
                     string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)) AS parts
              FROM documents)
    ) WHERE line <> '' OR pos < n
"""

# Trailing empty tokens are dropped; one that precedes a word, or an empty line's, counts.
_TOKENS = rf"""
    SELECT doc_id, pos, ts, unnest(CASE
        WHEN line = '' THEN ['']
        WHEN a[-1] <> '' THEN a
        WHEN len(a) = 2 AND a[1] = '' THEN CAST([] AS VARCHAR[])
        ELSE a[:-2] END) AS word
    FROM (SELECT doc_id, pos, ts, line,
                 string_split_regex(regexp_replace(line, '[^a-zA-Z ]', ' ', 'g'), '\s+') AS a
          FROM ({_LINES}))
"""

_ARRIVALS = """
    SELECT event_id AS row_id, ts, CAST(user_id % 20 + 1 AS INTEGER) AS store_id, value AS price,
           event_id % 3 AS source_partition,
           event_id + CASE WHEN event_id % 7 = 0 THEN 40 ELSE 0 END AS arrival
    FROM events
"""

_SEEN = f"""
    SELECT *, max(ts) OVER (PARTITION BY source_partition ORDER BY arrival, row_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
    FROM ({_ARRIVALS})
"""

ORACLE: dict[str, str] = {
    "q_tx_view": _TRANSACTIONS,
    "q_store_sliding": _sliding("store_id"),
    "q_product_sliding": _sliding("product_id"),
    "q_fanout_totals": f"""
        SELECT 'store_id' AS branch, window_start, window_end, store_id AS key, sum_amount, tran_count
        FROM ({_sliding("store_id")})
        UNION ALL
        SELECT 'product_id', window_start, window_end, product_id, sum_amount, tran_count
        FROM ({_sliding("product_id")})
    """,
    "q_store_net_sliding": _sliding("store_id", sales=_NET_SALES),
    "q_net_rollup": _rollup(_sliding("store_id", sales=_NET_SALES, shown="sum(amount)")),
    "q_global_rollup": _rollup(_sliding("store_id", shown="sum(amount)")),
    "q_name_sum": """
        SELECT ws AS window_start, ws + INTERVAL 3 HOUR AS window_end, name, n FROM (
            SELECT time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '1970-01-01') AS ws,
                   event_type AS name, count(*) AS n
            FROM events GROUP BY 1, 2)
    """,
    "q_text_lines": f"SELECT doc_id, pos, line FROM ({_LINES})",
    "q_line_word_counts": f"""
        SELECT doc_id, pos, word, count(*) AS n FROM ({_TOKENS}) GROUP BY doc_id, pos, word
    """,
    "q_wordcount_window": f"""
        SELECT ws AS window_start, ws + INTERVAL 5 SECOND AS window_end, word, n FROM (
            SELECT time_bucket(INTERVAL 5 SECOND, ts, TIMESTAMP '1970-01-01 00:00:02') AS ws,
                   word, count(*) AS n
            FROM ({_TOKENS}) GROUP BY 1, 2)
    """,
    "q_reading_halving": """
        SELECT ws AS window_start, ws + INTERVAL 1 DAY AS window_end, sensor_id,
               min(ts) AS first_ts,
               list_reduce(list(value ORDER BY ts, event_id), lambda a, x: (a + x) / 2)
                   AS temperature,
               count(*) AS n
        FROM (SELECT *, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS ws,
                     'sensor' || (user_id % 10) AS sensor_id FROM events)
        GROUP BY ws, sensor_id
    """,
    "q_decode_transactions": _TRANSACTIONS,
    "q_event_times": """
        SELECT ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, first_ts, last_ts, n FROM (
            SELECT time_bucket(INTERVAL 1 HOUR, ms, TIMESTAMP '1970-01-01') AS ws,
                   min(ms) AS first_ts, max(ms) AS last_ts, count(*) AS n
            FROM (SELECT make_timestamp(epoch_us(ts) // 1000 * 1000) AS ms FROM events) GROUP BY 1)
    """,
    "q_window_all": f"""
        SELECT window_start, window_start + INTERVAL 10 DAY AS window_end,
               CAST(max(amount) AS DOUBLE) AS highest, CAST(min(amount) AS DOUBLE) AS lowest,
               count(DISTINCT store_id) AS stores,
               arg_max(product_id, struct_pack(a := amount, p := product_id)) AS dearest
        FROM ({_SALES_SLIDING.format(key="store_id, product_id", sales=_SALES)}) GROUP BY window_start
    """,
    "q_by_store_roundtrip": _sliding("store_id", "CAST(store_id AS INTEGER)"),
    "q_publish_records": f"""
        SELECT CAST(transaction_id AS VARCHAR) AS key,
               CAST(transaction_id % 3 AS INTEGER) AS partition, ts AS record_ts, t.*
        FROM ({_TRANSACTIONS}) t JOIN (SELECT event_id, ts FROM events) e
          ON t.transaction_id = e.event_id
    """,
    "q_round_robin_balance": """
        SELECT task::INTEGER AS task, target::INTEGER AS target, (n_task + 2 - (target + 21 - task) % 3) // 3 AS n
        FROM (SELECT l_partkey % 7 AS task, count(*) AS n_task FROM lineitem GROUP BY ALL),
             (SELECT unnest([0, 1, 2]) AS target)
        WHERE n_task > (target + 21 - task) % 3
    """,
    "q_product_roundtrip": _sliding("product_id"),
    "q_late_rows": f"""
        SELECT row_id, ts, source_partition, arrival, store_id, price FROM ({_SEEN})
        WHERE time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL 2 HOUR
              <= seen - INTERVAL 2 SECOND
    """,
    "q_on_time_store_sliding": f"""
        SELECT window_start, window_start + INTERVAL 2 HOUR AS window_end, store_id,
               CAST(sum(CAST(price AS DECIMAL(18, 2))) AS DOUBLE) AS sum_amount,
               count(*) AS tran_count
        FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01')
                        - j * INTERVAL 1 HOUR AS window_start
              FROM ({_SEEN}), (SELECT unnest([0, 1]) AS j))
        WHERE seen IS NULL OR window_start + INTERVAL 2 HOUR > seen - INTERVAL 2 SECOND
        GROUP BY window_start, store_id
    """,
    "q_closed_windows": """
        SELECT ws AS window_start, ws + INTERVAL 1 DAY AS window_end, store_id,
               CAST(sum(amount) AS DOUBLE) AS sum_amount, count(*) AS tran_count
        FROM (SELECT time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS ws,
                     CAST(user_id % 20 + 1 AS INTEGER) AS store_id,
                     CAST(value AS DECIMAL(18, 2)) AS amount FROM events)
        WHERE ws + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 2 SECOND FROM events)
        GROUP BY ws, store_id
    """,
    "q_reading_halving_long": """
        SELECT ws AS window_start, ws + INTERVAL 30 DAY AS window_end, 'all' AS sensor_id,
               min(ts) AS first_ts,
               list_reduce(list(value ORDER BY ts, event_id), lambda a, x: (a + x) / 2)
                   AS temperature,
               count(*) AS n
        FROM (SELECT *, time_bucket(INTERVAL 30 DAY, ts, TIMESTAMP '1970-01-01') AS ws FROM events)
        GROUP BY ws
    """,
    "q_late_rows_nulls": f"""
        SELECT row_id, coalesce(nullif(source_partition, 2), -1) AS source,
               coalesce(time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL 2 HOUR
                        <= seen - INTERVAL 2 SECOND, FALSE) AS late
        FROM ({_SEEN})
    """,
    "q_stagger_nulls": """
        SELECT make_timestamp(us) AS window_start,
               make_timestamp(us) + INTERVAL 6 HOUR AS window_end, store,
               CAST(sum(amount) AS DOUBLE) AS sum_amount, count(*) AS tran_count
        FROM (SELECT t - (t - phase) % 21600000000 AS us, store, amount
              FROM (SELECT epoch_us(ts) AS t,
                           min(epoch_us(ts)) OVER (PARTITION BY user_id % 20) % 21600000000 AS phase,
                           coalesce(nullif(CAST(user_id % 20 AS INTEGER), 7), -1) AS store,
                           CAST(value AS DECIMAL(18, 2)) AS amount FROM events))
        GROUP BY us, store
    """,
    "q_tumbling_stagger": """
        SELECT make_timestamp(us) AS window_start,
               make_timestamp(us) + INTERVAL 6 HOUR AS window_end, store_id,
               CAST(sum(amount) AS DOUBLE) AS sum_amount, count(*) AS tran_count
        FROM (SELECT t - (t - phase) % 21600000000 AS us, store_id, amount
              FROM (SELECT epoch_us(ts) AS t,
                           min(epoch_us(ts)) OVER (PARTITION BY user_id % 20) % 21600000000 AS phase,
                           CAST(user_id % 20 + 1 AS INTEGER) AS store_id,
                           CAST(value AS DECIMAL(18, 2)) AS amount FROM events))
        GROUP BY us, store_id
    """,
}

# A stream emits a window once the newest row is past its end by the delay.
ORACLE["q_stream_store_sliding"] = f"""
    SELECT * FROM ({ORACLE["q_store_sliding"]})
    WHERE window_end <= (SELECT max(l_shipdate) - INTERVAL 2 SECOND FROM lineitem)
"""
ORACLE["q_stream_late_rows"] = ORACLE["q_late_rows"]
ORACLE["q_stream_flushed_store_sliding"] = ORACLE["q_store_sliding"]
ORACLE["q_stream_rollup"] = ORACLE["q_global_rollup"]
ORACLE["q_stream_name_sum"] = ORACLE["q_name_sum"]
ORACLE["q_stream_wordcount_window"] = ORACLE["q_wordcount_window"]
ORACLE["q_stream_reading_halving"] = ORACLE["q_reading_halving"]
ORACLE["q_stream_tumbling_stagger"] = ORACLE["q_tumbling_stagger"]
ORACLE["q_stream_reading_halving_long"] = ORACLE["q_reading_halving_long"]
ORACLE["q_stream_on_time_store_sliding"] = ORACLE["q_on_time_store_sliding"]
ORACLE["q_stream_late_pairs"] = f"""
    SELECT row_id, window_start, window_start + INTERVAL 2 HOUR AS window_end
    FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') - j * INTERVAL 1 HOUR AS window_start
          FROM ({_SEEN}), (SELECT unnest([0, 1]) AS j))
    WHERE window_start + INTERVAL 2 HOUR <= seen - INTERVAL 2 SECOND
"""
ORACLE["q_stream_fanout_totals"] = ORACLE["q_fanout_totals"]
ORACLE["q_stream_published_once"] = ORACLE["q_store_sliding"]
ORACLE["q_stream_topic_offsets"] = ORACLE["q_decode_transactions"]
