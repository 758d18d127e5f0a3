"""The queries of the catalog as plain SQL, for an independent result check."""

from __future__ import annotations

from orderloom.plans import derived as D
from orderloom.plans.catalog import CUT, STREAM_WINDOW

_ENRICHED = "order_id, product_id, product_name, quantity, order_ts"
_PRODUCT = "product_id, product_name, stock, last_updated_ts"


def _with(*tables: str) -> str:
    return "WITH " + ",".join(tables) + "\n"


def _versions(changes: str) -> str:
    """One version per key and time: the last arrival."""
    return f"""
versions AS (
  SELECT * FROM {changes}
  QUALIFY row_number() OVER (
    PARTITION BY product_id, last_updated_ts
    ORDER BY seq DESC NULLS LAST, op <> 'd' DESC, product_name DESC, stock DESC) = 1)"""


def _enriched(orders: str, changes: str) -> str:
    return (
        _versions(changes)
        + f""",
enriched AS (
  SELECT o.order_id, o.product_id, p.product_name, o.quantity, o.order_ts
  FROM {orders} o ASOF JOIN versions p
    ON o.product_id = p.product_id AND o.order_ts >= p.last_updated_ts
  WHERE p.op <> 'd')"""
    )


def _history(changes: str) -> str:
    return (
        _versions(changes)
        + """,
spans AS (
  SELECT *, lead(last_updated_ts) OVER (PARTITION BY product_id ORDER BY last_updated_ts) AS valid_to
  FROM versions)
SELECT product_id, product_name, stock, last_updated_ts AS valid_from, valid_to
FROM spans WHERE op <> 'd'"""
    )


def _counts(minutes: int) -> str:
    return f""",
counts AS (
  SELECT product_id, count(order_id) AS order_count,
         time_bucket(INTERVAL {minutes} MINUTE, order_ts, TIMESTAMP '1970-01-01') AS window_start
  FROM enriched GROUP BY ALL)
SELECT product_id, order_count, window_start,
       window_start + INTERVAL {minutes} MINUTE AS window_end
FROM counts"""


# Where the watermark stands after all input: the slower side, less one second.
_END = """(SELECT least((SELECT max(order_ts) FROM ev_orders),
                 (SELECT max(last_updated_ts) FROM ev_changes)) - INTERVAL 1 SECOND)"""

_SKEW_END = _END.replace("ev_orders", "skew_orders").replace("ev_changes", "skew_changes")

_EVENTS = (D.EVENT_ORDERS_SQL, D.EVENT_CHANGES_SQL)
_DELETES = (*_EVENTS, D.DELETES_SQL)
_SKEWED = (*_DELETES, D.SKEWED_ORDERS_SQL, D.SKEWED_CHANGES_SQL)
_LINES = (D.LINE_ORDERS_SQL, D.PART_CHANGES_SQL)

_DENSE = _with(D.DENSE_SQL, _enriched("dense_orders", "dense_changes"))
_EV = _with(*_EVENTS, _enriched("ev_orders", "ev_changes"))
_DEL = _with(*_DELETES, _enriched("ev_orders", "del_changes"))
_SKEW = _with(*_SKEWED, _enriched("skew_orders", "skew_changes"))
_LI = _with(*_LINES, _enriched("li_orders", "part_changes"))
_ALL_ENRICHED = f"\nSELECT {_ENRICHED} FROM enriched"
_ALL_ORDERS = _with(D.EVENT_ORDERS_SQL) + "SELECT * FROM ev_orders"

_CAPTURE = f"""
early AS (
  SELECT * FROM del_changes WHERE last_updated_ts < TIMESTAMP '{CUT}'
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY seq DESC) = 1),
capture AS (
  SELECT {_PRODUCT}, 'r' AS op, CAST(-1 AS BIGINT) AS seq FROM early WHERE op <> 'd'
  UNION ALL
  SELECT {_PRODUCT}, op, seq FROM del_changes WHERE last_updated_ts >= TIMESTAMP '{CUT}')"""

_BATCHES = f"""
target AS (
  SELECT {_PRODUCT} FROM ev_changes WHERE last_updated_ts < TIMESTAMP '{CUT}'
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY seq DESC) = 1),
batch AS (
  SELECT {_PRODUCT} FROM ev_changes WHERE last_updated_ts >= TIMESTAMP '{CUT}'
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY seq DESC) = 1)"""

_PART_BATCHES = f"""
target AS (SELECT {_PRODUCT} FROM part_changes WHERE op = 'c'),
batch AS (
  SELECT {_PRODUCT} FROM part_changes WHERE op <> 'c'
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY seq DESC) = 1)"""

_UPSERT = """
SELECT * FROM target WHERE product_id NOT IN (SELECT product_id FROM batch)
UNION ALL SELECT * FROM batch"""

ORACLE: dict[str, str] = {
    "orders_log": _ALL_ORDERS,
    "order_message_keys": _with(D.EVENT_ORDERS_SQL)
    + """SELECT hex(encode(product_id)) AS key_hex, product_id, count(*) AS messages
FROM ev_orders GROUP BY product_id""",
    "products_latest": _with(*_EVENTS)
    + f"""SELECT {_PRODUCT} FROM ev_changes
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY last_updated_ts DESC, seq DESC) = 1""",
    "products_history": _with(*_DELETES, _history("del_changes")),
    "products_history_hot_key": _with(*_SKEWED, _history("skew_changes")),
    "products_history_null_seq": _with(D.UNNUMBERED_SQL, _history("unnumbered")),
    "cdc_snapshot_plus_log": _with(*_DELETES, _CAPTURE) + "SELECT * FROM capture",
    "cdc_upsert_fold": _with(*_DELETES, _CAPTURE)
    + f"""SELECT {_PRODUCT} FROM (
  SELECT * FROM capture
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY seq DESC) = 1) WHERE op <> 'd'""",
    "upsert_products": _with(*_EVENTS, _BATCHES) + _UPSERT,
    "upsert_parts": _with(*_LINES, _PART_BATCHES) + _UPSERT,
    "upsert_new_parts": _with(*_LINES, _PART_BATCHES.replace("op = 'c')", "op = 'c' AND stock % 2 = 0)")) + _UPSERT,
    "temporal_enrich": _EV + _ALL_ENRICHED,
    "temporal_enrich_deletes": _DEL + _ALL_ENRICHED,
    "temporal_enrich_lineitem": _LI + _ALL_ENRICHED,
    "temporal_enrich_history": _DEL + _ALL_ENRICHED,
    "temporal_enrich_hot_key": _SKEW + _ALL_ENRICHED,
    "temporal_enrich_micros": _DENSE + _ALL_ENRICHED,
    "temporal_enrich_micros_split": _DENSE + _ALL_ENRICHED,
    "temporal_enrich_micros_broadcast": _DENSE + _ALL_ENRICHED,
    "temporal_enrich_keyed_logs": _DEL + _ALL_ENRICHED,
    "temporal_enrich_keyed_hot": _SKEW + _ALL_ENRICHED,
    "enriched_log": _EV + _ALL_ENRICHED,
    "product_window_counts": _EV + _counts(5),
    "product_window_counts_7m": _EV + _counts(7),
    "product_window_counts_60m": _EV + _counts(60),
    "product_window_counts_1d": _EV + _counts(1440),
    "product_window_counts_lineitem": _LI + _counts(7 * 1440),
    "product_window_counts_hot_key": _SKEW + _counts(1440),
    "csv_orders_ingest": _ALL_ORDERS,
    "csv_orders_quarantine": _with(D.EVENT_ORDERS_SQL, D.EVENT_CHANGES_SQL, """
texts AS (
  SELECT CAST(seq AS VARCHAR) || ',' || product_id AS head,
         strftime(last_updated_ts, '%Y-%m-%d %H:%M:%S.%g') AS ts FROM ev_changes)""")
    + """SELECT head || ',x,' || ts AS line, 'malformed line' AS error FROM texts
UNION ALL SELECT head, 'malformed line' FROM texts
UNION ALL SELECT head || ',1,' || ts || ',more', 'malformed line' FROM texts
UNION ALL SELECT 'order_id,product_id,quantity,order_ts', 'malformed line'
FROM (SELECT DISTINCT CAST(order_id AS BIGINT) % 10 FROM ev_orders)""",
    "zip_orders_quarantine": _with(D.EVENT_CHANGES_SQL)
    + """SELECT product_id AS archive, 'whole.csv' AS member,
       CAST(seq AS VARCHAR) || ',' || product_id AS line, 'malformed line' AS error FROM ev_changes
UNION ALL SELECT DISTINCT product_id, 'whole.csv', 'order_id,product_id,quantity,order_ts', 'malformed line'
FROM ev_changes
UNION ALL SELECT DISTINCT product_id, 'damaged.csv', NULL, 'bad member after 0 lines' FROM ev_changes""",
    "zip_orders_ingest": _ALL_ORDERS,
    "stream_window_counts": _EV
    + _counts(STREAM_WINDOW)
    + "\nWHERE window_end <= (SELECT max(order_ts) - INTERVAL 1 SECOND FROM enriched)",
    "stream_temporal_enrich": _EV + _ALL_ENRICHED + f"\nWHERE order_ts <= {_END}",
    "stream_pipeline": _EV + _counts(STREAM_WINDOW) + f"\nWHERE window_end <= {_END}",
    "pipeline_counts": _EV + _counts(STREAM_WINDOW) + f"\nWHERE window_end <= {_END}",
}
ORACLE["pipeline_products_latest"] = ORACLE["pipeline_latest_out_of_order"] = ORACLE["cdc_upsert_fold"]
# A snapshot in chunks and the log give the table that the whole log gives.
ORACLE["cdc_incremental_snapshot"] = ORACLE["pipeline_chunked_snapshot"] = (
    _with(*_DELETES)
    + f"""SELECT {_PRODUCT} FROM (
  SELECT * FROM del_changes QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY seq DESC) = 1)
WHERE op <> 'd'"""
)
ORACLE["stream_products_history"] = ORACLE["products_history_hot_key"]
ORACLE["stream_enrich_handover"] = ORACLE["stream_enrich_rebuilt"] = ORACLE["stream_temporal_enrich"]
ORACLE["stream_enrich_hot_key"] = _SKEW + _ALL_ENRICHED + f"\nWHERE order_ts <= {_SKEW_END}"
ORACLE["pipeline_accounting"] = (
    _with(*_DELETES, _versions("del_changes"))
    + f""", o AS (
  SELECT *, CAST(order_id AS BIGINT) % 40 <> 3 AS keyed,
    order_ts < TIMESTAMP '{CUT}' AND CAST(order_id AS BIGINT) % 50 <> 7 AS first FROM ev_orders),
ends AS (
  SELECT least((SELECT max(order_ts) FROM o WHERE keyed AND first),
               (SELECT max(last_updated_ts) FROM del_changes WHERE last_updated_ts < TIMESTAMP '{CUT}'))
           - INTERVAL 1 SECOND AS one,
         least((SELECT max(order_ts) FROM o WHERE keyed), (SELECT max(last_updated_ts) FROM del_changes))
           - INTERVAL 1 SECOND AS two),
joined AS (
  SELECT o.order_id, keyed, NOT first AND o.order_ts <= (SELECT one FROM ends) AS late,
    o.order_ts <= (SELECT two FROM ends) AS due, coalesce(p.op <> 'd', false) AS live
  FROM o ASOF LEFT JOIN versions p ON o.product_id = p.product_id AND o.order_ts >= p.last_updated_ts),
n AS (
  SELECT (SELECT count(*) FROM del_changes) AS refused, count(*) AS orders,
    count(*) FILTER (NOT keyed) AS unkeyed, count(*) FILTER (keyed AND late) AS late,
    count(*) FILTER (keyed AND NOT late AND due AND live) AS matched,
    count(*) FILTER (keyed AND NOT late AND due AND NOT live) AS unmatched,
    count(*) FILTER (keyed AND NOT late AND NOT due) AS waiting
  FROM joined)
SELECT unnest(['lines', 'refused', 'unkeyed', 'late', 'matched', 'unmatched', 'waiting']) AS part,
  unnest([orders + refused, refused, unkeyed, late, matched, unmatched, waiting]) AS n FROM n"""
)
ORACLE["join_state_handed_over"] = (
    _with(*_DELETES, _versions("del_changes"))
    + f""", early AS (
  SELECT * FROM versions WHERE last_updated_ts <= {_END}
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY last_updated_ts DESC) = 1),
needed AS (SELECT * FROM early UNION ALL SELECT * FROM del_changes WHERE last_updated_ts > {_END})
SELECT product_id, 0 AS kind, order_id, NULL AS product_name, quantity::BIGINT AS number, order_ts AS ts
FROM ev_orders WHERE order_ts > {_END}
UNION ALL
SELECT product_id, CASE WHEN op = 'd' THEN 2 ELSE 1 END, NULL, product_name, seq, last_updated_ts FROM needed"""
)
