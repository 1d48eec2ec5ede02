"""Plain SQL over the given tables for every registered query that SQL can express.

The statements never look at JSON: they restate the derived events relationally and apply
the expected verdict of each anomaly, so they check the decode and rule path from outside.
"""

from __future__ import annotations

from millrace.functions import rules as R
from millrace.model import COLUMN_DEFAULTS, ORDER_STATUSES, PAYMENT_METHOD_IDS, PAYMENT_METHOD_ROWS, PRIMARY_KEYS, TABLES
from millrace.operators import audits as A
from workload.derive import AS_OF

NOW = f"TIMESTAMP '{AS_OF}'"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def ts(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%g')"


def dbl(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def pct(part: str, whole: str, digits: int, empty: float) -> str:
    """Percentage rounded half up in whole numbers."""
    scale = 10**digits
    p, w = f"CAST({part} AS BIGINT)", f"CAST({whole} AS BIGINT)"
    return f"CASE WHEN {w} = 0 THEN {empty} ELSE ((200 * {scale} * {p} + {w}) // (2 * {w})) / {scale}.0 END"


def half_up(total: str, count: str, digits: int = 2) -> str:
    """total / count rounded half up in whole numbers; total has at most two decimals."""
    scale = 10**digits
    cents = f"CAST(CAST({total} AS DECIMAL(18,2)) * 100 AS BIGINT)"
    n = f"CAST({count} AS BIGINT)"
    return f"((2 * {cents} * {scale} + 100 * {n}) // (200 * {n})) / {scale}.0"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(quoted(v) for v in values) + "]"


def _filled(template: str, *parts: str) -> str:
    """SQL for a reason text with ``%s`` places."""
    pieces = template.split("%s")
    out = quoted(pieces[0])
    for part, piece in zip(parts, pieces[1:]):
        out += f" || {part} || {quoted(piece)}"
    return out


CODE = f"""CASE WHEN k = 1 THEN '{R.CORRUPT_PAYLOAD}'
    WHEN k = 2 THEN 'NULL_EVENT_ID' WHEN k = 3 THEN 'NULL_ORDER_ID' WHEN k = 4 THEN 'NULL_CUSTOMER_ID'
    WHEN k = 5 THEN 'NULL_LOCATION_ID' WHEN k = 6 THEN 'NULL_PAYMENT_METHOD'
    WHEN k = 7 THEN '{R.INVALID_PAYMENT_METHOD}' WHEN k = 8 THEN '{R.INVALID_ORDER_STATUS}'
    WHEN k = 9 THEN '{R.NEGATIVE_OR_NULL_TOTAL}' WHEN k = 10 THEN '{R.NEGATIVE_OR_NULL_NET}'
    WHEN k = 11 OR is_empty THEN '{R.EMPTY_ITEMS_ARRAY}'
    WHEN k = 12 THEN '{R.CORRUPT_LINE_ITEM}' WHEN k = 13 THEN '{R.NULL_PRODUCT_ID}'
    WHEN k = 14 THEN '{R.INVALID_QUANTITY}' WHEN k = 15 THEN '{R.INVALID_UNIT_PRICE}'
    WHEN k = 16 THEN '{R.NULL_TIMESTAMP}' WHEN k = 17 THEN '{R.FUTURE_TIMESTAMP_ANOMALY}'
    WHEN k = 18 THEN '{R.MALFORMED_TIMESTAMP}' END"""

CONSTRAINT = """CASE k WHEN 21 THEN 'CONSTRAINT_ITEM_COUNT' WHEN 22 THEN 'CONSTRAINT_DISCOUNT_AMOUNT'
    WHEN 23 THEN 'CONSTRAINT_TOTAL_ITEM_PRICE' END"""

ITEM_REASON = f"""CASE code WHEN '{R.CORRUPT_LINE_ITEM}' THEN {_filled(R.REASON_ITEM_MALFORMED, "'0'")}
    WHEN '{R.NULL_PRODUCT_ID}' THEN {_filled(R.REASON_ITEM_PRODUCT, "(n_items - 1)")}
    WHEN '{R.INVALID_QUANTITY}' THEN {_filled(R.REASON_ITEM_QUANTITY, "last_product", "'0'")}
    WHEN '{R.INVALID_UNIT_PRICE}' THEN {_filled(R.REASON_ITEM_PRICE, "last_product", "CAST(CAST(-last_price AS DOUBLE) AS VARCHAR)")} END"""

REASON = f"""CASE code WHEN '{R.CORRUPT_PAYLOAD}' THEN {quoted(R.REASON_CORRUPT)}
    {" ".join(f"WHEN '{code}' THEN {quoted(R.REASON_MISSING % column)}" for column, code in R.IDENTIFIER_CODES)}
    WHEN '{R.INVALID_PAYMENT_METHOD}' THEN {_filled(R.REASON_PAYMENT, "'PAY-UNRECOGNIZED-X'")}
    WHEN '{R.INVALID_ORDER_STATUS}' THEN {_filled(R.REASON_STATUS, "'MAGIC_DELIVERY'")}
    WHEN '{R.NEGATIVE_OR_NULL_TOTAL}' THEN {_filled(R.REASON_TOTAL, "'-150.0'")}
    WHEN '{R.NEGATIVE_OR_NULL_NET}' THEN {_filled(R.REASON_NET, "'-1.0'")}
    WHEN '{R.EMPTY_ITEMS_ARRAY}' THEN {quoted(R.REASON_NO_ITEMS)}
    WHEN '{R.NULL_TIMESTAMP}' THEN {quoted(R.REASON_NO_TIMESTAMP)}
    WHEN '{R.FUTURE_TIMESTAMP_ANOMALY}' THEN {_filled(R.REASON_FUTURE, "'2002-12-01T00:00:00Z'")}
    WHEN '{R.MALFORMED_TIMESTAMP}' THEN {_filled(R.REASON_UNPARSED, "'not-a-date'", _filled(R.DETAIL_NOT_ISO, "'not-a-date'"))}
    WHEN 'CONSTRAINT_ITEM_COUNT' THEN {quoted(R.REASON_CONSTRAINT % "item_count")}
    WHEN 'CONSTRAINT_DISCOUNT_AMOUNT' THEN {quoted(R.REASON_CONSTRAINT % "discount_amount")}
    WHEN 'CONSTRAINT_TOTAL_ITEM_PRICE' THEN {quoted(R.REASON_CONSTRAINT % "total_item_price")}
    WHEN '{R.DUPLICATE_EVENT_ID}' THEN {_filled(R.REASON_DUPLICATE_EVENT, "event_id", "regexp_replace(order_id, '-R$', '')")}
    ELSE {ITEM_REASON} END"""

_PAYMENTS = ", ".join(
    f"({quoted(i)}, {quoted(m)}, {quoted(p)}, false)" for i, m, p in PAYMENT_METHOD_ROWS if i != "PAY-CRYPTO"
)

_ALL_PAYMENTS = ", ".join(f"({quoted(i)}, {quoted(m)}, {quoted(p)})" for i, m, p in PAYMENT_METHOD_ROWS)

CTES = f"""WITH
ln AS (
  SELECT *, CAST(round(ext * rate, 2) AS DECIMAL(12,2)) AS d1
  FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT) AS qty,
      CAST(l_extendedprice AS DECIMAL(12,2)) AS ext, CAST(l_discount AS DECIMAL(4,2)) AS rate,
      CAST(l_tax AS DECIMAL(4,2)) AS tax_rate, p_retailprice
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey)),
it AS (
  SELECT l_orderkey, l_partkey,
    row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber, l_partkey, l_suppkey, qty, ext, rate, tax_rate) - 1 AS pos,
    'PROD-' || l_partkey AS product_id, qty AS quantity,
    CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price, ext AS total_item_price, d1 AS discount_applied,
    CAST(round((ext - d1) * tax_rate, 2) AS DECIMAL(12,2)) AS line_tax
  FROM ln),
par AS (
  SELECT l_orderkey, count(*) AS n_items, CAST(sum(quantity) AS BIGINT) AS item_count,
    CAST(sum(total_item_price) AS DECIMAL(12,2)) AS total, CAST(sum(discount_applied) AS DECIMAL(12,2)) AS discount,
    CAST(sum(line_tax) AS DECIMAL(12,2)) AS tax, arg_max(product_id, pos) AS last_product, arg_max(unit_price, pos) AS last_price
  FROM it GROUP BY l_orderkey),
base AS (
  SELECT o.o_orderkey AS ok, o.o_custkey AS ck, c.c_nationkey AS nk, o.o_orderkey % 200 AS k,
    p.l_orderkey IS NULL AS is_empty, CAST(o.o_orderkey AS VARCHAR) AS nm,
    list_extract({_list(PAYMENT_METHOD_IDS)}, o.o_orderkey % 9 + 1) AS pay,
    list_extract({_list(ORDER_STATUSES)}, (o.o_orderkey // 7) % 6 + 1) AS st,
    coalesce(p.n_items, 0) AS n_items, coalesce(p.item_count, 0) AS item_count,
    coalesce(p.total, 0) AS total, coalesce(p.discount, 0) AS discount, coalesce(p.tax, 0) AS tax,
    last_product, last_price, o.o_orderpriority AS channel,
    o.o_orderdate + to_seconds((o.o_orderkey * 37) % 86400) AS ots, o.o_orderkey % 5000 AS lat
  FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN par p ON p.l_orderkey = o.o_orderkey),
dl AS (
  SELECT b.*, r.copy, CASE WHEN r.copy >= 2 THEN 1 ELSE 0 END AS batch_id,
    ok * 10 + CASE r.copy WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 5 END AS seq,
    ots + to_milliseconds(lat + CASE WHEN r.copy >= 2 THEN 1000 ELSE 0 END) AS received_at,
    lat + CASE WHEN r.copy >= 2 THEN 1000 ELSE 0 END AS latency,
    CASE WHEN k NOT IN (1, 2) THEN 'EVT-' || nm END AS event_id,
    CASE WHEN k NOT IN (1, 3) THEN 'ORD-' || nm || CASE WHEN r.copy = 3 THEN '-R' ELSE '' END END AS order_id,
    CASE WHEN k = 1 THEN NULL WHEN k = 4 THEN '' ELSE 'CUST-' || ck END AS customer_id,
    CASE WHEN k NOT IN (1, 5) THEN 'LOC-' || nk END AS location_id,
    CASE WHEN k = 7 THEN 'PAY-UNRECOGNIZED-X' WHEN k NOT IN (1, 6) THEN pay END AS payment_method_id,
    CASE WHEN k = 1 THEN NULL WHEN r.copy = 1 THEN 'PROCESSING' WHEN r.copy = 2 AND k <= 53 THEN 'SHIPPED'
      WHEN k = 8 THEN 'MAGIC_DELIVERY' WHEN ok % 2 = 1 THEN lower(st) ELSE st END AS wire_status,
    CASE WHEN k = 1 THEN NULL WHEN k = 21 THEN 0 ELSE item_count END AS wire_count,
    CAST(CASE WHEN k = 1 THEN NULL WHEN k = 9 THEN -150 WHEN r.copy = 2 AND k = 54 THEN total + 10 ELSE total END AS DECIMAL(12,2)) AS wire_total,
    CAST(CASE WHEN k IN (1, 24) THEN NULL WHEN k = 22 THEN -1 ELSE discount END AS DECIMAL(12,2)) AS wire_discount,
    CAST(CASE WHEN k IN (1, 24) THEN NULL ELSE tax END AS DECIMAL(12,2)) AS wire_tax,
    CAST(CASE WHEN k = 1 THEN NULL WHEN k = 10 THEN -1 ELSE total - discount + tax + CASE WHEN k = 20 THEN 1 ELSE 0 END END AS DECIMAL(12,2)) AS wire_net,
    CASE WHEN k IN (1, 16) THEN NULL WHEN k = 17 THEN '2002-12-01T00:00:00Z' WHEN k = 18 THEN 'not-a-date'
      ELSE strftime(ots, '%Y-%m-%dT%H:%M:%SZ') END AS wire_time,
    {CODE} AS rule_code,
    coalesce({CODE}, {CONSTRAINT}) AS code
  FROM base b JOIN (VALUES (0), (1), (2), (3)) r(copy)
    ON r.copy = 0 OR (r.copy = 1 AND k = 60) OR (r.copy = 2 AND k BETWEEN 50 AND 54) OR (r.copy = 3 AND k = 55)),
vv AS (SELECT * FROM dl WHERE code IS NULL),
v AS (SELECT * FROM vv WHERE copy <> 3),
q0 AS (
  SELECT * FROM dl WHERE code IS NOT NULL
  UNION ALL SELECT * REPLACE ('{R.DUPLICATE_EVENT_ID}' AS code) FROM vv WHERE copy = 3),
q AS (SELECT *, {REASON} AS reason FROM q0),
fo AS (
  SELECT order_id, arg_min(event_id, seq) AS event_id, arg_min(customer_id, seq) AS customer_id,
    arg_min(location_id, seq) AS location_id, arg_min(payment_method_id, seq) AS payment_method_id,
    upper(arg_max(wire_status, seq)) AS order_status, arg_min(wire_total, seq) AS total_amount,
    arg_min(coalesce(wire_discount, 0), seq) AS discount_amount, arg_min(coalesce(wire_tax, 0), seq) AS tax_amount,
    arg_min(wire_net, seq) AS net_amount, arg_min(wire_count, seq) AS item_count, arg_min(ots, seq) AS order_timestamp,
    arg_max(received_at, seq) AS processed_at, arg_max(latency, seq) AS ingest_latency_ms,
    count(*) AS versions, arg_max(copy, seq) AS last_copy, arg_max(batch_id, seq) AS batch_id, max(seq) AS seq,
    any_value(k) AS k, any_value(ok) AS ok, any_value(ck) AS ck
  FROM v GROUP BY order_id),
foi AS (
  SELECT f.order_id, i.pos AS line_no, i.product_id, i.l_partkey, i.quantity, i.unit_price, i.total_item_price,
    i.discount_applied, f.processed_at AS created_at, f.batch_id, f.seq
  FROM fo f JOIN it i ON i.l_orderkey = f.ok
  WHERE NOT (f.last_copy = 2 AND f.k = 54 AND i.pos > 0)),
dc AS (
  SELECT 'CUST-' || c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment, false AS inferred
  FROM customer WHERE c_custkey % 97 <> 0
  UNION ALL SELECT DISTINCT 'CUST-' || ck, 'Customer CUST-' || ck, 'Standard', true FROM v WHERE ck % 97 = 0),
dloc AS (
  SELECT 'LOC-' || n_nationkey AS location_id, n_name AS city, n_name AS country, r_name AS region,
    {dbl("n_nationkey * 3 - 36")} AS latitude, {dbl("n_nationkey * 14 - 170")} AS longitude, false AS inferred
  FROM nation LEFT JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey <> 24
  UNION ALL SELECT DISTINCT 'LOC-24', 'Unknown', 'Unknown', NULL, NULL, NULL, true FROM v WHERE nk = 24),
dpay AS (
  SELECT * FROM (VALUES {_PAYMENTS}) t(payment_method_id, method_type, provider, inferred)
  UNION ALL SELECT DISTINCT 'PAY-CRYPTO', 'CRYPTO', 'CRYPTO', true FROM v WHERE pay = 'PAY-CRYPTO'),
dprod AS (
  SELECT 'PROD-' || p_partkey AS product_id, p_name AS product_name, p_type AS category, false AS inferred
  FROM part WHERE p_partkey % 97 <> 0
  UNION ALL SELECT DISTINCT i.product_id, 'Product ' || i.product_id, 'General', true
  FROM it i JOIN v ON v.ok = i.l_orderkey WHERE i.l_partkey % 97 = 0),
dups AS (
  SELECT batch_id, CAST(sum(CASE WHEN rn > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicates
  FROM (SELECT batch_id, row_number() OVER (PARTITION BY order_id ORDER BY seq) AS rn FROM v) GROUP BY batch_id),
stats AS (
  SELECT batch_id, count(*) AS processed, count(*) FILTER (WHERE code IS NULL AND copy <> 3) AS valid,
    count(*) FILTER (WHERE code IS NOT NULL OR copy = 3) AS quarantined, sum(latency) FILTER (WHERE code IS NULL AND copy <> 3) AS latency_total,
    max(received_at) AS finished_at FROM dl GROUP BY batch_id)
"""


def _audit(kind: tuple[str, str], total: str, failed: str, rows_failed: str, details: list[tuple[str, str]], source: str, extra: str = "") -> str:
    body = " || ',' || ".join(f"'\"{label}\":' || {value}" for label, value in details)
    passed = f"greatest(0, {total} - {failed})"
    return f"""SELECT {quoted(kind[0])} AS check_name, '{kind[1]}' AS check_type, 'fact_orders' AS table_audited,
      {total} AS records_evaluated, {passed} AS records_passed, {failed} AS records_failed, {rows_failed} AS rows_failed,
      {pct(passed, total, 2, 100.0)} AS pass_rate, CASE WHEN {failed} = 0 THEN 'PASSED' ELSE 'FAILED' END AS status,
      '{{' || {body} || '}}' AS details{extra} FROM ({source}) s WHERE {total} > 0"""


def _null_audit(extra: str = "") -> str:
    return _audit(
        A.NULL_CHECK, "n", "0", "0",
        [("total_rows", "n"), *[(label, "0") for _, label in A.MANDATORY]],
        "SELECT count(*) AS n FROM fo", extra,
    )


def _financial_audit(extra: str = "") -> str:
    return _audit(
        A.FINANCIAL_CHECK, "n", "bad", "bad",
        [("total_orders", "n"), ("reconciliation_discrepancies", "bad")],
        "SELECT count(*) AS n, count(*) FILTER (WHERE abs(net_amount - (total_amount - discount_amount + tax_amount)) > 0.05) AS bad FROM fo",
        extra,
    )


def _referential_audit(seeds_only: bool, extra: str = "") -> str:
    known = "WHERE NOT inferred" if seeds_only else ""
    source = f"""SELECT count(*) AS n, count(*) FILTER (WHERE c.customer_id IS NULL) AS oc,
        count(*) FILTER (WHERE l.location_id IS NULL) AS ol, count(*) FILTER (WHERE p.payment_method_id IS NULL) AS op,
        count(*) FILTER (WHERE c.customer_id IS NULL OR l.location_id IS NULL OR p.payment_method_id IS NULL) AS orows
      FROM fo LEFT JOIN (SELECT customer_id FROM dc {known}) c ON c.customer_id = fo.customer_id
      LEFT JOIN (SELECT location_id FROM dloc {known}) l ON l.location_id = fo.location_id
      LEFT JOIN (SELECT payment_method_id FROM dpay {known}) p ON p.payment_method_id = fo.payment_method_id"""
    return _audit(
        A.REFERENTIAL_CHECK, "n", "(oc + ol + op)", "orows",
        [("total_orders", "n"), ("orphan_customers", "oc"), ("orphan_locations", "ol"), ("orphan_payments", "op")],
        source, extra,
    )


def _suite(extra: str = "") -> str:
    return " UNION ALL ".join(
        [
            _null_audit(f", 1 AS check_order{extra}"),
            _referential_audit(False, f", 2 AS check_order{extra}"),
            _financial_audit(f", 3 AS check_order{extra}"),
        ]
    )


_AUDIT_COLUMNS = "check_name, check_type, table_audited, records_evaluated, records_passed, records_failed, pass_rate, status"
_AUDIT_LOG = f"SELECT *, {NOW} - to_hours(h) AS audited FROM ({_suite()}) a, range(8) r(h)"


def _mart(orders: str, quarantine: str) -> str:
    return f"""SELECT coalesce(f.start, x.start) AS start, coalesce(n, 0) AS n, coalesce(rev, 0) AS rev, coalesce(items, 0) AS items,
        coalesce(good, 0) AS good, coalesce(cancelled, 0) AS cancelled, coalesce(rejected, 0) AS rejected
      FROM (SELECT date_trunc('hour', order_timestamp) AS start, count(*) AS n, sum(net_amount) AS rev, sum(item_count) AS items,
          count(*) FILTER (WHERE order_status = 'DELIVERED') AS good, count(*) FILTER (WHERE order_status = 'CANCELLED') AS cancelled
        FROM {orders} GROUP BY 1) f
      FULL JOIN (SELECT date_trunc('hour', received_at) AS start, count(*) AS rejected FROM {quarantine} GROUP BY 1) x ON x.start = f.start"""


_MART_COLUMNS = f"""{ts("start")} AS hourly_window_start, {ts("start + INTERVAL 1 HOUR")} AS hourly_window_end,
    CAST(n AS BIGINT) AS total_orders, {dbl("rev")} AS total_revenue,
    CASE WHEN n = 0 THEN 0.0 ELSE {half_up("rev", "greatest(n, 1)")} END AS avg_order_value,
    CAST(items AS BIGINT) AS total_items_sold, CAST(good AS BIGINT) AS successful_orders, CAST(cancelled AS BIGINT) AS cancelled_orders,
    CAST(rejected AS BIGINT) AS quarantined_orders, {ts(NOW)} AS updated_at"""

_EARLY = """(SELECT order_id, arg_min(ots, seq) AS order_timestamp, arg_min(wire_net, seq) AS net_amount, arg_min(wire_count, seq) AS item_count,
    upper(arg_max(wire_status, seq)) AS order_status FROM v WHERE batch_id = 0 GROUP BY order_id)"""

_TOUCHED = """(SELECT date_trunc('hour', ots) FROM v WHERE batch_id = 1
    UNION SELECT date_trunc('hour', received_at) FROM q WHERE batch_id = 1)"""

_FACT_COLUMNS = f"""order_id, event_id, customer_id, location_id, payment_method_id, order_status, {dbl("total_amount")} AS total_amount,
    {dbl("discount_amount")} AS discount_amount, {dbl("tax_amount")} AS tax_amount, {dbl("net_amount")} AS net_amount, item_count,
    {ts("order_timestamp")} AS order_timestamp, {ts("processed_at")} AS processed_at, ingest_latency_ms"""

_TAX8 = "CAST(round(greatest(CAST(0 AS DECIMAL(18,2)), total_amount - discount_amount) * CAST(0.08 AS DECIMAL(6,4)), 2) AS DECIMAL(18,2))"


def _totals(source: str, keys: str) -> str:
    return f"""SELECT {keys}, item_count, {dbl("total_amount")} AS total_amount, {dbl("discount_amount")} AS discount_amount,
        {dbl(_TAX8)} AS tax_amount, {dbl(f"total_amount - discount_amount + {_TAX8}")} AS net_amount FROM ({source}) s"""


_CONTRACT = """concat_ws(',', CASE WHEN k = 5 THEN 'location_id' END, CASE WHEN k = 6 THEN 'payment_method_id' END,
    CASE WHEN k = 8 THEN 'order_status' END, CASE WHEN k = 11 OR is_empty THEN 'items' END,
    CASE WHEN k IN (12, 13) AND NOT is_empty THEN 'items.product_id' END,
    CASE WHEN k IN (12, 14) AND NOT is_empty THEN 'items.quantity' END,
    CASE WHEN k IN (12, 15) AND NOT is_empty THEN 'items.unit_price' END,
    CASE WHEN k IN (12, 23) AND NOT is_empty THEN 'items.total_item_price' END,
    CASE WHEN wire_count <= 0 THEN 'item_count' END, CASE WHEN k = 9 THEN 'total_amount' END,
    CASE WHEN k = 22 THEN 'discount_amount' END, CASE WHEN k = 10 THEN 'net_amount' END)"""

_ITEMS_SENT = """CASE WHEN k IN (1, 11) OR is_empty THEN 0 WHEN k = 12 THEN n_items + 1
    WHEN k = 54 AND copy = 2 THEN least(1, n_items) ELSE n_items END"""

_REQUESTED = """(SELECT DISTINCT order_id FROM (SELECT 'ORD-' || o_orderkey AS order_id FROM orders
    UNION ALL SELECT 'ORD-S' || s_suppkey FROM supplier UNION ALL SELECT '' FROM region) r)"""

# fact column name -> expression over a CTE row, for NULL counts of the stored tables
_PROFILES = {
    "fact_orders": ("fo", {}),
    "fact_order_items": ("foi", {}),
    "dim_customers": ("dc", {"city": True, "country": "inferred"}),
    "dim_locations": ("dloc", {"state": True, "postal_code": True, "region": "inferred", "latitude": "inferred", "longitude": "inferred"}),
    "dim_payment_methods": ("dpay", {}),
    "dim_products": ("dprod", {"supplier_id": "NOT inferred"}),
    "quarantine_orders": ("q", {"event_id": "event_id IS NULL", "order_id": "order_id IS NULL"}),
    "dim_dates": ("(SELECT unnest(generate_series(min(CAST(order_timestamp AS DATE)), max(CAST(order_timestamp AS DATE)), INTERVAL 1 DAY)) FROM fo) d", {}),
    "data_quality_audit_log": (f"({_AUDIT_LOG}) a", {}),
    "pipeline_health_metrics": ("stats", {}),
    "hourly_order_aggregates": (f"({_mart('fo', 'q')}) m", {}),
}


def _catalog() -> str:
    parts = []
    for table, (source, empty) in _PROFILES.items():
        for position, field in enumerate(TABLES[table].fields, 1):
            default = COLUMN_DEFAULTS.get(table, {}).get(field.name)
            shown = "NULL" if default is None else quoted(str(default).lower())
            rule = empty.get(field.name)
            nulls = "count(*)" if rule is True else f"count(*) FILTER (WHERE {rule})" if rule else "0"
            parts.append(
                f"SELECT '{table}' AS table_name, '{field.name}' AS column_name, count(*) AS row_count, {nulls} AS null_count, "
                f"{position} AS position, '{field.dataType.simpleString()}' AS data_type, CAST({shown} AS VARCHAR) AS default_value, "
                f"{'true' if PRIMARY_KEYS.get(table) == field.name else 'false'} AS is_key FROM {source}"
            )
    return " UNION ALL ".join(parts)


BODIES: dict[str, str] = {
    "stream_source_events": f"SELECT event_id, {ts('ts')} AS ts, user_id, event_type, value FROM events",
    "decode_events": f"""SELECT batch_id, seq, k <> 1 AS is_object, event_id, order_id, customer_id, location_id, payment_method_id,
        wire_status AS order_status, wire_count AS item_count, {dbl("wire_total")} AS total_amount, {dbl("wire_discount")} AS discount_amount,
        {dbl("wire_tax")} AS tax_amount, {dbl("wire_net")} AS net_amount, wire_time AS order_timestamp,
        CASE WHEN k <> 1 THEN 'd' || ok % 5 END AS device, CASE WHEN k <> 1 THEN channel END AS channel, {_ITEMS_SENT} AS items_decoded FROM dl""",
    "stream_bounded_ingest": "SELECT CASE WHEN code IS NULL AND copy <> 3 THEN 'valid' ELSE 'quarantined' END AS outcome, count(*) AS events FROM dl GROUP BY 1",
    "stream_ingest_orders": f"SELECT {_FACT_COLUMNS} FROM fo",
    "stream_quarantine": f"""SELECT event_id, order_id, code AS error_code, 'Rule_' || code AS failed_validation_rule,
        {ts("received_at")} AS quarantined_at, seq FROM q""",
    "publish_keyed_events": f"SELECT order_id AS key, seq, order_id, event_id, {dbl('wire_total')} AS total_amount FROM dl WHERE k <> 1",
    "publish_report": """SELECT ok % 7 <> 0 OR order_id IS NULL AS success, 'FILES' AS mode, 'raw_orders' AS topic, order_id, event_id, wire_time AS timestamp
        FROM dl WHERE k <> 1""",
    "param_scan": f"SELECT order_id, order_status, {dbl('net_amount')} AS net_amount FROM fo WHERE order_status = 'DELIVERED' AND net_amount >= 100000",
    "write_rowcount": """SELECT 'fact_orders' AS table_name, count(*) AS rows_written FROM fo
        UNION ALL SELECT 'fact_order_items', count(*) FROM foi UNION ALL SELECT 'quarantine_orders', count(*) FROM q""",
    "catalog_columns": _catalog(),
    "quarantine_rows": f"""SELECT batch_id, seq, event_id, order_id, code AS error_code, reason AS rejection_reason,
        'Rule_' || code AS failed_validation_rule, {ts("received_at")} AS quarantined_at, true AS has_payload FROM q""",
    "validate_events": "SELECT batch_id, seq, coalesce(rule_code, 'VALID') AS verdict, rule_code IS NULL AS is_valid FROM dl",
    "first_item_error": f"""SELECT batch_id, seq, CASE WHEN k = 12 THEN 0 ELSE n_items - 1 END AS item_index, code AS error_code,
        {ITEM_REASON} AS reason FROM dl WHERE k BETWEEN 12 AND 15 AND NOT is_empty""",
    "rejection_reasons": "SELECT batch_id, seq, reason AS rejection_reason FROM q",
    "route_valid": f"SELECT batch_id, seq, order_id, event_id, {dbl('wire_net')} AS net_amount FROM v",
    "route_quarantine": """SELECT batch_id, seq, event_id, order_id, code AS error_code, 'Rule_' || code AS failed_validation_rule
        FROM q""",
    "contract_violations": f"SELECT batch_id, seq, {_CONTRACT} AS violations FROM dl WHERE k <> 1",
    "contract_defaults": f"""SELECT batch_id, seq, true AS identified, upper(wire_status) AS order_status,
        {dbl("coalesce(wire_discount, 0)")} AS discount_amount, {dbl("coalesce(wire_tax, 0)")} AS tax_amount,
        coalesce(wire_time, strftime(received_at, '%Y-%m-%dT%H:%M:%SZ')) AS order_timestamp, 2 AS metadata_entries FROM dl WHERE k <> 1""",
    "constraint_violations": f"""SELECT code AS error_code, count(*) AS failure_count FROM q
        WHERE code LIKE 'CONSTRAINT%' OR code = '{R.DUPLICATE_EVENT_ID}' GROUP BY code""",
    "uniqueness_violations": """SELECT 'order_id' AS key_name, order_id AS key_value, count(*) AS copies FROM v GROUP BY order_id HAVING count(*) > 1
        UNION ALL SELECT 'event_id', event_id, count(*) FROM v GROUP BY event_id HAVING count(*) > 1""",
    "fact_orders": f"SELECT {_FACT_COLUMNS} FROM fo",
    "fact_order_items": f"""SELECT order_id, line_no, product_id, quantity, {dbl("unit_price")} AS unit_price,
        {dbl("total_item_price")} AS total_item_price, {dbl("discount_applied")} AS discount_applied, {ts("created_at")} AS created_at FROM foi""",
    "parse_event_time": f"""SELECT batch_id, seq, {ts(f"CASE WHEN k IN (1, 16, 18) THEN {NOW} WHEN k = 17 THEN TIMESTAMP '2002-12-01' ELSE ots END")} AS event_time
        FROM dl""",
    "ingest_latency": "SELECT batch_id, seq, CASE WHEN k = 17 THEN 0 ELSE latency END AS latency_ms FROM dl WHERE k NOT IN (1, 16, 18)",
    "order_totals_from_items": _totals(
        """SELECT order_id, CAST(sum(quantity) AS BIGINT) AS item_count, CAST(sum(total_item_price) AS DECIMAL(18,2)) AS total_amount,
           CAST(sum(discount_applied) AS DECIMAL(18,2)) AS discount_amount FROM foi GROUP BY order_id""",
        "order_id",
    ),
    "order_totals_in_place": _totals(
        """SELECT v1.batch_id, v1.seq, v1.order_id, CAST(sum(i.quantity) AS BIGINT) AS item_count,
           CAST(sum(i.total_item_price) AS DECIMAL(18,2)) AS total_amount, CAST(sum(i.discount_applied) AS DECIMAL(18,2)) AS discount_amount
           FROM v v1 JOIN it i ON i.l_orderkey = v1.ok WHERE NOT (v1.copy = 2 AND v1.k = 54 AND i.pos > 0)
           GROUP BY ALL""",
        "batch_id, seq, order_id",
    ),
    "line_prices": f"""SELECT order_id, line_no, quantity, {dbl("unit_price")} AS unit_price, {dbl("quantity * unit_price")} AS total_item_price,
        {dbl("CASE WHEN quantity >= 25 THEN round(quantity * unit_price * CAST(0.10 AS DECIMAL(4,2)), 2) ELSE 0 END")} AS discount_applied FROM foi""",
    "infer_customers": """SELECT DISTINCT customer_id, 'Customer ' || customer_id AS customer_name,
        lower(customer_id) || '@customers.invalid' AS email, 'Standard' AS segment FROM fo WHERE ck % 97 = 0""",
    "infer_locations": "SELECT DISTINCT location_id, 'Unknown' AS city, 'Unknown' AS country FROM fo WHERE location_id = 'LOC-24'",
    "infer_payment_methods": """SELECT DISTINCT payment_method_id, 'CRYPTO' AS method_type, 'CRYPTO' AS provider
        FROM fo WHERE payment_method_id = 'PAY-CRYPTO'""",
    "infer_products": f"""SELECT product_id, 'Product ' || product_id AS product_name, 'General' AS category, 'General' AS subcategory,
        {dbl("price")} AS base_price, {dbl("round(price * CAST(0.70 AS DECIMAL(4,2)), 2)")} AS cost_price, 'SUPP-AUTO' AS supplier_id,
        1000 AS inventory_count FROM (SELECT product_id, any_value(unit_price) AS price FROM foi WHERE l_partkey % 97 = 0 GROUP BY product_id)""",
    "dim_dates": """SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, strftime(d, '%Y-%m-%d') AS full_date, isodow(d) AS day_of_week,
        dayname(d) AS day_name, month(d) AS month_num, monthname(d) AS month_name, quarter(d) AS quarter, year(d) AS year,
        isodow(d) >= 6 AS is_weekend FROM (SELECT unnest(generate_series(min(CAST(order_timestamp AS DATE)),
        max(CAST(order_timestamp AS DATE)), INTERVAL 1 DAY)) AS d FROM fo)""",
    "seed_dim_upsert": f"""SELECT 'dim_customers' AS table_name, 'CUST-' || c_custkey AS key,
        CASE WHEN c_custkey % 97 <> 0 THEN c_name ELSE 'Reloaded ' || c_custkey END AS name, lower(c_mktsegment) AS label,
        'r' || c_custkey || '@customers.invalid' AS detail, CAST(NULL AS DOUBLE) AS price FROM customer
        UNION ALL SELECT 'dim_products', 'PROD-' || p_partkey, CASE WHEN p_partkey % 97 <> 0 THEN p_name ELSE 'Reloaded ' || p_partkey END,
        p_type, '500', {dbl("CAST(p_retailprice AS DECIMAL(12,2)) + 1")} FROM part
        UNION ALL SELECT 'dim_locations', 'LOC-' || n_nationkey, 'New ' || n_name, lower(n_name),
        'S/' || CASE WHEN n_nationkey <> 24 THEN r_name ELSE 'Elsewhere' END, NULL FROM nation LEFT JOIN region ON r_regionkey = n_regionkey
        UNION ALL SELECT 'dim_payment_methods', id, lower(method), 'by ' || provider, CASE WHEN id = 'PAY-CRYPTO' THEN 'false' ELSE 'true' END, NULL
        FROM (VALUES {_ALL_PAYMENTS}) t(id, method, provider)
        UNION ALL SELECT 'dim_dates', strftime(d, '%Y%m%d'), CASE WHEN d <= last_day THEN dayname(d) ELSE 'again' END, monthname(d),
        CASE WHEN isodow(d) >= 6 THEN 'true' ELSE 'false' END, NULL
        FROM (SELECT unnest(generate_series(first_day, last_day + 30, INTERVAL 1 DAY)) AS d, last_day FROM
          (SELECT min(CAST(order_timestamp AS DATE)) AS first_day, max(CAST(order_timestamp AS DATE)) AS last_day FROM fo))""",
    "recent_orders_feed": f"""SELECT fo.order_id, event_id, customer_name, segment AS customer_segment, city, country, method_type AS payment_method,
        order_status, item_count, {dbl("net_amount")} AS net_amount, ingest_latency_ms, {ts("order_timestamp")} AS order_timestamp,
        {ts("processed_at")} AS processed_at FROM fo LEFT JOIN dc USING (customer_id) LEFT JOIN dloc USING (location_id)
        LEFT JOIN dpay USING (payment_method_id) ORDER BY fo.order_timestamp DESC, fo.order_id LIMIT 50""",
    "order_status_lookup": f"""SELECT r.order_id, fo.order_id IS NOT NULL OR x.order_id IS NOT NULL AS found,
        CASE WHEN r.order_id = '' THEN 'UNKNOWN' WHEN fo.order_id IS NOT NULL THEN 'PERSISTED' WHEN x.order_id IS NOT NULL THEN 'QUARANTINED'
          ELSE 'PENDING_INGESTION' END AS status,
        CASE WHEN fo.order_id IS NOT NULL THEN 'fact_orders' WHEN x.order_id IS NOT NULL THEN 'quarantine_orders' END AS destination,
        CASE WHEN fo.order_id IS NOT NULL THEN fo.event_id ELSE x.event_id END AS event_id, fo.order_status, {dbl("fo.net_amount")} AS net_amount,
        fo.item_count, customer_name, city, country, method_type AS payment_method,
        CASE WHEN fo.order_id IS NULL THEN x.code END AS error_code, CASE WHEN fo.order_id IS NULL THEN x.reason END AS rejection_reason
      FROM {_REQUESTED} r LEFT JOIN fo ON fo.order_id = r.order_id
      LEFT JOIN (SELECT order_id, arg_min(event_id, seq) FILTER (WHERE event_id IS NOT NULL) AS event_id, arg_min(code, seq) AS code,
        arg_min(reason, seq) AS reason FROM q WHERE order_id IS NOT NULL GROUP BY order_id) x ON x.order_id = r.order_id
      LEFT JOIN dc ON dc.customer_id = fo.customer_id LEFT JOIN dloc ON dloc.location_id = fo.location_id
      LEFT JOIN dpay ON dpay.payment_method_id = fo.payment_method_id""",
    "dq_referential_integrity": _referential_audit(True, ", 'seeds' AS dimensions")
    + " UNION ALL "
    + _referential_audit(False, ", 'after_ingest' AS dimensions"),
    "revenue_by_category": f"""SELECT category, count(DISTINCT order_id) AS order_count, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
        {dbl("sum(total_item_price)")} AS category_revenue FROM foi JOIN dprod USING (product_id) GROUP BY category""",
    "payment_distribution": f"""SELECT method_type, provider, count(*) AS order_count, {dbl("sum(net_amount)")} AS total_volume
        FROM fo JOIN dpay USING (payment_method_id) GROUP BY ALL""",
    "geo_distribution": f"""SELECT city, country, region, latitude, longitude, count(*) AS order_count, {dbl("sum(net_amount)")} AS total_revenue
        FROM fo JOIN dloc USING (location_id) GROUP BY ALL""",
    "existing_orders": """SELECT order_id, seq FROM v WHERE batch_id = 1 AND order_id IN (SELECT order_id FROM v WHERE batch_id = 0)""",
    "new_dimension_keys": """SELECT 'dim_customers' AS table_name, count(DISTINCT customer_id) AS new_keys FROM fo WHERE ck % 97 = 0
        UNION ALL SELECT 'dim_locations', count(DISTINCT location_id) FROM fo WHERE location_id = 'LOC-24'
        UNION ALL SELECT 'dim_payment_methods', count(DISTINCT payment_method_id) FROM fo WHERE payment_method_id = 'PAY-CRYPTO'
        UNION ALL SELECT 'dim_products', count(DISTINCT product_id) FROM foi WHERE l_partkey % 97 = 0""",
    "fk_orphans": """SELECT 'fact_orders' AS child_table, 'customer_id' AS child_column, 'dim_customers' AS parent_table,
          count(DISTINCT customer_id) AS orphan_keys, count(*) AS orphan_rows FROM fo WHERE ck % 97 = 0
        UNION ALL SELECT 'fact_orders', 'location_id', 'dim_locations', count(DISTINCT location_id), count(*) FROM fo WHERE location_id = 'LOC-24'
        UNION ALL SELECT 'fact_orders', 'payment_method_id', 'dim_payment_methods', count(DISTINCT payment_method_id), count(*)
          FROM fo WHERE payment_method_id = 'PAY-CRYPTO'
        UNION ALL SELECT 'fact_order_items', 'order_id', 'fact_orders', 0, 0
        UNION ALL SELECT 'fact_order_items', 'product_id', 'dim_products', count(DISTINCT product_id), count(*) FROM foi WHERE l_partkey % 97 = 0""",
    "cascade_delete": """SELECT order_id, count(*) AS lines_left FROM foi WHERE order_id NOT IN
        (SELECT order_id FROM fo JOIN dc USING (customer_id) WHERE segment = 'BUILDING') GROUP BY order_id""",
    "executive_kpis": f"""SELECT count(*) AS total_orders, {dbl("coalesce(sum(net_amount), 0)")} AS total_revenue,
        coalesce({dbl("sum(net_amount)")} / nullif(count(*), 0), 0.0) AS avg_order_value, CAST(coalesce(sum(item_count), 0) AS BIGINT) AS total_items_sold,
        count(*) FILTER (WHERE order_status = 'DELIVERED') AS delivered_orders, count(*) FILTER (WHERE order_status = 'CANCELLED') AS cancelled_orders,
        (SELECT count(*) FROM q) AS quarantined_count,
        {pct("count(*) FILTER (WHERE order_status = 'DELIVERED')", "count(*)", 1, 0.0)} AS delivery_rate FROM fo""",
    "live_ingest_rate": """SELECT 'newest order' AS moment, CAST((2 * 10 * count(*) + 30) // 60 AS DOUBLE) / 10.0 AS events_per_second FROM fo
        WHERE processed_at >= (SELECT max(processed_at) FROM fo) - INTERVAL 30 SECOND
        UNION ALL SELECT 'idle', CAST((2 * 10 * processed + 3) // 6 AS DOUBLE) / 10.0 FROM
        (SELECT arg_max(processed, finished_at) AS processed FROM stats)""",
    "quarantine_summary": "SELECT code AS error_code, reason AS rejection_reason, count(*) AS failure_count FROM q GROUP BY ALL",
    "quarantine_by_code": "SELECT code AS error_code, count(*) AS failure_count FROM q GROUP BY ALL",
    "validation_pass_rate": f"""SELECT {pct("v", "v + x", 2, 100.0)} AS pass_rate, v AS valid_count, x AS quarantined_count
        FROM (SELECT (SELECT count(*) FROM fo) AS v, (SELECT count(*) FROM q) AS x)""",
    "table_stats": f"""SELECT count(*) AS fact_orders, (SELECT count(*) FROM foi) AS fact_order_items, (SELECT count(*) FROM dc) AS dim_customers,
        (SELECT count(*) FROM dprod) AS dim_products, (SELECT count(*) FROM q) AS quarantine_orders,
        {dbl("sum(ingest_latency_ms)")} / count(*) AS avg_latency_ms FROM fo""",
    "warehouse_heartbeat": f"""SELECT {ts(NOW)} AS timestamp, 'AIRFLOW' AS component, 'WAREHOUSE_HEARTBEAT' AS metric_name, CAST(0 AS DOUBLE) AS metric_value,
        'ms' AS metric_unit, 'HEALTHY' AS status_indicator, '{{"fact_orders_count":' || (SELECT count(*) FROM fo) || ',"items_count":' ||
        (SELECT count(*) FROM foi) || ',"quarantine_count":' || (SELECT count(*) FROM q) || '}}' AS details""",
    "dq_null_checks": _null_audit(),
    "dq_financial_reconciliation": _financial_audit(),
    "dq_suite": _suite(),
    "dq_audit_log": f"SELECT {_AUDIT_COLUMNS}, {ts('audited')} AS audit_timestamp, details FROM ({_AUDIT_LOG}) l",
    "dq_audit_history": f"""SELECT {_AUDIT_COLUMNS}, {ts('audited')} AS audit_timestamp FROM ({_AUDIT_LOG}) l
        ORDER BY audited DESC, check_type LIMIT 20""",
    "hourly_rollup": f"SELECT {_MART_COLUMNS} FROM ({_mart('fo', 'q')}) m",
    "rollup_snapshot": f"""SELECT {_MART_COLUMNS} FROM (SELECT date_trunc('hour', {NOW} - INTERVAL 1 HOUR) AS start, count(*) AS n,
        coalesce(sum(net_amount), 0) AS rev, coalesce(sum(item_count), 0) AS items, count(*) FILTER (WHERE order_status = 'DELIVERED') AS good,
        count(*) FILTER (WHERE order_status = 'CANCELLED') AS cancelled, (SELECT count(*) FROM q) AS rejected FROM fo) m""",
    "hourly_mart_upsert": f"""SELECT {_MART_COLUMNS} FROM ({_mart(_EARLY, '(SELECT * FROM q WHERE batch_id = 0)')}) m WHERE start NOT IN {_TOUCHED}
        UNION ALL SELECT {_MART_COLUMNS} FROM ({_mart('fo', 'q')}) m WHERE start IN {_TOUCHED}""",
    "mart_month": f"""SELECT {_MART_COLUMNS} FROM ({_mart('fo', 'q')}) m
        WHERE strftime(start, '%Y-%m') = (SELECT strftime(max(order_timestamp), '%Y-%m') FROM fo)""",
    "orders_after_merge": f"SELECT {_FACT_COLUMNS}, versions FROM fo",
    "items_after_merge": f"""SELECT order_id, count(*) AS lines, {dbl("sum(total_item_price)")} AS total, CAST(sum(quantity) AS BIGINT) AS units
        FROM foi GROUP BY order_id""",
    "batch_stats": f"""SELECT batch_id, processed, valid, quarantined, coalesce(duplicates, 0) AS duplicates, {ts("finished_at")} AS finished_at
        FROM stats LEFT JOIN dups USING (batch_id)""",
    "batch_health_metric": f"""SELECT batch_id, {ts("finished_at")} AS timestamp, 'SPARK' AS component, 'BATCH_RECORDS_PROCESSED' AS metric_name,
        {dbl("processed")} AS metric_value, 'records' AS metric_unit, 'HEALTHY' AS status_indicator,
        '{{"valid":' || valid || ',"quarantined":' || quarantined || ',"duplicates_detected":' || coalesce(duplicates, 0) ||
        ',"avg_latency_ms":' || CAST(CASE WHEN valid = 0 THEN 0.0 ELSE {half_up("latency_total", "greatest(valid, 1)")} END AS DOUBLE) || '}}' AS details
        FROM stats LEFT JOIN dups USING (batch_id)""",
    "latency_histogram": f"""SELECT CAST(b + 1 AS INT) AS bin, low + width * b AS bin_start, count(*) AS order_count FROM
        (SELECT low, width, least(coalesce(floor(CAST(x - low AS DOUBLE) / nullif(width, 0)), 0), 19) AS b FROM
          (SELECT ingest_latency_ms AS x, (SELECT min(ingest_latency_ms) FROM fo) AS low,
            {dbl("(SELECT max(ingest_latency_ms) - min(ingest_latency_ms) FROM fo)")} / 20.0 AS width FROM fo) s) t GROUP BY ALL""",
    "payment_share": f"""SELECT method_type, {dbl("sum(net_amount)")} AS total_volume,
        {dbl("sum(net_amount)")} / {dbl("sum(sum(net_amount)) OVER ()")} AS share FROM fo JOIN dpay USING (payment_method_id) GROUP BY method_type""",
    "cumulative_revenue": f"""SELECT order_id, {ts("order_timestamp")} AS order_timestamp, {dbl("net_amount")} AS net_amount,
        {dbl("sum(net_amount) OVER (ORDER BY fo.order_timestamp, fo.order_id ROWS UNBOUNDED PRECEDING)")} AS cumulative_revenue FROM fo""",
    "order_versions": """SELECT order_id, batch_id, seq, upper(wire_status) AS order_status,
        row_number() OVER (PARTITION BY order_id ORDER BY batch_id, seq) AS version_no FROM v""",
    "quarantine_latest": f"""SELECT batch_id, seq, event_id, order_id, code AS error_code, reason AS rejection_reason, {ts("received_at")} AS quarantined_at
        FROM q ORDER BY received_at DESC, batch_id, seq LIMIT 30""",
    "worker_active": "SELECT 'newest' AS moment, count(*) > 0 AS active FROM stats UNION ALL SELECT 'minute later', count(*) < 0 FROM stats",
    "combined_batch": """SELECT CASE WHEN batch_id = 1 THEN 'manual' ELSE 'automatic' END AS origin, count(*) AS processed,
        count(*) FILTER (WHERE code IS NULL) AS valid, count(*) FILTER (WHERE code IS NOT NULL) AS quarantined FROM dl GROUP BY 1""",
    "dims_after_ingest": """SELECT 'dim_customers' AS table_name, customer_id AS key, inferred FROM dc
        UNION ALL SELECT 'dim_locations', location_id, inferred FROM dloc UNION ALL SELECT 'dim_payment_methods', payment_method_id, inferred FROM dpay
        UNION ALL SELECT 'dim_products', product_id, inferred FROM dprod""",
    "orders_upsert_latest": f"""SELECT order_id, order_status, {dbl("total_amount")} AS total_amount, {dbl("net_amount")} AS net_amount,
        {ts("processed_at")} AS processed_at, ingest_latency_ms, versions FROM fo WHERE versions > 1""",
    "items_replace_latest": f"""SELECT foi.order_id, line_no, product_id, quantity, {dbl("total_item_price")} AS total_item_price, foi.batch_id, foi.seq
        FROM foi JOIN fo ON fo.order_id = foi.order_id WHERE fo.versions > 1""",
    "duplicate_counts": "SELECT batch_id, duplicates FROM dups",
    "replay_idempotent": f"""SELECT count(*) AS orders, {dbl("sum(net_amount)")} AS revenue, CAST(sum(versions) AS BIGINT) AS versions,
        (SELECT count(*) FROM dl) AS log_rows FROM fo""",
    "committed_batches": "SELECT batch_id, count(*) AS visible_rows FROM dl WHERE batch_id = 0 GROUP BY batch_id",
    "surrogate_keys": "SELECT count(*) AS stable_keys, count(*) AS distinct_keys, count(*) AS line_items FROM foi",
    "scalar_functions": f"""SELECT order_id, {dbl("coalesce(nullif(discount_amount, 0), -1)")} AS coalesced,
        CASE WHEN net_amount > 100000 THEN 'large' ELSE 'small' END AS size_class, {dbl("abs(net_amount - total_amount)")} AS absolute,
        {dbl("round(net_amount * CAST(0.7 AS DECIMAL(2,1)), 2)")} AS rounded, greatest(0, item_count - 100) AS clamped, lower(customer_id) AS lowered,
        ok AS order_number, CAST(strftime(order_timestamp, '%Y%m%d') AS INT) AS date_key, isodow(order_timestamp) AS iso_weekday,
        quarter(order_timestamp) AS quarter, {ts("date_trunc('hour', order_timestamp)")} AS hour_start,
        {ts("date_trunc('hour', order_timestamp) - INTERVAL 1 HOUR")} AS previous_hour, 'Customer ' || customer_id AS label, item_count AS json_count FROM fo""",
    "stream_dedup": "SELECT DISTINCT user_id FROM events",
    "stream_hourly_rollup": f"SELECT {_MART_COLUMNS} FROM ({_mart('fo', 'q')}) m",
    "stream_hourly_once": f"""SELECT {ts("date_trunc('hour', ots)")} AS hourly_window_start, {ts("date_trunc('hour', ots) + INTERVAL 1 HOUR")} AS hourly_window_end,
        count(*) AS total_orders, {dbl("sum(wire_net)")} AS total_revenue, CAST(sum(wire_count) AS BIGINT) AS total_items_sold
        FROM (SELECT * FROM dl WHERE code IS NULL) d WHERE copy IN (0, 3) GROUP BY date_trunc('hour', ots)""",
    "stream_progress": """SELECT 'SPARK' AS component, 'STREAM_TRIGGER_ROWS' AS metric_name, 'records' AS metric_unit,
        CAST(count(*) AS DOUBLE) AS rows FROM events""",
    "stream_event_rate": f"""SELECT {ts("time_bucket(INTERVAL 30 SECOND, ts)")} AS window_start, count(*) AS events,
        CAST((2 * 100 * count(*) + 30) // 60 AS DOUBLE) / 100.0 AS events_per_second FROM events GROUP BY time_bucket(INTERVAL 30 SECOND, ts)""",
    "segment_spending": f"""SELECT segment, count(*) AS order_count, count(DISTINCT customer_id) AS customer_count, {dbl("sum(net_amount)")} AS total_spend,
        {dbl("sum(net_amount)")} / count(*) AS avg_order_value FROM fo JOIN dc USING (customer_id) GROUP BY segment""",
    "status_breakdown": f"""SELECT order_status, n AS order_count, {pct("n", "t", 2, 0.0)} AS share_percent FROM
        (SELECT order_status, count(*) AS n, (SELECT count(*) FROM fo) AS t FROM fo GROUP BY order_status)""",
    "hourly_volume": f"""SELECT CAST(hour(order_timestamp) AS INT) AS hour_of_day, count(*) AS order_count, {dbl("sum(net_amount)")} AS total_revenue
        FROM fo GROUP BY 1""",
    "order_line_items": f"""SELECT foi.order_id, line_no, foi.product_id, product_name, category, quantity, {dbl("unit_price")} AS unit_price,
        {dbl("total_item_price")} AS total_item_price FROM foi JOIN fo ON fo.order_id = foi.order_id LEFT JOIN dprod ON dprod.product_id = foi.product_id
        WHERE fo.order_status = 'DELIVERED'""",
    "table_freshness": f"""SELECT table_name, {ts("last_update")} AS last_update,
        CAST(floor(epoch({NOW})) - floor(epoch(last_update)) AS BIGINT) AS age_seconds FROM (
        SELECT 'fact_orders' AS table_name, max(processed_at) AS last_update FROM fo UNION ALL SELECT 'fact_order_items', max(created_at) FROM foi
        UNION ALL SELECT 'quarantine_orders', max(received_at) FROM q UNION ALL SELECT 'pipeline_health_metrics', max(finished_at) FROM stats) t""",
}

_METRIC_ROW = f"{ts('finished_at')} AS timestamp, {dbl('processed')} AS metric_value"
BODIES["latest_batch_metric"] = f"SELECT {_METRIC_ROW} FROM stats ORDER BY finished_at DESC LIMIT 1"
BODIES["recent_batch_metrics"] = (
    f"SELECT timestamp, metric_value, details FROM ({BODIES['batch_health_metric']}) m ORDER BY timestamp DESC LIMIT 15"
)


def statements() -> dict[str, str]:
    return {name: f"{CTES}\n{body}" for name, body in BODIES.items()}
