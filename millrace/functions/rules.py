"""The ordered data-quality rules of an order event, as SQL expressions over its columns.

Rules are tried in order and the first failing one names the error. They are kept as text
and parsed as one CASE expression, so the same list serves batch and streaming plans and
setting up a micro-batch takes one call to the JVM instead of thousands.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from millrace.functions.clock import LOCAL_TIME_SQL
from millrace.model import ORDER_STATUSES, PAYMENT_METHOD_IDS

# --- Fixed values: error codes and reason texts -------------------------------------------
CORRUPT_PAYLOAD = "CORRUPT_PAYLOAD"
IDENTIFIER_CODES = [
    ("event_id", "NULL_EVENT_ID"),
    ("order_id", "NULL_ORDER_ID"),
    ("customer_id", "NULL_CUSTOMER_ID"),
    ("location_id", "NULL_LOCATION_ID"),
    ("payment_method_id", "NULL_PAYMENT_METHOD"),
]
INVALID_PAYMENT_METHOD = "INVALID_PAYMENT_METHOD"
INVALID_ORDER_STATUS = "INVALID_ORDER_STATUS"
NEGATIVE_OR_NULL_TOTAL = "NEGATIVE_OR_NULL_TOTAL"
NEGATIVE_OR_NULL_NET = "NEGATIVE_OR_NULL_NET"
EMPTY_ITEMS_ARRAY = "EMPTY_ITEMS_ARRAY"
CORRUPT_LINE_ITEM = "CORRUPT_LINE_ITEM"
NULL_PRODUCT_ID = "NULL_PRODUCT_ID"
INVALID_QUANTITY = "INVALID_QUANTITY"
INVALID_UNIT_PRICE = "INVALID_UNIT_PRICE"
NULL_TIMESTAMP = "NULL_TIMESTAMP"
FUTURE_TIMESTAMP_ANOMALY = "FUTURE_TIMESTAMP_ANOMALY"
MALFORMED_TIMESTAMP = "MALFORMED_TIMESTAMP"

REASON_CORRUPT = "Event payload is not a valid JSON dictionary."
REASON_MISSING = "Field '%s' is missing or null."
REASON_PAYMENT = "Payment method '%s' is not in reference dimensions."
REASON_STATUS = "Order status '%s' is not a recognized state."
REASON_TOTAL = "Gross total amount %s is negative or not a number."
REASON_NET = "Net amount %s is negative or not a number."
REASON_NO_ITEMS = "Order contains no line items."
REASON_ITEM_MALFORMED = "Line item at index %s is malformed."
REASON_ITEM_PRODUCT = "Line item at index %s has missing product_id."
REASON_ITEM_QUANTITY = "Line item %s has invalid quantity: %s."
REASON_ITEM_PRICE = "Line item %s has negative/null unit price: %s."
REASON_NO_TIMESTAMP = "Field 'order_timestamp' is missing."
REASON_FUTURE = "Timestamp %s is unreasonably far in the future."
REASON_UNPARSED = "Could not parse timestamp '%s': %s"
DETAIL_NAIVE = "can't compare offset-naive and offset-aware datetimes"
DETAIL_NOT_ISO = "Invalid isoformat string: '%s'"
# --- end of fixed values ------------------------------------------------------------------

# Codes of our own, for events that pass the rules above but break a table constraint.
CONSTRAINT_PREFIX = "CONSTRAINT_"
REASON_CONSTRAINT = "Column '%s' violates its table constraint."
DUPLICATE_EVENT_ID = "DUPLICATE_EVENT_ID"
REASON_DUPLICATE_EVENT = "Event id '%s' already belongs to order '%s'."

DEFAULT_TOLERANCE = "30 days"

# The largest double that still rounds to a decimal(12,2).
MONEY_LIMIT = "9999999999.995D"


@dataclass(frozen=True)
class Rule:
    """SQL for a code, for the condition under which it applies, and for its reason."""

    code: str
    fails: str
    reason: str


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literals(values: list[str]) -> str:
    return ", ".join(literal(v) for v in values)


def filled(template: str, *parts: str) -> str:
    """Fill ``%s`` places with expressions; an absent value reads None."""
    values = ", ".join(f"coalesce(CAST({p} AS STRING), 'None')" for p in parts)
    return f"format_string({literal(template)}, {values})"


def text(template: str, *parts: Column) -> Column:
    """``filled`` for columns."""
    return F.format_string(template, *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts])


def number_text(number: str) -> str:
    """A double as plain digits with at least one decimal, None if absent."""
    plain = rf"regexp_replace(CAST(try_cast({number} AS DECIMAL(38,6)) AS STRING), r'(\.\d+?)0+$', '$1')"
    return (
        f"coalesce(CASE WHEN isnan({number}) THEN 'nan' "
        f"WHEN abs({number}) >= 1e7 AND abs({number}) < 1e16 THEN {plain} ELSE CAST({number} AS STRING) END, 'None')"
    )


def as_sent(number: str, path: str) -> str:
    """A number as the payload has it: whole numbers and texts unchanged, others as doubles, None if absent.

    Only failing branches evaluate this, so the payload is not parsed again for good events.
    """
    sent = f"get_json_object(value, {path})"
    return (
        f"CASE WHEN {sent} RLIKE '^-?[0-9]+$' THEN {sent} WHEN {number} IS NOT NULL THEN {number_text(f'CAST({number} AS DOUBLE)')} "
        f"ELSE coalesce({sent}, 'None') END"
    )


def absent(column: str) -> str:
    """NULL and the empty string both count as not given."""
    return f"coalesce({column}, '') = ''"


def not_an_amount(amount: str) -> str:
    return f"({amount} IS NULL OR isnan({amount}) OR {amount} < 0)"


def not_a_quantity(quantity: str) -> str:
    return f"coalesce({quantity} <= 0, true)"


def _rule(code: str, fails: str, reason: str) -> Rule:
    return Rule(literal(code), fails, reason)


def _item_rules(item: str, index: str) -> list[Rule]:
    product, quantity, price = f"{item}.product_id", f"{item}.quantity", f"{item}.unit_price"
    return [
        _rule(CORRUPT_LINE_ITEM, f"{item} IS NULL", filled(REASON_ITEM_MALFORMED, index)),
        _rule(NULL_PRODUCT_ID, absent(product), filled(REASON_ITEM_PRODUCT, index)),
        _rule(INVALID_QUANTITY, not_a_quantity(quantity), filled(REASON_ITEM_QUANTITY, product, as_sent(quantity, f"concat('$.items[', {index}, '].quantity')"))),
        _rule(INVALID_UNIT_PRICE, not_an_amount(price), filled(REASON_ITEM_PRICE, product, as_sent(price, f"concat('$.items[', {index}, '].unit_price')"))),
    ]


def _case(rules: list[Rule], index: str) -> str:
    """CASE that yields (item_index, code, reason) of the first failing rule."""
    branches = " ".join(
        f"WHEN {r.fails} THEN named_struct('item_index', {index}, 'code', {r.code}, 'reason', {r.reason})" for r in rules
    )
    return f"CASE {branches} END"


def _any_absent(field: str, bad: str) -> str:
    """Whether a field of any element is NULL or has the given bad value."""
    return f"coalesce(array_contains(items.{field}, {bad}), true)"


def _any_unfit(field: str) -> str:
    """Whether an amount of any element doesn't fit its column; NaN is the largest double, NULL is passed over."""
    return f"array_max(items.{field}) >= {MONEY_LIMIT} OR array_min(items.{field}) <= -{MONEY_LIMIT}"


# True if an element breaks any line-item rule. It runs on every event, so it is made of array functions that are compiled
# instead of a lambda that is interpreted for each element. Fields of a NULL element are NULL.
HAS_BAD_ITEM = (
    f"({_any_absent('product_id', literal(''))} OR {_any_absent('quantity', '0')} OR array_min(items.quantity) <= 0 "
    f"OR {_any_absent('unit_price', '-1D')} OR array_min(items.unit_price) < 0 OR isnan(array_max(items.unit_price)))"
)
FIRST_ITEM_FAULT = (
    f"try_element_at(filter(transform(items, (item, i) -> {_case(_item_rules('item', 'i'), 'i')}), "
    "fault -> fault IS NOT NULL), 1)"
)


def first_item_fault() -> Column:
    """(item_index, code, reason) of the first bad element of ``items``, NULL if all are good."""
    return F.expr(f"CASE WHEN {HAS_BAD_ITEM} THEN {FIRST_ITEM_FAULT} END")


def header_rules() -> list[Rule]:
    """Rules up to the item list."""
    rules = [_rule(CORRUPT_PAYLOAD, "NOT is_object", literal(REASON_CORRUPT))]
    rules += [_rule(code, absent(column), literal(REASON_MISSING % column)) for column, code in IDENTIFIER_CODES]
    rules += [
        _rule(
            INVALID_PAYMENT_METHOD,
            f"payment_method_id NOT IN ({literals(PAYMENT_METHOD_IDS)})",
            filled(REASON_PAYMENT, "payment_method_id"),
        ),
        _rule(
            INVALID_ORDER_STATUS,
            f"coalesce(upper(order_status), '') NOT IN ({literals(ORDER_STATUSES)})",
            filled(REASON_STATUS, "coalesce(upper(order_status), 'NONE')"),
        ),
        _rule(NEGATIVE_OR_NULL_TOTAL, not_an_amount("total_amount"), filled(REASON_TOTAL, as_sent("total_amount", literal("$.total_amount")))),
        _rule(NEGATIVE_OR_NULL_NET, not_an_amount("net_amount"), filled(REASON_NET, as_sent("net_amount", literal("$.net_amount")))),
        _rule(EMPTY_ITEMS_ARRAY, "coalesce(size(items), 0) <= 0", literal(REASON_NO_ITEMS)),
    ]
    return rules


def time_rules(tolerance: str) -> list[Rule]:
    """Rules on the order time; ``_instant`` is the instant it names, ``_as_of`` the current one."""
    stamp, instant = "order_timestamp", "_instant"
    local = LOCAL_TIME_SQL.format(stamp)
    not_iso = filled(DETAIL_NOT_ISO, f"replace({stamp}, 'Z', '+00:00')")
    return [
        _rule(NULL_TIMESTAMP, absent(stamp), literal(REASON_NO_TIMESTAMP)),
        _rule(
            MALFORMED_TIMESTAMP,
            f"{instant} IS NULL",
            filled(REASON_UNPARSED, stamp, f"CASE WHEN {local} THEN {literal(DETAIL_NAIVE)} ELSE {not_iso} END"),
        ),
        _rule(
            FUTURE_TIMESTAMP_ANOMALY,
            f"{instant} > _as_of + INTERVAL '{tolerance}'",
            filled(REASON_FUTURE, stamp),
        ),
    ]


def constraint_rules() -> list[Rule]:
    """Table constraints that the rules above do not already cover."""

    def unfit(amount: str) -> str:
        return f"NOT (abs({amount}) < {MONEY_LIMIT})"

    def outside(amount: str) -> str:
        return f"({amount} IS NULL OR {unfit(amount)} OR {amount} < 0)"

    checks = [
        ("total_amount", outside("total_amount")),
        ("discount_amount", f"discount_amount IS NOT NULL AND {outside('discount_amount')}"),
        ("tax_amount", f"tax_amount IS NOT NULL AND {outside('tax_amount')}"),
        ("net_amount", outside("net_amount")),
        ("item_count", "coalesce(item_count <= 0, true)"),
        ("unit_price", _any_unfit("unit_price")),
        ("total_item_price", f"{_any_absent('total_item_price', '-1D')} OR {_any_unfit('total_item_price')} OR array_min(items.total_item_price) < 0"),
        ("discount_applied", _any_unfit("discount_applied")),
    ]
    return [
        _rule(f"{CONSTRAINT_PREFIX}{column.upper()}", fails, literal(REASON_CONSTRAINT % column))
        for column, fails in checks
    ]


def verdict(tolerance: str = DEFAULT_TOLERANCE, check_constraints: bool = True) -> Column:
    """(item_index, code, reason) of the first rule an event fails; NULL when all hold."""
    none = "CAST(NULL AS INT)"
    last = time_rules(tolerance) + (constraint_rules() if check_constraints else [])
    branches = [_case(header_rules(), none)[5:-4], f"WHEN {HAS_BAD_ITEM} THEN {FIRST_ITEM_FAULT}", _case(last, none)[5:-4]]
    return F.expr(f"CASE {' '.join(branches)} END")
