"""Data-quality audits of the stored facts.

Each audit is one row: rows evaluated, passed and failed, a pass rate, a status and JSON
details. An empty table yields no row.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.values import percent, surrogate_key
from millrace.model import FOREIGN_KEYS, TABLES

# --- Fixed values: audit names and statuses -----------------------------------------------
NULL_CHECK = ("Null Value Constraint Check", "NULL_CHECK")
REFERENTIAL_CHECK = ("Referential Integrity & Foreign Key Check", "REFERENTIAL_INTEGRITY")
FINANCIAL_CHECK = ("Financial Arithmetic Reconciliation", "FINANCIAL_RECONCILIATION")
PASSED, FAILED = "PASSED", "FAILED"
RECONCILIATION_TOLERANCE = "0.05"
MANDATORY = [
    ("order_id", "null_order_ids"),
    ("customer_id", "null_customer_ids"),
    ("total_amount", "null_totals"),
    ("order_timestamp", "null_timestamps"),
]
# --- end of fixed values ------------------------------------------------------------------


class AuditFailure(RuntimeError):
    """Raised by a strict audit run in which a check failed."""


def _count_if(condition: Column) -> Column:
    return F.coalesce(F.sum(condition.cast("long")), F.lit(0).cast("long"))


def _audit_row(
    name: tuple[str, str], total: Column, failed: Column, rows_failed: Column, details: list[Column]
) -> list[Column]:
    passed = F.greatest(F.lit(0).cast("long"), total - failed)
    return [
        F.lit(name[0]).alias("check_name"),
        F.lit(name[1]).alias("check_type"),
        F.lit("fact_orders").alias("table_audited"),
        total.alias("records_evaluated"),
        passed.alias("records_passed"),
        failed.alias("records_failed"),
        rows_failed.alias("rows_failed"),
        percent(passed, total, 2, 100.0).alias("pass_rate"),
        F.when(failed == 0, PASSED).otherwise(FAILED).alias("status"),
        F.to_json(F.struct(*details)).alias("details"),
    ]


def _null_counts() -> list[Column]:
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c, _ in MANDATORY])
    return [
        F.count("*").alias("total_rows"),
        *[_count_if(F.col(c).isNull()).alias(label) for c, label in MANDATORY],
        _count_if(any_null).alias("null_rows"),
    ]


def _discrepancy() -> Column:
    expected = F.col("total_amount") - F.col("discount_amount") + F.col("tax_amount")
    return F.abs(F.col("net_amount") - expected) > F.lit(RECONCILIATION_TOLERANCE).cast("decimal(4,2)")


def _financial_counts() -> list[Column]:
    return [
        F.count("*").alias("total_orders"),
        _count_if(F.coalesce(_discrepancy(), F.lit(False))).alias("reconciliation_discrepancies"),
    ]


def _null_audit(counts: DataFrame) -> DataFrame:
    labels = [label for _, label in MANDATORY]
    cells = reduce(lambda a, b: a + b, [F.col(c) for c in labels])
    details = [F.col("total_rows"), *[F.col(c) for c in labels]]
    return counts.where(F.col("total_rows") > 0).select(
        *_audit_row(NULL_CHECK, F.col("total_rows"), cells, F.col("null_rows"), details)
    )


def _financial_audit(counts: DataFrame) -> DataFrame:
    total, failed = F.col("total_orders"), F.col("reconciliation_discrepancies")
    return counts.where(total > 0).select(*_audit_row(FINANCIAL_CHECK, total, failed, failed, [total, failed]))


def null_checks(orders: DataFrame) -> DataFrame:
    """NULL cells in the mandatory columns; ``rows_failed`` counts affected rows."""
    return _null_audit(orders.agg(*_null_counts()))


def financial_checks(orders: DataFrame) -> DataFrame:
    """Orders whose net differs from total - discount + tax by more than the tolerance."""
    return _financial_audit(orders.agg(*_financial_counts()))


def referential_checks(
    orders: DataFrame, customers: DataFrame, locations: DataFrame, payments: DataFrame
) -> DataFrame:
    """Orphaned references of orders to their three dimensions.

    Orders are first counted per key combination, in one pass, so a key that holds much of
    the table meets its dimension as few rows. ``rows_failed`` counts orders with at least
    one orphan.
    """
    keys = ["customer_id", "location_id", "payment_method_id"]
    combos = orders.groupBy(*keys).agg(F.count("*").alias("orders"))
    marked = combos
    for key, dimension in zip(keys, [customers, locations, payments]):
        known = dimension.select(key, F.lit(True).alias(f"_has_{key}"))
        marked = marked.join(known, key, "left")
    lacks = {k: F.col(f"_has_{k}").isNull() for k in keys}

    def orders_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("orders")).otherwise(F.lit(0))), F.lit(0)).cast("long")

    counts = marked.agg(
        F.coalesce(F.sum("orders"), F.lit(0)).cast("long").alias("total_orders"),
        orders_where(lacks["customer_id"]).alias("orphan_customers"),
        orders_where(lacks["location_id"]).alias("orphan_locations"),
        orders_where(lacks["payment_method_id"]).alias("orphan_payments"),
        orders_where(reduce(lambda a, b: a | b, lacks.values())).alias("orphan_rows"),
    )
    total = F.col("total_orders")
    labels = ["orphan_customers", "orphan_locations", "orphan_payments"]
    orphans = reduce(lambda a, b: a + b, [F.col(c) for c in labels])
    return counts.where(total > 0).select(
        *_audit_row(REFERENTIAL_CHECK, total, orphans, F.col("orphan_rows"), [total, *[F.col(c) for c in labels]])
    )


def audit_suite(
    orders: DataFrame,
    customers: DataFrame,
    locations: DataFrame,
    payments: DataFrame,
    strict: bool = False,
) -> DataFrame:
    """The three audits in order. Null and financial counts share one pass over the table.

    ``strict`` runs the suite and raises on the first failed check.
    """
    shared = orders.agg(*_null_counts(), *_financial_counts())
    results = [
        _null_audit(shared),
        referential_checks(orders, customers, locations, payments),
        _financial_audit(shared),
    ]
    suite = reduce(DataFrame.unionByName, [r.withColumn("check_order", F.lit(i)) for i, r in enumerate(results, 1)])
    if strict:
        failed = suite.where(F.col("status") == FAILED).orderBy("check_order").take(1)
        if failed:
            row = failed[0]
            raise AuditFailure(f"{row['check_name']}: {row['records_failed']} of {row['records_evaluated']} failed")
    return suite


def audit_log_rows(suite: DataFrame, audited_at: Column) -> DataFrame:
    """Audit results as rows of the audit log."""
    stamped = suite.withColumn("audit_timestamp", audited_at).withColumn(
        "audit_id", surrogate_key(F.col("check_type"), audited_at)
    )
    schema = TABLES["data_quality_audit_log"]
    return stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def constraint_violations(log: DataFrame, prefix: str, extra_codes: list[str]) -> DataFrame:
    """Quarantined events that passed the event rules but broke a table constraint, by code."""
    code = F.col("error_code")
    return (
        log.where(code.startswith(prefix) | code.isin(extra_codes))
        .groupBy("error_code")
        .agg(F.count("*").alias("failure_count"))
    )


def uniqueness_violations(rows: DataFrame, key: str) -> DataFrame:
    """Key values held by more than one row."""
    return rows.groupBy(key).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def foreign_key_orphans(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per foreign key: how many key values and how many rows have no parent."""

    def report(child: str, column: str, parent: str, target: str) -> DataFrame:
        counted = tables[child].groupBy(F.col(column).alias("_key")).agg(F.count("*").alias("rows"))
        parents = tables[parent].select(F.col(target).alias("_key"))
        return (
            counted.join(parents, "_key", "left_anti")
            .agg(
                F.count("*").alias("orphan_keys"),
                F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("orphan_rows"),
            )
            .select(
                F.lit(child).alias("child_table"),
                F.lit(column).alias("child_column"),
                F.lit(parent).alias("parent_table"),
                "orphan_keys",
                "orphan_rows",
            )
        )

    return reduce(DataFrame.unionByName, [report(*key) for key in FOREIGN_KEYS])
