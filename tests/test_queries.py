"""Every registered query against its SQL counterpart, at the smallest scale and on skewed data."""

from __future__ import annotations

import os
import shutil

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import GIVEN, canonical
from pyspark.sql import functions as F
from workload import oracle, queries as workload_queries
from workload.stage import STREAM_FILES, Warehouse

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
STATEMENTS = oracle.statements()
QUERIES = workload_queries.registered()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def database(folder: str):
    duck = duckdb.connect()
    duck.execute("SET TimeZone='UTC'")
    for name in GIVEN:
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return duck


@pytest.fixture(scope="module")
def given():
    return database(SF_DIR)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """A third of all lines in one order, a third of one part, and many copies of one line;
    a third of all orders from one customer and a third at one instant."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    for name in GIVEN:
        if name not in ("lineitem", "orders"):
            shutil.copy(f"{SF_DIR}/{name}.parquet", folder)
    duck = duckdb.connect()
    duck.execute(
        f"""COPY (SELECT * EXCLUDE rn REPLACE (CASE WHEN rn % 3 = 0 THEN 177 ELSE l_orderkey END AS l_orderkey,
              CASE WHEN rn % 3 = 1 THEN 5 ELSE l_partkey END AS l_partkey)
            FROM (SELECT *, row_number() OVER () AS rn FROM '{SF_DIR}/lineitem.parquet')
            UNION ALL SELECT l.* FROM (SELECT * FROM '{SF_DIR}/lineitem.parquet' ORDER BY ALL LIMIT 1) l, range(3000))
          TO '{folder}/lineitem.parquet'"""
    )
    duck.execute(
        f"""COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey,
              CASE WHEN o_orderkey % 3 = 1 THEN TIMESTAMP '1999-01-01' ELSE o_orderdate END AS o_orderdate)
            FROM '{SF_DIR}/orders.parquet') TO '{folder}/orders.parquet'"""
    )
    return folder, database(folder)


def compare(spark, folder, duck, name):
    result = QUERIES[name](spark, folder)
    ours = [tuple(r) for r in result.collect()]
    answer = duck.execute(STATEMENTS[name])
    names = [d[0] for d in answer.description]
    assert sorted(result.columns) == sorted(names)
    assert canonical(result.columns, ours) == canonical(names, answer.fetchall())


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(STATEMENTS)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, given, name):
    compare(spark, SF_DIR, given, name)


SKEW_SENSITIVE = [
    "fact_orders",
    "fact_order_items",
    "order_versions",
    "cumulative_revenue",
    "revenue_by_category",
    "payment_distribution",
    "segment_spending",
    "dq_referential_integrity",
    "fk_orphans",
    "infer_products",
    "hourly_rollup",
    "order_totals_from_items",
    "order_status_lookup",
]


@pytest.mark.parametrize("name", SKEW_SENSITIVE)
def test_query_on_skewed_data(spark, skewed, name):
    compare(spark, *skewed, name)


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert rows and {"category", "order_count", "total_units_sold", "category_revenue"} == set(rows[0].asDict())


def test_raw_batches_dont_fall_into_more_files_with_more_partitions(spark):
    finer = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    kept = {k: spark.conf.get(k, None) for k in finer}
    try:
        for k, v in finer.items():
            spark.conf.set(k, v)
        w = Warehouse(spark, SF_DIR)
        files = [len(w.raw().where(F.col("batch_id") == n).select(F.input_file_name()).distinct().collect()) for n in (0, 1)]
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert 1 <= files[0] <= spark.sparkContext.defaultParallelism and 1 <= files[1] <= STREAM_FILES
