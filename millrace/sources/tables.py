"""Scans, counted writes and the batch-partitioned order store."""

from __future__ import annotations

import time
import uuid
from collections.abc import Collection, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from millrace.model import COLUMN_DEFAULTS, PRIMARY_KEYS, TABLES

BATCH, ATTEMPT = "batch_id", "attempt"


def parameter_scan(spark: SparkSession, query: str, tables: Mapping[str, DataFrame], **parameters: object) -> DataFrame:
    """Run a query with named parameter markers over the given tables."""
    return spark.sql(query, args=parameters, **dict(tables)) if tables else spark.sql(query, args=parameters)


def write_counted(rows: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None) -> int:
    """Write rows and return how many, counted by the write itself."""
    seen = Observation()
    observed = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return int(seen.get["rows"])


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table that the optimizer knows to be empty, so that joins and unions with it fall away."""
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]).where(F.lit(False))


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table, or an empty one of its schema where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return no_rows(spark, schema)


def catalog_columns(spark: SparkSession) -> DataFrame:
    """Every table column with its position, type, whether it may be NULL, default and whether it is the table's key."""
    rows = [
        (table, field.name, position, field.dataType.simpleString(), field.nullable, None if default is None else str(default).lower(), PRIMARY_KEYS.get(table) == field.name)
        for table, schema in TABLES.items()
        for position, field in enumerate(schema.fields, 1)
        for default in [COLUMN_DEFAULTS.get(table, {}).get(field.name)]
    ]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, position int, data_type string, nullable boolean, default_value string, is_key boolean"
    )


def clock_number(last: list[int] = [0]) -> int:  # noqa: B006
    """Nanoseconds of the clock, never the same or less within this process."""
    last[0] = max(last[0] + 1, time.time_ns())
    return last[0]


class BatchStore:
    """Append-only tables, one folder per attempt at a batch, made visible by a commit marker.

    Nothing written is ever overwritten: every attempt at a batch has folders of its own, and
    the marker, written last, names the attempt that counts. Readers take the attempt of each
    batch's latest marker. So an attempt that fails half-way is never seen, a batch that is
    delivered twice counts once, and readers keep the old rows until the new attempt is whole.

    A marker has a folder of its own too, and its number is the time it was written. So nothing
    is read before a commit, and writers that commit at once neither wait for nor hide each other.
    Of two attempts at one batch the later one counts; drivers on several machines need
    clocks that agree better than the time between a batch and its replay.
    """

    MARKERS = "commits"
    MARKER_SCHEMA = T.StructType(
        [
            T.StructField("commit_no", T.LongType()),
            T.StructField("committed_at", T.TimestampType()),
            T.StructField("rows", T.LongType()),
            T.StructField("source", T.StringType()),
            T.StructField("source_batch", T.LongType()),
            T.StructField("details", T.StringType()),
        ]
    )
    PLACE = [T.StructField(BATCH, T.LongType()), T.StructField(ATTEMPT, T.StringType())]

    def __init__(self, spark: SparkSession, root: str, schemas: Mapping[str, T.StructType]):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = dict(schemas)

    def _folder(self, table: str) -> str:
        return f"{self.root}/{table}"

    @staticmethod
    def new_attempt() -> str:
        return f"a{uuid.uuid4().hex}"

    def _place(self, table: str, batch_id: int, attempt: str) -> str:
        return f"{self._folder(table)}/{BATCH}={batch_id}/{ATTEMPT}={attempt}"

    def write(self, table: str, rows: DataFrame, batch_id: int, attempt: str, partition_by: list[str] | None = None) -> None:
        writer = rows.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self._place(table, batch_id, attempt))

    def write_counted(self, table: str, rows: DataFrame, batch_id: int, attempt: str) -> int:
        """As write, and how many rows there were."""
        return write_counted(rows, self._place(table, batch_id, attempt), "errorifexists")

    def _markers(self) -> DataFrame:
        schema = T.StructType([*self.MARKER_SCHEMA.fields, *self.PLACE])
        return read_table(self.spark, self._folder(self.MARKERS), schema)

    def commit(
        self,
        batch_id: int,
        attempt: str,
        committed_at: Column,
        rows: int,
        source: str | None = None,
        source_batch: int | None = None,
        details: str | None = None,
    ) -> None:
        values = {
            "commit_no": F.lit(clock_number()),
            "committed_at": committed_at,
            "rows": F.lit(rows),
            "source": F.lit(source),
            "source_batch": F.lit(source_batch),
            "details": F.lit(details),
        }
        marker = self.spark.range(1).select(*[values[f.name].cast(f.dataType).alias(f.name) for f in self.MARKER_SCHEMA])
        self.write(self.MARKERS, marker.coalesce(1), batch_id, attempt)

    def runs(self) -> DataFrame:
        """Every marker with its place, those of replaced attempts too."""
        return self._markers()

    def committed(self) -> DataFrame:
        """(batch_id, committed_at, rows, attempt, source, source_batch, details) of every finished batch."""
        names = ["committed_at", "rows", ATTEMPT, "source", "source_batch", "details"]
        latest = self._markers().groupBy(BATCH).agg(F.max_by(F.struct(*names), F.struct("commit_no", ATTEMPT)).alias("last"))
        return latest.select(BATCH, "last.*")

    def first_batch_of(self, source: str) -> int:
        """The batch number of a source's batch 0: as before if it has committed any, else after all others."""
        own = F.when(F.col("source") == source, F.col(BATCH) - F.col("source_batch"))
        found = self.committed().agg(F.max(own).alias("own"), F.max(BATCH).alias("last")).first()
        if found["own"] is not None:
            return found["own"]
        return max(0, found["last"] + 1) if found["last"] is not None else 0

    def raw(self, table: str) -> DataFrame:
        """All rows of a table with their batch and attempt, finished or not."""
        return read_table(self.spark, self._folder(table), T.StructType([*self.schemas[table].fields, *self.PLACE]))

    def read(self, table: str) -> DataFrame:
        """Rows of finished batches; the semi-join prunes the folders that are scanned."""
        # One row per batch.
        return self.raw(table).join(F.broadcast(self.committed().select(BATCH, ATTEMPT)), [BATCH, ATTEMPT], "left_semi").drop(ATTEMPT)

    def batch(self, table: str, batch_id: int, attempt: str) -> DataFrame:
        """Rows just written by one attempt at a batch."""
        return read_table(self.spark, self._place(table, batch_id, attempt), self.schemas[table]).withColumn(BATCH, F.lit(batch_id).cast("long"))

    def attempts_before(self, batch_id: int) -> dict[int, str]:
        """The attempts that count of the batches before the given one: one name per batch."""
        return dict(self.committed().where(F.col(BATCH) < batch_id).select(BATCH, ATTEMPT).collect())

    def of_attempts(self, table: str, attempts: Collection[str]) -> DataFrame:
        """Rows of the given attempts, from their folders alone."""
        if not attempts:
            return no_rows(self.spark, T.StructType([*self.schemas[table].fields, self.PLACE[0]]))
        return self.raw(table).where(F.col(ATTEMPT).isin(list(attempts))).drop(ATTEMPT)
