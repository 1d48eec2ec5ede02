"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Words between ASCII white space.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Rows that a Python worker turns into objects at a time.
ROWS = 1000
#: What this worker keeps, and the operator it is kept for.
_KEPT: list = []
_SERVED: list[str] = []
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: str.translate table that lower-cases A-Z alone.
ASCII_LOWER = {ord(c): c.lower() for c in _UPPER}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """The text with A-Z lower-cased and every other character as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())


def share_of(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo parts; null keys count as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts


def kept_in_worker(function: Callable) -> Callable:
    """Keep the function's result (a compiled table) while a Python worker serves the same operator."""
    kept = lru_cache(maxsize=2)(function)
    _KEPT.append(kept)
    return kept


def serve(owner: str) -> None:
    """Free what this worker keeps for other operators than owner."""
    if _SERVED != [owner]:
        for kept in _KEPT:
            kept.cache_clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _SERVED[:] = [owner]


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType, owner: str = "") -> DataFrame:
    """df.mapInArrow, with this package on the import path of the Python workers wherever its folder is there.

    run gets at most ROWS rows at a time. A worker that comes to another operator first frees what
    it keeps for the one before.
    """
    owner = owner or run.__module__

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serve(owner)
        yield from run(batch.slice(k, ROWS) for batch in batches for k in range(0, batch.num_rows, ROWS))

    path = df.sparkSession.sparkContext.environment
    if _ROOT not in path.get("PYTHONPATH", "").split(os.pathsep):
        path["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, path.get("PYTHONPATH")]))
    return df.mapInArrow(alone, schema)


def by_text(docs: DataFrame, columns: list[str], schema: str | StructType, work: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """work on Arrow tables with the given columns of docs; rows stay where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from work(pa.Table.from_batches([batch])).to_batches()

    return mapped(docs.select(*columns), run, schema, work.__module__)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; a temporary one only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    import tempfile

    folder = tempfile.mkdtemp(prefix="llm-checkpoint-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """df written to the shared folder and read again: lineage ends there and executors may go."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
