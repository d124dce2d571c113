"""Shared helpers: lineage cuts, size-checked broadcasts, Arrow batches, text."""

from __future__ import annotations

import itertools
import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.storage import shared_folder, written  # noqa: F401  operators take both from here

#: A side of a join is broadcast only if it has at most this many rows.
BROADCAST_ROWS = 200_000

#: Text bytes that one vectorised step holds at once inside a task.
STEP_BYTES = 1 << 20


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder and read back, so that its lineage
    ends there and a lost executor costs a re-read, not a re-run."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def bucketed(df: DataFrame, key: str, *columns: Column) -> DataFrame:
    """A row for each ``key`` with the aggregates ``columns``, written in the shared
    folder as a table bucketed by ``key``: joins on ``key`` then leave it in place.  Rows
    of a key are combined before they move, and the grouping deals them as the buckets
    do, so each bucket is one file."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"wicker_{uuid.uuid4().hex}"
    rows = df.groupBy(key).agg(*columns)
    rows.write.bucketBy(buckets, key).option("path", f"{shared_folder(spark)}/tables/{name}").option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def row_ids() -> Iterator[int]:
    """Ids that no other task of the same stage gives; the same after a retry."""
    return itertools.count((TaskContext.get().partitionId() if TaskContext.get() else 0) << 40)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows; otherwise as
    it is, for a shuffled join in which AQE splits skewed keys."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def text_of(col: str | Column = "text") -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches whose ``column`` holds about ``limit`` bytes (one
    row at least), so that vectorised work has bounded memory."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType, column: str = "text", limit: int = STEP_BYTES) -> DataFrame:
    """``function`` over bounded slices of ``df``, inside Spark's tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, column, limit):
            out = function(part)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of documents."""
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; Python workers will find this package where the driver did,
    unless the session already ships it."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
