"""Tables that are written once and read by several steps of a job."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark's setting that removes what a query has shuffled when the query ends.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.  Only a
    local session may be without one; it gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return _local_folder()


@functools.lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="spark-shared-")


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes inside remove their shuffle files when they end; otherwise these stay on the executors' disks
    until the driver happens to collect garbage, beside the table that was made from them."""
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEAN)
        else:
            spark.conf.set(_CLEAN, before)


def written(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: its lineage ends
    there, it is worked out once however often it is read, and it is read column by
    column.  Tables with whole texts take less room with zstd."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this job has made and no longer reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def exclusive_prefix(totals: DataFrame, part: str, sums: dict[str, str]) -> DataFrame:
    """``totals``, a row for each partition of a larger table, with the sums of each
    column of ``sums`` over the parts before it, under the names given there.  What
    goes through the driver is a few numbers a partition."""
    spark = totals.sparkSession
    rows = sorted(totals.collect(), key=lambda r: r[part])
    before, out = dict.fromkeys(sums, 0), []
    for r in rows:
        out.append((*r, *before.values()))
        before = {c: n + (r[c] or 0) for c, n in before.items()}
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in totals.schema)
    return spark.createDataFrame(out, types + "".join(f", `{name}` long" for name in sums.values()))


def numbered(df: DataFrame, order: list[str | Column], name: str, partitions: int | None = None) -> DataFrame:
    """``df`` with a gapless number from 1 in the order of ``order`` (which is total):
    rows are dealt by ranges, counted in each range, and numbered inside it after the
    exclusive prefix of the counts, so no task orders all rows."""
    if partitions:
        dealt = df.repartitionByRange(partitions, *order)
    else:
        dealt = df.repartitionByRange(*order)
    ranged = written(dealt.sortWithinPartitions(*order).withColumns({"part__": F.spark_partition_id(), "row__": F.monotonically_increasing_id()}))
    totals = ranged.groupBy("part__").agg(F.count("*").alias("n"), F.min("row__").alias("first__"))
    bases = exclusive_prefix(totals, "part__", {"n": "before__"}).select("part__", "first__", "before__")
    placed = ranged.join(F.broadcast(bases), "part__")  # a row for each partition
    return placed.withColumn(name, F.col("row__") - F.col("first__") + F.col("before__") + 1).drop("part__", "row__", "first__", "before__")
