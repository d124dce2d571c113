"""Publication in one step, samples and exports."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType, StringType, StructType, TimestampNTZType, TimestampType

#: Types that a published column may have.
PUBLISHABLE = (BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType, StringType, TimestampType, TimestampNTZType)


@dataclass(frozen=True)
class PublishSpec:
    """Of one table: its name there, a filter, how many recent weeks (0: all), and the columns
    of its indexes in a database."""

    name: str
    table: DataFrame
    where: str | None = None
    recent_weeks: int = 0
    week: str = "week"
    indexes: tuple[tuple[str, ...], ...] = ()

    def rows(self) -> DataFrame:
        """What is published; types that can't be are an error."""
        df = self.table.where(self.where) if self.where else self.table
        df = recent(df, self.week, self.recent_weeks) if self.recent_weeks else df
        check_publishable(df.schema)
        return df


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df``, whose rows are counted as they are written (``n``): nothing is worked out twice."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def check_publishable(schema: StructType) -> None:
    bad = [f.name for f in schema if not isinstance(f.dataType, PUBLISHABLE)]
    if bad:
        raise TypeError(f"columns of types that aren't published: {bad}")


def recent(df: DataFrame, week: str, weeks: int) -> DataFrame:
    """Rows of the last ``weeks`` weeks."""
    last = df.agg(F.max(week).alias("last__"))
    return df.crossJoin(F.broadcast(last)).where(F.col(week) > F.date_sub("last__", 7 * weeks)).drop("last__")


def publish(spark: SparkSession, specs: list[PublishSpec], target: str) -> dict[str, int]:
    """Writes every table under a new version, counts it again, and then moves the
    one pointer that readers follow; until then they see the version before."""
    version = uuid.uuid4().hex
    counts = {}
    for s in specs:
        path = f"{target}/versions/{version}/{s.name}"
        df, seen = counted(s.rows())
        df.write.parquet(path)
        if (kept := spark.read.parquet(path).count()) != seen.get["n"]:
            raise ValueError(f"{s.name}: {kept} rows written of {seen.get['n']}")
        counts[s.name] = kept
    row = spark.createDataFrame([(version, json.dumps(counts))], "version string, counts string")
    row.withColumn("published", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{target}/log")
    return counts


def publication_metadata(week: DataFrame, dates: DataFrame, files: DataFrame, version: str) -> DataFrame:
    """One row: version, last week, last date, source files and their rows."""
    out = week.agg(F.max("week").alias("last_week")).crossJoin(F.broadcast(dates.agg(F.max("date").alias("last_date"))))
    return out.crossJoin(F.broadcast(files.agg(F.count("*").alias("n_files"), F.sum("n_rows").alias("n_rows")))).withColumn("version", F.lit(version))


def save_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Each table as Parquet under its name."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def load_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}


def save_mapping(df: DataFrame, path: str) -> None:
    """A mapping or a review queue as delimited text with a header, nulls as empty."""
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)


@dataclass(frozen=True)
class Layer:
    """How a layer's tables are kept: as views, or as Parquet in ``folder``."""

    folder: str | None = None

    def keep(self, spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
        if self.folder is None:
            df.createOrReplaceTempView(name)
            return spark.table(name)
        path = f"{self.folder}/{name}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)


def published(spark: SparkSession, target: str, name: str) -> DataFrame:
    """A table of the latest version."""
    log = spark.read.parquet(f"{target}/log")
    version = log.orderBy(F.desc("published")).first().version
    return spark.read.parquet(f"{target}/versions/{version}/{name}")


def hash_sample(df: DataFrame, keys: list[str], strata: dict[str, int]) -> DataFrame:
    """Rows of each stratum (a condition) whose hash falls in so many sixteenths; the
    same rows on every run and in every engine."""
    digit = F.substring(F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys])), 1, 1)
    kept = F.lit(False)
    for where, sixteenths in strata.items():
        kept = kept | (F.expr(where) & (F.conv(digit, 16, 10).cast("int") < sixteenths))
    return df.where(kept)


def encode_by_catalog(df: DataFrame, column: str, catalog: DataFrame) -> DataFrame:
    """``df`` with the value's place in a catalog (value, position) instead of the
    value; a value that the catalog lacks is an error."""
    out = df.join(catalog.select(F.col("value").alias(column), F.col("position").alias("position__")), column, "left")
    place = F.when(F.col("position__").isNotNull(), F.col("position__")).otherwise(F.raise_error(F.concat(F.lit(f"not in the catalog of {column}: "),
        F.coalesce(F.col(column).cast("string"), F.lit("null")))).cast("int"))
    return out.withColumn(column, place).drop("position__")
