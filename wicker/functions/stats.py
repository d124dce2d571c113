"""Aggregates and joins that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..params import Params
from .storage import written


def rounded(x: Column, digits: int = 2) -> Column:
    """``x`` to ``digits`` decimals, halves up on the scaled double, so that other
    engines round alike."""
    k = float(10**digits)
    return F.floor(x * k + 0.5) / k


def small_side(df: DataFrame, rows: int = Params.broadcast_rows) -> DataFrame:
    """``df``, a written table, with a broadcast hint if it has at most ``rows`` rows;
    else as it is, for a shuffled join in which skewed keys are split at run time.
    The count reads no column.  Tables that aren't written get no hint: the optimiser
    knows the size of their files."""
    return F.broadcast(df) if df.count() <= rows else df


def one_row(df: DataFrame, other: DataFrame) -> DataFrame:
    """``df`` beside the only row of ``other`` (an aggregate without keys)."""
    return df.crossJoin(F.broadcast(other))


def latest_value(x: str, by: str, tie: str) -> Column:
    """The value of ``x`` in the row with the largest (by, tie).  Rows without a value or
    without ``by`` never win; where there is no other, the result is null."""
    found = F.col(x).isNotNull() & F.col(by).isNotNull()
    return F.max_by(F.when(found, F.col(x)), F.when(found, F.struct(F.col(by), F.col(tie))))


def first_by(x: str | Column, *order: str | Column) -> Column:
    """The value of ``x`` in the row that comes first; negate numbers to descend."""
    return F.min_by(x, F.struct(*order))


def most_frequent(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """keys, name: the most frequent value of each group, the least of equals."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    return counts.groupBy(*keys).agg(first_by(value, -F.col("n"), value).alias(name))


def geometric_mean(x: Column) -> Column:
    return F.exp(F.avg(F.ln(x)))


def share(flag: Column, digits: int = 1) -> Column:
    """Percentage of rows in which a boolean holds."""
    return rounded(100.0 * F.avg(flag.cast("int")), digits)


def quantile(x: str | Column, p: float) -> Column:
    """Exact continuous quantile."""
    return F.percentile(x, p)


def middle(values: str | Column) -> Column:
    """The median of a sorted array without nulls; null if it is empty."""
    values = F.col(values) if isinstance(values, str) else values
    n = F.size(values)
    return 0.5 * F.get(values, ((n - 1) / 2).cast("int")) + 0.5 * F.get(values, (n / 2).cast("int"))


def robust_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    """key, n, median, log_median, mad: medians of the positive values and median
    absolute deviation of their logarithms; two passes over equal values once, which are
    dealt by the key once for both."""
    counts = written(df.where(F.col(value) > 0).groupBy(key, F.col(value).alias("x__")).agg(F.count("*").alias("n__")))
    logs = counts.repartition(key).withColumn("log__", F.ln("x__"))
    median = lambda c: F.expr(f"percentile({c}, 0.5, n__)")
    centre = logs.groupBy(key).agg(F.sum("n__").alias("n"), median("x__").alias("median"), median("log__").alias("log_median"))
    spread = logs.join(centre, key).groupBy(key, "n", "median", "log_median")
    return spread.agg(F.expr("percentile(abs(log__ - log_median), 0.5, n__)").alias("mad"))


def quantiles_of_all(df: DataFrame, column: str, at: dict[str, float], pieces: int = 1024) -> DataFrame:
    """One row: exact continuous quantiles of a whole table (names and shares in
    ``at``).  Equal values are counted, the counts are summed in ``pieces`` ranges
    side by side and then over the ranges, so that no task orders all values."""
    x = F.col(column)
    counts = written(df.where(x.isNotNull()).groupBy(x.cast("double").alias("x")).agg(F.count("*").alias("k")))
    ends = counts.agg(F.min("x").alias("low"), F.max("x").alias("high"), F.sum("k").alias("n"))
    share = F.when(F.col("high") > F.col("low"), (F.col("x") - F.col("low")) / (F.col("high") - F.col("low"))).otherwise(0.0)
    placed = one_row(counts, ends).withColumn("piece", F.floor(share * (pieces - 1)))
    totals = placed.groupBy("piece").agg(F.sum("k").alias("k"))  # at most ``pieces`` rows
    before = totals.select("piece", (F.sum("k").over(Window.orderBy("piece")) - F.col("k")).alias("before"))
    upto = F.sum("k").over(Window.partitionBy("piece").orderBy("x")) + F.col("before")
    ranked = placed.join(F.broadcast(before), "piece").select("x", "n", upto.alias("upto"))
    found = []
    for name, p in at.items():
        h = (F.col("n") - 1) * F.lit(float(p))
        found += [F.min(F.when(F.col("upto") > F.floor(h), F.col("x"))).alias(f"{name}__low"), F.min(F.when(F.col("upto") > F.ceil(h), F.col("x"))).alias(f"{name}__high"), F.max(h - F.floor(h)).alias(f"{name}__part")]
    one = ranked.agg(*found)
    return one.select(*[(F.col(f"{n}__low") + (F.col(f"{n}__high") - F.col(f"{n}__low")) * F.col(f"{n}__part")).alias(n) for n in at])
