"""Sketches that are kept and merged upwards: distinct counts and quantiles.

A table of sketches has a row for each group of its keys; any coarser grouping, and any choice
of groups, comes from the sketches alone.  HyperLogLog with 2^k registers errs by
0.83 / sqrt(2^k) (one standard deviation); a KLL sketch of size k by a rank of about 2.3 / k^0.97,
99 times of 100.  ``distinct_error`` and ``rank_error`` are what results are held to.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Registers (as a power of two) and size of the sketches.
HLL_LG, KLL_K = 12, 400


def distinct_error(lg: int = HLL_LG) -> float:
    """Relative error of a distinct count: four standard deviations."""
    return 4 * 0.8326 / 2 ** (lg / 2)


def rank_error(k: int = KLL_K) -> float:
    """Error of a quantile's rank, twice that of 99 of 100 sketches."""
    return 2 * 2.296 / k**0.9723


def distinct_sketches(df: DataFrame, by: list[str], columns: list[str], lg: int = HLL_LG) -> DataFrame:
    """by, n_rows, and for each column n_empty (``<c>__e``) and the sketch of its values
    (``<c>__d``): one aggregate, in which no row is repeated."""
    parts = []
    for c in columns:
        text = F.col(c).cast("string")
        parts += [F.count_if(text.isNull() | (F.trim(text) == "")).alias(f"{c}__e"), F.hll_sketch_agg(text, F.lit(lg)).alias(f"{c}__d")]
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"), *parts)


def merged_distinct(sketches: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """by, column, n_rows, n_empty, n_distinct (estimated) over the sketches of each group of
    ``by``, which are some of their keys (none: of all)."""
    parts = []
    for c in columns:
        parts += [F.sum(f"{c}__e").alias(f"{c}__e"), F.hll_sketch_estimate(F.hll_union_agg(f"{c}__d")).alias(f"{c}__d")]
    one = sketches.groupBy(*by).agg(F.sum("n_rows").alias("n"), *parts)
    rows = [F.struct(F.lit(c).alias("column"), F.col("n").alias("n_rows"), F.col(f"{c}__e").alias("n_empty"), F.coalesce(f"{c}__d", F.lit(0)).alias("n_distinct")) for c in columns]
    return one.select(*by, F.inline(F.array(*rows)))


def cube(df: DataFrame, keys: list[str], value: str, sums: Mapping[str, Column] | None = None, distinct: str | None = None) -> DataFrame:
    """keys, n, total and values (a KLL sketch) of ``value``, the ``sums`` of other columns and, with
    ``distinct``, the sketch ``several`` of that column: all of them can be merged."""
    x = F.col(value).cast("double")
    more = [F.sum(c).alias(name) for name, c in (sums or {}).items()]
    if distinct:
        more.append(F.hll_sketch_agg(F.col(distinct).cast("string"), F.lit(HLL_LG)).alias("several"))
    return df.groupBy(*keys).agg(F.count(value).alias("n"), F.sum(F.col(value).cast("decimal(28,4)")).alias("total"), F.kll_sketch_agg_double(x, F.lit(KLL_K)).alias("values"), *more)


def rolled_up(cells: DataFrame, by: list[str], quantiles: Mapping[str, float], sums: list[str] = (), distinct: str | None = None) -> DataFrame:
    """by, n, mean, the quantiles and ``sums`` of the cells of each group, from a cube's columns only; with
    ``distinct``, the estimated count under that name."""
    more = [F.sum(s).alias(s) for s in sums]
    if distinct:
        more.append(F.hll_sketch_estimate(F.hll_union_agg("several")).alias(distinct))
    some = cells.where("n > 0").groupBy(*by).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.kll_merge_agg_double("values").alias("values"), *more)
    found = [F.kll_sketch_get_quantile_double("values", F.lit(float(p))).alias(name) for name, p in quantiles.items()]
    mean = (F.col("total").cast("double") / F.col("n")).alias("mean")
    return some.select(*by, "n", mean, *found, *sums, *([distinct] if distinct else []))


def by_period(cells: DataFrame, start: str, end: str, week: str = "week") -> DataFrame:
    """The cells of a period, and of the one of equal length before it, with ``period``."""
    days = f"datediff(date'{end}', date'{start}')"
    when = F.expr(
        f"CASE WHEN {week} BETWEEN date'{start}' AND date'{end}' THEN 'current' WHEN {week} BETWEEN date_sub(date'{start}', {days} + 1) AND date_sub(date'{start}', 1) THEN 'previous' END"
    )
    return cells.withColumn("period", when).where("period IS NOT NULL")
