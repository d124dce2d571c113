"""Data sets of the dashboard: index-encoded tables, their contract, period figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.stats import one_row, rounded
from ..functions.storage import numbered
from ..sources.publish import encode_by_catalog

OTHERS = "OTHERS"
#: Data sets that must have rows.
REQUIRED = ("weekly_savings", "chain_cost", "index", "differences", "availability", "baskets")


def catalog(values: DataFrame, column: str, first: tuple[str, ...] = ()) -> DataFrame:
    """value, position from 0 of the distinct values of a column in their order, after the
    values of ``first``."""
    rows = numbered(values.select(F.col(column).alias("value")).distinct(), ["value"], "position")
    return rows.select("value", (F.col("position") - 1 + len(first)).cast("int").alias("position"))


def week_axis(*tables: DataFrame) -> DataFrame:
    """value, position of all weeks of several tables."""
    return catalog(reduce(DataFrame.union, [t.select("week") for t in tables]).distinct(), "week")


def national_item_price(prices: DataFrame) -> DataFrame:
    """Median over places of an item's price, by week and chain."""
    return prices.groupBy("week", "chain", "item").agg(rounded(F.median("median_price"), 3).alias("median_price"), F.count("*").alias("places"))


def folded_coverage(coverage: DataFrame, reference: list[str]) -> DataFrame:
    """Coverage with all chains but the reference ones as one; sums and row counts,
    so that means can still be worked out."""
    chain = F.when(F.col("chain").isin(reference), F.col("chain")).otherwise(OTHERS)
    total = lambda c: F.sum(c).alias(c)
    return coverage.groupBy("week", "place_id", chain.alias("chain")).agg(
        total("n_observations"), F.count("*").alias("n_rows"), total("n_stores"), total("n_days"), rounded(F.sum("pct_outliers"), 3).alias("pct_outliers"),
            rounded(F.sum("pct_not_comparable")).alias("pct_not_comparable")
    )


def missing_items(availability: DataFrame) -> DataFrame:
    return availability.where(~F.col("available")).select("week", "place_id", "chain", "item")


def encoded(datasets: dict[str, DataFrame], catalogs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Each data set with its week, place, chain and item as positions; a value that a
    catalog lacks is an error.  ``catalogs``: by column name."""
    out = {}
    for name, df in datasets.items():
        for column, known in catalogs.items():
            if column in df.columns:
                df = encode_by_catalog(df, column, known)
        out[name] = df
    return out


def check_export(datasets: dict[str, DataFrame], catalogs: dict[str, DataFrame]) -> DataFrame:
    """dataset, n_rows, n_outside (positions beyond their catalog), fine: none is
    outside and a required set has rows."""
    sizes = one = None
    for column, known in catalogs.items():
        one = known.agg((F.max("position") + 1).alias(f"size_{column}"))
        sizes = one if sizes is None else one_row(sizes, one)
    parts = []
    for name, df in datasets.items():
        bad = F.lit(False)
        for column in catalogs:
            if column in df.columns:
                bad = bad | F.col(column).isNull() | (F.col(column) < 0) | (F.col(column) >= F.col(f"size_{column}"))
        n = one_row(df, sizes).agg(F.count("*").alias("n_rows"), F.count_if(bad).alias("n_outside"))
        parts.append(n.select(F.lit(name).alias("dataset"), "n_rows", "n_outside", ((F.col("n_outside") == 0) & (F.lit(name not in REQUIRED) | (F.col("n_rows") > 0))).alias("fine")))
    return reduce(DataFrame.unionByName, parts)


def period_summary(weekly: DataFrame, index: DataFrame, availability: DataFrame, differences: DataFrame, start: str, end: str) -> DataFrame:
    """period and its figures, for the period and the one of equal length before (if
    it has weeks): median of weekly medians, sums for counts, ratios of sums for
    shares, last index against the first."""
    days = f"datediff(date'{end}', date'{start}')"
    when = F.expr(f"CASE WHEN week BETWEEN date'{start}' AND date'{end}' THEN 'current' WHEN week BETWEEN date_sub(date'{start}', {days} + 1) AND date_sub(date'{start}', 1) THEN 'previous' END")
    of = lambda df: df.withColumn("period", when).where("period IS NOT NULL").groupBy("period")
    a = of(weekly).agg(rounded(F.median("median_gap")).alias("median_gap"), F.sum("places").alias("places"), F.count("*").alias("weeks"))
    b = of(index.where("scope = 'ALL'")).agg(rounded(100 * F.max_by("index", "week") / F.min_by("index", "week")).alias("index_change"))
    c = of(availability).agg(rounded(100.0 * F.sum("cells_with_item") / F.sum("cells"), 1).alias("pct_available"))
    d = of(differences).agg(rounded(F.sum(F.col("accumulated_difference").cast("decimal(18,4)")).cast("double")).alias("accumulated_difference"))
    return reduce(lambda x, y: x.join(y, "period", "left"), [b, c, d], a)


def item_ranking(differences: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` items with the largest accumulated difference, with their share of
    the total, as they rank."""
    each = differences.groupBy("item").agg(F.sum(F.col("accumulated_difference").cast("decimal(18,4)")).alias("s"))
    total = each.agg(F.sum("s").cast("double").alias("total"))
    s = F.col("s").cast("double")
    out = one_row(each, total).select("item", rounded(s).alias("accumulated"), rounded(100 * s / F.nullif(F.col("total"), F.lit(0.0)), 1).alias("pct_of_total"))
    top = out.orderBy(F.desc("accumulated"), "item").limit(n)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("accumulated"), "item")))


def availability_matrix(availability: DataFrame, chains: list[str]) -> DataFrame:
    """Item by chain: percentage of cells with the item, a ratio of sums."""
    wide = availability.groupBy("item").pivot("chain", chains).agg(rounded(100.0 * F.sum("cells_with_item") / F.sum("cells"), 1))
    return wide.withColumnsRenamed({c: c.lower().replace(" ", "_") for c in chains})


def observation_heatmap(coverage: DataFrame, places: DataFrame) -> DataFrame:
    """Observations by state, place and month; with the totals of each state."""
    rows = coverage.join(places, "place_id").groupBy("state_iso", "place_id", F.trunc("week", "month").alias("month")).agg(F.sum("n_observations").alias("n_observations"))
    return rows.withColumn("state_total", F.sum("n_observations").over(Window.partitionBy("state_iso", "month")))
