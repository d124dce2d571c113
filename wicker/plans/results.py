"""Result tables: answers out of the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import one_row, quantile, rounded, share
from ..params import Params


def period(savings: DataFrame, params: Params = Params()) -> DataFrame:
    """One row: first and last comparable week, where the recent weeks begin, and how
    many place-weeks and places can be compared."""
    return savings.agg(
        F.min("week").alias("first_week"), F.max("week").alias("last_week"), F.date_sub(F.max("week"), 7 * (params.recent_weeks - 1)).alias("recent_from"), F.any_value("version").alias("version"),
        F.countDistinct(F.struct("place_id", "week")).alias("place_weeks"), F.countDistinct("place_id").alias("places"),
    )


def cost_by_chain(savings: DataFrame, params: Params = Params()) -> DataFrame:
    """Costs of comparable cells, of all weeks and of the recent ones."""
    rows = one_row(savings, period(savings, params).select("recent_from"))
    recent = F.when(F.col("week") >= F.col("recent_from"), F.col("basket_cost"))
    return rows.groupBy("chain", "chain_group").agg(F.count("*").alias("place_weeks"), rounded(F.median("basket_cost")).alias("median_cost"),
        rounded(F.median(recent)).alias("median_cost_recent"), rounded(F.median("vs_median_pct")).alias("vs_median_pct"))


def gaps(savings: DataFrame, all_chains: int = 4) -> DataFrame:
    """Gaps of all cells, of those with all chains, and of those with rivals."""
    cells = savings.select("place_id", "week", "chains_compared", "groups_compared", "gap", "gap_pct").distinct()
    flags = {"all": F.lit(True), "all chains": F.col("chains_compared") == all_chains, "rivals": F.col("groups_compared") >= 2}
    scopes = F.filter(F.array(*[F.when(f, F.lit(n)) for n, f in flags.items()]), lambda x: x.isNotNull())
    rows = cells.select("gap", "gap_pct", F.explode(scopes).alias("scope"))
    return rows.groupBy("scope").agg(F.count("*").alias("place_weeks"), rounded(F.median("gap")).alias("median_gap"),
        rounded(F.median("gap_pct")).alias("median_gap_pct"), rounded(quantile("gap", 0.9), 4).alias("p90_gap"))


def saving_by_chain(savings: DataFrame) -> DataFrame:
    """What changing to the cheapest chain would save, a week and a year."""
    middle = F.median("saving")
    return savings.groupBy("chain").agg(F.count("*").alias("place_weeks"), share(F.col("is_cheapest")).alias("pct_cheapest"), rounded(middle).alias("median_saving"),
        rounded(F.median("saving_pct")).alias("median_saving_pct"), rounded(middle * 52, 0).alias("yearly_saving"))


def index_series(index: DataFrame) -> DataFrame:
    """week, pairs, index over all chains."""
    return index.where("scope = 'ALL'").select("week", "pairs", "index")


def index_by_month(index: DataFrame) -> DataFrame:
    """Monthly means of the weekly index."""
    rows = index_series(index).groupBy(F.trunc("week", "month").alias("month"))
    return rows.agg(rounded(F.avg(F.col("index").cast("decimal(18,2)")).cast("double"), 1).alias("mean_index"), rounded(F.avg("pairs"), 1).alias("mean_pairs"))


def surcharge_by_item(prices: DataFrame) -> DataFrame:
    """Where an item isn't at its cheapest: usual and high surcharge."""
    rows = prices.where((F.col("chains_with_item") >= 2) & ~F.col("is_cheapest_item_chain"))
    return rows.groupBy("item").agg(F.count("*").alias("cells"), rounded(F.median("over_min_pct")).alias("median_over_min_pct"), rounded(quantile("over_min_pct", 0.9), 4).alias("p90_over_min_pct"))


def indicators(measures: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """indicator, value: a measure of each of several tables."""
    out = None
    for name, (df, measure) in measures.items():
        one = df.agg(rounded(measure.cast("double"), 3).alias("value")).select(F.lit(name).alias("indicator"), "value")
        out = one if out is None else out.unionByName(one)
    return out


def coverage_by_chain(coverage: DataFrame) -> DataFrame:
    return coverage.groupBy("chain").agg(
        F.countDistinct("place_id").alias("places"), F.countDistinct("week").alias("weeks"), rounded(F.median("n_stores"), 1).alias("stores_a_cell"),
            rounded(F.median("n_days"), 1).alias("days_a_week"), share(F.col("is_complete")).alias("pct_complete")
    )


def never_comparable(places: DataFrame, savings: DataFrame) -> DataFrame:
    """Places in which no basket was ever compared."""
    return places.join(savings.select("place_id").distinct(), "place_id", "left_anti")


def run_summary(obs: DataFrame, weekly: DataFrame, index: DataFrame, weeks: int = 4) -> DataFrame:
    """One row: last date, last week, usual gap of the last weeks, latest index."""
    last = weekly.agg(F.max("week").alias("last_week"))
    recent = one_row(weekly, last).where(F.col("week") > F.date_sub("last_week", 7 * weeks))
    out = one_row(obs.agg(F.max("date").alias("last_date")), last)
    out = one_row(out, recent.agg(rounded(F.median("median_gap")).alias("recent_gap")))
    return one_row(out, index_series(index).agg(F.max_by("index", "week").alias("latest_index")))


def in_alert(rules: DataFrame) -> DataFrame:
    """Rules that don't hold."""
    return rules.where(~F.col("passed"))
