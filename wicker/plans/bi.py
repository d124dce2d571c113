"""BI tables, results and period roll-ups over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import first_by, one_row, quantile, rounded, share
from ..params import Params


def weekly_chain_cost(savings: DataFrame) -> DataFrame:
    """Paired cells by week and chain."""
    return savings.groupBy("version", "week", "week_end", "chain", "chain_group").agg(
        F.count("*").alias("places"),
        rounded(F.median("basket_cost")).alias("median_cost"),
        rounded(quantile("basket_cost", 0.25), 4).alias("p25_cost"),
        rounded(quantile("basket_cost", 0.75), 4).alias("p75_cost"),
        F.count_if("is_cheapest").alias("times_cheapest"),
        share(F.col("is_cheapest")).alias("pct_cheapest"),
        rounded(F.median("saving")).alias("median_saving"),
        rounded(F.median("saving_pct")).alias("median_saving_pct"),
        F.sum("n_observations").alias("n_observations"),
    )


def weekly_savings(savings: DataFrame, all_chains: int = 4) -> DataFrame:
    """Paired cells by week: gaps, and the chain that is cheapest most often."""
    cells = savings.select("version", "week", "week_end", "place_id", "chains_compared", "groups_compared", "gap", "gap_pct", "cheapest_chain").distinct()
    keys = ["version", "week", "week_end"]
    top = cells.groupBy(*keys, "cheapest_chain").agg(F.count("*").alias("n")).groupBy(*keys).agg(first_by("cheapest_chain", -F.col("n"), "cheapest_chain").alias("most_often_cheapest"))
    rivals = F.when(F.col("groups_compared") >= 2, F.col("gap"))
    return cells.groupBy(*keys).agg(
        F.count("*").alias("places"),
        F.count_if(F.col("chains_compared") == all_chains).alias("places_with_all_chains"),
        F.count_if(F.col("groups_compared") >= 2).alias("places_with_rivals"),
        rounded(F.median("gap")).alias("median_gap"),
        rounded(F.median("gap_pct")).alias("median_gap_pct"),
        rounded(quantile("gap", 0.9), 4).alias("p90_gap"),
        rounded(F.median(rivals)).alias("median_gap_rivals"),
    ).join(top, keys)


def weekly_item_differences(items: DataFrame, savings: DataFrame) -> DataFrame:
    """By week and item: what the dearer chains charge over the cheapest basket's
    chain (sums add up over time), and the usual surcharge over the least price."""
    flags = savings.select("version", "place_id", "week", "chain", "is_cheapest")
    rows = items.join(flags, ["version", "place_id", "week", "chain"], "left")
    dearer = F.col("is_paired") & ~F.col("is_cheapest")
    over = (F.col("chains_with_item") >= 2) & ~F.col("is_cheapest_item_chain")
    return rows.groupBy("version", "week", "item").agg(
        F.count_if(dearer).alias("cells_compared"),
        rounded(F.coalesce(F.sum(F.when(dearer, F.col("vs_cheapest_basket").cast("decimal(18,4)"))), F.lit(0)).cast("double"), 4).alias("accumulated_difference"),
        F.count_if(over).alias("cells_over_min"),
        rounded(F.median(F.when(over, F.col("over_min_pct")))).alias("median_over_min_pct"),
        rounded(F.median("median_price"), 4).alias("median_price"),
    )


def item_availability(baskets: DataFrame, items: DataFrame, basket: DataFrame) -> DataFrame:
    """Every cell with every item of the basket, and whether it is there."""
    cells = baskets.select("version", "chain", "place_id", "week")
    names = basket.agg(F.array_sort(F.collect_set("item")).alias("names"))  # a basket is a short list
    dense = one_row(cells, names).select(*cells.columns, F.explode("names").alias("item"))
    there = items.select("chain", "place_id", "week", "item", "n_observations")
    return dense.join(there, ["chain", "place_id", "week", "item"], "left").select(
        "version", "chain", "place_id", "week", "item", F.col("n_observations").isNotNull().alias("available"), F.coalesce("n_observations", F.lit(0).cast("long")).alias("n_observations")
    )


def weekly_availability(availability: DataFrame) -> DataFrame:
    return availability.groupBy("version", "week", "chain", "item").agg(F.count("*").alias("cells"), F.count_if("available").alias("cells_with_item"), share(F.col("available")).alias("pct_available"))


def fixed_panel_index(baskets: DataFrame, params: Params = Params()) -> DataFrame:
    """Weekly geometric mean of cost over base cost, for all chains and for each; the
    base of a chain and place is its median cost in the first weeks, and pairs that
    have none are left out."""
    full = baskets.where(F.col("is_complete") & F.col("window_complete")).select("chain", "place_id", "week", "basket_cost")
    first = full.agg(F.min("week").alias("first_week"))
    base = one_row(full, first).where(F.col("week") < F.date_add("first_week", 7 * params.index_base_weeks)).groupBy("chain", "place_id").agg(F.median("basket_cost").alias("base_cost"))
    pairs = full.join(base, ["chain", "place_id"]).withColumn("log_ratio", F.ln(F.col("basket_cost") / F.col("base_cost")))
    sets = pairs.groupingSets([["week"], ["week", "chain"]], "week", "chain").agg(F.grouping("chain").alias("g"), F.count("*").alias("pairs"), rounded(100 * F.exp(F.avg("log_ratio"))).alias("index"))
    return sets.select(F.lit(params.version).alias("version"), "week", F.when(F.col("g") == 1, "ALL").otherwise(F.col("chain")).alias("scope"), "pairs", "index")


def price_level(savings: DataFrame, min_weeks: int = 4, min_chains: int = 2) -> DataFrame:
    """How dear a place is: each chain's median cost there over its national median,
    geometric mean over the chains."""
    nation = savings.groupBy("chain").agg(F.median("basket_cost").alias("nation_cost"))
    here = savings.groupBy("place_id", "chain").agg(F.median("basket_cost").alias("place_cost"), F.countDistinct("week").alias("weeks")).where(F.col("weeks") >= min_weeks)
    out = here.join(nation, "chain").groupBy("place_id").agg(F.count("*").alias("chains"), rounded(100 * F.exp(F.avg(F.ln(F.col("place_cost") / F.col("nation_cost"))))).alias("level"))
    return out.where(F.col("chains") >= min_chains)


def cheapest_and_dearest(levels: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` cheapest and the ``n`` dearest places."""
    low = levels.orderBy("level", "place_id").limit(n).withColumn("end", F.lit("cheapest"))
    return low.unionByName(levels.orderBy(F.desc("level"), "place_id").limit(n).withColumn("end", F.lit("dearest")))


def explain_items(items: DataFrame, savings: DataFrame) -> DataFrame:
    """Items that make up the difference between chains: accumulated, share of the
    net difference, usual difference, share of cells below the cheapest basket's."""
    dear = savings.where(~F.col("is_cheapest")).select("place_id", "week", "chain")
    rows = items.where("is_paired").join(dear, ["place_id", "week", "chain"], "left_semi")
    exact = F.col("vs_cheapest_basket").cast("decimal(18,4)")
    each = rows.groupBy("item").agg(
        F.sum(exact).alias("s"), rounded(F.median("vs_cheapest_basket")).alias("median_difference"), share(F.col("vs_cheapest_basket") < 0).alias("pct_cells_cheaper"), F.count("*").alias("cells")
    )
    total = each.agg(F.sum("s").alias("total"))
    s = F.col("s").cast("double")
    return one_row(each, total).select("item", rounded(s).alias("accumulated"), rounded(100 * s / F.nullif(F.col("total").cast("double"), F.lit(0.0)),
        1).alias("pct_of_net"), "median_difference", "pct_cells_cheaper", "cells")


def period_rollup(savings: DataFrame, start: str, end: str) -> DataFrame:
    """Per chain over a period: median of weekly medians, sums for counts, ratio of
    sums for shares, and the same of the previous period of equal length."""
    weekly = weekly_chain_cost(savings)
    days = f"datediff(date'{end}', date'{start}')"
    now = weekly.where(f"week BETWEEN date'{start}' AND date'{end}'").withColumn("period", F.lit("current"))
    before = weekly.where(f"week BETWEEN date_sub(date'{start}', {days} + 1) AND date_sub(date'{start}', 1)").withColumn("period", F.lit("previous"))
    both = now.unionByName(before).groupBy("period", "chain").agg(
        rounded(F.median("median_cost")).alias("median_cost"), F.sum("places").alias("places"), F.sum("times_cheapest").alias("times_cheapest"), F.count("*").alias("weeks")
    )
    return both.withColumn("pct_cheapest", rounded(100.0 * F.col("times_cheapest") / F.col("places"), 1))


def cost_matrix(items: DataFrame, chains: list[str]) -> DataFrame:
    """Item by chain: median of the median unit prices; the chains are given."""
    wide = items.groupBy("item").pivot("chain", chains).agg(rounded(F.median("median_price"), 4))
    names = [F.col(f"`{c}`") for c in chains]
    return wide.select("item", *[n.alias(c.lower().replace(" ", "_")) for n, c in zip(names, chains, strict=True)], rounded(F.greatest(*names) / F.least(*names), 4).alias("max_over_min"))
