"""Rolling item prices, basket costs, paired savings, decomposition, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.stats import first_by, middle, one_row, robust_stats, rounded, small_side
from ..functions.storage import written
from ..params import Params

CELL = ["chain", "place_id", "week"]


def flag_outliers(obs: DataFrame, params: Params = Params(), key: str = "product_id", value: str = "price") -> DataFrame:
    """``obs`` with median, deviation, rule (0 none, 1 far from the median, 2 far by
    the MAD) and is_outlier; no row is removed.  Values that aren't positive have no
    statistics and no rule."""
    stats = small_side(written(robust_stats(obs, key, value)).select(key, F.col("n").alias("n_product"), "median", "log_median", "mad"))
    x, m = F.col(value), F.col("median")
    deviation = F.abs(F.ln(value) - F.col("log_median"))
    far = (x > params.outlier_factor * m) | (x < m / params.outlier_factor)
    by_mad = (F.col("n_product") >= params.outlier_min_rows) & (F.col("mad") > 0) & (deviation > params.outlier_mad * 1.4826 * F.col("mad")) & (deviation > F.ln(F.lit(params.outlier_mad_factor)))
    rule = F.when(x <= 0, 0).when(far, 1).when(by_mad, 2).otherwise(0)
    out = obs.join(stats, key, "left").withColumns({"deviation": deviation, "rule": F.coalesce(rule, F.lit(0))})
    return out.withColumn("is_outlier", F.col("rule") > 0)


def consolidate(obs: DataFrame, keys: list[str], price: str, bit: str) -> DataFrame:
    """keys, price, n_source_rows, catalog_mask, has_conflict: equal observations in
    one row; a conflict is a group of ``keys`` with more than one price."""
    out = obs.where(F.col(price).isNotNull()).groupBy(*keys, price).agg(F.count("*").alias("n_source_rows"), F.bit_or(F.call_function("shiftleft", F.lit(1), F.col(bit))).alias("catalog_mask"))
    return out.withColumn("has_conflict", F.count("*").over(Window.partitionBy(*keys)) > 1)


def rolling_weeks(df: DataFrame, previous: int, week: str = "week") -> DataFrame:
    """Every row in its own week (with ``own``) and the ``previous`` next ones, so that
    a group by week spans a window."""
    moved = df.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(previous))))
    return moved.withColumns({week: F.date_add(week, F.col("k") * 7), "own": F.col("k") == 0}).drop("k")


def distinct(column: str) -> Column:
    """How many values a group has.  Several exact counts in one aggregate would
    repeat every row for each; a set holds each value of the group once."""
    return F.size(F.collect_set(column)).cast("long")


def rolling_item_price(obs: DataFrame, params: Params = Params()) -> DataFrame:
    """Per chain, place, week and item, over the week and the previous ones; weeks
    after the last observed one are cut.  Observations are grouped and shuffled once, by their own week, into one row
    a cell with its prices and sets; windows are put together from these rows, as many as there are cells.
    Written before that cut, so that the first and the last week don't cost another pass over the observations."""
    counted = ("store_id", "product_id", "date")
    own = obs.groupBy(*CELL, "item").agg(F.count("*").alias("n"), F.collect_list("unit_price").alias("prices"), *[F.collect_set(c).alias(f"{c}s") for c in counted])
    together = lambda c: F.flatten(F.collect_list(c))
    several = lambda c: F.size(F.array_distinct(together(c))).cast("long")
    windows = rolling_weeks(own, params.previous_weeks).groupBy(*CELL, "item").agg(
        F.sort_array(together("prices")).alias("prices"),
        F.sum("n").alias("n_observations"),
        several("store_ids").alias("n_stores"),
        several("product_ids").alias("n_products"),
        several("dates").alias("n_days"),
        F.bool_or("own").alias("own"),
    )
    cells = written(
        windows.select(
            *CELL,
            "item",
            middle("prices").alias("median_price"),
            F.get("prices", F.lit(0)).alias("min_price"),
            F.get("prices", F.size("prices") - 1).alias("max_price"),
            "n_observations",
            "n_stores",
            "n_products",
            "n_days",
            "own",
        )
    )
    ends = cells.where("own").agg(F.min("week").alias("first_week"), F.max("week").alias("last_week"))
    complete = F.date_sub("week", 7 * params.previous_weeks) >= F.col("first_week")
    return one_row(cells, ends).where("week <= last_week").withColumn("window_complete", complete).drop("own", "first_week", "last_week")


def basket_cost(items: DataFrame, basket: DataFrame, params: Params = Params()) -> DataFrame:
    """Per chain, place and week: how many items there are and what they cost; the
    cost of the basket only where it is complete.  ``basket``: item, quantity."""
    total = basket.agg(F.count("*").alias("items_total"))
    priced = items.join(basket, "item").withColumn("cost", F.col("median_price") * F.col("quantity"))
    cells = priced.groupBy(*CELL).agg(
        F.count("*").alias("items_available"),
        F.sum("cost").alias("sum_cost"),
        F.sum("n_observations").alias("n_observations"),
        F.min("n_observations").alias("min_item_observations"),
        F.max("n_stores").alias("max_item_stores"),
        F.bool_and("window_complete").alias("window_complete"),
    )
    full = F.col("items_available") == F.col("items_total")
    return one_row(cells, total).select(
        F.lit(params.version).alias("version"),
        *CELL,
        F.date_add("week", 6).alias("week_end"),
        F.date_sub("week", 7 * params.previous_weeks).alias("window_from"),
        "items_available",
        "items_total",
        rounded(100.0 * F.col("items_available") / F.col("items_total"), 1).alias("pct_items"),
        full.alias("is_complete"),
        F.when(full, rounded(F.col("sum_cost"))).alias("basket_cost"),
        rounded(F.col("sum_cost")).alias("partial_cost"),
        "n_observations",
        "min_item_observations",
        "max_item_stores",
        "window_complete",
    )


def paired_savings(baskets: DataFrame, chains: DataFrame) -> DataFrame:
    """Every complete basket of a place and week in which at least two reference
    chains have one, against the cheapest.  ``chains``: chain, chain_group.  A place
    and week has at most a row for each chain, so its rows travel in one array."""
    full = baskets.where(F.col("is_complete") & F.col("window_complete")).join(chains, "chain")
    cells = full.groupBy("place_id", "week").agg(
        F.count("*").alias("chains_compared"),
        distinct("chain_group").alias("groups_compared"),
        F.min("basket_cost").alias("min_cost"),
        F.max("basket_cost").alias("max_cost"),
        F.median("basket_cost").alias("median_cost"),
        first_by("chain", "basket_cost", "chain").alias("cheapest_chain"),
        first_by("chain", -F.col("basket_cost"), "chain").alias("dearest_chain"),
        F.array_sort(F.collect_list("basket_cost")).alias("costs"),
        F.collect_list(F.struct("version", "week_end", "chain", "chain_group", "basket_cost", "n_observations")).alias("rows"),
    )
    rows = cells.where("chains_compared >= 2").select("*", F.inline("rows"))
    c, low, mid, high = (F.col(x) for x in ("basket_cost", "min_cost", "median_cost", "max_cost"))
    return rows.select(
        "version", "week", "week_end", "place_id", "chain", "chain_group", "basket_cost",
        F.array_position("costs", c).cast("int").alias("position"),  # equal costs share the first place
        "chains_compared", "groups_compared", "min_cost", "max_cost",
        rounded(mid).alias("median_cost"), "cheapest_chain", "dearest_chain",
        (F.col("chain") == F.col("cheapest_chain")).alias("is_cheapest"),
        rounded(c - low).alias("saving"),
        rounded(100 * (c - low) / c).alias("saving_pct"),
        rounded(100 * (c - mid) / mid).alias("vs_median_pct"),
        rounded(high - low).alias("gap"),
        rounded(100 * (high - low) / high).alias("gap_pct"),
        "n_observations",
    )


def item_decomposition(items: DataFrame, basket: DataFrame, savings: DataFrame, params: Params = Params()) -> DataFrame:
    """What each item costs in each chain, over the cheapest chain for the item, and
    in paired cells against the chain with the cheapest basket.  The chains of an
    item in a place and week travel in one array."""
    paired = savings.groupBy("place_id", "week").agg(F.first("cheapest_chain").alias("winner"), F.collect_set("chain").alias("paired"))
    a = items.join(basket, "item").withColumn("cost", F.col("median_price") * F.col("quantity"))
    cells = a.groupBy("place_id", "week", "item").agg(
        F.count("*").alias("chains_with_item"),
        F.min("median_price").alias("min_chain_price"),
        F.max("median_price").alias("max_chain_price"),
        first_by("chain", "median_price", "chain").alias("cheapest_item_chain"),
        F.collect_list(F.struct("chain", "median_price", "cost", "n_observations", "n_stores", "n_products")).alias("rows"),
    )
    out = cells.join(paired, ["place_id", "week"], "left")
    base = F.get(F.filter("rows", lambda x: x["chain"] == F.col("winner")), F.lit(0))["cost"]
    out = out.withColumn("cost_in_cheapest", base).select("*", F.inline("rows"))
    is_paired = F.coalesce(F.array_contains("paired", F.col("chain")), F.lit(False))
    return out.select(
        F.lit(params.version).alias("version"), "week", "place_id", "chain", "item",
        rounded(F.col("median_price"), 4).alias("median_price"), rounded(F.col("cost"), 4).alias("item_cost"),
        "n_observations", "n_stores", "n_products", "chains_with_item",
        rounded(F.col("min_chain_price"), 4).alias("min_chain_price"), rounded(F.col("max_chain_price"), 4).alias("max_chain_price"),
        (F.col("chain") == F.col("cheapest_item_chain")).alias("is_cheapest_item_chain"),
        rounded(100 * (F.col("median_price") - F.col("min_chain_price")) / F.col("min_chain_price")).alias("over_min_pct"),
        is_paired.alias("is_paired"),
        F.when(is_paired, rounded(F.col("cost") - F.col("cost_in_cheapest"), 4)).alias("vs_cheapest_basket"),
    )


def coverage(flagged: DataFrame, baskets: DataFrame, basket: DataFrame, params: Params = Params()) -> DataFrame:
    """How complete each chain, place and week is: rows of the week itself, and the
    items that the rolling window offers (0 and false where it has no cell)."""
    own = flagged.groupBy(*CELL).agg(
        F.count("*").alias("n_observations"),
        distinct("store_id").alias("n_stores"),
        distinct("product_id").alias("n_products"),
        distinct("date").alias("n_days"),
        F.count_if("is_outlier").alias("n_outliers"),
        F.count_if(F.col("content").isNull() | (F.col("content") <= 0)).alias("n_not_comparable"),
    )
    got = baskets.select(*CELL, "items_available", "is_complete")
    out = one_row(own, basket.agg(F.count("*").alias("items_total"))).join(got, CELL, "left")
    return out.select(
        F.lit(params.version).alias("version"), *CELL, "n_observations", "n_stores", "n_products", "n_days", "n_outliers", "n_not_comparable",
        rounded(100.0 * F.col("n_outliers") / F.col("n_observations"), 3).alias("pct_outliers"),
        rounded(100.0 * F.col("n_not_comparable") / F.col("n_observations")).alias("pct_not_comparable"),
        F.coalesce("items_available", F.lit(0).cast("long")).alias("items_available"), "items_total",
        F.coalesce("is_complete", F.lit(False)).alias("is_complete"),
    )
