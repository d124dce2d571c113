"""Which basket can be priced: presence, completeness, scenarios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.stats import one_row, rounded
from ..params import Params
from ..plans.marts import rolling_weeks


def best_sku(obs: DataFrame, group: str, sku: str, chain: str, cell: list[str]) -> DataFrame:
    """For each group the product with the best presence over the chains: share of
    the chain's cells it is in, then number of chains, least and mean presence."""
    total = obs.select(chain, *cell).distinct().groupBy(chain).agg(F.count("*").alias("n_cells"))
    there = obs.select(group, sku, chain, *cell).distinct().groupBy(group, sku, chain).agg(F.count("*").alias("n_there"))
    share = there.join(total, chain).withColumn("pct", 100.0 * F.col("n_there") / F.col("n_cells"))
    each = share.groupBy(group, sku).agg(F.count("*").alias("n_chains"), rounded(F.min("pct"), 4).alias("min_pct"), rounded(F.avg("pct"), 4).alias("avg_pct"))
    order = Window.partitionBy(group).orderBy(F.desc("n_chains"), F.desc("min_pct"), F.desc("avg_pct"), sku)
    return each.withColumn("k", F.row_number().over(order)).where("k = 1").drop("k")


def basket_completeness(obs: DataFrame, grains: dict[str, str], key: str, chain: str, place: str) -> DataFrame:
    """grain, n_cells, pct_complete, pct_missing_one: all scenarios in one job.
    ``grains``: name and expression of the period of a row."""
    periods = F.array(*[F.struct(F.lit(n).alias("grain"), F.expr(e).cast("date").alias("period")) for n, e in grains.items()])
    rows = obs.select(key, chain, place, F.inline(periods))
    total = obs.agg(F.countDistinct(key).alias("n_items"))
    cells = one_row(rows.groupBy("grain", "period", chain, place).agg(F.countDistinct(key).alias("n")), total)
    return cells.groupBy("grain").agg(
        F.count("*").alias("n_cells"), rounded(100.0 * F.avg((F.col("n") == F.col("n_items")).cast("int"))).alias("pct_complete"),
            rounded(100.0 * F.avg((F.col("n") >= F.col("n_items") - 1).cast("int"))).alias("pct_missing_one")
    )


def scenario_cells(items: DataFrame, scenarios: DataFrame) -> DataFrame:
    """scenario, n_cells, pct_complete: compositions (scenario, item) over the cells
    of ``items``, joined once."""
    size = scenarios.groupBy("scenario").agg(F.count("*").alias("size"))
    got = items.join(scenarios, "item").groupBy("scenario", "chain", "place_id", "week").agg(F.count("*").alias("n"))
    return got.join(size, "scenario").groupBy("scenario").agg(F.count("*").alias("n_cells"), rounded(100.0 * F.avg((F.col("n") == F.col("size")).cast("int"))).alias("pct_complete"))


def completeness_by_chain(obs: DataFrame, best: DataFrame, item: str = "item", sku: str = "product_id") -> DataFrame:
    """scenario, chain, n_cells, pct_complete, pct_missing_one: exact products (the
    best of each item) by week and fortnight, any product of an item by week, window
    of 14 days, fortnight and month; every row names the cells it counts for, so all
    six are one job.  ``best``: item, product."""
    exact = obs.join(best.select(item, sku, F.lit(True).alias("exact")), [item, sku], "left")
    half = F.when(F.day("date") <= 15, F.trunc("date", "month")).otherwise(F.date_add(F.trunc("date", "month"), 15))
    cell = lambda name, period, only=False: F.when(F.coalesce("exact", F.lit(False)) if only else F.lit(True), F.struct(F.lit(name).alias("scenario"),
        period.cast("date").alias("period")))
    week = F.col("week")
    cells = [cell("exact, week", week, True), cell("exact, fortnight", half, True), cell("any, week", week), cell("any, 14 days", week), cell("any, 14 days",
        F.date_add(week, 7)), cell("any, fortnight", half), cell("any, month", F.trunc("date", "month"))]
    rows = exact.select(item, "chain", "place_id", F.inline(F.filter(F.array(*cells), lambda x: x.isNotNull())))
    total = obs.agg(F.countDistinct(item).alias("n_items"))
    n = one_row(rows.groupBy("scenario", "chain", "place_id", "period").agg(F.size(F.collect_set(item)).alias("n")), total)
    pct = lambda flag: rounded(100.0 * F.avg(flag.cast("int")), 1)
    return n.groupBy("scenario", "chain").agg(F.count("*").alias("n_cells"), pct(F.col("n") == F.col("n_items")).alias("pct_complete"),
        pct(F.col("n") >= F.col("n_items") - 1).alias("pct_missing_one"))


def definition_coverage(obs: DataFrame, definitions: DataFrame, text: str, params: Params = Params()) -> DataFrame:
    """definition, chain, n_cells, pct_cells, median_unit_price: of alternative
    definitions of items (definition, item, include, exclude) the share of a chain's
    places and weeks (with the weeks before) that have one, and its usual price.
    Definitions are tried once for each different item and text."""
    d = definitions.select("definition", F.col("item").alias("d_item"), "include", "exclude")
    meets = (F.col("item") == F.col("d_item")) & F.call_function("rlike", F.col(text), F.col("include")) & ~F.coalesce(F.call_function("rlike", F.col(text), F.col("exclude")), F.lit(False))
    spread = lambda df: rolling_weeks(df.distinct(), params.previous_weeks).drop("own").distinct()
    cells = spread(obs.select("chain", "place_id", "week")).groupBy("chain").agg(F.count("*").alias("n_all"))
    kinds = obs.select("item", text).distinct().join(d, meets).select("item", text, "definition")
    rows = obs.join(kinds, ["item", text]).select("definition", "chain", "place_id", "week", "unit_price")
    there = spread(rows.select("definition", "chain", "place_id", "week")).groupBy("definition", "chain").agg(F.count("*").alias("n_cells"))
    price = rows.groupBy("definition", "chain").agg(rounded(F.median("unit_price"), 4).alias("median_unit_price"))
    out = there.join(cells, "chain").join(price, ["definition", "chain"])
    return out.select("definition", "chain", "n_cells", rounded(100.0 * F.col("n_cells") / F.col("n_all"), 1).alias("pct_cells"), "median_unit_price")


def compositions(items: DataFrame, scenarios: DataFrame) -> DataFrame:
    """scenario, chain ('ALL' for all), n_cells, pct_complete, and of each scenario the
    place-weeks and places in which two chains or more are complete."""
    size = scenarios.groupBy("scenario").agg(F.count("*").alias("size"))
    got = items.join(scenarios, "item").groupBy("scenario", "chain", "place_id", "week").agg(F.count("*").alias("n")).join(size, "scenario").withColumn("full", F.col("n") == F.col("size"))
    sets = got.groupingSets([["scenario"], ["scenario", "chain"]], "scenario", "chain").agg(F.grouping("chain").alias("g"), F.count("*").alias("n_cells"),
        rounded(100.0 * F.avg(F.col("full").cast("int")), 1).alias("pct_complete"))
    pairs = got.groupBy("scenario", "place_id", "week").agg(F.count_if("full").alias("k")).where("k >= 2")
    pairs = pairs.groupBy("scenario").agg(F.count("*").alias("place_weeks"), F.countDistinct("place_id").alias("places"))
    out = sets.join(pairs, "scenario", "left")
    return out.select("scenario", F.when(F.col("g") == 1, "ALL").otherwise(F.col("chain")).alias("chain"), "n_cells", "pct_complete", F.coalesce("place_weeks",
        F.lit(0)).alias("place_weeks"), F.coalesce("places", F.lit(0)).alias("places"))
