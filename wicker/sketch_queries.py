"""Queries of kept sketches: exact where they can be, and within their stated error."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import queries as Q
from .functions import sketches as S
from .functions.stats import rounded, small_side
from .functions.storage import written
from .operators import profile
from .plans.bindings import OBS, observations
from .plans.raw import RAW, raw_prices
from .queries import query, r, sql

_SKETCHED = ["product", "package", "brand", "chain", "store", "address", "day", "price"]


@query(sql(RAW, select=" UNION ALL ".join(
    f"""SELECT scope, '{c}' AS "column", count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL OR trim({c}) = '') AS n_empty, count(DISTINCT {c}) AS n_distinct, true AS within
    FROM (SELECT 'all' AS scope, {c} FROM raw UNION ALL SELECT right(source_file, 6), {c} FROM raw) GROUP BY scope""" for c in _SKETCHED)))  # fmt: skip
def distinct_by_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values of columns, exactly and from sketches kept for each file, merged to halves of months and
    to the whole; ``within``: the sketches' error bound holds."""
    raw = raw_prices(spark, sf_dir).withColumn("scope", F.substring("source_file", -6, 6))
    kept = written(S.distinct_sketches(raw, ["source_file", "scope"], _SKETCHED))
    merged = S.merged_distinct(kept, ["scope"], _SKETCHED).unionByName(S.merged_distinct(kept, [], _SKETCHED).withColumn("scope", F.lit("all")))
    text = raw.select("scope", *_SKETCHED)
    exact = text.unionByName(text.withColumn("scope", F.lit("all"))).groupBy("scope").agg(*[F.countDistinct(c).alias(c) for c in _SKETCHED])
    exact = exact.unpivot(["scope"], _SKETCHED, "column", "exact")
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= F.lit(S.distinct_error()) * F.col("exact")
    return merged.join(exact, ["scope", "column"]).select("scope", "column", "n_rows", "n_empty", F.col("exact").alias("n_distinct"), near.alias("within"))


@query(sql(RAW, select=" UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL OR trim({c}) = '') AS n_empty,
    true AS within FROM raw""" for c in _SKETCHED)))
def column_profile_by_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of columns without exact counts, against the one with them."""
    raw = raw_prices(spark, sf_dir)
    exact = profile.column_profile(raw, _SKETCHED).select("column", F.col("n_distinct").alias("exact"))
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= F.lit(S.distinct_error()) * F.col("exact")
    return profile.column_profile(raw, _SKETCHED, approximate=True).join(exact, "column").select("column", "n_rows", "n_empty", near.alias("within"))


_PERIOD = """CASE WHEN week BETWEEN DATE '1996-01-01' AND DATE '1996-12-30' THEN 'current' WHEN week BETWEEN DATE '1995-01-01' AND DATE '1995-12-31' THEN 'previous' END"""
_CELLS = ["week", "place_id", "chain", "item"]


@query(sql(OBS, select=f"""SELECT period, chain, count(unit_price) AS n, {r("sum(CAST(unit_price AS DECIMAL(28,4)))::DOUBLE / count(unit_price)")} AS mean, true AS median_within, true AS stores_within
  FROM (SELECT *, {_PERIOD} AS period FROM obs WHERE place_id < 3) WHERE period IS NOT NULL GROUP BY ALL"""))
def period_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of chains over a period and the one before, in some places, from a cube of weekly cells
    alone; ``within``: a median's rank and a count of stores are as near as stated."""
    obs = observations(spark, sf_dir)
    cells = written(S.cube(obs, _CELLS, "unit_price", distinct="store_id"))
    figures = S.rolled_up(S.by_period(cells.where("place_id < 3"), "1996-01-01", "1996-12-30"), ["period", "chain"], {"median": 0.5}, distinct="stores")
    figures = small_side(written(figures))
    rows = S.by_period(obs.where("place_id < 3 AND unit_price IS NOT NULL"), "1996-01-01", "1996-12-30")
    x = F.col("unit_price")
    ranks = rows.join(figures, ["period", "chain"]).groupBy("period", "chain").agg(F.count_if(x < F.col("median")).alias("below"),
        F.count_if(x <= F.col("median")).alias("upto"), F.count("*").alias("rows"), F.countDistinct("store_id").alias("exact"))
    error = F.lit(S.rank_error())
    median = (F.col("below") <= (0.5 + error) * F.col("rows")) & (F.col("upto") >= (0.5 - error) * F.col("rows"))
    stores = F.abs(F.col("stores") - F.col("exact")) <= F.greatest(F.lit(S.distinct_error()) * F.col("exact"), F.lit(1.0))
    return figures.join(ranks, ["period", "chain"]).select("period", "chain", "n", rounded(F.col("mean")).alias("mean"), median.alias("median_within"), stores.alias("stores_within"))


@query(sql(OBS, Q.ITEMS, Q.BASKET, Q.SAVINGS, select=f"""SELECT period, n_cells, n_cheapest, {r("100.0::DOUBLE * n_cheapest / n_cells", 1)} AS pct_cheapest, true AS within
  FROM (SELECT {_PERIOD} AS period, count(*) AS n_cells, count(*) FILTER (WHERE is_cheapest) AS n_cheapest FROM savings GROUP BY 1) WHERE period IS NOT NULL"""))
def savings_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares and medians of paired baskets over a period and the one before, from a cube of weeks
    and chains."""
    savings = written(Q.paired_savings(spark, sf_dir))
    cells = written(S.cube(savings, ["week", "chain"], "basket_cost", {"n_cheapest": F.col("is_cheapest").cast("long")}))
    figures = written(S.rolled_up(S.by_period(cells, "1996-01-01", "1996-12-30"), ["period"], {"median": 0.5}, ["n_cheapest"]))
    x = F.col("basket_cost")
    ranks = S.by_period(savings, "1996-01-01", "1996-12-30").join(F.broadcast(figures), "period").groupBy("period").agg(F.count_if(x < F.col("median")).alias("below"),
        F.count_if(x <= F.col("median")).alias("upto"))  # two rows
    error = F.lit(S.rank_error())
    near = (F.col("below") <= (0.5 + error) * F.col("n")) & (F.col("upto") >= (0.5 - error) * F.col("n"))
    share = rounded(100.0 * F.col("n_cheapest") / F.col("n"), 1)
    return figures.join(ranks, "period").select("period", F.col("n").alias("n_cells"), "n_cheapest", share.alias("pct_cheapest"), near.alias("within"))
