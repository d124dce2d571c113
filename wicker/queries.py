"""Queries over the given tables, each with the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.storage import written
from .params import Params
from .plans import bi, marts
from .plans.bindings import OBS, chain_of, observations, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
P = Params()


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def r(x: str, digits: int = 2) -> str:
    """The rounding of ``rounded`` in SQL."""
    return f"floor(({x}) * {10.0**digits} + 0.5) / {10.0**digits}"


# --- the chain of tables, in SQL -----------------------------------------------

ITEMS = """items AS (
  SELECT chain, place_id, week, item, median(unit_price) AS median_price, min(unit_price) AS min_price, max(unit_price) AS max_price,
         count(*) AS n_observations, count(DISTINCT store_id) AS n_stores, count(DISTINCT product_id) AS n_products, count(DISTINCT date) AS n_days,
         week - 7 >= first_week AS window_complete
  FROM (SELECT o.* EXCLUDE (week), o.week + 7 * CAST(k AS INT) AS week, (SELECT min(week) FROM obs) AS first_week FROM obs o, unnest(range(0, 2)) AS u(k))
  WHERE week <= (SELECT max(week) FROM obs)
  GROUP BY chain, place_id, week, item, first_week)"""
BASKET = f"""basket AS (SELECT DISTINCT p_type AS item, 1.0::DOUBLE AS quantity FROM part),
cells AS (
  SELECT chain, place_id, week, count(*) AS items_available, sum(median_price * quantity) AS s, CAST(sum(n_observations) AS BIGINT) AS n_observations,
         min(n_observations) AS min_item_observations, max(n_stores) AS max_item_stores, bool_and(window_complete) AS window_complete
  FROM items JOIN basket USING (item) GROUP BY ALL),
baskets AS (
  SELECT 'v1' AS version, chain, place_id, week, week + 6 AS week_end, week - 7 AS window_from, items_available, items_total,
         {r("100.0::DOUBLE * items_available / items_total", 1)} AS pct_items, items_available = items_total AS is_complete,
         CASE WHEN items_available = items_total THEN {r("s")} END AS basket_cost, {r("s")} AS partial_cost,
         n_observations, min_item_observations, max_item_stores, window_complete
  FROM cells, (SELECT count(*) AS items_total FROM basket))"""
SAVINGS = f"""full_baskets AS (SELECT b.*, 'GROUP ' || (CAST(right(chain, 1) AS INT) % 2) AS chain_group FROM baskets b WHERE is_complete AND window_complete),
ends AS (
  SELECT place_id, week, count(*) AS chains_compared, count(DISTINCT chain_group) AS groups_compared, min(basket_cost) AS min_cost, max(basket_cost) AS max_cost,
         median(basket_cost) AS median_cost, first(chain ORDER BY basket_cost, chain) AS cheapest_chain, first(chain ORDER BY basket_cost DESC, chain) AS dearest_chain
  FROM full_baskets GROUP BY ALL HAVING count(*) >= 2),
savings AS (
  SELECT version, week, week_end, place_id, chain, chain_group, basket_cost, CAST(rank() OVER (PARTITION BY place_id, week ORDER BY basket_cost) AS INT) AS position,
         chains_compared, groups_compared, min_cost, max_cost, {r("median_cost")} AS median_cost, cheapest_chain, dearest_chain, chain = cheapest_chain AS is_cheapest,
         {r("basket_cost - min_cost")} AS saving, {r("100 * (basket_cost - min_cost) / basket_cost")} AS saving_pct, {r("100 * (basket_cost - median_cost) / median_cost")} AS vs_median_pct,
         {r("max_cost - min_cost")} AS gap, {r("100 * (max_cost - min_cost) / max_cost")} AS gap_pct, n_observations
  FROM full_baskets JOIN ends USING (place_id, week))"""
PRICES = f"""a AS (SELECT i.*, median_price * quantity AS cost FROM items i JOIN basket USING (item)),
best AS (SELECT place_id, week, item, count(*) AS chains_with_item, min(median_price) AS lo, max(median_price) AS hi, first(chain ORDER BY median_price,
    chain) AS cheapest_item_chain FROM a GROUP BY ALL),
base AS (SELECT a.place_id, a.week, a.item, a.cost AS cost_in_cheapest FROM a JOIN (SELECT DISTINCT place_id, week, cheapest_chain AS chain FROM savings) USING (place_id, week, chain)),
prices AS (
  SELECT 'v1' AS version, week, place_id, chain, item, {r("median_price", 4)} AS median_price, {r("cost", 4)} AS item_cost, a.n_observations, n_stores, n_products, chains_with_item,
         {r("lo", 4)} AS min_chain_price, {r("hi", 4)} AS max_chain_price, chain = cheapest_item_chain AS is_cheapest_item_chain, {r("100 * (median_price - lo) / lo")} AS over_min_pct,
         s.is_cheapest IS NOT NULL AS is_paired, CASE WHEN s.is_cheapest IS NOT NULL THEN {r("cost - cost_in_cheapest", 4)} END AS vs_cheapest_basket
  FROM a JOIN best USING (place_id, week, item) LEFT JOIN (SELECT place_id, week, chain, is_cheapest FROM savings) s USING (place_id, week, chain)
       LEFT JOIN base USING (place_id, week, item))"""
FLAGGED = f"""logs AS (SELECT product_id, price, ln(price) AS x FROM obs WHERE price > 0),
centre AS (SELECT product_id, count(*) AS n, median(price) AS m, median(x) AS lm FROM logs GROUP BY 1),
spread AS (SELECT product_id, median(abs(x - lm)) AS mad FROM logs JOIN centre USING (product_id) GROUP BY 1),
flagged AS (
  SELECT o.*, n, m, mad, CASE WHEN price <= 0 THEN 0 WHEN price > 10 * m OR price < m / 10 THEN 1
              WHEN n >= 30 AND mad > 0 AND abs(ln(price) - lm) > 5 * 1.4826 * mad AND abs(ln(price) - lm) > ln(3) THEN 2 ELSE 0 END AS rule
  FROM obs o LEFT JOIN centre USING (product_id) LEFT JOIN spread USING (product_id))"""
AVAILABLE = """available AS (
  SELECT version, chain, place_id, week, item, i.n IS NOT NULL AS available, coalesce(i.n, 0) AS n_observations
  FROM (SELECT * FROM baskets, basket) LEFT JOIN (SELECT chain, place_id, week, item, n_observations AS n FROM items) i USING (chain, place_id, week, item))"""


def sql(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def _basket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_type").alias("item")).distinct().withColumn("quantity", F.lit(1.0))


def _chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chain, chain_group of all stores."""
    return table(spark, sf_dir, "supplier").select(*chain_of("s_suppkey")).distinct()


def _baskets(spark: SparkSession, sf_dir: str, items: DataFrame) -> DataFrame:
    return marts.basket_cost(items, _basket(spark, sf_dir), P)


def _savings(spark: SparkSession, sf_dir: str, items: DataFrame | None = None) -> DataFrame:
    items = marts.rolling_item_price(observations(spark, sf_dir), P) if items is None else items
    return marts.paired_savings(_baskets(spark, sf_dir, items), _chains(spark, sf_dir))


def _prices(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """items, savings (written) and their decomposition."""
    items = marts.rolling_item_price(observations(spark, sf_dir), P)
    savings = written(_savings(spark, sf_dir, items))
    return items, savings, marts.item_decomposition(items, _basket(spark, sf_dir), savings, P)


def _covered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """baskets (written) and the coverage."""
    flagged = marts.flag_outliers(observations(spark, sf_dir), P)
    wanted = ["chain", "place_id", "week", "item", "unit_price", "store_id", "product_id", "date", "content", "is_outlier"]
    flagged = written(flagged.select(*wanted))  # the rolling prices and the coverage both read it
    baskets = written(_baskets(spark, sf_dir, marts.rolling_item_price(flagged, P)))
    return baskets, marts.coverage(flagged, baskets, _basket(spark, sf_dir), P)


@query(sql(OBS, ITEMS, select="SELECT * FROM items"))
def rolling_item_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.rolling_item_price(observations(spark, sf_dir), P)


@query(sql(OBS, ITEMS, BASKET, select="SELECT * FROM baskets"))
def basket_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _baskets(spark, sf_dir, marts.rolling_item_price(observations(spark, sf_dir), P))


@query(sql(OBS, ITEMS, BASKET, SAVINGS, select="SELECT * FROM savings"))
def paired_savings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _savings(spark, sf_dir)


@query(sql(OBS, ITEMS, BASKET, SAVINGS, PRICES, select="SELECT * FROM prices"))
def item_decomposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prices(spark, sf_dir)[2]


@query(sql(OBS, ITEMS, BASKET, FLAGGED, f"""own AS (
  SELECT chain, place_id, week, count(*) AS n_observations, count(DISTINCT store_id) AS n_stores, count(DISTINCT product_id) AS n_products, count(DISTINCT date) AS n_days,
         count(*) FILTER (WHERE rule > 0) AS n_outliers, count(*) FILTER (WHERE content IS NULL OR content <= 0) AS n_not_comparable
  FROM flagged GROUP BY ALL)""", select=f"""
  SELECT 'v1' AS version, own.chain, own.place_id, own.week, own.n_observations, n_stores, n_products, n_days, n_outliers, n_not_comparable,
         {r("100.0::DOUBLE * n_outliers / own.n_observations", 3)} AS pct_outliers, {r("100.0::DOUBLE * n_not_comparable / own.n_observations")} AS pct_not_comparable,
         coalesce(b.items_available, 0) AS items_available, (SELECT count(*) FROM basket) AS items_total, coalesce(b.is_complete, false) AS is_complete
  FROM own LEFT JOIN baskets b ON own.chain = b.chain AND own.place_id = b.place_id AND own.week = b.week"""))
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _covered(spark, sf_dir)[1]


_RULES = "SELECT product_id, store_id, date, {r} AS price, rule, n AS n_product, {m} AS median FROM flagged WHERE rule > 0".format(r=r("price", 4), m=r("m", 4))


def _outliers(obs: DataFrame, params: Params) -> DataFrame:
    out = marts.flag_outliers(obs, params).where("is_outlier")
    return out.select("product_id", "store_id", "date", marts.rounded(F.col("price"), 4).alias("price"), "rule", "n_product", marts.rounded(F.col("median"), 4).alias("median"))


@query(sql(OBS, FLAGGED, select=_RULES))
def robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outliers(observations(spark, sf_dir), P)


@query(sql(OBS, FLAGGED.replace("10 * m", "20 * m").replace("m / 10", "m / 20").replace("> 5 *", "> 4 *"), select=_RULES))
def robust_outliers_by_mad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outliers(observations(spark, sf_dir), Params(outlier_factor=20.0, outlier_mad=4.0))


_MONTH = """grouped AS (
  SELECT product_id, chain, month, cents, count(*) AS n_source_rows, bit_or(1 << bit) AS catalog_mask
  FROM (SELECT product_id, chain, CAST(date_trunc('month', date) AS DATE) AS month, CAST(floor(price * 100 + 0.5) AS BIGINT) AS cents, CASE flag WHEN 'A' THEN 0
      WHEN 'N' THEN 1 ELSE 2 END AS bit FROM obs)
  GROUP BY ALL)"""


@query(sql(OBS, _MONTH, select="SELECT *, count(*) OVER (PARTITION BY product_id, chain, month) > 1 AS has_conflict FROM grouped"))
def consolidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir).select(
        "product_id", "chain", F.trunc("date", "month").alias("month"), F.floor(F.col("price") * 100 + 0.5).alias("cents"), F.when(F.col("flag") == "A",
            0).when(F.col("flag") == "N", 1).otherwise(2).alias("bit")
    )
    return marts.consolidate(obs, ["product_id", "chain", "month"], "cents", "bit")


@query(sql(OBS, ITEMS, BASKET, SAVINGS, select=f"""
  SELECT version, week, week_end, chain, chain_group, count(*) AS places, {r("median(basket_cost)")} AS median_cost, {r("quantile_cont(basket_cost, 0.25)", 4)} AS p25_cost,
         {r("quantile_cont(basket_cost, 0.75)", 4)} AS p75_cost, count(*) FILTER (WHERE is_cheapest) AS times_cheapest, {r("100.0::DOUBLE * avg(is_cheapest::INT)", 1)} AS pct_cheapest,
         {r("median(saving)")} AS median_saving, {r("median(saving_pct)")} AS median_saving_pct, CAST(sum(n_observations) AS BIGINT) AS n_observations
  FROM savings GROUP BY version, week, week_end, chain, chain_group"""))
def weekly_chain_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.weekly_chain_cost(_savings(spark, sf_dir))


@query(sql(OBS, ITEMS, BASKET, SAVINGS, """c AS (SELECT *, count(*) OVER (PARTITION BY week, cheapest_chain) AS n FROM
  (SELECT DISTINCT version, week, week_end, place_id, chains_compared, groups_compared, gap, gap_pct, cheapest_chain FROM savings))""", select=f"""
  SELECT version, week, week_end, count(*) AS places, count(*) FILTER (WHERE chains_compared = 4) AS places_with_all_chains, count(*) FILTER (WHERE groups_compared >= 2) AS places_with_rivals,
         {r("median(gap)")} AS median_gap, {r("median(gap_pct)")} AS median_gap_pct, {r("quantile_cont(gap, 0.9)", 4)} AS p90_gap,
         {r("median(gap) FILTER (WHERE groups_compared >= 2)")} AS median_gap_rivals, first(cheapest_chain ORDER BY n DESC, cheapest_chain) AS most_often_cheapest
  FROM c GROUP BY version, week, week_end"""))
def weekly_savings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.weekly_savings(written(_savings(spark, sf_dir)))


_DEARER = "is_paired AND NOT s.is_cheapest"
_OVER = "chains_with_item >= 2 AND NOT is_cheapest_item_chain"


@query(sql(OBS, ITEMS, BASKET, SAVINGS, PRICES, select=f"""
  SELECT p.version, p.week, p.item, count(*) FILTER (WHERE {_DEARER}) AS cells_compared,
         {r(f"CAST(coalesce(sum(CAST(vs_cheapest_basket AS DECIMAL(18,4))) FILTER (WHERE {_DEARER}), 0) AS DOUBLE)", 4)} AS accumulated_difference,
         count(*) FILTER (WHERE {_OVER}) AS cells_over_min, {r(f"median(over_min_pct) FILTER (WHERE {_OVER})")} AS median_over_min_pct, {r("median(median_price)", 4)} AS median_price
  FROM prices p LEFT JOIN (SELECT place_id, week, chain, is_cheapest FROM savings) s ON p.place_id = s.place_id AND p.week = s.week AND p.chain = s.chain
  GROUP BY p.version, p.week, p.item"""))
def weekly_item_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, savings, prices = _prices(spark, sf_dir)
    return bi.weekly_item_differences(prices, savings)


@query(sql(OBS, ITEMS, BASKET, AVAILABLE, select="SELECT * FROM available"))
def item_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = marts.rolling_item_price(observations(spark, sf_dir), P)
    return bi.item_availability(_baskets(spark, sf_dir, items), items, _basket(spark, sf_dir))


@query(sql(OBS, ITEMS, BASKET, AVAILABLE, select=f"""SELECT version, week, chain, item, count(*) AS cells, count(*) FILTER (WHERE available) AS cells_with_item,
  {r("100.0::DOUBLE * avg(available::INT)", 1)} AS pct_available FROM available GROUP BY version, week, chain, item"""))
def weekly_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.weekly_availability(item_availability(spark, sf_dir))


@query(sql(OBS, ITEMS, BASKET, """f AS (SELECT chain, place_id, week, basket_cost FROM baskets WHERE is_complete AND window_complete),
b AS (SELECT chain, place_id, median(basket_cost) AS base FROM f WHERE week < (SELECT min(week) FROM f) + 56 GROUP BY ALL),
p AS (SELECT f.*, ln(basket_cost / base) AS x FROM f JOIN b USING (chain, place_id))""", select=f"""
  SELECT 'v1' AS version, week, 'ALL' AS scope, count(*) AS pairs, {r("100 * exp(avg(x))")} AS index FROM p GROUP BY week
  UNION ALL SELECT 'v1', week, chain, count(*), {r("100 * exp(avg(x))")} FROM p GROUP BY week, chain"""))
def fixed_panel_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.fixed_panel_index(written(_baskets(spark, sf_dir, marts.rolling_item_price(observations(spark, sf_dir), P))), P)


@query(sql(OBS, ITEMS, BASKET, SAVINGS, """nation_cost AS (SELECT chain, median(basket_cost) AS n FROM savings GROUP BY 1),
h AS (SELECT place_id, chain, median(basket_cost) AS c FROM savings GROUP BY ALL HAVING count(DISTINCT week) >= 4)""", select=f"""
  SELECT place_id, count(*) AS chains, {r("100 * exp(avg(ln(c / n)))")} AS level FROM h JOIN nation_cost USING (chain) GROUP BY place_id HAVING count(*) >= 2"""))
def price_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.price_level(written(_savings(spark, sf_dir)))


@query(sql(OBS, ITEMS, BASKET, SAVINGS, PRICES, f"""e AS (
  SELECT item, sum(CAST(vs_cheapest_basket AS DECIMAL(18,4))) AS s, {r("median(vs_cheapest_basket)")} AS median_difference,
      {r("100.0::DOUBLE * avg((vs_cheapest_basket < 0)::INT)", 1)} AS pct_cells_cheaper, count(*) AS cells
  FROM prices p JOIN savings v USING (place_id, week, chain) WHERE NOT v.is_cheapest GROUP BY item)""", select=f"""
  SELECT item, {r("s::DOUBLE")} AS accumulated, {r("100 * s::DOUBLE / nullif((SELECT sum(s)::DOUBLE FROM e), 0)", 1)} AS pct_of_net, median_difference, pct_cells_cheaper, cells FROM e"""))
def explain_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, savings, prices = _prices(spark, sf_dir)
    return bi.explain_items(prices, savings)


_W = f"""w AS (SELECT week, chain, count(*) AS places, {r("median(basket_cost)")} AS median_cost, count(*) FILTER (WHERE is_cheapest) AS times_cheapest FROM savings GROUP BY week, chain)"""


@query(sql(OBS, ITEMS, BASKET, SAVINGS, _W, select=f"""
  SELECT period, chain, {r("median(median_cost)")} AS median_cost, CAST(sum(places) AS BIGINT) AS places, CAST(sum(times_cheapest) AS BIGINT) AS times_cheapest, count(*) AS weeks,
         {r("100.0::DOUBLE * sum(times_cheapest) / sum(places)", 1)} AS pct_cheapest
  FROM (SELECT 'current' AS period, * FROM w WHERE week BETWEEN DATE '1996-01-01' AND DATE '1996-12-30'
        UNION ALL SELECT 'previous', * FROM w WHERE week BETWEEN DATE '1996-01-01' - 365 AND DATE '1995-12-31') GROUP BY period, chain"""))
def period_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.period_rollup(_savings(spark, sf_dir), "1996-01-01", "1996-12-30")


@query(sql(OBS, ITEMS, f"""m AS (SELECT item, chain, {r("median(median_price)", 4)} AS x FROM items GROUP BY ALL)""", select=f"""
  SELECT item, max(x) FILTER (WHERE chain = 'CHAIN 0') AS chain_0, max(x) FILTER (WHERE chain = 'CHAIN 1') AS chain_1, max(x) FILTER (WHERE chain = 'CHAIN 2') AS chain_2,
         max(x) FILTER (WHERE chain = 'CHAIN 3') AS chain_3, {r("max(x) / min(x)", 4)} AS max_over_min FROM m GROUP BY item"""))
def item_chain_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.cost_matrix(marts.rolling_item_price(observations(spark, sf_dir), P), [f"CHAIN {i}" for i in range(4)])
