"""Queries of result tables, dashboard sets, feasibility, validation and file loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import more_queries as more
from . import queries as Q
from .dimension_queries import BASKET_OBS, CATALOG_MAP, CONSOLIDATED, FACT, PRODUCTS, SEEDS, SKUS, STORE_DIM, STORES, Star, basket_seed, chain_seed
from .functions.storage import written
from .functions.text import canonical_key
from .operators import dimensions as D
from .operators import feasibility, normalize, packages, validation
from .plans import bi, dashboard, marts, results
from .plans.bindings import OBS, observations, table
from .plans.raw import RAW, STAGED
from .queries import ITEMS, ORACLES, P, query, r, sql

CHAINS = [f"CHAIN {i}" for i in range(4)]
START, END = "1996-01-01", "1996-12-30"


def _of(*names: str) -> str:
    """The SQL of other queries as tables."""
    return ", ".join(f"{n} AS ({ORACLES[n]})" for n in names)


def _q(names: str, select: str) -> str:
    return f"WITH {_of(*names.split())} {select}"


def _savings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(Q.paired_savings(spark, sf_dir))


# --- results --------------------------------------------------------------------


@query(_q("paired_savings", """SELECT min(week) AS first_week, max(week) AS last_week, max(week) - 49 AS recent_from, any_value(version) AS version,
    count(DISTINCT (place_id, week)) AS place_weeks, count(DISTINCT place_id) AS places FROM paired_savings"""))
def result_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.period(Q.paired_savings(spark, sf_dir), P)


@query(_q("paired_savings", f"""SELECT chain, chain_group, count(*) AS place_weeks, {r("median(basket_cost)")} AS median_cost,
    {r("median(basket_cost) FILTER (WHERE week >= (SELECT max(week) - 49 FROM paired_savings))")} AS median_cost_recent, {r("median(vs_median_pct)")} AS vs_median_pct
        FROM paired_savings GROUP BY ALL"""))
def result_cost_by_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.cost_by_chain(_savings(spark, sf_dir), P)


_GAP = f"count(*) AS place_weeks, {r('median(gap)')} AS median_gap, {r('median(gap_pct)')} AS median_gap_pct, {r('quantile_cont(gap, 0.9)', 4)} AS p90_gap FROM cells"


@query(f"WITH {_of('paired_savings')}, cells AS (SELECT DISTINCT place_id, week, chains_compared, groups_compared, gap, gap_pct FROM paired_savings) SELECT 'all' AS scope, {_GAP} HAVING count(*) > 0 UNION ALL SELECT 'all chains', {_GAP} WHERE chains_compared = 4 HAVING count(*) > 0 UNION ALL SELECT 'rivals', {_GAP} WHERE groups_compared >= 2 HAVING count(*) > 0")
def result_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.gaps(Q.paired_savings(spark, sf_dir))


@query(_q("price_level", """SELECT * FROM (SELECT *, 'cheapest' AS "end" FROM price_level ORDER BY level, place_id LIMIT 2) UNION ALL SELECT * FROM (SELECT *, 'dearest'
    FROM price_level ORDER BY level DESC, place_id LIMIT 2)"""))
def result_extreme_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bi.cheapest_and_dearest(written(Q.price_level(spark, sf_dir)), 2)


@query(_q("paired_savings", f"""SELECT chain, count(*) AS place_weeks, {r("100.0::DOUBLE * avg(is_cheapest::INT)", 1)} AS pct_cheapest,
    {r("median(saving)")} AS median_saving, {r("median(saving_pct)")} AS median_saving_pct, {r("median(saving) * 52", 0)} AS yearly_saving FROM paired_savings GROUP BY chain"""))
def result_saving_by_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.saving_by_chain(Q.paired_savings(spark, sf_dir))


@query(_q("fixed_panel_index", f"""SELECT CAST(date_trunc('month', week) AS DATE) AS month, {r("avg(CAST(index AS DECIMAL(18,2)))", 1)} AS mean_index, {r("avg(pairs)",
    1)} AS mean_pairs FROM fixed_panel_index WHERE scope = 'ALL' GROUP BY 1"""))
def result_index_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.index_by_month(Q.fixed_panel_index(spark, sf_dir))


@query(_q("item_decomposition", f"""SELECT item, count(*) AS cells, {r("median(over_min_pct)")} AS median_over_min_pct, {r("quantile_cont(over_min_pct, 0.9)",
    4)} AS p90_over_min_pct FROM item_decomposition WHERE chains_with_item >= 2 AND NOT is_cheapest_item_chain GROUP BY item"""))
def result_surcharge_by_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.surcharge_by_item(Q.item_decomposition(spark, sf_dir))


@query(f"""WITH {_of("robust_outliers", "basket_cost")} SELECT 'observations' AS indicator, count(*)::DOUBLE AS value FROM lineitem
    UNION ALL SELECT 'nations with stores', count(DISTINCT s_nationkey) FROM supplier UNION ALL SELECT 'stores', count(*) FROM supplier
  UNION ALL SELECT '% outliers', {r("100.0::DOUBLE * (SELECT count(*) FROM robust_outliers) / count(*)", 3)} FROM lineitem UNION ALL SELECT '% complete baskets',
      {r("100.0::DOUBLE * avg(is_complete::INT)", 3)} FROM basket_cost WHERE window_complete""")
def result_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir)
    stores = table(spark, sf_dir, "supplier")
    pct = lambda c: 100.0 * F.avg(F.col(c).cast("int"))
    return results.indicators(
        {
            "observations": (table(spark, sf_dir, "lineitem"), F.count("*")), "nations with stores": (stores, F.countDistinct("s_nationkey")), "stores": (stores, F.count("*")),
            "% outliers": (marts.flag_outliers(obs, P), pct("is_outlier")), "% complete baskets": (Q.basket_cost(spark, sf_dir).where("window_complete"), pct("is_complete")),
        }
    )


@query(_q("coverage", f"""SELECT chain, count(DISTINCT place_id) AS places, count(DISTINCT week) AS weeks, {r("median(n_stores)", 1)} AS stores_a_cell,
    {r("median(n_days)", 1)} AS days_a_week, {r("100.0::DOUBLE * avg(is_complete::INT)", 1)} AS pct_complete FROM coverage GROUP BY chain"""))
def result_coverage_by_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.coverage_by_chain(written(Q.coverage(spark, sf_dir)))


@query(f"""WITH {_of("paired_savings")} SELECT n_nationkey AS place_id, n_name, count(s_suppkey) AS n_stores FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey
    WHERE n_nationkey NOT IN (SELECT place_id FROM paired_savings) GROUP BY ALL""")
def result_never_comparable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations stand for places here: those beyond the compared ones."""
    stores = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("place_id")).agg(F.count("*").alias("n"))
    places = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("place_id"), "n_name").join(stores, "place_id", "left")
    return results.never_comparable(places.select("place_id", "n_name", F.coalesce("n", F.lit(0)).alias("n_stores")), Q.paired_savings(spark, sf_dir))


@query(f"""WITH {_of("weekly_savings", "fixed_panel_index")}, w AS (SELECT max(week) AS last_week FROM weekly_savings) SELECT (SELECT max(l_shipdate)::DATE FROM lineitem) AS last_date, last_week,
  (SELECT {r("median(median_gap)")} FROM weekly_savings WHERE week > last_week - 28) AS recent_gap, (SELECT arg_max(index, week) FROM fixed_panel_index WHERE scope = 'ALL') AS latest_index FROM w""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir)
    baskets = written(Q._baskets(spark, sf_dir, marts.rolling_item_price(obs, P)))
    weekly = bi.weekly_savings(written(marts.paired_savings(baskets, Q._chains(spark, sf_dir))))
    return results.run_summary(obs, written(weekly), bi.fixed_panel_index(baskets, P))


# --- dashboard ------------------------------------------------------------------


@query(_q("basket_cost coverage weekly_savings", """SELECT week AS value, CAST(row_number() OVER (ORDER BY week) - 1 AS INT) AS position FROM (SELECT week
    FROM basket_cost UNION SELECT week FROM coverage UNION SELECT week FROM weekly_savings)"""))
def dashboard_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    baskets, coverage = Q._covered(spark, sf_dir)
    weekly = bi.weekly_savings(written(marts.paired_savings(baskets, Q._chains(spark, sf_dir))))
    return dashboard.week_axis(baskets, coverage, weekly)


_NATIONAL = f"national AS (SELECT week, chain, item, {r('median(median_price)', 3)} AS median_price, count(*) AS places FROM item_decomposition GROUP BY ALL)"


@query(f"WITH {_of('item_decomposition')}, {_NATIONAL} SELECT * FROM national")
def dashboard_item_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.national_item_price(Q.item_decomposition(spark, sf_dir))


_FOLDED = f"""folded AS (SELECT week, place_id, CASE WHEN chain = 'CHAIN 3' THEN 'OTHERS' ELSE chain END AS chain, CAST(sum(n_observations) AS BIGINT) AS n_observations,
    count(*) AS n_rows, CAST(sum(n_stores) AS BIGINT) AS n_stores, CAST(sum(n_days) AS BIGINT) AS n_days,
  {r("sum(pct_outliers)", 3)} AS pct_outliers, {r("sum(pct_not_comparable)")} AS pct_not_comparable FROM coverage GROUP BY ALL)"""


@query(f"WITH {_of('coverage')}, {_FOLDED} SELECT * FROM folded")
def dashboard_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.folded_coverage(Q.coverage(spark, sf_dir), CHAINS[:3])


@query(_q("item_availability", "SELECT week, place_id, chain, item FROM item_availability WHERE NOT available"))
def dashboard_missing_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.missing_items(Q.item_availability(spark, sf_dir))


def _datasets(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The ten data sets, index-encoded, and their catalogs."""
    items, savings, prices = Q._prices(spark, sf_dir)
    prices, baskets = written(prices), written(Q._baskets(spark, sf_dir, items))
    there = written(bi.item_availability(baskets, items, Q._basket(spark, sf_dir)))
    coverage = written(marts.coverage(marts.flag_outliers(observations(spark, sf_dir), P), baskets, Q._basket(spark, sf_dir), P))
    weekly = written(bi.weekly_savings(savings))
    index = bi.fixed_panel_index(baskets, P).withColumnRenamed("scope", "chain")
    plain = {
        "weekly_savings": weekly.drop("version", "week_end").withColumnRenamed("most_often_cheapest", "chain"),
        "chain_cost": bi.weekly_chain_cost(savings).drop("version", "week_end", "chain_group"),
        "index": index.drop("version"),
        "differences": bi.weekly_item_differences(prices, savings).drop("version"),
        "availability": bi.weekly_availability(there).drop("version"),
        "savings_by_place": savings.select("week", "place_id", "chain", "position", "basket_cost", "saving", "saving_pct", "chains_compared"),
        "item_price": dashboard.national_item_price(prices),
        "coverage": dashboard.folded_coverage(coverage, CHAINS[:3]),
        "baskets": baskets.select("week", "place_id", "chain", F.col("is_complete").cast("int").alias("is_complete")),
        "missing": dashboard.missing_items(there),
    }
    chains = spark.createDataFrame([(c, i) for i, c in enumerate([*CHAINS, dashboard.OTHERS, "ALL"])], "value string, position int")
    catalogs = {"week": written(dashboard.week_axis(baskets, coverage, weekly)), "chain": chains, "item": dashboard.catalog(Q._basket(spark, sf_dir), "item"),
        "place_id": dashboard.catalog(coverage, "place_id")}
    return dashboard.encoded(plain, catalogs), catalogs


_SETS = {
    "weekly_savings": "weekly_savings", "chain_cost": "weekly_chain_cost", "index": "fixed_panel_index", "differences": "weekly_item_differences",
        "availability": "weekly_availability", "savings_by_place": "paired_savings",
    "item_price": "national", "coverage": "folded", "baskets": "basket_cost", "missing": "(SELECT 1 FROM item_availability WHERE NOT available)",
}
_SET_SQL = "WITH " + _of("weekly_savings", "weekly_chain_cost", "fixed_panel_index", "weekly_item_differences", "weekly_availability", "paired_savings",
    "item_decomposition", "coverage", "basket_cost", "item_availability") + f", {_NATIONAL}, {_FOLDED} "


@query(_SET_SQL + " UNION ALL ".join(f"SELECT '{n}' AS dataset, count(*) AS n_rows, 0::BIGINT AS n_outside, {'count(*) > 0' if n in dashboard.REQUIRED else 'true'} AS fine FROM {t}" for n, t in _SETS.items()))
def dashboard_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the ten encoded sets, and positions outside their catalogs."""
    return dashboard.check_export(*_datasets(spark, sf_dir))


_POSITIONS = """w AS (SELECT week, CAST(row_number() OVER (ORDER BY week) - 1 AS INT) AS p FROM (SELECT week FROM basket_cost UNION SELECT week FROM coverage UNION SELECT week FROM weekly_savings)),
g AS (SELECT place_id, CAST(row_number() OVER (ORDER BY place_id) - 1 AS INT) AS p FROM (SELECT DISTINCT place_id FROM coverage))"""


@query(f"WITH {_of('paired_savings', 'basket_cost', 'coverage',
    'weekly_savings')}, {_POSITIONS} SELECT w.p AS week, g.p AS place_id, CAST(right(chain, 1) AS INT) AS chain, position, basket_cost, saving, saving_pct, chains_compared FROM paired_savings s JOIN w USING (week) JOIN g ON g.place_id = s.place_id")
def dashboard_savings_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _datasets(spark, sf_dir)[0]["savings_by_place"]


@query(f"""WITH {_of("weekly_savings", "fixed_panel_index", "weekly_availability", "weekly_item_differences")}, p AS (SELECT * FROM (VALUES ('current', DATE '{START}',
    DATE '{END}'), ('previous', DATE '{START}' - 365, DATE '{START}' - 1)) v(period, a, b))
SELECT period, {r("(SELECT median(median_gap) FROM weekly_savings WHERE week BETWEEN a AND b)")} AS median_gap, (SELECT CAST(sum(places) AS BIGINT) FROM weekly_savings
    WHERE week BETWEEN a AND b) AS places, (SELECT count(*) FROM weekly_savings WHERE week BETWEEN a AND b) AS weeks,
  {r("(SELECT 100 * arg_max(index, week) / arg_min(index, week) FROM fixed_panel_index WHERE scope = 'ALL' AND week BETWEEN a AND b)")} AS index_change,
  {r("(SELECT 100.0::DOUBLE * sum(cells_with_item) / sum(cells) FROM weekly_availability WHERE week BETWEEN a AND b)", 1)} AS pct_available,
  {r("(SELECT CAST(sum(CAST(accumulated_difference AS DECIMAL(18,4))) AS DOUBLE) FROM weekly_item_differences WHERE week BETWEEN a AND b)")} AS accumulated_difference
FROM p WHERE EXISTS (SELECT 1 FROM weekly_savings WHERE week BETWEEN a AND b)""")
def period_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, savings, prices = Q._prices(spark, sf_dir)
    baskets = written(Q._baskets(spark, sf_dir, items))
    there = bi.weekly_availability(bi.item_availability(baskets, items, Q._basket(spark, sf_dir)))
    return dashboard.period_summary(bi.weekly_savings(savings), bi.fixed_panel_index(baskets, P), there, bi.weekly_item_differences(prices, savings), START, END)


@query(_q("weekly_item_differences", f"""SELECT item, {r("s")} AS accumulated, {r("100 * s / nullif(t, 0)", 1)} AS pct_of_total, CAST(row_number()
    OVER (ORDER BY {r("s")} DESC, item) AS INT) AS place FROM (SELECT item, CAST(sum(CAST(accumulated_difference AS DECIMAL(18,4))) AS DOUBLE) AS s FROM weekly_item_differences GROUP BY item),
  (SELECT CAST(sum(CAST(accumulated_difference AS DECIMAL(18,4))) AS DOUBLE) AS t FROM weekly_item_differences) QUALIFY place <= 4"""))
def item_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.item_ranking(written(Q.weekly_item_differences(spark, sf_dir)), 4)


@query(_q("weekly_availability", "SELECT item, " + ", ".join(f"max(x) FILTER (WHERE chain = '{c}') AS {c.lower().replace(' ',
    '_')}" for c in CHAINS) + f" FROM (SELECT item, chain, {r('100.0::DOUBLE * sum(cells_with_item) / sum(cells)', 1)} AS x FROM weekly_availability GROUP BY ALL) GROUP BY item"))
def availability_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.availability_matrix(Q.weekly_availability(spark, sf_dir), CHAINS)


@query(_q("coverage", """SELECT *, CAST(sum(n_observations) OVER (PARTITION BY state_iso, month) AS BIGINT) AS state_total FROM (SELECT substr(r_name, 1, 1) AS state_iso,
    place_id, CAST(date_trunc('month', week) AS DATE) AS month, CAST(sum(n_observations) AS BIGINT) AS n_observations FROM coverage JOIN region ON r_regionkey = place_id GROUP BY ALL)"""))
def observation_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("place_id"), F.substring("r_name", 1, 1).alias("state_iso"))
    return dashboard.observation_heatmap(Q.coverage(spark, sf_dir), places)


# --- feasibility and validation ---------------------------------------------------

_HALF = "CASE WHEN day(date) <= 15 THEN date_trunc('month', date)::DATE ELSE date_trunc('month', date)::DATE + 15 END"
_PCT = lambda flag: r(f"100.0::DOUBLE * avg(({flag})::INT)", 1)


@query(f"""WITH {OBS}, {_of("best_sku")}, o AS (SELECT obs.*, b.product_id IS NOT NULL AS exact FROM obs LEFT JOIN best_sku b ON b.item = obs.item AND b.product_id = obs.product_id),
c AS (SELECT scenario, chain, place_id, period, count(DISTINCT item) AS n FROM (
  SELECT 'exact, week' AS scenario, chain, place_id, week AS period, item FROM o WHERE exact UNION ALL SELECT 'exact, fortnight', chain, place_id, {_HALF}, item FROM o WHERE exact
  UNION ALL SELECT 'any, week', chain, place_id, week, item FROM o UNION ALL SELECT 'any, 14 days', chain, place_id, week, item FROM o UNION ALL SELECT 'any, 14 days',
      chain, place_id, week + 7, item FROM o
  UNION ALL SELECT 'any, fortnight', chain, place_id, {_HALF}, item FROM o UNION ALL SELECT 'any, month', chain, place_id, date_trunc('month', date)::DATE, item FROM o) GROUP BY ALL)
SELECT scenario, chain, count(*) AS n_cells, {_PCT("n = t")} AS pct_complete, {_PCT("n >= t - 1")} AS pct_missing_one FROM c, (SELECT count(DISTINCT item) AS t FROM obs) GROUP BY scenario, chain""")
def completeness_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six scenarios, by chain."""
    return feasibility.completeness_by_chain(observations(spark, sf_dir), written(more.best_sku(spark, sf_dir)))


_DEFINITIONS = [("small packs", "ECONOMY", "^BOLSA [0-9] KG", None), ("any pack", "ECONOMY", "^BOLSA", None), ("no giant", "PROMO", "^BOLSA", "^BOLSA [45][0-9] KG")]


@query(f"""WITH {OBS}, d AS (SELECT * FROM (VALUES ('small packs', 'ECONOMY', 1, 9), ('any pack', 'ECONOMY', 1, 99), ('no giant', 'PROMO', 1, 39)) v(definition, item, low, high)),
w AS (SELECT chain, count(*) AS n_all FROM (SELECT chain, place_id, week FROM obs UNION SELECT chain, place_id, week + 7 FROM obs) GROUP BY chain),
m AS (SELECT definition, chain, place_id, week, unit_price FROM obs JOIN d USING (item) WHERE content BETWEEN low AND high),
t AS (SELECT definition, chain, count(*) AS n_cells FROM (SELECT definition, chain, place_id, week FROM m UNION SELECT definition, chain, place_id, week + 7 FROM m) GROUP BY ALL),
p AS (SELECT definition, chain, {r("median(unit_price)", 4)} AS median_unit_price FROM m GROUP BY ALL)
SELECT definition, chain, n_cells, {r("100.0::DOUBLE * n_cells / n_all", 1)} AS pct_cells, median_unit_price FROM t JOIN w USING (chain) JOIN p USING (definition, chain)""")
def definition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir).withColumn("package", F.concat(F.lit("BOLSA "), F.col("content").cast("string"), F.lit(" KG")))
    return feasibility.definition_coverage(obs, spark.createDataFrame(_DEFINITIONS, "definition string, item string, include string, exclude string"), "package")


_SCENARIOS = [("all six", x) for x in ("ECONOMY", "STANDARD", "LARGE", "MEDIUM", "PROMO", "SMALL")] + [("three", x) for x in ("ECONOMY", "LARGE", "SMALL")] + [("one", "PROMO")]


@query(f"""WITH {OBS}, {ITEMS}, s AS (SELECT * FROM (VALUES {", ".join(f"('{a}', '{b}')" for a, b in _SCENARIOS)}) v(scenario, item)), z AS (SELECT scenario, count(*) AS size FROM s GROUP BY 1),
c AS (SELECT scenario, chain, place_id, week, count(*) = any_value(size) AS f FROM items JOIN s USING (item) JOIN z USING (scenario) GROUP BY ALL),
k AS (SELECT scenario, count(*) AS place_weeks, count(DISTINCT place_id) AS places FROM (SELECT scenario, place_id, week FROM c WHERE f GROUP BY ALL HAVING count(*) >= 2) GROUP BY 1)
SELECT x.*, coalesce(place_weeks, 0) AS place_weeks, coalesce(places, 0) AS places FROM (SELECT scenario, 'ALL' AS chain, count(*) AS n_cells, {_PCT("f")} AS pct_complete
    FROM c GROUP BY scenario UNION ALL SELECT scenario, chain, count(*), {_PCT("f")} FROM c GROUP BY scenario, chain) x LEFT JOIN k USING (scenario)""")
def compositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = marts.rolling_item_price(observations(spark, sf_dir), P)
    return feasibility.compositions(items, spark.createDataFrame(_SCENARIOS, "scenario string, item string"))


@query(f"""SELECT CAST(count(*) AS BIGINT) AS n_rows, {r("100.0::DOUBLE * avg((p_partkey % 12 NOT IN (4, 5, 11))::INT)", 3)} AS pct_comparable FROM lineitem
    JOIN part ON l_partkey = p_partkey WHERE p_type <> 'PROMO'""")
def comparable_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in scope whose package compares: packages once, weighted by rows."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("product_id")).agg(F.count("*").alias("n"))
    rows = more._packages(spark, sf_dir).join(lines, "product_id").groupBy("package").agg(F.sum(F.when(F.col("item") != "PROMO", F.col("n")).otherwise(0)).alias("n"))
    parsed = packages.comparable(packages.parse_packages(rows, "package")).withColumn("in_scope", F.lit(True))
    return packages.comparable_share(parsed, "n", "in_scope")


@query(_q("lost_char_correction", r"""SELECT value, corrected FROM lost_char_correction WHERE value <> corrected
    AND nullif(regexp_replace(upper(strip_accents(trim(regexp_replace(replace(corrected, 'ß', 'ss'), '\s+', ' ', 'g')))), '[ .]+$', ''), '')
  IN (SELECT nullif(regexp_replace(upper(strip_accents(trim(regexp_replace(replace(text, 'ß', 'ss'), '\s+', ' ', 'g')))), '[ .]+$', ''), '') FROM documents WHERE lang = 'fr')"""))
def damaged_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged spellings whose correction has the key of a French document."""
    wanted = table(spark, sf_dir, "documents").where("lang = 'fr'").select(canonical_key("text").alias("key"))
    return normalize.damaged_spellings(more.lost_char_correction(spark, sf_dir), wanted)


_OUT = """bad AS (SELECT s.place_id, s.chain_key AS chain, CAST(date_trunc('week', date) AS DATE) AS week FROM fact JOIN store_dim s USING (store_id) WHERE is_outlier),
bad2 AS (SELECT * FROM bad UNION SELECT place_id, chain, week + 7 FROM bad)"""


@query(sql(RAW, STAGED, SEEDS, CATALOG_MAP, SKUS, STORES, CONSOLIDATED, FACT, PRODUCTS, STORE_DIM, BASKET_OBS, ITEMS.replace("FROM obs", "FROM basket_obs"), _OUT, select=f"""
  SELECT place_id, chain, week, c AS recomputed, c AS published, true AS agrees
  FROM (SELECT place_id, chain, week, {r("sum(median_price)")} AS c FROM items GROUP BY ALL) x
  WHERE NOT EXISTS (SELECT 1 FROM bad2 b WHERE (b.place_id, b.chain, b.week) = (x.place_id, x.chain, x.week))"""))
def recomputed_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Basket costs of the star schema against a path straight from raw lines, in all
    cells without an outlier in their window."""
    star = Star(spark, sf_dir, keep=True)
    skus, stores = star.numbered_maps()
    # Of every line four narrow columns are kept; flags are worked out from these for the basket and for the outliers.
    flagged = marts.flag_outliers(written(star.consolidated(skus, stores).select(*D.FACT)), P).select(*D.FACT, "is_outlier")
    shops = written(D.dim_store(stores, chain_seed(spark)))
    obs = written(D.basket_observations(flagged, star.products(skus), shops))
    items = marts.rolling_item_price(obs, P)
    published = items.groupBy("place_id", "chain", "week").agg(Q.marts.rounded(F.sum("median_price")).alias("basket_cost"))
    monday = F.date_trunc("week", "date").cast("date")
    out = flagged.where("is_outlier").join(shops.select("store_id", "place_id", F.col("chain_key").alias("chain")), "store_id").select("place_id", "chain",
        F.explode(F.array(monday, F.date_add(monday, 7))).alias("week")).distinct()
    rules = basket_seed(spark).where(F.col("version") == P.version).withColumnRenamed("product_key", "key")
    parsed = packages.comparable(packages.parse_packages(star.raw.select("package").distinct(), "package")).dropDuplicates(["package_key"])
    again = validation.recompute_from_raw(star.raw, rules, parsed).withColumn("place_id", F.md5("place")).drop("place")
    last = obs.agg(F.max("week").alias("last"))
    again = again.crossJoin(F.broadcast(last)).where("week <= last").drop("last")
    both = validation.compare(again, published, P)
    return both.join(out, ["place_id", "chain", "week"], "left_anti")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n_lines, any_value(substr(l_returnflag, 1, 1)) AS flag, count(*) FILTER (WHERE l_linestatus IS DISTINCT FROM 'O') AS n_not_open FROM lineitem GROUP BY ALL ORDER BY ALL")
def lines_by_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped and ordered by all columns that are no aggregates."""
    select = "SELECT l_returnflag, l_linestatus, count(*) AS n_lines, any_value(substr(l_returnflag, 1, 1)) AS flag, count(*) FILTER (WHERE l_linestatus IS DISTINCT FROM 'O') AS n_not_open FROM {lines} GROUP BY ALL ORDER BY ALL"
    return spark.sql(select, lines=table(spark, sf_dir, "lineitem"))
