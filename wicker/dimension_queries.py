"""Queries of staging, key maps, consolidation and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.stats import small_side
from .functions.storage import written
from .operators import dimensions as D
from .operators import packages
from .plans import marts
from .plans.raw import RAW, STAGED, key_sql, raw_prices, source_files
from .queries import ITEMS, P, query, r, sql

#: The seeds of the bound tables: catalogs, basket items, reference chains, states.
CATALOGS = [("Básicos", 0, True), ("Frutas y legumbres", 3, True), ("Pacic", 4, True), ("Medicamentos", 1, False)]
BASKET = [("v1", "widgets", "SMALL WIDGET", "^BOLSA", None), ("v1", "plates", "RED PLATE", "^BOLSA", "^BOLSA [1-5] KG"), ("v1", "rings", "HOT RING", "KG$", None), ("v0",
    "rods", "OLD ROD", "^BOLSA", None)]
REFERENCE = ["CADENA 0", "CADENA 1", "CADENA 2", "CADENA 3"]
STATES = [("AFRICA", "AF"), ("AMERICA", "AM"), ("ASIA", "AS"), ("EUROPE", "EU")]


def catalog_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATALOGS, "catalog string, bit int, in_scope boolean")


def basket_seed(spark: SparkSession) -> DataFrame:
    rows = [(v, i, k, "kg", None, a, b, 1.0) for v, i, k, a, b in BASKET]
    return spark.createDataFrame(rows, "version string, item_id string, product_key string, unit string, subtype string, include string, exclude string, quantity double")


def chain_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c,) for c in REFERENCE], "chain_key string")


def iso_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATES, "state_key string, state_iso string")


def _values(rows: list[tuple]) -> str:
    text = lambda x: "NULL" if x is None else str(x) if not isinstance(x, str) else f"'{x}'"
    return ", ".join(f"({', '.join(map(text, row))})" for row in rows)


SEEDS = f"""seed AS (SELECT * FROM (VALUES {_values(CATALOGS)}) v(catalog, bit, in_scope)),
items_seed AS (SELECT * FROM (VALUES {_values(BASKET)}) v(version, item_id, product_key, include, exclude)),
chains_seed AS (SELECT * FROM (VALUES {_values([(c,) for c in REFERENCE])}) v(chain_key)),
iso AS (SELECT * FROM (VALUES {_values(STATES)}) v(state_key, state_iso))"""
CATALOG_MAP = f"""catalog_map AS (SELECT o.catalog, s.catalog AS seed_catalog, 1 << s.bit AS mask FROM (SELECT DISTINCT catalog FROM raw) o
    LEFT JOIN seed s ON {key_sql("o.catalog")} = {key_sql("s.catalog")})"""
SKUS = f"""sku_counts AS (SELECT product, package, brand, catalog, category, count(*) AS n FROM raw GROUP BY ALL),
sku_rows AS (SELECT product, package, brand, bit_or(mask) AS catalog_mask, CAST(sum(n) AS BIGINT) AS n_rows,
  coalesce(arg_max(category, (n, category)) FILTER (WHERE seed_catalog IS DISTINCT FROM 'Pacic'), arg_max(category, (n, category))) AS category
  FROM sku_counts LEFT JOIN catalog_map USING (catalog) GROUP BY product, package, brand),
sku_keys AS (SELECT *, {key_sql("product")} AS product_key, {key_sql("package")} AS package_key, coalesce({key_sql("brand")} IN ('S/M', 'SM', 'SIN MARCA', 'NO BRAND'),
    true) AS is_no_brand FROM sku_rows),
skus AS (SELECT *, md5(coalesce(product_key, '') || '|' || coalesce(package_key, '') || '|' || brand_key) AS product_id
  FROM (SELECT *, CASE WHEN is_no_brand THEN 'SIN MARCA' ELSE {key_sql("brand")} END AS brand_key FROM sku_keys))"""
#: Undated rows never win, as in ``latest_value``.
_LAST = "arg_max({0}, ({1}, {0})) FILTER (WHERE {0} IS NOT NULL AND {1} IS NOT NULL)"
_BOXED = "CASE WHEN latitude BETWEEN 14 AND 33 AND longitude BETWEEN -119 AND -86 THEN {} END"
STORES = f"""boxed AS (SELECT * REPLACE ({_BOXED.format("latitude")} AS latitude, {_BOXED.format("longitude")} AS longitude) FROM staged),
store_rows AS (SELECT store, address, state, municipality, {", ".join(f"{_LAST.format(c, 'date')} AS {c}" for c in ("chain", "format", "latitude", "longitude"))},
  min(date) AS first_date, max(date) AS last_date, count(*) AS n_rows FROM boxed GROUP BY store, address, state, municipality),
store_keys AS (SELECT *, coalesce({key_sql("state")}, '') AS state_key, coalesce({key_sql("municipality")}, '') AS municipality_key, coalesce({key_sql("chain")}, '') AS chain_key,
  coalesce({key_sql("store")}, '') || '|' || coalesce({key_sql("address")}, '') AS store_key FROM store_rows),
stores AS (SELECT *, md5(store_key || '|' || state_key || '|' || municipality_key) AS store_id, md5(state_key || '|' || municipality_key) AS place_id FROM store_keys)"""
CONSOLIDATED = """grouped AS (SELECT product_id, store_id, date, price, min(price_text) AS price_text, min((product, package, brand)) AS o, bit_or(mask) AS catalog_mask,
    count(*) AS n_source_rows, min(source_file) AS source_file
  FROM staged LEFT JOIN catalog_map USING (catalog) JOIN (SELECT product, package, brand, product_id FROM skus) USING (product, package, brand)
       JOIN (SELECT store, address, state, municipality, store_id FROM stores) USING (store, address, state, municipality)
  WHERE price IS NOT NULL AND date IS NOT NULL GROUP BY product_id, store_id, date, price),
consolidated AS (SELECT product_id, store_id, date, price, price_text, o[1] AS product, o[2] AS package, o[3] AS brand, catalog_mask, n_source_rows,
  count(*) OVER (PARTITION BY product_id, store_id, date) > 1 AS has_conflict, source_file FROM grouped)"""
PRODUCTS = f"""by_product AS (SELECT product_id, arg_max(product, (n_rows, product)) AS product, any_value(product_key) AS product_key, arg_max(package, (n_rows,
    package)) AS package, any_value(package_key) AS package_key,
  arg_max(brand, (n_rows, brand)) AS brand, any_value(brand_key) AS brand_key, bool_or(is_no_brand) AS is_no_brand, arg_max(category, (n_rows, category)) AS category,
      bit_or(catalog_mask) AS catalog_mask,
  count(*) AS n_variants, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM skus GROUP BY product_id),
products AS (SELECT p.*, 'kg' AS base_unit, CAST(regexp_extract(package_key, '[0-9]+') AS DOUBLE) AS content, NULL::VARCHAR AS count_subtype, 'quantity' AS rule,
    'high' AS confidence, false AS needs_review, true AS is_comparable,
  (SELECT string_agg(s.catalog, ' + ' ORDER BY s.bit) FROM seed s WHERE (p.catalog_mask >> s.bit) & 1 = 1) AS catalogs,
  (SELECT min(item_id) FROM items_seed i WHERE i.version = 'v1' AND i.product_key = p.product_key AND regexp_matches(p.package_key, i.include)
      AND (i.exclude IS NULL OR NOT regexp_matches(p.package_key, i.exclude))) AS item_id
  FROM by_product p)"""
STORE_DIM = f"""store_dim AS (SELECT a.*, latitude IS NOT NULL AND longitude IS NOT NULL AS has_coordinates, chain_key IN (SELECT chain_key FROM chains_seed) AS is_reference_chain FROM (
  SELECT store_id, any_value(store_key) AS store_key, any_value(place_id) AS place_id, {", ".join(f"{_LAST.format(c, 'last_date')} AS {c}" for c in ("store", "address",
      "chain", "chain_key", "format", "latitude", "longitude"))},
         min(first_date) AS first_date, max(last_date) AS last_date, count(*) AS n_variants, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM stores GROUP BY store_id) a)"""
FACT = """logs AS (SELECT product_id, CAST(price AS DOUBLE) AS x FROM consolidated WHERE price > 0),
centre AS (SELECT product_id, count(*) AS n, median(x) AS m, median(ln(x)) AS lm FROM logs GROUP BY 1),
spread AS (SELECT product_id, median(abs(ln(x) - lm)) AS mad FROM logs JOIN centre USING (product_id) GROUP BY 1),
fact AS (SELECT c.*, CASE WHEN price <= 0 THEN false ELSE coalesce(price > 10 * m OR price < m / 10 OR (n >= 30 AND mad > 0 AND abs(ln(price) - lm) > 5 * 1.4826 * mad
    AND abs(ln(price) - lm) > ln(3)), false) END AS is_outlier
  FROM consolidated c LEFT JOIN centre USING (product_id) LEFT JOIN spread USING (product_id))"""
BASKET_OBS = f"""basket_obs AS (SELECT f.product_id, f.store_id, f.date, CAST(date_trunc('week', f.date) AS DATE) AS week, p.item_id AS item, s.chain_key AS chain,
    s.place_id, CAST(f.price AS DOUBLE) AS price,
  {r("CAST(f.price AS DOUBLE) / p.content", 4)} AS unit_price
  FROM fact f JOIN products p USING (product_id) JOIN store_dim s USING (store_id) WHERE NOT f.is_outlier AND p.item_id IS NOT NULL AND p.is_comparable)"""
_MAPS = (RAW, STAGED, SEEDS, CATALOG_MAP)


class Star:
    """The tables of the star schema over the bound tables.  ``keep``: the raw lines and
    the ledger of their files are written once, for queries that read them often."""

    def __init__(self, spark: SparkSession, sf_dir: str, keep: bool = False):
        self.spark = spark
        raw = raw_prices(spark, sf_dir)
        self.raw = written(raw, "zstd") if keep else raw
        self.files = written(source_files(self.raw)) if keep else source_files(self.raw)
        self.staged = D.stage_prices(self.raw, small_side(self.files) if keep else self.files)

    def skus(self) -> DataFrame:
        return D.sku_map(self.staged, catalog_seed(self.spark))

    def stores(self) -> DataFrame:
        return D.store_map(self.staged)

    def consolidated(self, skus: DataFrame, stores: DataFrame) -> DataFrame:
        return D.consolidate_observations(self.staged, skus, stores, catalog_seed(self.spark))

    def products(self, skus: DataFrame) -> DataFrame:
        read = packages.comparable(packages.parse_packages(skus.select("package_key").distinct().withColumn("text__", F.col("package_key")).select("text__"), "text__"))
        rules = basket_seed(self.spark).where(F.col("version") == P.version).withColumnRenamed("product_key", "key")
        return D.dim_product(skus, read, catalog_seed(self.spark), rules)

    def numbered_maps(self) -> tuple[DataFrame, DataFrame]:
        """skus and stores, written, with numbers as product_id and store_id: among keys that go with every line, the
        digests of 32 characters would take most of the room."""
        return tuple(D.numbered_ids(written(df), c) for df, c in ((self.skus(), "product_id"), (self.stores(), "store_id")))

    def basket_observations(self) -> DataFrame:
        """Only lines of products of the basket are consolidated: outliers are told inside each product, and the others are no observation of the basket."""
        skus, stores = written(self.skus()), written(self.stores())
        products = written(self.products(skus))
        own = skus.join(D.in_basket(products).select("product_id"), "product_id", "left_semi")
        fact = written(self.consolidated(own, stores).select(*D.FACT))
        return D.basket_observations(marts.flag_outliers(fact, P), products, D.dim_store(stores, chain_seed(self.spark)))


@query(sql(RAW, STAGED, select="SELECT product, package, brand, catalog, price_text, CAST(price AS DOUBLE) AS price, date, latitude, longitude, store, source_file FROM staged"))
def staged_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Star(spark, sf_dir).staged.select("product", "package", "brand", "catalog", "price_text", F.col("price").cast("double").alias("price"), "date", "latitude",
        "longitude", "store", "source_file")


@query(sql(*_MAPS, select="SELECT catalog AS original, seed_catalog AS catalog, coalesce(mask, 0) AS mask FROM catalog_map"))
def catalog_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = raw_prices(spark, sf_dir).select(F.col("catalog").alias("value")).distinct()
    return D.map_catalogs(values, catalog_seed(spark)).select("original", "catalog", F.coalesce("mask", F.lit(0)).alias("mask"))


@query(sql(*_MAPS, SKUS, select="SELECT product, package, brand, product_key, package_key, brand_key, is_no_brand, product_id, coalesce(catalog_mask, 0) AS catalog_mask, category, n_rows FROM skus"))
def sku_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Star(spark, sf_dir).skus().select("product", "package", "brand", "product_key", "package_key", "brand_key", "is_no_brand", "product_id",
        F.coalesce("catalog_mask", F.lit(0)).alias("catalog_mask"), "category", "n_rows")


@query(sql(*_MAPS, STORES, select="SELECT store, address, state, municipality, chain, format, latitude, longitude, first_date, last_date, n_rows, state_key, municipality_key, chain_key, store_key, store_id, place_id FROM stores"))
def store_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Star(spark, sf_dir).stores().select("store", "address", "state", "municipality", "chain", "format", "latitude", "longitude", "first_date", "last_date",
        "n_rows", "state_key", "municipality_key", "chain_key", "store_key", "store_id", "place_id")


@query(sql(*_MAPS, SKUS, STORES, CONSOLIDATED, select="SELECT * REPLACE (CAST(price AS DOUBLE) AS price, coalesce(catalog_mask, 0) AS catalog_mask) FROM consolidated"))
def observations_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = Star(spark, sf_dir, keep=True)
    return star.consolidated(star.skus(), star.stores()).withColumns({"price": F.col("price").cast("double"), "catalog_mask": F.coalesce("catalog_mask", F.lit(0))})


@query(sql(*_MAPS, SKUS, PRODUCTS, select="SELECT * REPLACE (coalesce(catalog_mask, 0) AS catalog_mask) FROM products"))
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = Star(spark, sf_dir)
    return star.products(written(star.skus())).withColumn("catalog_mask", F.coalesce("catalog_mask", F.lit(0)))


@query(sql(*_MAPS, STORES, STORE_DIM, select="SELECT * FROM store_dim"))
def dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.dim_store(Star(spark, sf_dir).stores(), chain_seed(spark))


@query(sql(*_MAPS, STORES, f"""places AS (SELECT place_id, any_value(state_key) AS state_key, any_value(municipality_key) AS municipality_key,
    {_LAST.format("municipality", "last_date")} AS municipality,
  count(DISTINCT store_id) AS n_stores, min(first_date) AS first_date, max(last_date) AS last_date FROM stores GROUP BY place_id),
states AS (SELECT state_key, {_LAST.format("state", "last_date")} AS state FROM stores GROUP BY state_key)""",
    select="SELECT * FROM places JOIN states USING (state_key) LEFT JOIN iso USING (state_key)"))
def dim_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.dim_place(written(Star(spark, sf_dir).stores()), iso_seed(spark))


@query(sql(*_MAPS, SKUS, STORES, CONSOLIDATED, FACT, PRODUCTS, STORE_DIM, BASKET_OBS, select="SELECT * FROM basket_obs"))
def basket_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Star(spark, sf_dir, keep=True).basket_observations()


@query(sql(*_MAPS, SKUS, STORES, CONSOLIDATED, FACT, PRODUCTS, STORE_DIM, BASKET_OBS, ITEMS.replace("FROM obs", "FROM basket_obs"), select="SELECT * FROM items"))
def rolling_basket_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rolling price over comparable basket observations that aren't outliers."""
    return marts.rolling_item_price(written(basket_observations(spark, sf_dir)), P)


@query(sql(SEEDS, "counted AS (SELECT product_key, count(*) AS n_parts FROM (SELECT upper(p_name) AS product_key FROM part) GROUP BY 1)",
    select="SELECT version, item_id, product_key, version = 'v1' AS is_current, coalesce(n_parts, 0) AS n_parts FROM items_seed LEFT JOIN counted USING (product_key)"))
def dim_basket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versioned basket items, with the parts that bear their name."""
    from .plans.bindings import table

    parts = table(spark, sf_dir, "part").groupBy(F.upper("p_name").alias("product_key")).agg(F.count("*").alias("n_parts"))
    rows = D.dim_basket(basket_seed(spark), P).join(parts, "product_key", "left")
    return rows.select("version", "item_id", "product_key", "is_current", F.coalesce("n_parts", F.lit(0)).alias("n_parts"))


@query(sql(SEEDS, select="SELECT (SELECT max(version) FROM items_seed WHERE version = 'v1') AS version, p_type AS item, count(*) AS n_parts FROM part GROUP BY p_type"))
def single_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of each item under the one current version of the basket."""
    from .plans.bindings import table

    version = D.current_version(D.dim_basket(basket_seed(spark), P))
    return table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("item")).agg(F.count("*").alias("n_parts")).withColumn("version", F.lit(version))
