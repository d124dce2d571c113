"""Queries of rules, data tests and profiles over raw lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .dimension_queries import CATALOG_MAP, SEEDS, SKUS, Star
from .functions import text as T
from .functions.storage import written
from .more_queries import _by_form, _packages
from .operators import dimensions as D
from .operators import packages, profile, quality
from .plans import bi, marts
from .plans.bindings import OBS, observations, table
from .plans.raw import RAW, STAGED, TEXTS, raw_prices, source_files
from .queries import AVAILABLE, BASKET, FLAGGED, ITEMS, PRICES, SAVINGS, P, _basket, _baskets, _DEARER, _prices, query, r, sql

RUN_DATE = "2026-01-01"
ESSENTIAL = ["product", "package", "brand", "price_text", "day", "chain", "store", "state", "municipality"]
_TEXT = TEXTS
_SAME = ["product", "package", "brand", "category", "catalog", "price_text", "day", "chain", "format", "store", "address", "state", "municipality", "latitude", "longitude"]
_RULE = "SELECT '{0}' AS id, '{1}' AS severity, '{2}' AS comparator, {3}::DOUBLE AS threshold, ({4})::DOUBLE AS value"
_JUDGED = "SELECT *, coalesce(CASE comparator WHEN '<=' THEN value <= threshold WHEN '>=' THEN value >= threshold ELSE value = threshold END, true) AS passed FROM ("
_FILES = "files AS (SELECT source_file AS file, any_value(date_format) AS date_format, count(*) AS n_rows FROM raw GROUP BY 1)"


def _judged(rules: list[tuple]) -> str:
    return _JUDGED + " UNION ALL ".join(_RULE.format(*x) for x in rules) + ")"


def _pct(flag: str, table_: str) -> str:
    return f"SELECT {r(f'100.0::DOUBLE * avg(coalesce({flag}, false)::INT)', 6)} FROM {table_}"


_EMPTY = " OR ".join(f"coalesce(trim({c}), '') = ''" for c in ESSENTIAL)
_EXPECTED = """expected AS (SELECT strftime(m, '%m-%Y') || q AS file FROM (SELECT CAST(unnest(generate_series(date_trunc('month', min(date)), date_trunc('month',
    max(date)), INTERVAL 1 MONTH)) AS DATE) AS m FROM staged), unnest(['_Q1.csv', '_Q2.csv']) AS u(q))"""
_RAW_RULES = [
    ("R-01", "error", "==", 0, "SELECT count(*) FROM expected WHERE file NOT IN (SELECT file FROM files)"),
    ("R-02", "error", "<=", 0.1, _pct(f"({_EMPTY})", "staged")),
    ("R-03", "error", "<=", 0.01, _pct("price IS NULL", "staged")),
    ("R-04", "error", "==", 0, "SELECT count(*) FROM staged WHERE price <= 0"),
    ("R-05", "error", "<=", 0, _pct("date IS NULL", "staged")),
    ("R-06", "error", "==", 0, f"SELECT count(*) FROM staged WHERE date < DATE '2015-01-01' OR date > DATE '{RUN_DATE}'"),
    ("R-07", "warning", "<=", 0.1, _pct("strftime(date, '%m-%Y') <> regexp_extract(source_file, '(\\d{2}-\\d{4})', 1)", "staged")),
    ("R-08", "warning", "<=", 1, _pct("NOT coalesce(latitude BETWEEN 14 AND 33 AND longitude BETWEEN -119 AND -86, false)", "staged")),
    ("R-09", "warning", "<=", 0.1, f"SELECT {r('100.0::DOUBLE * sum(n - 1) / sum(n)', 6)} FROM (SELECT count(*) AS n FROM raw GROUP BY source_file, {', '.join(_TEXT)})"),
    ("R-10", "warning", ">=", 0.5, f"SELECT {r('min(n_rows) / median(n_rows)', 6)} FROM files"),
]


@query(sql(RAW, STAGED, _FILES, _EXPECTED, select=_judged(_RAW_RULES)))
def rules_raw_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R-01 to R-10 over raw lines and their files."""
    star = Star(spark, sf_dir)
    staged = written(star.staged)
    ends = staged.agg(F.trunc(F.min("date"), "month").alias("a"), F.trunc(F.max("date"), "month").alias("b"))
    months = ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("m"))
    expected = months.select(F.explode(F.array(*[F.concat(F.date_format("m", "MM-yyyy"), F.lit(q)) for q in ("_Q1.csv", "_Q2.csv")])).alias("file"))
    box = T.in_box(F.col("latitude"), F.col("longitude"), *D.BOX)
    return quality.all_raw_rules(staged, source_files(staged), expected, _SAME, ESSENTIAL, box, RUN_DATE)


_MART_RULES = [
    ("M-01", "warning", "<=", 1, _pct("rule > 0", "flagged")),
    ("M-02", "error", "<=", 5, _pct("rule > 0", "flagged")),
    ("M-03", "warning", "<=", 5, f"SELECT {r('100.0::DOUBLE * avg((content IS NULL OR content <= 7)::INT)', 6)} FROM flagged WHERE flag <> 'R'"),
    ("M-08", "warning", "<=", 35, f"SELECT DATE '{RUN_DATE}' - max(date) FROM obs"),
    ("M-04", "warning", ">=", 50, _pct("is_complete", "baskets WHERE window_complete")),
    ("M-05", "warning", "==", 0, "SELECT count(*) FROM basket WHERE item NOT IN (SELECT item FROM items WHERE week = (SELECT max(week) FROM items))"),
    ("M-06", "error", "==", 0, "SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM obs WHERE price IS NOT NULL)"),
    ("M-07", "warning", ">=", 70, _pct("complete >= 2", "(SELECT count(*) AS chains, sum(is_complete::INT) AS complete FROM baskets WHERE window_complete GROUP BY place_id, week) WHERE chains >= 2")),
]


@query(sql(OBS, ITEMS, BASKET, FLAGGED, select=_judged(_MART_RULES)))
def rules_marts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-01 to M-08; contents up to 7 count as not comparable here, so that M-03 has some."""
    obs = observations(spark, sf_dir)
    items = marts.rolling_item_price(obs, P)
    flagged = marts.flag_outliers(obs, P).withColumn("content", F.when(F.col("content") > 7, F.col("content")))
    kept = obs.where(F.col("price").isNotNull()).groupBy("product_id", "store_id", "date", "price").agg(F.count("*").alias("k")).agg(F.sum("k").alias("n"))
    raw = table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n"))
    return quality.all_mart_rules(flagged, items, _basket(spark, sf_dir), written(_baskets(spark, sf_dir, items)), raw, kept, RUN_DATE, F.col("flag") != "R")


@query(f"""WITH p AS (SELECT p_type AS item, p_partkey % 12 AS k, CASE p_partkey % 12 {_by_form(1)} END AS u, CASE p_partkey % 12 {_by_form(2)} END AS c,
  CASE p_partkey % 12 WHEN 2 THEN 'PIEZA' WHEN 3 THEN 'ROLLO' WHEN 6 THEN 'PIEZA' WHEN 9 THEN 'PIEZA' WHEN 10 THEN 'PIEZA' END AS s, p_partkey % 12 NOT IN (4, 5, 11) AS ok FROM part)
SELECT item, count(DISTINCT (u, c, s, ok)) AS n_readings FROM p GROUP BY item HAVING count(DISTINCT (u, c, s, ok)) > 1""")
def several_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items whose packages read in several ways (of a package key there are none)."""
    parsed = packages.comparable(packages.parse_packages(_packages(spark, sf_dir), "package"))
    return quality.several_readings(parsed, "item")


@query(sql(RAW, STAGED, SEEDS, CATALOG_MAP, SKUS, select="SELECT (SELECT count(*) FROM skus) AS n_raw, (SELECT count(*) FROM skus WHERE product = upper(product)) AS n_mapped"))
def unmapped_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All original combinations against a map that lacks the lower-case ones."""
    star = Star(spark, sf_dir)
    return quality.unmapped_combinations(star.staged, star.skus().where(F.col("product") == F.upper("product")), D.SKU)


@query(sql(OBS, ITEMS, BASKET, SAVINGS, PRICES, AVAILABLE, select=f"""
  SELECT 'differences' AS "check", 1::BIGINT AS n, (abs(a - b) > greatest(0.0001 * abs(b), 1))::BIGINT AS n_wrong FROM (
    SELECT coalesce(sum(vs_cheapest_basket) FILTER (WHERE {_DEARER}), 0) AS a, (SELECT coalesce(sum(saving), 0) FROM savings) AS b FROM prices p
        LEFT JOIN (SELECT place_id, week, chain, is_cheapest FROM savings) s USING (place_id, week, chain))
  UNION ALL SELECT 'availability', count(*), count(*) FILTER (WHERE there <> items_available) FROM (SELECT chain, place_id, week,
      count(*) FILTER (WHERE available) AS there FROM available GROUP BY ALL) JOIN baskets USING (chain, place_id, week)"""))
def bi_against_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, savings, prices = _prices(spark, sf_dir)
    baskets = written(_baskets(spark, sf_dir, items))
    return quality.bi_against_marts(bi.weekly_item_differences(prices, savings), savings, bi.item_availability(baskets, items, _basket(spark, sf_dir)), baskets)


@query("""SELECT 'unique order lines' AS test, count(*) AS n_failures FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'unique part and store', count(*) FROM (SELECT l_partkey, l_suppkey FROM lineitem GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'quantity under 45', count(*) FROM lineitem WHERE NOT (l_quantity < 45)
UNION ALL SELECT 'known flags', count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')
UNION ALL SELECT 'orders exist', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
UNION ALL SELECT 'texts are there', count(*) FROM documents WHERE text IS NULL
UNION ALL SELECT 'missing languages', count(*) FROM documents WHERE lang IS NULL""")
def data_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generic tests; some hold and some don't."""
    line, docs = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "documents")
    return quality.data_tests(
        {
            "unique order lines": quality.unique_combination(line, ["l_orderkey", "l_linenumber"]),
            "unique part and store": quality.unique_combination(line, ["l_partkey", "l_suppkey"]),
            "quantity under 45": quality.expression_is_true(line, "l_quantity < 45"),
            "known flags": quality.accepted_values(line, "l_returnflag", ["A", "N"]),
            "orders exist": quality.relationships(line, "l_orderkey", table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'"), "o_orderkey"),
            "texts are there": quality.not_null(docs, "text"),
            "missing languages": quality.not_null(docs, "lang"),
        }
    )


# --- profiles -------------------------------------------------------------------

_UP = "upper(strip_accents(trim({})))"
PROFILED = f"""profiled AS (SELECT *, CAST(date_trunc('week', date) AS DATE) AS week FROM (
  SELECT source_file AS file, product, package, brand, catalog, TRY_CAST(price AS DOUBLE) AS price, CAST(coalesce(try_strptime(day, '%Y/%m/%d'), try_strptime(day, '%d/%m/%Y')) AS DATE) AS date,
    CASE WHEN try_strptime(day, '%Y/%m/%d') IS NOT NULL THEN 'yyyy/mm/dd' WHEN try_strptime(day, '%d/%m/%Y') IS NOT NULL THEN 'dd/mm/yyyy' ELSE 'none' END AS date_format, chain, format,
    md5(concat_ws('|', {", ".join(_UP.format(c) for c in ("store", "address", "state", "municipality"))})) AS store, {_UP.format("state")} AS state,
        {_UP.format("municipality")} AS municipality FROM raw))"""


def _profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.observation_table(raw_prices(spark, sf_dir))


@query(sql(RAW, PROFILED, select="SELECT * FROM profiled"))
def profile_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiled(spark, sf_dir)


_BY_FILE = """formats AS (SELECT file, min(date_format) FILTER (WHERE date IS NOT NULL) AS date_format,
    count(DISTINCT date_format) FILTER (WHERE date IS NOT NULL) AS n_formats, min(date) AS first_date, max(date) AS last_date, count(DISTINCT date) AS n_days,
        count(*) FILTER (WHERE date IS NULL) AS n_unparsed FROM profiled GROUP BY file)"""


@query(sql(RAW, PROFILED, _BY_FILE, select="SELECT * FROM formats"))
def profile_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.formats_by_file(_profiled(spark, sf_dir))


@query(sql(RAW, PROFILED, select="SELECT price, product, package, brand, catalog, chain, file FROM profiled WHERE price IS NOT NULL ORDER BY price DESC, product, package, brand, catalog, chain, file LIMIT 10"))
def profile_highest_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.highest(_profiled(spark, sf_dir), "price", ["product", "package", "brand", "catalog", "chain", "file"])


@query(sql(RAW, select="""SELECT count(*) FILTER (WHERE TRY_CAST(latitude AS DOUBLE) IS NULL OR TRY_CAST(longitude AS DOUBLE) IS NULL) AS n_without,
  count(*) FILTER (WHERE TRY_CAST(latitude AS DOUBLE) NOT BETWEEN 14 AND 33) AS n_latitude_outside, count(*) FILTER (WHERE TRY_CAST(longitude AS DOUBLE) NOT BETWEEN -119
      AND -86) AS n_longitude_outside FROM raw"""))
def profile_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.coordinate_summary(raw_prices(spark, sf_dir), D.BOX)


@query(sql(RAW, PROFILED, select="SELECT catalog, coalesce(year(date), 0) AS year, count(*) AS n_rows, count(DISTINCT product) AS n_products FROM profiled GROUP BY ALL"))
def profile_catalogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.catalog_by_year(_profiled(spark, sf_dir)).withColumn("year", F.coalesce("year", F.lit(0)))


@query(sql(RAW, PROFILED, select="SELECT format, count(*) AS n_rows, count(DISTINCT chain) AS n_chains, count(DISTINCT file) AS n_files FROM profiled GROUP BY format"))
def profile_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.store_formats(_profiled(spark, sf_dir))


_STATES = f"states AS (SELECT {_UP.format('state')} AS normalised, state AS original, count(*) AS n_rows, min(source_file) AS first_file, max(source_file) AS last_file FROM raw GROUP BY ALL)"


@query(sql(RAW, _STATES, select="SELECT * FROM states"))
def profile_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.spellings(raw_prices(spark, sf_dir), "state", "source_file")


@query(sql(RAW, PROFILED, select="SELECT brand, coalesce(year(date), 0) AS year, count(*) AS n_rows FROM profiled WHERE upper(brand) = 'S/M' GROUP BY ALL"))
def profile_no_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.no_brand_by_year(_profiled(spark, sf_dir)).withColumn("year", F.coalesce("year", F.lit(0)))


@query(sql(RAW, PROFILED, select="SELECT state, count(DISTINCT municipality) AS n_municipalities, count(DISTINCT week) AS n_weeks, count(DISTINCT store) AS n_stores, count(*) AS n_rows FROM profiled GROUP BY state"))
def profile_coverage_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.coverage_by_state(_profiled(spark, sf_dir))


@query(sql(RAW, PROFILED, select="""SELECT chain, count(DISTINCT state) AS n_states, count(DISTINCT (state, municipality)) AS n_municipalities,
    count(DISTINCT store) AS n_stores, count(DISTINCT week) AS n_weeks, count(DISTINCT product) AS n_products, count(*) AS n_rows
  FROM profiled WHERE catalog = 'Basicos' GROUP BY chain HAVING count(*) > 200"""))
def profile_coverage_by_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.coverage_by_chain(_profiled(spark, sf_dir), "Basicos", 200)


@query(sql(RAW, PROFILED, """v AS (SELECT store, CASE WHEN day(date) <= 15 THEN date_trunc('month', date)::DATE ELSE date_trunc('month', date)::DATE + 15 END AS f,
    count(DISTINCT date) AS n_days FROM profiled GROUP BY ALL)""", select="SELECT n_days, count(*) AS n_store_fortnights FROM v GROUP BY n_days"))
def profile_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.visit_days(_profiled(spark, sf_dir))


_GRAIN = ", ".join(profile.GRAIN)
_NAMED = ["product", "package", "brand", "category", "catalog", "chain", "format", "store", "address", "state", "municipality"]
_REPEATED = f"""h AS (SELECT source_file, {_GRAIN}, count(*) AS n, count(DISTINCT price) AS prices, count(DISTINCT catalog) AS catalogs FROM raw GROUP BY source_file, {_GRAIN}),
e AS (SELECT source_file, sum(n - 1) AS equal FROM (SELECT source_file, count(*) AS n FROM raw GROUP BY source_file, {", ".join(TEXTS)}) GROUP BY 1),
repeated AS (SELECT h.source_file AS file, CAST(sum(n) AS BIGINT) AS n_rows, CAST(any_value(e.equal) AS BIGINT) AS n_equal, CAST(sum(n - 1) AS BIGINT) AS n_same_grain,
    count(*) FILTER (WHERE n > 1 AND catalogs > 1) AS n_in_catalogs,
  count(*) FILTER (WHERE n > 1 AND prices > 1 AND catalogs = 1) AS n_conflicts, 0::BIGINT AS n_lost FROM h JOIN e ON h.source_file = e.source_file GROUP BY h.source_file)"""


def _doubled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines, those of the flag's second half of a day said again."""
    raw = raw_prices(spark, sf_dir)
    line = lambda catalog=F.col("catalog"), price=F.col("price"): F.struct(catalog.alias("catalog"), price.alias("price"))
    ends = lambda x: F.col("price").endswith(x)
    more = F.when(ends("5"), line()).when(ends("7"), line(catalog=F.lit("Otro"))).when(ends("9"), line(price=F.concat(F.lit("1"), "price")))
    said = F.when(more.isNull(), F.array(line())).otherwise(F.array(line(), more))  # one pass over the lines
    others = [c for c in raw.columns if c not in ("catalog", "price")]
    return raw.select(*others, F.inline(said)).select(*raw.columns)


_DOUBLED = RAW.replace("raw AS (",
    "raw0 AS (") + ", raw AS (SELECT * FROM raw0 UNION ALL SELECT * FROM raw0 WHERE price LIKE '%5' UNION ALL SELECT * REPLACE ('Otro' AS catalog) FROM raw0 WHERE price LIKE '%7' UNION ALL SELECT * REPLACE ('1' || price AS price) FROM raw0 WHERE price LIKE '%9')"


@query(sql(_DOUBLED, _REPEATED, select="SELECT * FROM repeated"))
def profile_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.duplicates_by_file(_doubled(spark, sf_dir), TEXTS, _NAMED)


@query(sql(_DOUBLED, f"s AS (SELECT source_file, {_GRAIN}, string_agg(DISTINCT catalog, ' + ' ORDER BY catalog) AS combination, count(DISTINCT catalog) AS n FROM raw GROUP BY source_file, {_GRAIN})", select="SELECT combination, count(*) AS n_groups FROM s WHERE n > 1 GROUP BY combination"))
def profile_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.catalog_combinations(_doubled(spark, sf_dir))


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of the raw lines as an inventory has them."""
    files = source_files(raw_prices(spark, sf_dir))
    first = F.col("file") < "06"
    return files.withColumns({"encoding": F.when(first, "UTF-8").otherwise("windows-1252"), "bom": first, "n_lines": F.col("n_rows") + F.when(F.col("file").endswith("1999_Q1.csv"), 1).otherwise(0)})


_LEDGER = _FILES + ", ledger AS (SELECT *, CASE WHEN file < '06' THEN 'UTF-8' ELSE 'windows-1252' END AS encoding, file < '06' AS bom, n_rows + CASE WHEN file LIKE '%1999\\_Q1.csv' ESCAPE '\\' THEN 1 ELSE 0 END AS n_lines FROM files)"


@query(sql(RAW, _LEDGER, select="SELECT encoding, bom, date_format, count(*) AS n_files, CAST(sum(n_rows) AS BIGINT) AS n_rows, min(file) AS first_file, max(file) AS last_file FROM ledger GROUP BY ALL"))
def profile_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.inventory_summary(_ledger(spark, sf_dir))


@query(sql(_DOUBLED, PROFILED, _BY_FILE, _STATES, _REPEATED, _LEDGER, select="""SELECT finding, n FROM (
  SELECT 'several encodings' AS finding, CASE WHEN count(DISTINCT encoding) > 1 THEN count(DISTINCT encoding) ELSE 0 END AS n FROM ledger
  UNION ALL SELECT 'several date formats', CASE WHEN count(DISTINCT date_format) > 1 THEN count(DISTINCT date_format) ELSE 0 END FROM formats
  UNION ALL SELECT 'unparsed dates', CAST(sum(n_unparsed) AS BIGINT) FROM formats
  UNION ALL SELECT 'rejected rows', count(*) FROM raw WHERE price = 'n/d'
  UNION ALL SELECT 'rows unlike lines', count(*) FROM ledger WHERE n_rows <> n_lines
  UNION ALL SELECT 'overlapping files', count(*) FROM (SELECT last_date, lead(first_date) OVER (ORDER BY first_date, file) AS next FROM formats) WHERE next <= last_date
  UNION ALL SELECT 'extreme price', (max(price) > 100 * quantile_cont(price, 0.99))::BIGINT FROM profiled
  UNION ALL SELECT 'equal rows', CAST(sum(n_equal) AS BIGINT) FROM repeated
  UNION ALL SELECT 'lost characters', CAST(sum(n_lost) AS BIGINT) FROM repeated
  UNION ALL SELECT 'spelling variants', count(*) FROM (SELECT normalised FROM states GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'no-brand spellings', CASE WHEN count(DISTINCT brand) > 1 THEN count(DISTINCT brand) ELSE 0 END FROM profiled WHERE upper(brand) = 'S/M') WHERE n > 0"""))
def profile_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = written(_doubled(spark, sf_dir))
    obs = profile.observation_table(raw)
    files = source_files(raw).withColumns({"encoding": F.when(F.col("file") < "06", "UTF-8").otherwise("windows-1252"),
        "n_lines": F.col("n_rows") + F.when(F.col("file").endswith("1999_Q1.csv"), 1).otherwise(0)})
    return profile.all_findings(
        files, profile.formats_by_file(obs), raw.where("price = 'n/d'"), profile.number_summary(obs, "price"), profile.duplicates_by_file(raw, TEXTS, _NAMED),
            profile.spellings(raw, "state", "source_file"), profile.no_brand_by_year(obs)
    )
