"""Queries of the normalisation, quality, profile and validation operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .functions.storage import written

from .operators import feasibility, normalize, packages, profile, quality, validation
from .plans import marts
from .plans.bindings import OBS, observations, table
from .queries import BASKET, FLAGGED, ITEMS, PRICES, SAVINGS, P, _basket, _baskets, _prices, query, r, sql


@query("""SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS price, CAST(o_orderdate AS DATE) AS date, o_orderkey % 2 = 0 AS by_slash
FROM orders""")
def stage_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices and dates written as text in two formats and read back tolerantly."""
    d = F.col("o_orderdate")
    slash = F.col("o_orderkey") % 2 == 0
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("string").alias("price"), F.when(slash, F.date_format(d, "yyyy/MM/dd")).otherwise(F.date_format(d, "dd/MM/yyyy")).alias("day"),
        F.when(slash, "yyyy/mm/dd").otherwise("dd/mm/yyyy").alias("format"),
    )
    return raw.select("o_orderkey", F.col("price").try_cast("decimal(12,2)").cast("double").alias("price"), T.parse_date_by_format(F.col("day"),
        F.col("format")).alias("date"), (F.col("format") == "yyyy/mm/dd").alias("by_slash"))


@query(r"""SELECT doc_id, nullif(regexp_replace(upper(strip_accents(trim(regexp_replace(replace(text, 'ß', 'ss'), '\s+', ' ', 'g')))), '[ .]+$', ''), '') AS key FROM documents""")
def canonical_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of whole documents."""
    return table(spark, sf_dir, "documents").select("doc_id", T.canonical_key("text").alias("key"))


@query(r"""SELECT doc_id, nullif(regexp_replace(upper(strip_accents(trim(regexp_replace(replace(text, 'ß', 'ss'), '\s+', ' ', 'g')))), '[ .]+$', ''), '') AS key FROM documents""")
def canonical_key_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as canonical_key, under the name it had when that one cut its texts."""
    return canonical_key(spark, sf_dir)


@query("""WITH m AS (SELECT l_partkey, bit_or(1 << CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END) AS mask FROM lineitem GROUP BY 1)
SELECT l_partkey AS product_id, mask, concat_ws(' + ', CASE WHEN mask & 1 > 0 THEN 'ALPHA' END, CASE WHEN mask & 2 > 0 THEN 'NORMAL' END, CASE
    WHEN mask & 4 > 0 THEN 'RETURN' END) AS catalogs FROM m""")
def catalog_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    seed = spark.createDataFrame([("ALPHA", 0, "A"), ("NORMAL", 1, "N"), ("RETURN", 2, "R")], "catalog string, bit int, l_returnflag string")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("product_id"), "l_returnflag").join(F.broadcast(seed), "l_returnflag")
    masks = rows.groupBy("product_id").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("bit"))).alias("mask"))
    return normalize.expand_mask(masks, "mask", seed, ["product_id"]).join(masks, "product_id").select("product_id", "mask", "catalogs")


@query("""SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(props, (ts, event_id)) FILTER (WHERE props IS NOT NULL) AS props, max(ts) AS last_ts
    FROM events GROUP BY user_id""")
def latest_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.latest_attributes(table(spark, sf_dir, "events"), ["user_id"], ["event_type", "props"], "ts", "event_id")


#: Package texts by ``p_partkey % 12``: the text in SQL, and how it reads.  One of
#: every rule, and some that go to review.
_FORMS = [
    ("'Bolsa ' || p_size || ' Kg. ' || p_type", "'kg'", "p_size::DOUBLE", "quantity", "NULL"),
    ("p_size || ' latas de 355 ml'", "'l'", "round(p_size * 0.355, 6)::DOUBLE", "pack", "NULL"),
    ("'Caja C/' || p_size", "'piece'", "p_size::DOUBLE", "count_with_slash", "NULL"),
    ("p_size || ' rollos'", "'piece'", "p_size::DOUBLE", "count", "NULL"),
    ("'Frasco ' || p_size || ' gr. o ' || (p_size + 1) || ' gr.'", "'kg'", "round(p_size * 0.001, 6)::DOUBLE", "alternatives", "'alternatives'"),
    ("p_name", "NULL", "NULL::DOUBLE", "none", "'no_quantity'"),
    ("'Pan, pieza de ' || p_size || ' a ' || (p_size + 9) || ' gr'", "'piece'", "1.0::DOUBLE", "piece_with_range", "NULL"),
    ("'Caja ' || (3 * p_size) || ' ml (' || p_size || ' ml. y ' || (2 * p_size) || ' ml.)'", "'l'", "round(3 * p_size * 0.001, 6)::DOUBLE", "quantity_with_parts", "NULL"),
    ("'Queso. Contenido variable ' || p_type || ' por KG'", "'kg'", "1.0::DOUBLE", "variable_content", "NULL"),
    ("'Charola con ' || p_size || '. ' || p_type", "'piece'", "p_size::DOUBLE", "count_after_con", "NULL"),
    ("'Docena ' || p_name", "'piece'", "12.0::DOUBLE", "implicit_count", "NULL"),
    ("'Kit ' || p_size || ' kg y ' || p_size || ' ml'", "'kg'", "p_size::DOUBLE", "quantity", "'mixed_units'"),
]


def _by_form(k: int) -> str:
    return " ".join(f"WHEN {i} THEN {form[k]}" for i, form in enumerate(_FORMS))


def _packages(spark: SparkSession, sf_dir: str, forms: int = len(_FORMS)) -> DataFrame:
    """product_id, item, package: a package text for every part."""
    text = "CASE p_partkey % {} {} END".format(forms, " ".join(f"WHEN {i} THEN {form[0]}" for i, form in enumerate(_FORMS[:forms])))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("item"), F.expr(text).alias("package"))


@query(f"""SELECT p_partkey AS product_id, CASE p_partkey % 12 {_by_form(0)} END AS package, CASE p_partkey % 12 {_by_form(1)} END AS base_unit, CASE p_partkey % 12 {_by_form(2)} END AS content,
  CASE p_partkey % 12 {" ".join(f"WHEN {i} THEN '{form[3]}'" for i, form in enumerate(_FORMS))} END AS rule, CASE p_partkey % 12 {_by_form(4)} END AS review_reason,
      p_partkey % 12 IN (4, 5, 11) AS needs_review
FROM part""")
def package_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part, with a text for every rule."""
    return packages.parse_packages(_packages(spark, sf_dir), "package").select("product_id", "package", "base_unit", "content", "rule", "review_reason", "needs_review")


@query(f"""SELECT p_partkey AS product_id, CASE p_partkey % 6 {" ".join(f"WHEN {i} THEN {f[0]}" for i, f in enumerate(_FORMS[:6]))} END AS package,
  CASE p_partkey % 6 WHEN 0 THEN 'kg' WHEN 1 THEN 'l' WHEN 2 THEN 'piece' WHEN 3 THEN 'piece' WHEN 4 THEN 'kg' END AS base_unit,
  CASE p_partkey % 6 WHEN 0 THEN p_size::DOUBLE WHEN 1 THEN round(p_size * 0.355, 6)::DOUBLE WHEN 2 THEN p_size::DOUBLE WHEN 3 THEN p_size::DOUBLE
      WHEN 4 THEN round(p_size * 0.001, 6)::DOUBLE END AS content,
  CASE p_partkey % 6 WHEN 0 THEN 'quantity' WHEN 1 THEN 'pack' WHEN 2 THEN 'count_with_slash' WHEN 3 THEN 'count' WHEN 4 THEN 'alternatives' ELSE 'none' END AS rule,
  p_partkey % 6 >= 4 AS needs_review
FROM part""")
def package_parse_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part, with the six simplest texts."""
    return packages.parse_packages(_packages(spark, sf_dir, 6), "package").select("product_id", "package", "base_unit", "content", "rule", "needs_review")


@query("""SELECT p_partkey AS product_id, CASE WHEN p_partkey % 6 = 0 THEN 'bag' WHEN p_partkey % 6 = 1 AND p_size > 6 THEN 'tins' WHEN p_partkey % 6 = 3 THEN 'rolls' END AS item_id
FROM part WHERE p_partkey % 6 IN (0, 3) OR (p_partkey % 6 = 1 AND p_size > 6)""")
def rule_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(
        [("BAG", "kg", None, "bag", r"^BOLSA", None), ("TINS", "l", None, "tins", r"LATAS", r"^[1-6] LATAS"), ("ROLLS", "piece", "ROLLO", "rolls", None, None)],
        "key string, unit string, subtype string, item_id string, include string, exclude string",
    )
    rows = packages.parse_packages(_packages(spark, sf_dir, 6), "package")
    rows = rows.withColumn("rule_key", F.when(F.col("base_unit") == "kg", "BAG").when(F.col("base_unit") == "l", "TINS").otherwise("ROLLS"))
    return normalize.assign_by_rules(rows.select("product_id", "rule_key", "base_unit", "count_subtype", "package_key"), rules, "rule_key", "package_key").select("product_id", "item_id")


_LOST = "éèêçñöäüßíóá"


@query(rf"""WITH t AS (SELECT DISTINCT text AS v FROM documents WHERE text IS NOT NULL),
n AS (SELECT v FROM t UNION SELECT translate(v, '{_LOST}', '{"?" * len(_LOST)}') FROM t WHERE regexp_matches(v, '[{_LOST}]')),
s AS (SELECT v, lower(regexp_replace(v, '[^\x00-\x7F]', '?', 'g')) AS skeleton, regexp_extract_all(v, '[^\x00-\x7F]|\?') AS beyond FROM n),
d AS (SELECT v AS damaged, skeleton, beyond AS x FROM s WHERE contains(v, '?')),
i AS (SELECT v, skeleton, beyond AS y, nullif(regexp_replace(upper(strip_accents(trim(regexp_replace(replace(v, 'ß', 'ss'), '\s+', ' ', 'g')))), '[ .]+$', ''), '') AS k
    FROM s WHERE NOT contains(v, '?') AND len(beyond) > 0),
p AS (SELECT damaged, v, k, len(y) AS b FROM d JOIN i USING (skeleton)
      WHERE len(list_filter(range(1, len(x) + 1), lambda j: NOT (x[j] = '?' OR lower(x[j]) = lower(y[j]) OR upper(x[j]) = upper(y[j])))) = 0),
g AS (SELECT damaged, count(DISTINCT k) AS c, first(v ORDER BY b DESC, v) AS best FROM p GROUP BY 1)
SELECT damaged AS value, coalesce(c, 0) AS candidates, CASE WHEN c = 1 THEN best ELSE damaged END AS corrected, coalesce(c, 0) <> 1 AS needs_review FROM d LEFT JOIN g USING (damaged)""")
def lost_char_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts of all documents, real marks included, and their damaged copies."""
    texts = table(spark, sf_dir, "documents").select(F.col("text").alias("value")).where(F.col("value").isNotNull()).distinct()
    damaged = texts.where(F.col("value").rlike(f"[{_LOST}]")).select(F.translate("value", _LOST, "?" * len(_LOST)).alias("value"))
    return normalize.correct_lost_chars(texts.unionByName(damaged).distinct().select(F.lit("text").alias("column"), "value")).drop("column")


@query()
def lost_char_correction_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as lost_char_correction, under the name it had when that one cut its texts."""
    return lost_char_correction(spark, sf_dir)


@query("""WITH d AS (SELECT CAST(unnest(generate_series(min(l_shipdate)::DATE, max(l_shipdate)::DATE, INTERVAL 1 DAY)) AS DATE) AS date FROM lineitem)
SELECT date, year(date) AS year, month(date) AS month, day(date) AS day, isodow(date) AS iso_weekday,
  list_extract(['lunes','martes','miércoles','jueves','viernes','sábado','domingo'], isodow(date)::INT) AS weekday, isoyear(date) AS iso_year, week(date) AS iso_week,
  date_trunc('week', date)::DATE AS week, CASE WHEN day(date) <= 15 THEN date_trunc('month', date)::DATE ELSE date_trunc('month', date)::DATE + 15 END AS fortnight,
      date_trunc('month', date)::DATE AS month_start FROM d""")
def calendar_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = table(spark, sf_dir, "lineitem").agg(F.min("l_shipdate").cast("date").alias("a"), F.max("l_shipdate").cast("date").alias("b"))
    return normalize.calendar(F.col("a"), F.col("b"), ends)


_GRAINS = {"week": "week", "month": "trunc(date, 'month')", "quarter": "trunc(date, 'quarter')"}


@query(sql(OBS, """x AS (SELECT g AS grain, item, chain, place_id, CASE g WHEN 'week' THEN week WHEN 'month' THEN date_trunc('month', date)::DATE ELSE date_trunc('quarter', date)::DATE END AS period
  FROM obs, unnest(['week', 'month', 'quarter']) AS u(g)), c AS (SELECT grain, period, chain, place_id, count(DISTINCT item) AS n FROM x GROUP BY ALL)""", select=f"""
  SELECT grain, count(*) AS n_cells, {r("100.0::DOUBLE * avg((n = t)::INT)")} AS pct_complete, {r("100.0::DOUBLE * avg((n >= t - 1)::INT)")} AS pct_missing_one
  FROM c, (SELECT count(DISTINCT item) AS t FROM obs) GROUP BY grain"""))
def completeness_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feasibility.basket_completeness(observations(spark, sf_dir), _GRAINS, "item", "chain", "place_id")


@query(sql(OBS, f"""t AS (SELECT chain, count(DISTINCT (place_id, week)) AS n_cells FROM obs GROUP BY 1),
s AS (SELECT item, product_id, chain, count(DISTINCT (place_id, week)) AS n FROM obs GROUP BY ALL),
e AS (SELECT item, product_id, count(*) AS n_chains, {r("min(100.0::DOUBLE * n / n_cells)", 4)} AS min_pct, {r("avg(100.0::DOUBLE * n / n_cells)", 4)} AS avg_pct FROM s
    JOIN t USING (chain) GROUP BY ALL)""",
    select="SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY item ORDER BY n_chains DESC, min_pct DESC, avg_pct DESC, product_id) = 1"))
def best_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feasibility.best_sku(observations(spark, sf_dir), "item", "product_id", "chain", ["place_id", "week"])


@query("""WITH g AS (SELECT l_returnflag, l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_returnflag, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS n_surplus FROM g GROUP BY 1""")
def duplicates_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicates(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"], ["l_returnflag"])


_COLUMNS = ["c_name", "c_nationkey", "c_mktsegment", "c_acctbal"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL OR trim({c}::VARCHAR) = '') AS n_empty, count(DISTINCT {c}) AS n_distinct FROM customer" for c in _COLUMNS))
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_profile(table(spark, sf_dir, "customer"), _COLUMNS)


@query(f"""SELECT count(*) FILTER (WHERE o_totalprice IS NULL) AS n_unparsed, count(*) FILTER (WHERE o_totalprice < 0) AS n_negative, count(*) FILTER (WHERE o_totalprice = 0) AS n_zero,
  {r("min(o_totalprice)", 4)} AS min, {r("quantile_cont(o_totalprice, 0.01)", 4)} AS p01, {r("median(o_totalprice)", 4)} AS median,
      {r("quantile_cont(o_totalprice, 0.99)", 4)} AS p99, {r("max(o_totalprice)", 4)} AS max FROM orders""")
def price_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.number_summary(table(spark, sf_dir, "orders"), "o_totalprice")


@query(f"""WITH m AS (SELECT {r("100.0::DOUBLE * avg((coalesce(trim(o_orderstatus), '') = '' OR coalesce(trim(o_orderpriority), '') = '')::INT)", 6)} AS a,
  {r("100.0::DOUBLE * avg((o_totalprice IS NULL)::INT)", 6)} AS b, count(*) FILTER (WHERE o_totalprice <= 0) AS c, {r("100.0::DOUBLE * avg((o_orderdate IS NULL)::INT)", 6)} AS d,
  count(*) FILTER (WHERE o_orderdate::DATE < DATE '1990-01-01' OR o_orderdate::DATE > DATE '2026-01-01') AS e FROM orders)
SELECT id, 'error' AS severity, CASE WHEN id IN ('R-04', 'R-06') THEN '==' ELSE '<=' END AS comparator, threshold, value, CASE WHEN id IN ('R-04',
    'R-06') THEN value = threshold ELSE value <= threshold END AS passed FROM (
  SELECT 'R-02' AS id, 0.1::DOUBLE AS threshold, a::DOUBLE AS value FROM m UNION ALL SELECT 'R-03', 0.01, b FROM m UNION ALL SELECT 'R-04', 0, c FROM m
      UNION ALL SELECT 'R-05', 0, d FROM m UNION ALL SELECT 'R-06', 0, e FROM m)""")
def rules_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rules = quality.raw_rules(F.col("o_totalprice"), F.col("o_orderdate").cast("date"), [F.col("o_orderstatus"), F.col("o_orderpriority")], F.to_date(F.lit("2026-01-01")), earliest="1990-01-01")
    return quality.evaluate_rules(orders, rules)


@query(sql(OBS, FLAGGED, f"m AS (SELECT {r('100.0::DOUBLE * avg((rule > 0)::INT)', 6)} AS v, count(*) FILTER (WHERE price <= 0)::DOUBLE AS n FROM flagged)", select="""
  SELECT 'M-01' AS id, 'warning' AS severity, '<=' AS comparator, 1.0::DOUBLE AS threshold, v AS value, v <= 1 AS passed FROM m
  UNION ALL SELECT 'M-02', 'error', '<=', 5.0, v, v <= 5 FROM m UNION ALL SELECT 'M-09', 'error', '==', 0.0, n, n = 0 FROM m"""))
def rules_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = quality.percent(F.col("is_outlier"))
    rules = [quality.Rule("M-01", share, "<=", 1, "warning"), quality.Rule("M-02", share, "<=", 5), quality.Rule("M-09", F.count_if(F.col("price") <= 0), "==", 0)]
    return quality.evaluate_rules(marts.flag_outliers(observations(spark, sf_dir), P), rules)


@query("""WITH f AS (SELECT 'file ' || (o_orderkey % 5) AS file, min(o_orderdate)::DATE AS first_date, max(o_orderdate)::DATE AS last_date,
    count(DISTINCT o_orderdate::DATE) AS n_days, count(*) FILTER (WHERE o_orderdate IS NULL) AS n_unparsed, count(*) AS n_rows FROM orders GROUP BY 1)
SELECT *, lead(file) OVER (ORDER BY first_date, file) AS next_file, lead(first_date) OVER (ORDER BY first_date, file) AS next_first FROM f QUALIFY next_first <= last_date""")
def file_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.concat(F.lit("file "), (F.col("o_orderkey") % 5).cast("string")).alias("file"), F.col("o_orderdate").cast("date").alias("date"))
    return profile.overlapping_files(profile.dates_by_file(rows, "file", "date"), "file")


@query("""SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag = 'A'
  OR (l_returnflag = 'N' AND substr(md5(l_orderkey || '|' || l_linenumber), 1, 1) < '1') OR (l_returnflag = 'R' AND substr(md5(l_orderkey || '|' || l_linenumber), 1, 1) < '2')""")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sources.publish import hash_sample as sample

    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return sample(rows, ["l_orderkey", "l_linenumber"], {"l_returnflag = 'A'": 16, "l_returnflag = 'N'": 1, "l_returnflag = 'R'": 2})


@query(sql(OBS, ITEMS, BASKET, SAVINGS, PRICES, select="""SELECT place_id, week, chain, saving FROM savings s
  LEFT JOIN (SELECT place_id, week, chain, sum(vs_cheapest_basket) AS b FROM prices WHERE is_paired GROUP BY ALL) USING (place_id, week, chain) WHERE abs(coalesce(b, 0) - saving) > 0.05"""))
def decomposition_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, savings, prices = _prices(spark, sf_dir)
    return quality.decomposition_gap(prices, savings).select("place_id", "week", "chain", "saving")


@query(sql(OBS, ITEMS, BASKET, select="SELECT place_id, week, chain, partial_cost AS recomputed, partial_cost AS published, true AS agrees FROM baskets WHERE week <= (SELECT max(week) FROM obs)"))
def recomputed_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell recomputed from observations by a date window, against the mart."""
    obs = observations(spark, sf_dir)
    baskets = written(_baskets(spark, sf_dir, marts.rolling_item_price(obs, P)))
    cells = baskets.select("place_id", "week").distinct()
    again = validation.recompute_cells(obs, cells, _basket(spark, sf_dir), P)
    return validation.compare(again, baskets.withColumn("basket_cost", F.col("partial_cost")), P)


@query("""SELECT "column", value, count(*) AS n_rows FROM (SELECT 'c_mktsegment' AS "column", c_mktsegment AS value FROM customer UNION ALL SELECT 'c_nationkey',
    c_nationkey::VARCHAR FROM customer) WHERE value IS NOT NULL GROUP BY ALL""")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.distinct_values(table(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey"]).select("column", "value", "n_rows")


