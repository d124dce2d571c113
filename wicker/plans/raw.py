"""Raw price lines out of the order tables: text columns as a source file has them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bindings import table

_DAY = "CAST(l_shipdate AS DATE)"
#: One line in fifty thousandths is filed a month late, so that months disagree.
_FILED = f"CAST(CASE WHEN l_orderkey % 400 = 0 THEN {_DAY} + 31 ELSE {_DAY} END AS DATE)"
_PAD = lambda x, n=2: f"lpad(CAST({x} AS STRING), {n}, '0')"
_CENTS = "CAST(floor(l_extendedprice / l_quantity * 100 + 0.5) AS BIGINT)"
_ISO = f"{_PAD(f'year({_DAY})', 4)} || '/' || {_PAD(f'month({_DAY})')} || '/' || {_PAD(f'day({_DAY})')}"
_SLASH = f"{_PAD(f'day({_DAY})')} || '/' || {_PAD(f'month({_DAY})')} || '/' || {_PAD(f'year({_DAY})', 4)}"

#: Of each column the expression that both engines read: spellings differ by line
#: status, some prices, places and months are wrong.
COLUMNS = {
    "product": "CASE WHEN l_linestatus = 'O' THEN upper(p_name) ELSE p_name || '.' END",
    "package": "'Bolsa ' || CAST(p_size AS STRING) || CASE WHEN l_linestatus = 'O' THEN ' Kg.' ELSE '  KG' END",
    "brand": "CASE WHEN p_partkey % 7 <> 0 THEN p_brand WHEN l_linestatus = 'O' THEN 'S/M' ELSE 'Sin  Marca' END",
    "category": "CASE WHEN l_returnflag = 'R' THEN 'Pacic ' || p_type ELSE p_type || CASE WHEN l_linenumber = 1 THEN ' A' ELSE '' END END",
    "catalog": "CASE l_returnflag WHEN 'A' THEN 'Basicos' WHEN 'N' THEN CASE WHEN l_linestatus = 'O' THEN 'FRUTAS Y LEGUMBRES' ELSE 'Frutas y  legumbres' END ELSE CASE WHEN l_linenumber = 7 THEN 'Otro' ELSE 'Pacic' END END",
    "price": f"CASE WHEN l_orderkey % 997 = 0 THEN 'n/d' WHEN l_orderkey % 991 = 0 THEN '0' ELSE CAST(CAST(floor({_CENTS} / 100) AS BIGINT) AS STRING) || '.' || {_PAD(f'{_CENTS} % 100')} END",
    "day": f"CASE WHEN l_orderkey % 983 = 0 THEN 'sin fecha' WHEN month({_FILED}) % 2 = 0 THEN {_ISO} ELSE {_SLASH} END",
    "chain": "CASE WHEN l_linestatus = 'O' THEN 'CADENA ' ELSE 'Cadena  ' END || CAST(l_suppkey % 5 AS STRING)",
    "format": "CASE WHEN l_suppkey % 3 = 0 THEN 'Supermercado' WHEN year(l_shipdate) >= 1998 AND l_suppkey % 5 = 0 THEN 'Tienda' ELSE 'Mercado' END",
    "store": "s_name",
    "address": "CASE WHEN l_linestatus = 'O' THEN 'CALLE ' ELSE 'Calle ' END || CAST(l_suppkey AS STRING)",
    "state": "CASE WHEN l_linestatus = 'O' THEN r_name ELSE lower(r_name) END",
    "municipality": "CASE WHEN l_linestatus = 'O' THEN n_name ELSE lower(n_name) END",
    "latitude": "CASE WHEN l_suppkey % 11 = 0 THEN NULL WHEN l_suppkey % 13 = 0 THEN '99.5' ELSE CAST(14 + l_suppkey % 19 AS STRING) || '.25' END",
    "longitude": "CASE WHEN l_suppkey % 11 = 0 THEN '' ELSE '-' || CAST(87 + l_suppkey % 31 AS STRING) || '.5' END",
    "source_file": f"{_PAD(f'month({_FILED})')} || '-' || {_PAD(f'year({_FILED})', 4)} || CASE WHEN day({_FILED}) <= 15 THEN '_Q1.csv' ELSE '_Q2.csv' END",
    "date_format": f"CASE WHEN month({_FILED}) % 2 = 0 THEN 'yyyy/mm/dd' ELSE 'dd/mm/yyyy' END",
}
#: The columns of a line, without those of its file.
TEXTS = [c for c in COLUMNS if c not in ("source_file", "date_format")]


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line for each order line: text columns, source_file, date_format.  Lines meet one table after the other: the
    optimiser knows the size of a file, but takes that of a join for the product of its sides, and would shuffle all lines."""
    t = lambda name: table(spark, sf_dir, name)
    lines = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    lines = lines.join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return lines.selectExpr(*[f"{e} AS {c}" for c, e in COLUMNS.items()])


def source_files(raw: DataFrame) -> DataFrame:
    """file, date_format, n_rows: the ledger of the files of ``raw``."""
    return raw.groupBy(F.col("source_file").alias("file")).agg(F.first("date_format").alias("date_format"), F.count("*").alias("n_rows"))


#: The same in SQL, and typed.
RAW = f"""raw AS (SELECT {", ".join(f"{e} AS {c}" for c, e in COLUMNS.items())}
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
STAGED = """staged AS (SELECT * REPLACE (TRY_CAST(price AS DECIMAL(12,2)) AS price, TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude),
  price AS price_text, CAST(CASE date_format WHEN 'yyyy/mm/dd' THEN try_strptime(day, '%Y/%m/%d') ELSE try_strptime(day, '%d/%m/%Y') END AS DATE) AS date FROM raw)"""


def key_sql(x: str) -> str:
    """The canonical key in SQL."""
    return rf"nullif(regexp_replace(upper(strip_accents(trim(regexp_replace({x}, '\s+', ' ', 'g')))), '[ .]+$', ''), '')"
