"""Profiles of raw tables, and findings out of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.sketches import distinct_sketches, merged_distinct
from ..functions.stats import one_row, quantiles_of_all, rounded
from ..functions.storage import numbered


def column_profile(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """column, n_rows, n_empty, n_distinct: all columns in one aggregate.  Exact counts repeat
    every row for each column; ``approximate`` ones, within ``sketches.distinct_error``, don't."""
    if approximate:
        return merged_distinct(distinct_sketches(df, [], columns), [], columns)
    parts = []
    for c in columns:
        text = F.col(c).cast("string")
        parts += [F.count_if(text.isNull() | (F.trim(text) == "")).alias(f"{c}__e"), F.countDistinct(c).alias(f"{c}__d")]
    one = df.agg(F.count("*").alias("n"), *parts)
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col("n").alias("n_rows"), F.col(f"{c}__e").alias("n_empty"), F.col(f"{c}__d").alias("n_distinct")) for c in columns])))


def number_summary(df: DataFrame, column: str) -> DataFrame:
    """One row: rows that don't parse, negative, zero, and quantiles of the rest."""
    x = F.col(column).try_cast("double")
    counts = df.agg(F.count_if(x.isNull()).alias("n_unparsed"), F.count_if(x < 0).alias("n_negative"), F.count_if(x == 0).alias("n_zero"), rounded(F.min(x),
        4).alias("min"), rounded(F.max(x), 4).alias("max"))
    found = quantiles_of_all(df.select(x.alias("x")), "x", {"p01": 0.01, "median": 0.5, "p99": 0.99})
    both = one_row(counts, found.select(*[rounded(F.col(c), 4).alias(c) for c in found.columns]))
    return both.select("n_unparsed", "n_negative", "n_zero", "min", "p01", "median", "p99", "max")


def dates_by_file(df: DataFrame, file: str, date: str) -> DataFrame:
    return df.groupBy(file).agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"), F.countDistinct(date).alias("n_days"),
        F.count_if(F.col(date).isNull()).alias("n_unparsed"), F.count("*").alias("n_rows"))


def overlapping_files(dates: DataFrame, file: str) -> DataFrame:
    """Files whose dates reach into the next file's, which is that of the next number in the
    order of first dates."""
    placed = numbered(dates, ["first_date", file], "place__")
    after = placed.select((F.col("place__") - 1).alias("place__"), F.col(file).alias("next_file"), F.col("first_date").alias("next_first"))
    return placed.join(after, "place__").drop("place__").where("next_first <= last_date")


def spelling_variants(df: DataFrame, column: str, key) -> DataFrame:
    """Canonical keys with more than one spelling."""
    return df.groupBy(key.alias("key")).agg(F.countDistinct(column).alias("n_spellings"), F.count("*").alias("n_rows")).where("n_spellings > 1")


def observation_table(raw: DataFrame) -> DataFrame:
    """The compact table that profiles read: file, product, package, brand, catalog,
    price, date (by the first format that fits), date_format, week, chain, format,
    store (a hash of its normalised texts), state, municipality (normalised)."""
    day = T.parse_date_any(F.col("day"))
    store = F.md5(F.concat_ws("|", *[T.plain_upper(F.col(c)) for c in ("store", "address", "state", "municipality")]))
    return raw.select(
        F.col("source_file").alias("file"), "product", "package", "brand", "catalog", F.col("price").try_cast("double").alias("price"), day.alias("date"),
            T.date_format_of(F.col("day")).alias("date_format"),
        F.date_trunc("week", day).cast("date").alias("week"), "chain", "format", store.alias("store"), T.plain_upper(F.col("state")).alias("state"),
            T.plain_upper(F.col("municipality")).alias("municipality"),
    )


def formats_by_file(obs: DataFrame) -> DataFrame:
    """Dates and their formats in each file."""
    known = F.when(F.col("date").isNotNull(), F.col("date_format"))
    return obs.groupBy("file").agg(F.min(known).alias("date_format"), F.countDistinct(known).alias("n_formats"), F.min("date").alias("first_date"),
        F.max("date").alias("last_date"), F.countDistinct("date").alias("n_days"), F.count_if(F.col("date").isNull()).alias("n_unparsed"))


def highest(df: DataFrame, value: str, columns: list[str], n: int = 10) -> DataFrame:
    """The ``n`` rows with the highest values, the first texts of equals."""
    return df.where(F.col(value).isNotNull()).select(value, *columns).orderBy(F.desc(value), *columns).limit(n)


def coordinate_summary(df: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """One row: rows without coordinates, and outside the box on either axis."""
    lat, lon = F.col("latitude").try_cast("double"), F.col("longitude").try_cast("double")
    south, north, west, east = box
    return df.agg(F.count_if(lat.isNull() | lon.isNull()).alias("n_without"), F.count_if(~lat.between(south, north)).alias("n_latitude_outside"),
        F.count_if(~lon.between(west, east)).alias("n_longitude_outside"))


def catalog_by_year(obs: DataFrame) -> DataFrame:
    return obs.groupBy("catalog", F.year("date").alias("year")).agg(F.count("*").alias("n_rows"), F.countDistinct("product").alias("n_products"))


def store_formats(obs: DataFrame) -> DataFrame:
    return obs.groupBy("format").agg(F.count("*").alias("n_rows"), F.countDistinct("chain").alias("n_chains"), F.countDistinct("file").alias("n_files"))


def spellings(df: DataFrame, column: str, file: str) -> DataFrame:
    """Normalised and original spelling, with the first and the last file of each."""
    return df.groupBy(T.plain_upper(F.col(column)).alias("normalised"), F.col(column).alias("original")).agg(F.count("*").alias("n_rows"),
        F.min(file).alias("first_file"), F.max(file).alias("last_file"))


def no_brand_by_year(obs: DataFrame, spelling: str = "S/M") -> DataFrame:
    return obs.where(F.upper("brand") == spelling).groupBy("brand", F.year("date").alias("year")).agg(F.count("*").alias("n_rows"))


def coverage_by_state(obs: DataFrame) -> DataFrame:
    return obs.groupBy("state").agg(F.countDistinct("municipality").alias("n_municipalities"), F.countDistinct("week").alias("n_weeks"),
        F.countDistinct("store").alias("n_stores"), F.count("*").alias("n_rows"))


def coverage_by_chain(obs: DataFrame, catalog: str, more_than: int = 50_000) -> DataFrame:
    """Chains with more than so many rows in one catalog."""
    out = obs.where(F.col("catalog") == catalog).groupBy("chain").agg(
        F.countDistinct("state").alias("n_states"), F.countDistinct(F.struct("state", "municipality")).alias("n_municipalities"),
            F.countDistinct("store").alias("n_stores"), F.countDistinct("week").alias("n_weeks"), F.countDistinct("product").alias("n_products"), F.count("*").alias("n_rows"),
    )
    return out.where(F.col("n_rows") > more_than)


def fortnight(date: str) -> Column:
    return F.when(F.day(date) <= 15, F.trunc(date, "month")).otherwise(F.date_add(F.trunc(date, "month"), 15))


def visit_days(obs: DataFrame) -> DataFrame:
    """How many stores and fortnights have so many days with prices."""
    days = obs.groupBy("store", fortnight("date").alias("fortnight")).agg(F.countDistinct("date").alias("n_days"))
    return days.groupBy("n_days").agg(F.count("*").alias("n_store_fortnights"))


GRAIN = ["product", "package", "brand", "store", "address", "state", "municipality", "day"]


def duplicates_by_file(raw: DataFrame, texts: list[str], named: list[str]) -> DataFrame:
    """Of each file: rows, surplus equal rows, surplus rows of a grain (``GRAIN``),
    grains in several catalogs, grains with several prices in one catalog, and rows
    with a lost character in ``named``: one grouping by row inside one by grain."""
    lost = F.concat_ws("|", *named).rlike(r"[A-Za-z]\?[A-Za-z]")
    rows = raw.groupBy("source_file", F.xxhash64(*GRAIN).alias("g"), F.xxhash64(*texts).alias("h")).agg(F.count("*").alias("n"), F.first("price").alias("price"),
        F.first("catalog").alias("catalog"), F.max(lost.cast("int")).alias("lost"))
    grains = rows.groupBy("source_file", "g").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("equal"), F.size(F.collect_set("price")).alias("prices"), F.size(F.collect_set("catalog")).alias("catalogs"),
            F.sum(F.col("n") * F.col("lost")).alias("lost"),
    )
    several = F.col("n") > 1
    return grains.groupBy(F.col("source_file").alias("file")).agg(
        F.sum("n").alias("n_rows"), F.sum("equal").alias("n_equal"), F.sum(F.col("n") - 1).alias("n_same_grain"), F.count_if(several & (F.col("catalogs") > 1)).alias("n_in_catalogs"),
        F.count_if(several & (F.col("prices") > 1) & (F.col("catalogs") == 1)).alias("n_conflicts"), F.sum("lost").alias("n_lost"),
    )


def catalog_combinations(raw: DataFrame) -> DataFrame:
    """The catalogs that share a grain, and how many grains they share; only grains
    in several catalogs have their names put in order."""
    rows = raw.select("source_file", F.xxhash64(*GRAIN).alias("g"), "catalog")
    sets = rows.groupBy("source_file", "g").agg(F.collect_set("catalog").alias("names")).where(F.size("names") > 1)
    return sets.groupBy(F.concat_ws(" + ", F.array_sort("names")).alias("combination")).agg(F.count("*").alias("n_groups"))


def inventory_summary(files: DataFrame) -> DataFrame:
    """Files and rows by encoding, byte order mark and date format."""
    return files.groupBy("encoding", "bom", "date_format").agg(F.count("*").alias("n_files"), F.sum("n_rows").alias("n_rows"), F.min("file").alias("first_file"), F.max("file").alias("last_file"))


def all_findings(files: DataFrame, formats: DataFrame, rejects: DataFrame, prices: DataFrame, repeated: DataFrame, states: DataFrame, brands: DataFrame, factor: float = 100.0) -> DataFrame:
    """finding, n of what a reader should know; only what there is.  The inputs are
    the profile's own small tables; ``files``: encoding, n_rows, n_lines."""
    count = lambda df, name: df.groupBy().agg(F.count("*").alias("n")).select(F.lit(name).alias("finding"), "n")
    total = lambda df, c, name: df.groupBy().agg(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias("n")).select(F.lit(name).alias("finding"), "n")
    kinds = lambda df, c, name: df.groupBy().agg(F.when(F.countDistinct(c) > 1, F.countDistinct(c)).otherwise(0).cast("long").alias("n")).select(F.lit(name).alias("finding"), "n")
    parts = [
        kinds(files, "encoding", "several encodings"), kinds(formats, "date_format", "several date formats"), total(formats, "n_unparsed", "unparsed dates"), count(rejects, "rejected rows"),
        count(files.where("n_rows <> n_lines"), "rows unlike lines"), count(overlapping_files(formats, "file"), "overlapping files"),
            count(prices.where(F.col("max") > factor * F.col("p99")), "extreme price"),
        total(repeated, "n_equal", "equal rows"), total(repeated, "n_lost", "lost characters"), count(states.groupBy("normalised").count().where("count > 1"),
            "spelling variants"), kinds(brands, "brand", "no-brand spellings"),
    ]
    return reduce(DataFrame.unionByName, parts).where("n > 0")


def findings(summary: DataFrame, overlaps: DataFrame, factor: float = 100.0) -> DataFrame:
    """finding, n: what a reader should know."""
    extreme = summary.where(F.col("max") > factor * F.col("p99")).select(F.lit("extreme value").alias("finding"), F.lit(1).cast("long").alias("n"))
    bad = summary.where("n_unparsed > 0").select(F.lit("unparsed numbers").alias("finding"), F.col("n_unparsed").alias("n"))
    over = overlaps.groupBy().agg(F.count("*").alias("n")).where("n > 0").select(F.lit("overlapping files").alias("finding"), "n")
    return extreme.unionByName(bad).unionByName(over)
