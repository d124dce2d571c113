"""Spellings: distinct values, lost characters, mappings, rules, review queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import first_by, latest_value
from ..functions.storage import numbered
from ..functions.text import canonical_key, surrogate

#: Spellings of "no brand" as canonical keys.
NO_BRAND = ("S/M", "SM", "SIN MARCA", "NO BRAND")


def distinct_values(df: DataFrame, columns: list[str], scope: Column | None = None, example: str | None = None) -> DataFrame:
    """column, value, n_rows, in_scope, example: the values of several columns in
    one pass."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    rows = df.select((F.lit(True) if scope is None else scope).alias("s"), (F.col(example) if example else F.lit(None).cast("string")).alias("e"), F.inline(cells))
    return rows.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n_rows"), F.bool_or("s").alias("in_scope"), F.min("e").alias("example"))


def correct_lost_chars(values: DataFrame, mark: str = "?") -> DataFrame:
    """column, value, candidates, corrected, needs_review for each damaged value of
    (column, value): characters beyond ASCII were lost to ``mark``.  A candidate is
    an intact value of the same column and length that is equal elsewhere, letter
    case aside, and has a character beyond ASCII at every mark.  One candidate key
    corrects, none or several go to review.  Both sides meet on a hash of their
    skeleton, which is then compared."""
    v = F.col("value")
    skeleton = lambda c: F.lower(F.regexp_replace(c, r"[^\x00-\x7F]|\?", "?"))
    damaged = values.where(v.contains(mark)).select("column", v.alias("damaged"), F.xxhash64(skeleton(v)).alias("h"))
    intact = values.where(~v.contains(mark) & v.rlike(r"[^\x00-\x7F]")).select("column", v.alias("candidate"), F.xxhash64(skeleton(v)).alias("h"))
    d, x = F.col("damaged"), F.col("candidate")
    # Characters beyond ASCII that weren't lost must agree too.  No expression is built from a text: it would fail on long ones.
    beyond = lambda c: F.split(F.regexp_replace(c, r"[\x00-\x7F&&[^?]]", ""), "")
    agree = F.forall(F.arrays_zip(beyond(d).alias("a"), beyond(x).alias("b")), lambda p: (p["a"] == mark) | (F.lower(p["a"]) == F.lower(p["b"])) | (F.upper(p["a"]) == F.upper(p["b"])))
    fits = (skeleton(d) == skeleton(x)) & (~d.rlike(r"[^\x00-\x7F]") | agree)
    pairs = damaged.join(intact, ["column", "h"], "left").withColumn("ok", F.coalesce(fits, F.lit(False)))
    c = F.when(F.col("ok"), F.col("candidate"))
    # Grouped as they were joined: texts aren't dealt out again.
    each = pairs.groupBy("column", "h", "damaged").agg(
        F.countDistinct(F.when(F.col("ok"), F.md5(canonical_key(x)))).alias("candidates"),
        F.min_by(c, F.when(F.col("ok"), F.struct((-F.regexp_count(x, F.lit(r"[^\x00-\x7F]"))).alias("n"), x.alias("x")))).alias("best"),
    )
    one = F.col("candidates") == 1
    return each.select("column", F.col("damaged").alias("value"), "candidates", F.when(one, F.col("best")).otherwise(F.col("damaged")).alias("corrected"), (~one).alias("needs_review"))


def apply_overrides(auto: DataFrame, manual: DataFrame) -> DataFrame:
    """Manual corrections (column, value, corrected) win; those without an automatic
    counterpart are added."""
    m = manual.select("column", "value", F.col("corrected").alias("m"))
    out = auto.join(m, ["column", "value"], "full")
    return out.select("column", "value", F.coalesce("candidates", F.lit(0)).alias("candidates"), F.coalesce("m", "corrected").alias("corrected"),
        (F.col("m").isNull() & F.coalesce("needs_review", F.lit(False))).alias("needs_review"), F.when(F.col("m").isNotNull(), "manual").otherwise("auto").alias("method"))


def apply_corrections(df: DataFrame, corrections: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with each of ``columns`` corrected, or as it was."""
    for c in columns:
        fix = corrections.where(F.col("column") == c).select(F.col("value").alias(c), F.col("corrected").alias("fix__"))
        df = df.join(fix, c, "left").withColumn(c, F.coalesce("fix__", c)).drop("fix__")
    return df


def map_brands(df: DataFrame, brand: str) -> DataFrame:
    """``df`` with brand_key and is_no_brand; all spellings of no brand are one."""
    key = canonical_key(brand)
    none = key.isin(*NO_BRAND) | key.isNull()
    return df.withColumns({"brand_key": F.when(none, "SIN MARCA").otherwise(key), "is_no_brand": none})


def map_catalogs(values: DataFrame, seed: DataFrame) -> DataFrame:
    """original, catalog, bit, mask: by canonical key; unknown catalogs have no bit."""
    known = seed.select(canonical_key("catalog").alias("key"), "catalog", "bit")
    out = values.select(F.col("value").alias("original"), canonical_key("value").alias("key")).join(known, "key", "left")
    return out.select("original", "catalog", "bit", F.call_function("shiftleft", F.lit(1), F.col("bit")).alias("mask"))


def expand_mask(df: DataFrame, mask: str, seed: DataFrame, keys: list[str]) -> DataFrame:
    """keys, catalogs: the names of the catalogs in a bit mask, in order of bits."""
    bits = F.filter(F.sequence(F.lit(0), F.lit(31)), lambda b: F.call_function("getbit", F.col(mask), b) == 1)
    rows = df.select(*keys, F.explode(bits).alias("bit")).join(seed.select("bit", "catalog"), "bit")
    return rows.groupBy(*keys).agg(F.concat_ws(" + ", F.transform(F.array_sort(F.collect_set(F.struct("bit", "catalog"))), lambda x: x["catalog"])).alias("catalogs"))


def assign_by_rules(products: DataFrame, rules: DataFrame, key: str, text: str) -> DataFrame:
    """Products with the basket item whose rule they meet: same key and unit, the
    subtype if the rule has one, text that meets the rule's include expression and
    not its exclude one.  With several items, the first by id."""
    r = rules.select(F.col("key").alias("r_key"), F.col("unit").alias("r_unit"), F.col("subtype").alias("r_subtype"), "item_id", "include", "exclude")
    meets = (
        (F.col(key) == F.col("r_key"))
        & (F.col("base_unit") == F.col("r_unit"))
        & (F.col("r_subtype").isNull() | (F.col("r_subtype") == F.col("count_subtype")))
        & F.coalesce(F.call_function("rlike", F.col(text), F.col("include")), F.lit(True))
        & ~F.coalesce(F.call_function("rlike", F.col(text), F.col("exclude")), F.lit(False))
    )
    out = products.join(F.broadcast(r), meets)  # a basket's rules are a short list
    return out.groupBy(*products.columns).agg(F.min("item_id").alias("item_id"))


def latest_attributes(df: DataFrame, keys: list[str], attributes: list[str], by: str, tie: str) -> DataFrame:
    """keys and the latest value that is not null of each attribute."""
    return df.groupBy(*keys).agg(*[latest_value(a, by, tie).alias(a) for a in attributes], F.max(by).alias(f"last_{by}"))


def store_keys(df: DataFrame, parts: list[str], place: list[str]) -> DataFrame:
    """``df`` with store_key and place_key, from canonical keys."""
    return df.withColumns({"store_key": surrogate(*map(canonical_key, parts)), "place_key": surrogate(*map(canonical_key, place))})


def review_queue(packages: DataFrame, corrections: DataFrame) -> DataFrame:
    """What people should look at: in scope first, then by rows; ranges of that order are
    numbered side by side."""
    a = packages.where("needs_review").select(F.lit("package").alias("kind"), "value", "review_reason", "in_scope", "n_rows")
    b = corrections.where("needs_review").select(F.lit("text").alias("kind"), "value", F.lit("lost_characters").alias("review_reason"), "in_scope", "n_rows")
    both = a.unionByName(b)
    order = [F.desc("in_scope"), F.desc("n_rows"), F.col("kind").asc(), F.col("value").asc()]
    return numbered(both, order, "priority").withColumn("priority", F.col("priority").cast("int"))


def most_used(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, value: the value with most rows, the least of equals."""
    n = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    return n.groupBy(*keys).agg(first_by(value, -F.col("n"), value).alias(value))


def dense_id(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Whole numbers for distinct values, in their order (nulls first): the distinct values
    are dealt by ranges and numbered after the exclusive prefix of the ranges' counts, and
    rows take the number of theirs."""
    keys = numbered(df.select(*columns).distinct(), [F.col(c).asc_nulls_first() for c in columns], name)
    keys = keys.withColumn(name, F.col(name).cast("int")).withColumnsRenamed({c: f"{c}__" for c in columns})
    same = [F.col(c).eqNullSafe(F.col(f"{c}__")) for c in columns]
    return df.join(keys, same).drop(*[f"{c}__" for c in columns])


def calendar(first: Column, last: Column, rows: DataFrame) -> DataFrame:
    """A row for each day between two dates of ``rows`` (one row): ISO attributes and
    the beginnings of week, fortnight and month."""
    days = rows.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date"))
    d = F.col("date")
    names = F.array(*map(F.lit, ("lunes", "martes", "miércoles", "jueves", "viernes", "sábado", "domingo")))
    dow = F.weekday(d) + 1
    return days.select(
        "date", F.year(d).alias("year"), F.month(d).alias("month"), F.day(d).alias("day"), dow.alias("iso_weekday"), F.element_at(names, dow).alias("weekday"),
        F.extract(F.lit("YEAROFWEEK"), d).cast("int").alias("iso_year"), F.weekofyear(d).alias("iso_week"), F.date_trunc("week", d).cast("date").alias("week"),
        F.when(F.day(d) <= 15, F.trunc(d, "month")).otherwise(F.date_add(F.trunc(d, "month"), 15)).alias("fortnight"), F.trunc(d, "month").alias("month_start"),
    )


def damaged_spellings(corrections: DataFrame, keys: DataFrame) -> DataFrame:
    """Damaged values whose correction has one of the wanted keys (key)."""
    found = corrections.where(F.col("value") != F.col("corrected")).withColumn("key", canonical_key("corrected"))
    return found.join(keys.select("key").distinct(), "key", "left_semi").select("value", "corrected")
