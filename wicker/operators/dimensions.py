"""Staging, key maps, consolidation and the dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..functions.stats import latest_value, rounded, small_side
from ..functions.storage import written
from ..params import Params
from .normalize import NO_BRAND, apply_corrections, assign_by_rules, expand_mask, map_catalogs

#: The box that valid places lie in (south, north, west, east).
BOX = (14.0, 33.0, -119.0, -86.0)
SKU = ["product", "package", "brand"]
STORE = ["store", "address", "state", "municipality"]
#: Of a consolidated observation what prices are worked out from.
FACT = ["product_id", "store_id", "date", "price"]


def stage_prices(raw: DataFrame, files: DataFrame) -> DataFrame:
    """``raw`` with typed price, date, latitude and longitude beside the price as it
    was written (price_text).  The date's format is its file's; what doesn't parse is
    null, and no row goes.  ``files``: file, date_format."""
    formats = files.select(F.col("file").alias("source_file"), F.col("date_format").alias("format__"))
    out = raw.drop("date_format").join(formats, "source_file").withColumn("price_text", F.col("price"))
    return out.withColumns(
        {
            "date": T.parse_date_by_format(F.col("day"), F.col("format__")),
            "price": F.col("price").try_cast("decimal(12,2)"),
            "latitude": F.col("latitude").try_cast("double"),
            "longitude": F.col("longitude").try_cast("double"),
        }
    ).withColumnRenamed("format__", "date_format")


def largest(x: str, by: str) -> Column:
    """The value with the largest ``by``, the last of equals."""
    return F.max_by(x, F.struct(by, x))


def sku_map(staged: DataFrame, seed: DataFrame, corrections: DataFrame | None = None, avoided: str = "Pacic") -> DataFrame:
    """A row for each original (product, package, brand): their keys and product_id,
    catalog_mask, category (that of most rows outside the ``avoided`` catalog, else
    of most rows) and n_rows.  ``seed``: catalog, bit; ``corrections``: column,
    value, corrected."""
    counts = written(staged.groupBy(*SKU, "catalog", "category").agg(F.count("*").alias("n")))
    known = map_catalogs(counts.select(F.col("catalog").alias("value")).distinct(), seed)
    known = known.select(F.col("original").alias("catalog"), F.col("catalog").alias("seed_catalog"), "mask")
    rows = counts.join(small_side(written(known)), "catalog", "left")
    other = ~F.col("seed_catalog").eqNullSafe(avoided)
    preferred = F.max_by(F.when(other, F.col("category")), F.when(other, F.struct("n", "category")))
    out = rows.groupBy(*SKU).agg(F.bit_or("mask").alias("catalog_mask"), F.coalesce(preferred, largest("category", "n")).alias("category"), F.sum("n").alias("n_rows"))
    fixed = out.withColumns({f"{c}_text": F.col(c) for c in SKU})
    if corrections is not None:
        fixed = apply_corrections(fixed, corrections.withColumn("column", F.concat("column", F.lit("_text"))), [f"{c}_text" for c in SKU])
    brand = T.canonical_key("brand_text")
    no_brand = brand.isin(*NO_BRAND) | brand.isNull()
    keyed = fixed.withColumns({"product_key": T.canonical_key("product_text"), "package_key": T.canonical_key("package_text"), "brand_key": F.when(no_brand,
        "SIN MARCA").otherwise(brand), "is_no_brand": no_brand})
    return keyed.withColumn("product_id", T.surrogate(F.col("product_key"), F.col("package_key"), F.col("brand_key")))


def store_map(staged: DataFrame, corrections: DataFrame | None = None) -> DataFrame:
    """A row for each original (store, address, state, municipality): store_id,
    place_id and their keys, the latest chain, format and valid coordinates, first
    and last date, n_rows."""
    valid = T.in_box(F.col("latitude"), F.col("longitude"), *BOX)
    dated = staged.select(*STORE, "chain", "format", "date", F.when(valid, F.col("latitude")).alias("latitude"), F.when(valid, F.col("longitude")).alias("longitude"))
    # Dates and counts alone are summed over the lines, in place: aggregates of texts would sort all of them.
    seen = ["chain", "format", "latitude", "longitude"]
    spans = dated.groupBy(*STORE, *seen).agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count("*").alias("n_rows"))
    last = lambda c: latest_value(c, "last_date", c).alias(c)
    out = spans.groupBy(*STORE).agg(*map(last, seen), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"), F.sum("n_rows").alias("n_rows"))
    texts = [*STORE, "chain", "format"]
    fixed = out.withColumns({f"{c}_text": F.col(c) for c in texts})
    if corrections is not None:
        fixed = apply_corrections(fixed, corrections.withColumn("column", F.concat("column", F.lit("_text"))), [f"{c}_text" for c in texts])
    key = lambda c: F.coalesce(T.canonical_key(c), F.lit(""))
    keyed = fixed.withColumns({"state_key": key("state_text"), "municipality_key": key("municipality_text"), "chain_key": key("chain_text"), "store_key": F.concat_ws("|",
        key("store_text"), key("address_text"))})
    return keyed.withColumns({"store_id": T.surrogate(F.col("store_key"), F.col("state_key"), F.col("municipality_key")), "place_id": T.surrogate(F.col("state_key"), F.col("municipality_key"))})


def consolidate_observations(staged: DataFrame, skus: DataFrame, stores: DataFrame, seed: DataFrame) -> DataFrame:
    """product_id, store_id, date, price: equal observations in one row, with the
    price and the originals of one of them, its source file, the union of catalogs,
    n_source_rows, and whether the day has another price too.  Rows without a price
    or a date form no observation.
    The maps are written and counted, so that small ones are broadcast: a shuffle by
    catalog would bring the rows of one catalog, a third of all, into one task.  Rows are
    dealt once, by product, store and date."""
    known = map_catalogs(staged.select(F.col("catalog").alias("value")).distinct(), seed).select(F.col("original").alias("catalog"), "mask")
    rows = staged.where(F.col("price").isNotNull() & F.col("date").isNotNull()).join(small_side(written(known)), "catalog", "left")
    rows = rows.join(small_side(written(skus.select(*SKU, "product_id"))), SKU).join(small_side(written(stores.select(*STORE, "store_id"))), STORE)
    keys = ["product_id", "store_id", "date"]
    dealt = rows.select(*keys, "price", "price_text", *SKU, "mask", "source_file").repartition(*keys)
    out = dealt.groupBy(*keys, "price").agg(
        F.min("price_text").alias("price_text"), F.min(F.struct(*SKU)).alias("original"), F.bit_or("mask").alias("catalog_mask"), F.count("*").alias("n_source_rows"),
            F.min("source_file").alias("source_file"),
    )
    conflict = F.count("*").over(Window.partitionBy(*keys)) > 1
    return out.select(*keys, "price", "price_text", "original.*", "catalog_mask", "n_source_rows", conflict.alias("has_conflict"), "source_file")


def dim_product(skus: DataFrame, packages: DataFrame, seed: DataFrame, rules: DataFrame) -> DataFrame:
    """A row for each product_id: texts and category of the variant with most rows,
    catalogs in order of bits, how its package reads, and the basket item whose rule
    it meets.  ``packages``: package_key and its reading, several rows of a key being
    equal."""
    by = skus.groupBy("product_id").agg(
        largest("product_text", "n_rows").alias("product"), F.any_value("product_key").alias("product_key"), largest("package_text", "n_rows").alias("package"),
            F.any_value("package_key").alias("package_key"),
        largest("brand_text", "n_rows").alias("brand"), F.any_value("brand_key").alias("brand_key"), F.bool_or("is_no_brand").alias("is_no_brand"), largest("category", "n_rows").alias("category"),
        F.bit_or("catalog_mask").alias("catalog_mask"), F.count("*").alias("n_variants"), F.sum("n_rows").alias("n_rows"),
    )
    read = packages.groupBy("package_key").agg(F.first(F.struct("base_unit", "content", "count_subtype", "rule", "confidence", "needs_review",
        "is_comparable")).alias("r")).select("package_key", "r.*")
    rows = by.join(read, "package_key")
    names = expand_mask(rows, "catalog_mask", seed, ["product_id"])
    assigned = assign_by_rules(rows.select("product_id", "product_key", "package_key", "base_unit", "count_subtype"), rules, "product_key", "package_key").select("product_id", "item_id")
    return rows.join(names, "product_id", "left").join(assigned, "product_id", "left")


def dim_store(stores: DataFrame, chains: DataFrame) -> DataFrame:
    """A row for each store_id: the latest texts and coordinates of its variants, and
    whether its chain is a reference chain.  ``chains``: chain_key."""
    last = lambda c: latest_value(c, "last_date", c)
    out = stores.groupBy("store_id").agg(
        F.any_value("store_key").alias("store_key"), last("store_text").alias("store"), last("address_text").alias("address"), last("chain_text").alias("chain"),
            last("chain_key").alias("chain_key"), last("format_text").alias("format"),
        F.any_value("place_id").alias("place_id"), last("latitude").alias("latitude"), last("longitude").alias("longitude"),
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"), F.count("*").alias("n_variants"), F.sum("n_rows").alias("n_rows"),
    )
    known = chains.select("chain_key", F.lit(True).alias("known__")).distinct()
    out = out.withColumn("has_coordinates", F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).join(known, "chain_key", "left")
    return out.withColumn("is_reference_chain", F.col("known__").isNotNull()).drop("known__")


def dim_place(stores: DataFrame, iso: DataFrame) -> DataFrame:
    """A row for each place_id: its latest spelling, the state's latest spelling (over
    the whole state) and ISO code.  ``iso``: state_key, state_iso."""
    last = lambda c: latest_value(c, "last_date", c)
    places = stores.groupBy("place_id").agg(
        F.any_value("state_key").alias("state_key"), F.any_value("municipality_key").alias("municipality_key"), last("municipality_text").alias("municipality"),
        F.countDistinct("store_id").alias("n_stores"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
    )
    states = stores.groupBy("state_key").agg(last("state_text").alias("state"))
    return places.join(states, "state_key").join(iso, "state_key", "left")


def dim_basket(items: DataFrame, params: Params = Params()) -> DataFrame:
    """The versioned items of ``items``, and whether their version is the current one."""
    return items.withColumn("is_current", F.col("version") == params.version)


def current_version(basket: DataFrame) -> str:
    """The one current version; none or several are an error."""
    found = [r.version for r in basket.where("is_current").select("version").distinct().limit(2).collect()]
    if len(found) != 1:
        raise ValueError(f"one current version of the basket is needed, not {found}")
    return found[0]


def numbered_ids(rows: DataFrame, key: str) -> DataFrame:
    """``rows``, a written table, with a number of eight bytes in place of each different ``key``."""
    numbers = written(rows.select(key).distinct().withColumn("number__", F.monotonically_increasing_id()))
    return written(rows.join(numbers, key).drop(key).withColumnRenamed("number__", key))


def in_basket(products: DataFrame) -> DataFrame:
    """The comparable products that a rule of the basket fits."""
    return products.where(F.col("item_id").isNotNull() & F.col("is_comparable"))


def basket_observations(fact: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """Observations of comparable products of the basket that aren't outliers, with
    item, chain, place, week and unit price."""
    p = small_side(written(in_basket(products).select("product_id", F.col("item_id").alias("item"), "content")))
    s = small_side(written(stores.select("store_id", F.col("chain_key").alias("chain"), "place_id")))
    rows = fact.where(~F.col("is_outlier")).join(p, "product_id").join(s, "store_id")
    week = F.date_trunc("week", "date").cast("date")
    price = F.col("price").cast("double")
    return rows.select("product_id", "store_id", "date", week.alias("week"), "item", "chain", "place_id", price.alias("price"), rounded(price / F.col("content"), 4).alias("unit_price"))
