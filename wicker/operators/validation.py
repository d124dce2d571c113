"""Independent recomputation of published cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..functions.stats import rounded, small_side
from ..functions.storage import written
from ..params import Params
from ..plans.marts import rolling_weeks
from .normalize import NO_BRAND


def pick_cells(savings: DataFrame, outliers: DataFrame, n: int = 6, params: Params = Params()) -> DataFrame:
    """``n`` paired cells without outliers in their window, one for each place, most
    chains first, then by a hash."""
    found = outliers.select("place_id", "week").distinct()
    bad = rolling_weeks(found, params.previous_weeks).select("place_id", "week").distinct()
    cells = savings.select("place_id", "week", "chains_compared").distinct().join(bad, ["place_id", "week"], "left_anti")
    mark = F.md5(F.concat_ws("|", "place_id", "week"))
    order = Window.partitionBy("place_id").orderBy(F.desc("chains_compared"), mark)
    best = cells.withColumn("k", F.row_number().over(order)).where("k = 1").drop("k")
    return best.orderBy(F.desc("chains_compared"), F.md5(F.concat_ws("|", "place_id", "week"))).limit(n)


def recompute_cells(obs: DataFrame, cells: DataFrame, basket: DataFrame, params: Params = Params()) -> DataFrame:
    """Basket costs of some cells straight from observations.  Every date names the
    weeks whose window holds it, and rows meet their cells on place and week."""
    monday = F.date_sub("date", F.weekday("date"))
    weeks = F.transform(F.sequence(F.lit(0), F.lit(params.previous_weeks)), lambda k: F.date_add(monday, k * 7))
    dated = obs.select("place_id", "chain", "item", "unit_price", F.explode(weeks).alias("cell_week"))
    c = cells.select("place_id", F.col("week").alias("cell_week")).distinct()
    rows = dated.join(c, ["place_id", "cell_week"], "left_semi").join(basket, "item")
    per = rows.groupBy("place_id", "cell_week", "chain", "item").agg((F.percentile("unit_price", 0.5) * F.first("quantity")).alias("cost"))
    return per.groupBy("place_id", F.col("cell_week").alias("week"), "chain").agg(rounded(F.sum("cost")).alias("cost"), F.count("*").alias("n_items"))


def compare(recomputed: DataFrame, published: DataFrame, params: Params = Params()) -> DataFrame:
    """Every cell of either side, and whether the costs agree."""
    a = recomputed.select("place_id", "week", "chain", F.col("cost").alias("recomputed"))
    b = published.select("place_id", "week", "chain", F.col("basket_cost").alias("published"))
    both = a.join(b, ["place_id", "week", "chain"], "full")
    same = (F.col("recomputed").isNull() & F.col("published").isNull()) | (F.abs(F.col("recomputed") - F.col("published")) <= params.cost_tolerance)
    return both.withColumn("agrees", F.coalesce(same, F.lit(False)))


def recompute_from_raw(raw: DataFrame, rules: DataFrame, parsed: DataFrame, params: Params = Params()) -> DataFrame:
    """place, week, chain, cost, n_items from raw lines and no table of the star
    schema: each line's date by any format, keys, package and rule (the first that
    fits), equal lines of a day once, median of the window times quantity.
    ``rules``: key, unit, include, exclude, item_id, quantity; ``parsed``: package_key
    with its reading.
    Keys and rules are tried once for each different product and package as they are written;
    lines meet these by their texts, and only those that a rule fits get their other keys."""
    price = F.col("price").try_cast("decimal(12,2)").cast("double")
    r = rules.select(F.col("key").alias("r_key"), "unit", "include", "exclude", "item_id", "quantity")
    meets = (F.col("product_key") == F.col("r_key")) & (F.col("base_unit") == F.col("unit")) & F.call_function("rlike", F.col("package_key"),
        F.col("include")) & ~F.coalesce(F.call_function("rlike", F.col("package_key"), F.col("exclude")), F.lit(False))
    read = parsed.where("is_comparable").select("package_key", "base_unit", "content")
    texts = raw.select("product", "package").distinct().withColumns({"product_key": T.canonical_key("product"), "package_key": T.canonical_key("package")})
    kinds = texts.join(read, "package_key").join(r, meets).select("product", "package", "product_key", "package_key", "item_id", "quantity", "content")
    named = raw.join(small_side(written(kinds)), ["product", "package"]).select(
        F.col("product_key").alias("product"), "package_key", T.canonical_key("brand").alias("brand"), price.alias("price"), T.parse_date_any(F.col("day")).alias("date"),
        F.concat_ws("|", *[F.coalesce(T.canonical_key(c), F.lit("")) for c in ("store", "address", "state", "municipality")]).alias("store"),
        F.concat_ws("|", T.canonical_key("state"), T.canonical_key("municipality")).alias("place"), T.canonical_key("chain").alias("chain"), "item_id", "quantity", "content",
    ).where(F.col("price").isNotNull() & F.col("date").isNotNull())
    none = F.col("brand").isin(*NO_BRAND) | F.col("brand").isNull()
    named = named.withColumn("brand", F.when(none, "SIN MARCA").otherwise(F.col("brand")))
    once = named.groupBy("product", "package_key", "brand", "store", "place", "chain", "date", "price").agg(F.min(F.struct("item_id", "quantity", "content")).alias("m"))
    monday = F.date_sub("date", F.weekday("date"))
    unit_price = rounded(F.col("price") / F.col("m.content"), 4).alias("unit_price")
    own = once.select("place", "chain", "m.item_id", "m.quantity", unit_price, monday.alias("week"))
    windows = rolling_weeks(own, params.previous_weeks)
    per = windows.groupBy("place", "week", "chain", "item_id", "quantity").agg((F.percentile("unit_price", 0.5) * F.col("quantity")).alias("cost"))
    return per.groupBy("place", "week", "chain").agg(rounded(F.sum("cost")).alias("cost"), F.count("*").alias("n_items"))
