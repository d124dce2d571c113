"""Numbers without one task, sketches that merge, windows that don't replicate rows."""

from __future__ import annotations

import datetime as dt
import os
import random
import statistics
from collections import defaultdict
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wicker.functions import sketches as S
from wicker.functions.storage import exclusive_prefix, numbered
from wicker.operators import normalize, validation
from wicker.params import Params
from wicker.plans import marts


def test_numbers_follow_the_order_over_partitions(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abc"), rng.randrange(50), i) for i in range(500)] + [(None, 7, 900), ("b", None, 901)]
    df = spark.createDataFrame(rows, "k string, n int, id int").repartition(6)
    got = numbered(df, [F.col("k").asc_nulls_last(), F.desc("n"), F.col("id").asc()], "place", partitions=5).orderBy("place").collect()
    assert [r.place for r in got] == list(range(1, len(rows) + 1))
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", -(r[1] if r[1] is not None else -1), r[2]))
    assert [r.id for r in got] == [r[2] for r in want]
    assert numbered(df.limit(0), ["k"], "place").count() == 0
    ids = {(r.k, r.n): r.i for r in normalize.dense_id(df, ["k", "n"], "i").collect()}
    order = sorted({(r[0], r[1]) for r in rows}, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0))
    assert [ids[x] for x in order] == list(range(1, len(order) + 1)) and normalize.dense_id(df, ["k", "n"], "i").count() == len(rows)


def test_no_window_without_a_partition(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(50)], "k int, n int")
    for plan in (normalize.dense_id(df, ["k"], "i"), numbered(df, ["n"], "i")):
        assert "Exchange SinglePartition" not in plan._jdf.queryExecution().toString()


def test_exclusive_prefix(spark):
    df = spark.createDataFrame([(3, 5, 1), (1, 2, None), (2, 0, 4)], "part int, a long, b long")
    got = {r.part: (r.x, r.y) for r in exclusive_prefix(df, "part", {"a": "x", "b": "y"}).collect()}
    assert got == {1: (0, 0), 2: (2, 0), 3: (2, 4)}
    assert exclusive_prefix(df.limit(0), "part", {"a": "x"}).count() == 0


# --- sketches -----------------------------------------------------------------------


def test_distinct_counts_merge_within_their_bound(spark):
    df = spark.range(60000).select((F.col("id") % 13).alias("file"), (F.col("id") % 7).alias("week"), (F.col("id") % 20011).cast("string").alias("many"), (F.col("id") % 5).alias("few"), F.when(F.col("id") % 3 > 0, " ").alias("blank"))
    columns = ["many", "few", "blank"]
    kept = S.distinct_sketches(df, ["file", "week"], columns).cache()
    for by in ([], ["file"], ["week"]):
        exact = {(*[r[b] for b in by], c): r[c] for r in df.groupBy(*by).agg(*[F.countDistinct(c).alias(c) for c in columns]).collect() for c in columns}
        for r in S.merged_distinct(kept, by, columns).collect():
            n = exact[(*[r[b] for b in by], r.column)]
            assert abs(r.n_distinct - n) <= S.distinct_error() * n and (n > 100 or r.n_distinct == n)
            assert r.n_empty == (0 if r.column != "blank" else r.n_rows)
    (r,) = S.merged_distinct(S.distinct_sketches(df.limit(0), [], ["few"]), [], ["few"]).collect()
    assert r.n_distinct == 0


def test_a_cube_gives_medians_of_any_filter_within_their_rank(spark):
    rng = np.random.default_rng(5)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(7 * int(w)), int(p), float(x), int(s)) for w, p, x, s in zip(rng.integers(0, 30, 20000), rng.integers(0, 9, 20000), rng.lognormal(2, 1, 20000).round(4), rng.integers(0, 400, 20000), strict=True)]
    df = spark.createDataFrame(rows, "week date, place_id int, price double, store int")
    cells = S.cube(df, ["week", "place_id"], "price", {"cheap": (F.col("price") < 5).cast("long")}, "store").cache()
    for where in ("place_id = 3", "place_id > 1 AND week < '2024-05-01'", "true"):
        chosen = [r for r in df.where(where).collect()]
        x = np.sort([r.price for r in chosen])
        got = S.rolled_up(cells.where(where), [], {"low": 0.1, "median": 0.5}, ["cheap"], "stores").first()
        assert got.n == len(x) and got.cheap == (x < 5).sum() and abs(got.mean - x.mean()) < 1e-6
        for q, p in ((got.low, 0.1), (got.median, 0.5)):
            assert np.searchsorted(x, q, "left") / len(x) <= p + S.rank_error() and np.searchsorted(x, q, "right") / len(x) >= p - S.rank_error()
        exact = len({r.store for r in chosen})
        assert abs(got.stores - exact) <= S.distinct_error() * exact
    periods = {r.period: r.n for r in S.rolled_up(S.by_period(cells, "2024-03-04", "2024-03-31"), ["period"], {"median": 0.5}).collect()}
    assert periods == {"current": sum(dt.date(2024, 3, 4) <= r[0] <= dt.date(2024, 3, 31) for r in rows), "previous": sum(dt.date(2024, 2, 5) <= r[0] <= dt.date(2024, 3, 3) for r in rows)}


# --- rolling windows ------------------------------------------------------------------


def rolling_rows():
    rng = random.Random(9)
    weeks = [dt.date(2024, 1, 1) + dt.timedelta(7 * i) for i in (0, 1, 2, 5, 6, 9)]
    out = []
    for _ in range(400):
        w = rng.choice(weeks)
        price = rng.choice([1.0, 1.5, 2.0, 2.25, None])
        out.append((rng.choice("AB"), rng.randrange(2), w, rng.choice("xyz"), price, rng.randrange(5), rng.randrange(9), w + dt.timedelta(rng.randrange(7))))
    return out


@pytest.mark.parametrize("previous", [0, 1, 4])
def test_rolling_prices_against_brute_force(spark, previous):
    rows = rolling_rows()
    df = spark.createDataFrame(rows, "chain string, place_id int, week date, item string, unit_price double, store_id int, product_id int, date date").repartition(3)
    got = {(r.chain, r.place_id, r.week, r.item): r for r in marts.rolling_item_price(df, replace(Params(), previous_weeks=previous)).collect()}
    held = defaultdict(list)
    first, last = min(r[2] for r in rows), max(r[2] for r in rows)
    for r in rows:
        for k in range(previous + 1):
            w = r[2] + dt.timedelta(7 * k)
            if w <= last:
                held[r[0], r[1], w, r[3]].append(r)
    assert got.keys() == held.keys()
    for key, own in held.items():
        prices = [r[4] for r in own if r[4] is not None]
        want = (statistics.median(prices) if prices else None, min(prices, default=None), max(prices, default=None), len(own), len({r[5] for r in own}), len({r[6] for r in own}), len({r[7] for r in own}), key[2] - dt.timedelta(7 * previous) >= first)
        g = got[key]
        assert (g.median_price, g.min_price, g.max_price, g.n_observations, g.n_stores, g.n_products, g.n_days, g.window_complete) == want


def test_no_shuffle_follows_the_replication_of_weeks(spark):
    df = spark.createDataFrame(rolling_rows(), "chain string, place_id int, week date, item string, unit_price double, store_id int, product_id int, date date")
    counted = df.groupBy(*marts.CELL, "item", "unit_price").agg(F.count("*").alias("n")).repartition("chain", "place_id", "item")
    plan = marts.rolling_weeks(counted, 4).groupBy(*marts.CELL, "item").agg(F.sum("n"))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") > plan.index("Generate")  # plans read upwards


def test_rolling_prices_shuffle_cells_instead_of_prices(spark, monkeypatch):
    """Grouped by price, nearly every observation was a group with three sets, shuffled twice."""
    plans = []
    monkeypatch.setattr(marts, "written", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    df = spark.createDataFrame(rolling_rows(), "chain string, place_id int, week date, item string, unit_price double, store_id int, product_id int, date date")
    assert marts.rolling_item_price(df).count() > 0
    keys = [line[line.index("keys=[") : line.index("], functions")] for line in plans[0].split("\n") if "keys=[" in line]
    assert keys and not any("unit_price" in k for k in keys), keys


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the tables aren't here")
@pytest.mark.parametrize("name", ["run_summary", "dashboard_weeks"])
def test_rolling_prices_are_worked_out_once(spark, monkeypatch, name):
    calls, rolling = [], marts.rolling_item_price
    monkeypatch.setattr(marts, "rolling_item_price", lambda *a: calls.append(1) or rolling(*a))
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0 and len(calls) == 1


def test_coverage_does_not_repeat_rows_for_its_distinct_counts(spark):
    df = spark.createDataFrame(rolling_rows(), "chain string, place_id int, week date, item string, unit_price double, store_id int, product_id int, date date")
    flagged = df.withColumns({"is_outlier": F.lit(False), "content": F.lit(1)})
    basket = df.select("item", F.lit(1.0).alias("quantity")).distinct()
    out = marts.coverage(flagged, marts.basket_cost(marts.rolling_item_price(df), basket), basket)
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    want = {(r.chain, r.place_id, r.week): (r.s, r.p, r.d) for r in df.groupBy(*marts.CELL).agg(F.countDistinct("store_id").alias("s"), F.countDistinct("product_id").alias("p"), F.countDistinct("date").alias("d")).collect()}
    assert {(r.chain, r.place_id, r.week): (r.n_stores, r.n_products, r.n_days) for r in out.collect()} == want


def test_validation_cells_avoid_every_window_with_an_outlier(spark):
    week = lambda i: dt.date(2024, 1, 1) + dt.timedelta(7 * i)
    savings = spark.createDataFrame([(1, week(i), 5 - i) for i in range(5)] + [(2, week(0), 2)], "place_id int, week date, chains_compared int")
    bad = spark.createDataFrame([(1, week(0))], "place_id int, week date")
    for previous, first in ((0, 1), (1, 2), (2, 3)):
        got = {r.place_id: r.week for r in validation.pick_cells(savings, bad, 6, replace(Params(), previous_weeks=previous)).collect()}
        assert got == {1: week(first), 2: week(0)}


# --- steps that one key or every row would hold up ------------------------------------


def test_consolidation_shuffles_no_rows_by_catalog(spark):
    """Five catalogs in 64 partitions: a join by catalog would bring a third of all rows into one task."""
    from wicker.dimension_queries import CATALOGS
    from wicker.operators import dimensions as D

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        seed = spark.createDataFrame(CATALOGS, "catalog string, bit int, in_scope boolean")
        day, rows = dt.date(2024, 1, 1), []
        for i in range(600):
            rows.append((f"p{i % 9}", "Bolsa 1 KG", "b", ["Basicos", "Pacic", "Otro"][i % 3], "1.5" if i % 7 else "2.5", float(i % 7 == 0) + 1.5, day + dt.timedelta(i % 5), f"s{i % 4}", "a", "x", "y", "01-2024_Q1.csv"))
        staged = spark.createDataFrame(rows, "product string, package string, brand string, catalog string, price_text string, price double, date date, store string, address string, state string, municipality string, source_file string")
        skus = staged.select(*D.SKU).distinct().withColumn("product_id", F.md5("product"))
        stores = staged.select(*D.STORE).distinct().withColumn("store_id", F.md5("store"))
        out = D.consolidate_observations(staged, skus, stores, seed)
        got = {(r.product, r.store, r.date, r.price): (r.n_source_rows, r.catalog_mask, r.has_conflict) for r in out.join(stores.select("store", "store_id"), "store_id").collect()}
        want, prices = defaultdict(lambda: [0, None]), defaultdict(set)
        for p, _, _, catalog, _, price, date, store, *_ in rows:
            cell, mask = want[p, store, date, price], {"Basicos": 1, "Pacic": 16}.get(catalog)
            cell[0] += 1
            cell[1] = cell[1] if mask is None else (cell[1] or 0) | mask
            prices[p, store, date].add(price)
        assert got == {k: (n, mask, len(prices[k[:3]]) > 1) for k, (n, mask) in want.items()}
        plan = D.consolidate_observations(staged, skus, stores, seed)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("rightHint=(strategy=broadcast)") == 3, plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_lines_that_no_rule_fits_get_no_keys(spark):
    """Keys of stores, brands and chains are made after the join with the products that a rule fits."""
    raw = spark.createDataFrame(
        [("Hot Ring.", "Bolsa 2 KG", "x", "3.00", "2024/01/02", "c", "s", "a", "st", "m"), ("HOT  RING", "Bolsa 2  KG", "X.", "3.00", "02/01/2024", "C", "S", "A", "ST", "M"),
            ("old rod", "Bolsa 2 KG", "x", "9.00", "2024/01/02", "c", "s", "a", "st", "m"), ("hot ring", "Bolsa 2 KG", "x", "n/d", "2024/01/02", "c", "s", "a", "st", "m"), (None, None, None, "1", "2024/01/02", "c", "s", "a", "st", "m")],
        "product string, package string, brand string, price string, day string, chain string, store string, address string, state string, municipality string",
    )
    rules = spark.createDataFrame([("HOT RING", "kg", "KG$", None, "rings", 2.0)], "key string, unit string, include string, exclude string, item_id string, quantity double")
    parsed = spark.createDataFrame([("BOLSA 2 KG", "kg", 2.0, True)], "package_key string, base_unit string, content double, is_comparable boolean")
    out = validation.recompute_from_raw(raw, rules, parsed)
    assert sorted((str(r.week), r.cost, r.n_items, r.place, r.chain) for r in out.collect()) == [("2024-01-01", 3.0, 1, "ST|M", "C"), ("2024-01-08", 3.0, 1, "ST|M", "C")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join Inner") :].split("\n")
    assert not any("regexp_replace" in line for line in below), plan


# --- disk -----------------------------------------------------------------------------


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_") and n.endswith(".data")}


def test_written_tables_leave_no_shuffle_behind(spark):
    """What a step had shuffled stayed beside its table until the driver collected garbage."""
    from wicker.functions.storage import written

    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", _shuffle_files(spark)
    was = spark.conf.get(key)
    table = written(spark.range(50000).groupBy((F.col("id") % 7919).alias("k")).agg(F.count("*").alias("n")))
    assert not _shuffle_files(spark) - before and spark.conf.get(key) == was
    assert (table.count(), table.agg(F.sum("n")).first()[0]) == (7919, 50000)
    with pytest.raises(Exception, match="no_such"):
        written(spark.range(3).where(F.raise_error(F.lit("no_such"))))
    assert spark.conf.get(key) == was


def _facts(spark, monkeypatch, name):
    """What the query hands to the outlier flags, as (columns and types, rows)."""
    seen, flag = [], marts.flag_outliers
    monkeypatch.setattr(marts, "flag_outliers", lambda obs, *a: seen.append(obs) or flag(obs, *a))
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
    return seen[0]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the tables aren't here")
@pytest.mark.parametrize("name", ["basket_observations", "rolling_basket_price"])
def test_the_basket_consolidates_only_its_products(spark, monkeypatch, name):
    fact = _facts(spark, monkeypatch, name)
    assert sorted(fact.columns) == ["date", "price", "product_id", "store_id"]
    products = entry.queries()["dim_product"](spark, "/root/testdata/sf0.001").where("item_id IS NOT NULL AND is_comparable")
    assert {r[0] for r in fact.select("product_id").distinct().collect()} <= {r[0] for r in products.select("product_id").collect()}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the tables aren't here")
def test_the_recomputation_keeps_narrow_lines_of_all_products(spark, monkeypatch):
    fact = _facts(spark, monkeypatch, "recomputed_from_raw")
    assert sorted(fact.dtypes) == [("date", "date"), ("price", "decimal(12,2)"), ("product_id", "bigint"), ("store_id", "bigint")]
    assert fact.count() == entry.queries()["observations_by_day"](spark, "/root/testdata/sf0.001").count()


def test_statistics_of_a_key_are_dealt_once(spark):
    from wicker.functions.stats import robust_stats

    df = spark.createDataFrame([(i % 9, float(i % 23)) for i in range(900)], "k int, x double")
    plan = robust_stats(df, "k", "x")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan and "ENSURE_REQUIREMENTS" not in plan.replace("EXECUTOR_BROADCAST", ""), plan


def test_stores_are_spanned_without_sorting_their_lines(spark):
    from wicker.operators import dimensions as D

    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(i)
    rows = [
        ("s", "a", "x", "y", "old", "F", 20.0, -100.0, day(0)), ("s", "a", "x", "y", "new", None, 99.0, -100.0, day(5)), ("s", "a", "x", "y", "newer", "G", None, None, day(5)),
        ("s", "a", "x", "y", "undated", "Z", 21.0, -101.0, None), ("s", "a", "x", "y", "old", "F", 20.0, -100.0, day(2)), (None, "a", "x", "y", None, None, 20.0, -100.0, None),
    ]
    staged = spark.createDataFrame(rows, "store string, address string, state string, municipality string, chain string, format string, latitude double, longitude double, date date")
    out = D.store_map(staged)
    got = {r.store: (r.chain, r.format, r.latitude, r.longitude, r.first_date, r.last_date, r.n_rows) for r in out.collect()}
    assert got == {"s": ("newer", "G", 20.0, -100.0, day(0), day(5), 5), None: (None, None, None, None, None, None, 1)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("HashAggregate") :]  # plans read upwards: the first step over the lines
    assert "SortAggregate" not in below, plan


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the tables aren't here")
def test_raw_lines_meet_small_tables_without_a_shuffle(spark):
    from wicker.plans.raw import raw_prices

    plan = raw_prices(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 4, plan
