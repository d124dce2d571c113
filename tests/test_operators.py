"""Small cases of the price-basket operators."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from wicker.functions import text as T
from wicker.functions.stats import latest_value, robust_stats
from wicker.operators import normalize, packages, profile, quality, validation
from wicker.plans import bi, marts
from wicker.sources import files, publish

CASES = [  # text, base unit, content, review, rule, reason
    ("Jugo de uva 1 L", "l", 1.0, False, "quantity", None),
    ("Jugo de uva 1000 ml.", "l", 1.0, False, "quantity", None),
    ("Aceite 1LT", "l", 1.0, False, "quantity", None),
    ("Saco de 2,5 kilos", "kg", 2.5, False, "quantity", None),
    ("Harina 750 Grs.con levadura", "kg", 0.75, False, "quantity", None),
    ("Mezcla 80/20 en 3 kg", "kg", 3.0, False, "quantity", None),
    ("Tarro A4 con tapa 200 g", "kg", 0.2, False, "quantity", None),
    ("Charola con 6 vasos de 125 gr", "kg", 0.75, False, "pack", None),
    ("Estuche C/ 10 Botellas 60 ml", "l", 0.6, False, "pack", None),
    ("Refresco 6X250ML", "l", 1.5, False, "pack", None),
    ("Te 40 gr. (20 sobres de 2 gr.)", "kg", 0.04, False, "pack", None),
    ("Te 90 gr. (20 sobres de 2 gr.)", "kg", 0.04, True, "pack", "pack_against_total"),
    ("Malla 3 latas de 1.250 gr", "kg", 3.75, True, "pack", "ambiguous_separator"),
    ("Pan, pieza de 55 a 70 gr", "piece", 1.0, False, "piece_with_range", None),
    ("Frasco 45 o 50 gr.", "kg", 0.045, True, "alternatives", "alternatives"),
    ("Bote 1 lt. / 1.2 lt.", "l", 1.0, True, "alternatives", "alternatives"),
    ("Bote 300/330 ml", "l", 0.3, True, "alternatives", "alternatives"),
    ("Kit 2 kg y 250 ml", "kg", 2.0, True, "quantity", "mixed_units"),
    ("Costal 5 kg, rinde 400 gr", "kg", 5.0, True, "quantity", "several_quantities"),
    ("Tubo 2.750 gr", "kg", 2.75, True, "quantity", "ambiguous_separator"),
    ("Bidon 4.125 lts", "l", 4.125, True, "quantity", "ambiguous_separator"),
    ("Surtido 90 g (60 g mora y 30 g pera)", "kg", 0.09, False, "quantity_with_parts", None),
    ("Queso, contenido variable, precio por KG", "kg", 1.0, False, "variable_content", None),
    ("Toallas 24 o 28 piezas", "piece", 24.0, True, "alternatives", "alternatives"),
    ("Servilletas C/150 blancas", "piece", 150.0, False, "count_with_slash", None),
    ("Papel 12 rollos dobles", "piece", 12.0, False, "count", None),
    ("Estuche 5 cajas. 20 sobres C/U", "piece", 20.0, True, "count", "count_per_pack"),
    ("Analgesico 16 tabletas de 200 mg", "piece", 16.0, False, "count", None),
    ("Rastrillo con 3. Azul", "piece", 3.0, False, "count_after_con", None),
    ("Apio, manojo", "piece", 1.0, False, "implicit_count", None),
    ("Huevo, docena", "piece", 12.0, False, "implicit_count", None),
    ("Bolsa 0 kg", "kg", 0.0, True, "quantity", "content_not_positive"),
    ("A granel", None, None, True, "none", "no_quantity"),
    ("", None, None, True, "none", "no_quantity"),
    (None, None, None, True, "none", "no_quantity"),
]


def test_packages(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, package string")
    got = {r.i: r for r in packages.parse_packages(df, "package").collect()}
    assert [(got[i].base_unit, got[i].content, got[i].needs_review, got[i].rule, got[i].review_reason) for i in range(len(CASES))] == [c[1:] for c in CASES]
    by = {c[0]: got[i] for i, c in enumerate(CASES)}
    assert (by["Te 40 gr. (20 sobres de 2 gr.)"].confidence, by["Charola con 6 vasos de 125 gr"].confidence, by["Refresco 6X250ML"].pack_units) == ("high", "medium", 6)
    assert (by["Papel 12 rollos dobles"].count_subtype, by["Huevo, docena"].count_subtype, by["Apio, manojo"].count_subtype) == ("ROLLO", "PIEZA", "MANOJO")


def test_package_decisions(spark):
    parsed = packages.parse_packages(spark.createDataFrame([("A granel",), ("1 kg",)], "package string"), "package")
    fix = spark.createDataFrame([("A GRANEL", "correct", "kg", 2.0)], "package_key string, decision string, base_unit string, content double")
    got = {r.package_key: r for r in packages.comparable(packages.apply_package_decisions(parsed, fix)).collect()}
    assert (got["A GRANEL"].content, got["A GRANEL"].is_comparable, got["1 KG"].method) == (2.0, True, "auto")
    with pytest.raises(Exception, match="unknown decision"):
        packages.apply_package_decisions(parsed, fix.withColumn("decision", F.lit("maybe"))).collect()


def test_canonical_key(spark):
    df = spark.createDataFrame([("  Café   con leche. ",), (" . ",), (None,)], "x string")
    assert [r.k for r in df.select(T.canonical_key("x").alias("k")).collect()] == ["CAFE CON LECHE", None, None]


def test_lost_characters(spark):
    names = ["Azúcar", "AZÚCAR", "Az?car", "Pan", "P?n", "Léon", "Lóon", "L?on", "Ñandú", "?and?", "Ñand?"]
    got = {r.value: r for r in normalize.correct_lost_chars(spark.createDataFrame([("c", n) for n in names], "column string, value string")).collect()}
    assert got["Az?car"].corrected in ("Azúcar", "AZÚCAR") and not got["Az?car"].needs_review
    assert got["P?n"].needs_review and got["L?on"].candidates == 2
    assert got["?and?"].corrected == "Ñandú" and got["Ñand?"].corrected == "Ñandú"


def test_latest_value_and_stats(spark):
    rows = [(1, "a", 1), (1, None, 3), (1, "b", 2), (1, "z", None), (2, None, 1), (3, "undated", None)]
    df = spark.createDataFrame(rows, "k int, v string, t int")
    assert {r.k: r.v for r in df.groupBy("k").agg(latest_value("v", "t", "v").alias("v")).collect()} == {1: "b", 2: None, 3: None}
    prices = spark.createDataFrame([(1, float(p)) for p in (1, 2, 3, 4, 0)], "k int, price double")
    row = robust_stats(prices, "k", "price").first()
    assert (row.n, row.median) == (4, 2.5)


def _obs(spark):
    day = dt.date(2024, 1, 1)
    rows = [(1 + s, s, f"C{s}", f"G{s}", 1, day + dt.timedelta(7 * w), day + dt.timedelta(7 * w), i, 1, 10.0 * (s + 1), 10.0 * (s + 1) + w) for s in (0, 1) for w in range(12) for i in ("x", "y") if (s, w, i) != (1, 5, "y")]
    return spark.createDataFrame(rows, "product_id int, store_id int, chain string, chain_group string, place_id int, date date, week date, item string, content int, price double, unit_price double")


def test_marts(spark):
    obs = _obs(spark)
    basket = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "item string, quantity double")
    items = marts.rolling_item_price(obs)
    baskets = marts.basket_cost(items, basket)
    savings = marts.paired_savings(baskets, obs.select("chain", "chain_group").distinct())
    decomposed = marts.item_decomposition(items, basket, savings)
    assert baskets.where("NOT window_complete").select("week").distinct().count() == 1
    assert savings.where("is_cheapest").select("chain").distinct().collect()[0].chain == "C0"
    assert quality.decomposition_gap(decomposed, savings).count() == 0
    assert quality.unique_combination(baskets, ["chain", "place_id", "week"]).count() == 0
    again = validation.recompute_cells(obs, baskets.select("place_id", "week").distinct(), basket)
    assert validation.compare(again, baskets.withColumn("basket_cost", F.col("partial_cost"))).where("NOT agrees").count() == 0
    first = bi.fixed_panel_index(baskets).where("scope = 'ALL'").orderBy("week").collect()
    assert len(first) == 11 and first[0]["index"] < 100 < first[-1]["index"]
    flagged = marts.flag_outliers(obs.withColumn("price", F.when(F.col("date") == dt.date(2024, 1, 1), 1e4).otherwise(F.col("price"))))
    assert marts.coverage(flagged, baskets, basket).agg(F.sum("n_outliers")).first()[0] == flagged.where("is_outlier").count() == 4


def test_empty_tables(spark):
    obs = _obs(spark).limit(0)
    basket = spark.createDataFrame([("x", 1.0)], "item string, quantity double")
    items = marts.rolling_item_price(obs)
    baskets = marts.basket_cost(items, basket)
    assert items.count() == baskets.count() == bi.fixed_panel_index(baskets).where("scope <> 'ALL'").count() == 0


def test_rules(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "p double")
    got = {r.id: r for r in quality.evaluate_rules(df, [quality.Rule("a", F.count_if(F.col("p") <= 0), "==", 0), quality.Rule("b", quality.percent(F.col("p").isNull()), "<=", 50, "warning")]).collect()}
    assert (got["a"].value, got["a"].passed, got["b"].passed) == (1.0, False, True)
    assert quality.expression_is_true(df, "p > 0").count() == 1 and quality.not_null(df, "p").count() == 1
    assert quality.duplicates(df.union(df), ["p"]).first().n_surplus == 3
    over = spark.createDataFrame([("a", 1, 5), ("b", 4, 9), ("c", 10, 11)], "file string, first_date int, last_date int")
    assert [r.file for r in profile.overlapping_files(over, "file").collect()] == ["a"]


def test_files(spark, tmp_path):
    head = "name,price,day"
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbf" + f"{head}\r\n\"Café, molido\",1.5,2024/01/02\r\nPan,2,2024/01/03\r\n".encode())
    (tmp_path / "b.csv").write_bytes(f"{head}\r\nAzúcar €,3,02/01/2024\r\n".encode("windows-1252"))
    (tmp_path / "c.csv").write_bytes(b"price,name,day\n1,x,y\n")
    (tmp_path / "d.csv").write_bytes(f"{head}\n\"two\nlines\",1,2024/01/02\n".encode())
    inventory = files.file_inventory(spark, str(tmp_path / "*.csv")).cache()
    by = {r.file[-5:]: r for r in inventory.collect()}
    assert (by["a.csv"].bom, by["a.csv"].encoding, by["a.csv"].lines, by["a.csv"].crlf, by["a.csv"].delimiter) == (True, "UTF-8", 3, True, ",")
    assert by["b.csv"].encoding == "windows-1252"
    status = {r.file[-5:]: r.status for r in files.check_headers(inventory, ["name", "price", "day"], ["note"]).collect()}
    assert status == {"a.csv": "ok", "b.csv": "ok", "c.csv": "moved", "d.csv": "ok"}
    good, bad = files.read_with_rejects(spark, [str(tmp_path / "b.csv")], ["name", "price", "day"], files.Dialect("windows-1252"))
    assert good.first().name == "Azúcar €" and bad.count() == 0
    one = inventory.where("file LIKE '%a.csv'")
    changed = one.withColumn("sha256", F.lit("x"))
    assert [r.status for r in files.verify_manifest(one, changed).collect()] == ["corrupt"]


def test_publish(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2024, 1, 1) + dt.timedelta(7 * i), i) for i in range(10)], "week date, n int")
    target = str(tmp_path / "pub")
    assert publish.publish(spark, [publish.PublishSpec("t", df, recent_weeks=3)], target) == {"t": 3}
    with pytest.raises(TypeError):
        publish.publish(spark, [publish.PublishSpec("t", df.withColumn("a", F.array("n")))], target)
    assert publish.published(spark, target, "t").count() == 3
    catalog = spark.createDataFrame([(i, i) for i in range(9)], "value int, position int")
    assert publish.encode_by_catalog(df.where("n < 9"), "n", catalog).count() == 9
    with pytest.raises(Exception, match="not in the catalog"):
        publish.encode_by_catalog(df, "n", catalog).collect()


def test_physical_profile_and_versions(spark, tmp_path):
    (tmp_path / "a.csv").write_text('name,price,day\n"a, b",1,2024/01/02\nc,2,03/01/2024\nd,2\ne,2,x,y\n')
    path = [str(tmp_path / "a.csv")]
    got = {r.date_format: (r.n_rows, r.n_bad_width) for r in files.physical_profile(spark, path, ["name", "price", "day"], "day").collect()}
    assert got["yyyy/mm/dd"] == (1, 0) and got["dd/mm/yyyy"] == (1, 0) and sum(n for n, _ in got.values()) == 4 and sum(b for _, b in got.values()) == 2
    good, bad = files.read_with_rejects(spark, path, ["name", "price", "day"])
    assert good.count() == 2 and {(r.line, r.n_fields, r.error) for r in bad.collect()} == {("d,2", 2, "too few fields"), ("e,2,x,y", 4, "too many fields")}
    assert files.file_inventory(spark, path[0]).first().quotes == 2
    v = lambda *rows: spark.createDataFrame(rows, "file string, sha256 string")
    new, old = v(("a", "1"), ("b", "2"), ("c", "3")), v(("a", "1"), ("b", "9"), ("d", "4"))
    assert {r.file: r.state for r in files.classify_versions(new, old).collect()} == {"a": "unchanged", "b": "pending", "c": "new", "d": "absent"}
    assert {r.file: r.state for r in files.classify_versions(new, old, replace=True).collect()}["b"] == "replaced"
    assert files.merged_by_name(new, new.withColumn("note", F.lit("x"))).where("note IS NULL").count() == 3


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("á", 1), (None, 2)], "value string, n int")
    publish.save_tables({"t": df}, str(tmp_path / "tables"))
    assert publish.load_tables(spark, str(tmp_path / "tables"), ["t"])["t"].count() == 2
    publish.save_mapping(df, str(tmp_path / "map"))
    assert {r.value for r in files.load_seed(spark, str(tmp_path / "map"), "value string, n int").collect()} == {"á", None}
    assert publish.Layer().keep(spark, "a_view", df).count() == publish.Layer(str(tmp_path)).keep(spark, "a_table", df).count() == 2
    weeks = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 3))], "week date, date date")
    row = publish.publication_metadata(weeks, weeks, spark.createDataFrame([("f", 5)], "file string, n_rows long"), "v1").first()
    assert (row.last_week, row.last_date, row.n_files, row.n_rows, row.version) == (dt.date(2024, 1, 1), dt.date(2024, 1, 3), 1, 5, "v1")


def test_quantiles_of_all(spark):
    import numpy as np

    from wicker.functions.stats import quantiles_of_all

    rng = np.random.default_rng(3)
    for values in (rng.normal(0, 10, 500).round(2), np.r_[rng.integers(0, 5, 300), 1e9], np.array([4.0]), np.repeat(2.0, 9)):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
        got = quantiles_of_all(df, "x", {"a": 0.01, "b": 0.5, "c": 0.99}, pieces=16).first()
        assert np.allclose([got.a, got.b, got.c], np.quantile(values, [0.01, 0.5, 0.99]))
    assert quantiles_of_all(df.limit(0), "x", {"a": 0.5}).first().a is None


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the tables aren't here")
def test_lines_said_again_take_one_pass(spark):
    from wicker import profile_queries
    from wicker.plans.raw import raw_prices

    sf = "/root/testdata/sf0.001"
    out, raw = profile_queries._doubled(spark, sf), raw_prices(spark, sf)
    assert out._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet") == 1
    again = raw.where("price LIKE '%5'").unionByName(raw.where("price LIKE '%7'").withColumn("catalog", F.lit("Otro"))).unionByName(raw.where("price LIKE '%9'").withColumn("price", F.concat(F.lit("1"), "price")))
    want = raw.unionByName(again)
    assert out.columns == raw.columns and out.exceptAll(want).count() == 0 and want.exceptAll(out).count() == 0
