"""Each query against its SQL on the small tables."""

from __future__ import annotations

import os
import unicodedata

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables aren't here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    value = lambda x: None if x is None or x is pd.NA or x != x else x if isinstance(x, (int, float, bool)) else str(x).replace(" 00:00:00", "")
    return sorted(repr(tuple(map(value, r))) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_sql(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = con.execute(entry.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_package_parse_all_keeps_every_part(spark, tmp_path):
    rows = [(k, 7 + k, f"name {k}", "TYPE") for k in range(12)]
    spark.createDataFrame(rows, "p_partkey long, p_size int, p_name string, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    got = {r.product_id: r for r in entry.queries()["package_parse_all"](spark, str(tmp_path)).collect()}
    assert sorted(got) == list(range(12))
    for k in (4, 10):
        assert got[k].package == f"Frasco {7 + k} gr. o {8 + k} gr."
        assert (got[k].base_unit, got[k].content, got[k].rule, got[k].needs_review) == ("kg", round((7 + k) * 0.001, 6), "alternatives", True)


def test_canonical_key_all_folds_whole_texts(spark, tmp_path):
    head = "le même début " * 8
    rows = [(1, head + "Café  au lait. . "), (2, head + "cafe au\nlait"), (3, head + "thé"), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    start = "LE MEME DEBUT " * 8
    got = {r.doc_id: r.key for r in entry.queries()["canonical_key_all"](spark, str(tmp_path)).collect()}
    assert got == {1: start + "CAFE AU LAIT", 2: start + "CAFE AU LAIT", 3: start + "THE", 4: None}


def test_lost_char_correction_all_against_brute_force(spark, tmp_path):
    long = "Der Bär läuft über die Straße, señor. " * 2500
    texts = [
        (long + "Ende", "de"), (long + "Ändé", "de"), (long + "?nd?", "de"), ("Café?", "fr"), ("Caf? ÉTÉ", None), ("Café ÉTÉ", None), ("caf\u00ea ÉTÉ", "xx"), ("Caf? ETE", "en"),
        ("a?b", "en"), ("x" * 70 + "é", "es"), ("x" * 70 + "ó", "es"), ("x" * 70 + "É", "es"), ("\\Qé\\E.*", "fr"), ("\\q?\\e.*", "fr"), ("?", "en"), (None, "en"), ("", "en"), ("Pan", "es"),
    ]
    spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    letters = "éèêçñöäüßíóá"
    values = {t for t, _ in texts if t is not None}
    values |= {t.translate(str.maketrans(letters, "?" * len(letters))) for t in values if set(letters) & set(t)}
    key = lambda t: "".join(c for c in unicodedata.normalize("NFD", " ".join(t.replace("ß", "SS").split()).upper()) if c.isascii()).rstrip(" .")

    def fits(d, c):
        if len(d) != len(c) or "?" in c or c.isascii():
            return False
        return all(not b.isascii() if a == "?" else a.lower() == b.lower() for a, b in zip(d, c, strict=True))

    want = {}
    for d in values:
        if "?" in d:
            found = [c for c in values if fits(d, c)]
            n = len({key(c) for c in found})
            best = min(found, key=lambda c: (-sum(not x.isascii() for x in c), c.encode()), default=d)
            want[d] = (n, best if n == 1 else d, n != 1)
    got = {r.value: (r.candidates, r.corrected, r.needs_review) for r in entry.queries()["lost_char_correction_all"](spark, str(tmp_path)).collect()}
    assert got == want and {n for n, _, _ in want.values()} == {0, 1, 2}
