"""Quality rules with adaptive thresholds, in DataFrame functions only.

Each text is measured once (``measures``).  For every language and source a
quantile sketch of each measure is kept: counts in logarithmic buckets, so that
any quantile is known to within ``ACCURACY``.  Sketches are merged by adding
their counts: first over the tasks, then from sources to languages and to the
whole table, which groups of under ``MIN_ROWS`` rows fall back on.  A measure is
out of line if it lies beyond the quartiles of its group by more than ``REACH``
times their distance (or times the measure's least spread, where that is more).
The thresholds, one row for each language and source, are joined to the measures.

Null texts have no words; null languages and sources count as empty names.
Repeated rows get equal results.  Repeated 5-word windows are found by 64-bit
hashes of their words' hashes; very long texts are measured whole.  Other columns
are kept by ``keep_good``, whatever their names.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, small, text_of, written

BLANK = r"[\x20\x09-\x0D]"
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Relative error of a quantile, and the ratio of neighbouring buckets' bounds.
ACCURACY = 0.01
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
MIN_ROWS = 100
REACH = 3.0
#: Least spread of each measure, and whether values below the quartiles count too.
RATIOS = {"symbols": (0.05, False), "dup_lines": (0.15, False), "repeats": (0.06, False), "capitals": (0.05, False), "word_length": (0.75, True)}


def measures(docs: DataFrame, text: str = "text", p: str = "") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    and the ratios that the thresholds are for, each name with prefix ``p``."""
    t = text_of(text)
    c = lambda name: F.col(p + name)
    words = F.array_remove(F.split(t, BLANK + "+"), "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = docs.withColumns(
        {
            p + "words": words,
            p + "lines": lines,
            p + "n_symbols": F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long"),
            p + "n_capitals": F.regexp_count(t, F.lit("[A-ZÀ-ÖØ-Þ]")).cast("long"),
        }
    )
    df = df.withColumns(
        {
            p + "n_words": F.size(c("words")).cast("long"),
            p + "word_chars": F.length(F.array_join(c("words"), "")).cast("long"),
            p + "n_lines": F.size(c("lines")).cast("long"),
            p + "n_dup_lines": (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long"),
            p + "h": F.transform(c("words"), lambda x: F.xxhash64(x)),
        }
    ).drop(p + "words", p + "lines")
    n = F.size(c("h"))
    window = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*(F.get(c("h"), i + k) for k in range(WINDOW))))
    df = df.withColumn(p + "win", F.when(n >= WINDOW, window).otherwise(F.array().cast("array<bigint>"))).drop(p + "h")
    # Only texts with a window that comes twice have their windows sorted.
    twice = F.size(F.array_distinct(c("win"))) < F.size(c("win"))
    placed = F.array_sort(F.transform(c("win"), lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    df = df.withColumn(p + "placed", F.when(twice, placed)).drop(p + "win")
    s = c("placed")
    again = F.zip_with(s, F.slice(s, 2, F.greatest(F.size(s), F.lit(1))), lambda a, b: a["x"] == b["x"])
    df = df.withColumn(p + "again", again)
    found = F.filter(s, lambda e, j: F.coalesce(F.get(c("again"), j), F.lit(False)) | F.coalesce(F.get(c("again"), j - 1), F.lit(False)))
    df = df.withColumn(p + "at", F.array_sort(F.transform(found, lambda e: e["i"]))).drop(p + "placed", p + "again")
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    step = lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), x - acc["last"])).alias("n"))
    covered = F.aggregate(c("at"), start, step, lambda acc: acc["n"])
    df = df.withColumn(p + "n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop(p + "at")
    per = lambda a, b: F.when(c(b) > 0, c(a) / c(b)).otherwise(F.lit(0.0))
    return df.withColumns(
        {
            p + "symbols": per("n_symbols", "n_words"),
            p + "dup_lines": per("n_dup_lines", "n_lines"),
            p + "repeats": per("n_repeat_words", "n_words"),
            p + "capitals": per("n_capitals", "word_chars"),
            p + "word_length": per("word_chars", "n_words"),
        }
    )


def sketches(measured: DataFrame, lang: Column, source: Column, p: str = "") -> DataFrame:
    """lang, source, measure, bucket, n: a mergeable sketch of each measure for
    each language and source.  Bucket b > least holds values in
    (gamma^(b-1), gamma^b]; the least bucket holds zero."""
    each = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(p + m).alias("x")) for m in RATIOS])
    long = measured.select(lang.alias("lang"), source.alias("source"), F.inline(each))
    bucket = F.when(F.col("x") > 0, F.ceil(F.log("x") / F.log(F.lit(GAMMA)))).otherwise(F.lit(-(10**6))).cast("int")
    return long.groupBy("lang", "source", "measure", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    """Sketches of coarser groups: ``keys`` out of lang and source."""
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, keys: list[str], at: tuple[float, ...]) -> DataFrame:
    """keys, measure, rows, q0, q1, ...: quantiles of each group's sketch."""
    by = Window.partitionBy(*keys, "measure")
    run = sketch.withColumns({"below": F.sum("n").over(by.orderBy("bucket")), "rows": F.sum("n").over(by)})
    value = F.when(F.col("bucket") > -(10**6), 2 * F.pow(F.lit(GAMMA), F.col("bucket")) / (GAMMA + 1)).otherwise(F.lit(0.0))
    picks = [F.min(F.when(F.col("below") >= q * F.col("rows"), value)).alias(f"q{i}") for i, q in enumerate(at)]
    return run.groupBy(*keys, "measure").agg(F.first("rows").alias("rows"), *picks)


def thresholds(sketch: DataFrame) -> DataFrame:
    """lang, source and, for each measure, <measure>_low and <measure>_high."""
    at = (0.25, 0.75)
    own = quantiles(sketch, ["lang", "source"], at)
    lang = quantiles(merged(sketch, "lang"), ["lang"], at).select("lang", "measure", F.col("rows").alias("rows_l"), F.col("q0").alias("l0"), F.col("q1").alias("l1"))
    all_ = quantiles(merged(sketch), [], at).select("measure", F.col("q0").alias("a0"), F.col("q1").alias("a1"))
    level = own.join(lang, ["lang", "measure"]).join(all_, "measure")
    pick = lambda i: F.when(F.col("rows") >= MIN_ROWS, F.col(f"q{i}")).when(F.col("rows_l") >= MIN_ROWS, F.col(f"l{i}")).otherwise(F.col(f"a{i}"))
    level = level.select("lang", "source", "measure", pick(0).alias("low"), pick(1).alias("high"))
    cols = []
    for m, (least, both) in RATIOS.items():
        here = F.col("measure") == m
        reach = REACH * F.greatest(F.col("high") - F.col("low"), F.lit(least))
        cols.append(F.max(F.when(here, F.col("high") + reach)).alias(f"{m}_high"))
        cols.append(F.max(F.when(here, F.col("low") - reach if both else F.lit(-1.0))).alias(f"{m}_low"))
    return level.groupBy("lang", "source").agg(*cols)


def verdicts(measured: DataFrame, limits: DataFrame, lang: str, source: str, p: str = "") -> DataFrame:
    """``measured`` with base_failed and kept (names with prefix ``p``)."""
    names = {c: f"{p}limit_{c}" for c in limits.columns}
    limits = limits.withColumnsRenamed(names)
    same = measured[lang].eqNullSafe(limits[names["lang"]]) & measured[source].eqNullSafe(limits[names["source"]])
    joined = measured.join(small(limits), same)
    n, r = F.col(p + "n_words"), F.col(p + "n_repeat_words")
    base = (n < MIN_WORDS) | (100 * r > MAX_REPEAT_PERCENT * n)
    fine = F.lit(True)
    for m in RATIOS:
        fine = fine & (F.col(p + m) <= F.col(names[f"{m}_high"])) & (F.col(p + m) >= F.col(names[f"{m}_low"]))
    return joined.withColumns({p + "base_failed": base, p + "kept": ~base & fine}).drop(*names.values())


def judge(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", source: str = "source") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept of every row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(lang).alias("lang"), text_of(source).alias("source"), F.col(text).alias("text"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    measured = written(measures(rows).select("doc_id", "lang", "source", *base, *RATIOS))
    limits = thresholds(cut(sketches(measured, F.col("lang"), F.col("source"))))
    return verdicts(measured, cut(limits), "lang", "source").select("doc_id", *base, "base_failed", "kept")


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns only."""
    p = "qr__"
    while any(c.lower().startswith(p) for c in docs.columns):
        p = "_" + p
    named = docs.withColumns({p + "lang": text_of(lang), p + "source": text_of(source)})
    own = [p + x for x in ("lang", "source", "n_words", "n_repeat_words", *RATIOS)]
    # Written, since the thresholds and the filter both need the measures.
    measured = written(measures(named, text, p).select(*docs.columns, *own), "zstd")
    limits = cut(thresholds(cut(sketches(measured, F.col(p + "lang"), F.col(p + "source"), p))))
    judged = verdicts(measured, limits, p + "lang", p + "source", p)
    return judged.where(F.col(p + "kept")).select(*docs.columns)


def _oracle() -> str:
    bucket = f"CASE WHEN x > 0 THEN CAST(ceil(ln(x) / ln({GAMMA!r})) AS INT) ELSE -1000000 END"
    value = f"CASE WHEN bucket > -1000000 THEN 2 * power({GAMMA!r}, bucket) / ({GAMMA!r} + 1) ELSE 0.0 END"
    quantile = lambda keys: f"""
      SELECT {keys}measure, any_value(total) AS total, min(CASE WHEN below >= 0.25 * total THEN {value} END) AS q0,
             min(CASE WHEN below >= 0.75 * total THEN {value} END) AS q1
      FROM (SELECT *, sum(n) OVER (PARTITION BY {keys}measure ORDER BY bucket) AS below, sum(n) OVER (PARTITION BY {keys}measure) AS total
            FROM (SELECT {keys}measure, bucket, sum(n) AS n FROM sketch GROUP BY {keys}measure, bucket))
      GROUP BY {keys}measure"""  # noqa: E731
    limits = ", ".join(f"max(CASE WHEN measure = '{m}' THEN high + {REACH} * greatest(high - low, {least}) END) AS {m}_high, max(CASE WHEN measure = '{m}' THEN {f'low - {REACH} * greatest(high - low, {least})' if both else '-1.0'} END) AS {m}_low" for m, (least, both) in RATIOS.items())
    fine = " AND ".join(f"{m} <= {m}_high AND {m} >= {m}_low" for m in RATIOS)
    union = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, {m} AS x FROM m" for m in RATIOS)
    per = lambda a, b, name: f"CASE WHEN {b} > 0 THEN CAST({a} AS DOUBLE) / {b} ELSE 0.0 END AS {name}"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT rid, i, array_to_string(words[i:i + 4], ' ') AS s FROM w, unnest(range(1, len(words) - 3)) AS u(i) WHERE len(words) >= 5),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, unnest(range(0, 5)) AS u(k) GROUP BY rid),
b AS (SELECT w.doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(length(t) - length(regexp_replace(t, '[A-ZÀ-ÖØ-Þ]', '', 'g')) AS BIGINT) AS n_capitals,
             CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN cov ON w.rid = cov.rid),
m AS (SELECT *, {per("n_symbols", "n_words", "symbols")}, {per("n_dup_lines", "n_lines", "dup_lines")}, {per("n_repeat_words", "n_words", "repeats")},
             {per("n_capitals", "word_chars", "capitals")}, {per("word_chars", "n_words", "word_length")} FROM b),
sketch AS (SELECT lang, source, measure, {bucket} AS bucket, count(*) AS n FROM ({union}) GROUP BY ALL),
own AS ({quantile("lang, source, ")}), bylang AS ({quantile("lang, ")}), overall AS ({quantile("")}),
level AS (SELECT o.lang, o.source, o.measure,
                 CASE WHEN o.total >= {MIN_ROWS} THEN o.q0 WHEN l.total >= {MIN_ROWS} THEN l.q0 ELSE a.q0 END AS low,
                 CASE WHEN o.total >= {MIN_ROWS} THEN o.q1 WHEN l.total >= {MIN_ROWS} THEN l.q1 ELSE a.q1 END AS high
          FROM own o JOIN bylang l ON o.lang = l.lang AND o.measure = l.measure JOIN overall a ON o.measure = a.measure),
limits AS (SELECT lang, source, {limits} FROM level GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND {fine} AS kept
FROM m JOIN limits USING (lang, source)"""


ORACLE = _oracle()
