"""Quality rules in one pass for each table, and generic tests."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import rounded


@dataclass(frozen=True)
class Rule:
    """One measure of a table; ``measure`` is an aggregate.  A failed 'error' stops
    a run, a failed 'warning' is reported."""

    id: str
    measure: Column
    comparator: str
    threshold: float
    severity: str = "error"


def evaluate_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """id, severity, comparator, threshold, value, passed: one aggregate over ``df``
    for all rules.  A measure of no rows is null and passes."""
    one = df.agg(*[rounded(r.measure.cast("double"), 6).alias(r.id) for r in rules])
    rows = F.array(*[F.struct(F.lit(r.id).alias("id"), F.lit(r.severity).alias("severity"), F.lit(r.comparator).alias("comparator"),
        F.lit(float(r.threshold)).alias("threshold"), F.col(r.id).alias("value")) for r in rules])
    v, t = F.col("value"), F.col("threshold")
    passed = F.when(F.col("comparator") == "<=", v <= t).when(F.col("comparator") == ">=", v >= t).otherwise(v == t)
    return one.select(F.inline(rows)).withColumn("passed", F.coalesce(passed, F.lit(True)))


def percent(flag: Column) -> Column:
    """Percentage of rows, nulls counted as false."""
    return 100.0 * F.avg(F.coalesce(flag, F.lit(False)).cast("int"))


def raw_rules(price: Column, date: Column, essential: list[Column], run_date: Column, earliest: str = "2015-01-01") -> list[Rule]:
    """Rules over raw text rows: ``price`` and ``date`` are tolerant casts."""
    empty = reduce(lambda a, b: a | b, [F.coalesce(F.trim(c) == "", F.lit(True)) for c in essential])
    return [
        Rule("R-02", percent(empty), "<=", 0.1),
        Rule("R-03", percent(price.isNull()), "<=", 0.01),
        Rule("R-04", F.count_if(price <= 0), "==", 0),
        Rule("R-05", percent(date.isNull()), "<=", 0),
        Rule("R-06", F.count_if((date < F.to_date(F.lit(earliest))) | (date > run_date)), "==", 0),
    ]


def place_rules(date: Column, file: Column, in_box: Column) -> list[Rule]:
    """More rules over the same rows: months against the file's name, coordinates."""
    month = F.regexp_extract(file, r"(\d{2}-\d{4})", 1)
    return [Rule("R-07", percent(F.date_format(date, "MM-yyyy") != month), "<=", 0.1, "warning"), Rule("R-08", percent(~in_box), "<=", 1, "warning")]


def all_raw_rules(staged: DataFrame, files: DataFrame, expected: DataFrame, texts: list[str], essential: list[str], in_box: Column, run_date: str) -> DataFrame:
    """R-01 to R-10: one pass over the rows, one over the files, one over the groups
    of equal rows.  ``files``: file, n_rows; ``expected``: file."""
    rows = raw_rules(F.col("price"), F.col("date"), [F.col(c) for c in essential], F.to_date(F.lit(run_date))) + place_rules(F.col("date"), F.col("source_file"), in_box)
    missing = expected.join(files, "file", "left_anti")
    same = duplicates(staged, texts, ["source_file"])
    parts = [
        evaluate_rules(missing, [Rule("R-01", F.count("*"), "==", 0)]),
        evaluate_rules(staged, rows),
        evaluate_rules(same, [Rule("R-09", 100.0 * F.sum("n_surplus") / F.sum("n_rows"), "<=", 0.1, "warning")]),
        evaluate_rules(files, [Rule("R-10", F.min("n_rows") / F.median("n_rows"), ">=", 0.5, "warning")]),
    ]
    return reduce(DataFrame.unionByName, parts)


def all_mart_rules(flagged: DataFrame, items: DataFrame, basket: DataFrame, baskets: DataFrame, n_raw: DataFrame, n_kept: DataFrame, run_date: str, in_scope: Column) -> DataFrame:
    """M-01 to M-08.  ``n_raw`` and ``n_kept``: one row each, n; ``in_scope``: whether
    an observation is in a catalog of the basket."""
    outliers = percent(F.col("is_outlier"))
    loose = F.avg(F.when(in_scope, (F.col("content").isNull() | (F.col("content") <= 0)).cast("int"))) * 100.0
    last = items.agg(F.max("week").alias("week"))
    unseen = basket.select("item").distinct().join(items.join(F.broadcast(last), "week", "left_semi"), "item", "left_anti")
    whole = baskets.where("window_complete")
    cells = whole.groupBy("place_id", "week").agg(F.count("*").alias("chains"), F.count_if("is_complete").alias("complete")).where("chains >= 2")
    lost = n_raw.withColumnRenamed("n", "n_raw").crossJoin(F.broadcast(n_kept.withColumnRenamed("n", "n_kept")))
    parts = [
        evaluate_rules(flagged, [Rule("M-01", outliers, "<=", 1, "warning"), Rule("M-02", outliers, "<=", 5), Rule("M-03", loose, "<=", 5, "warning"), Rule("M-08",
            F.date_diff(F.to_date(F.lit(run_date)), F.max("date")), "<=", 35, "warning")]),
        evaluate_rules(whole, [Rule("M-04", percent(F.col("is_complete")), ">=", 50, "warning")]),
        evaluate_rules(unseen, [Rule("M-05", F.count("*"), "==", 0, "warning")]),
        evaluate_rules(lost, [Rule("M-06", F.max(F.col("n_raw") - F.col("n_kept")), "==", 0)]),
        evaluate_rules(cells, [Rule("M-07", percent(F.col("complete") >= 2), ">=", 70, "warning")]),
    ]
    return reduce(DataFrame.unionByName, parts)


def duplicates(df: DataFrame, keys: list[str], within: list[str] = ()) -> DataFrame:
    """within, n_rows, n_surplus: rows beyond the first of each group of equal keys."""
    groups = df.groupBy(*within, F.xxhash64(*keys).alias("h")).agg(F.count("*").alias("n"))
    return groups.groupBy(*within).agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("n_surplus"))


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Combinations that come more than once."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def expression_is_true(df: DataFrame, expression: str) -> DataFrame:
    """Rows that break an expression; null passes."""
    return df.where(f"NOT ({expression})")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(~F.col(column).isin(values))


def relationships(df: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose value is in no row of the parent; nulls pass."""
    return df.where(F.col(column).isNotNull()).join(parent.select(F.col(key).alias("parent__")), F.col(column) == F.col("parent__"), "left_anti")


def rows_conserved(raw: DataFrame, consolidated: DataFrame, count: str) -> DataFrame:
    """A row if the consolidated counts don't sum to the raw rows."""
    both = raw.agg(F.count("*").alias("n_raw")).crossJoin(F.broadcast(consolidated.agg(F.coalesce(F.sum(count), F.lit(0)).alias("n_kept"))))
    return both.where("n_raw <> n_kept")


def decomposition_gap(items: DataFrame, savings: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """Paired baskets whose items' differences don't sum to the saving."""
    s = items.where("is_paired").groupBy("place_id", "week", "chain").agg(F.sum("vs_cheapest_basket").alias("by_items"))
    return savings.join(s, ["place_id", "week", "chain"], "left").where(F.abs(F.coalesce("by_items", F.lit(0.0)) - F.col("saving")) > tolerance)


def several_readings(parsed: DataFrame, key: str) -> DataFrame:
    """Keys whose package reads in more than one way."""
    reading = F.struct("base_unit", "content", "count_subtype", "is_comparable")
    return parsed.groupBy(key).agg(F.countDistinct(reading).alias("n_readings")).where("n_readings > 1")


def unmapped_combinations(staged: DataFrame, skus: DataFrame, columns: list[str]) -> DataFrame:
    """One row if the original combinations are not as many as the mapped ones."""
    raw = staged.select(*columns).distinct().agg(F.count("*").alias("n_raw"))
    return raw.crossJoin(F.broadcast(skus.agg(F.count("*").alias("n_mapped")))).where("n_raw <> n_mapped")


def bi_against_marts(differences: DataFrame, savings: DataFrame, availability: DataFrame, baskets: DataFrame) -> DataFrame:
    """check, n, n_wrong: the items' differences against the savings (within a ten
    thousandth or 1), and the items there in each cell against its basket."""
    total = differences.agg(F.coalesce(F.sum("accumulated_difference"), F.lit(0.0)).alias("a")).crossJoin(F.broadcast(savings.agg(F.coalesce(F.sum("saving"), F.lit(0.0)).alias("b"))))
    wrong = F.abs(F.col("a") - F.col("b")) > F.greatest(0.0001 * F.abs("b"), F.lit(1.0))
    one = total.select(F.lit("differences").alias("check"), F.lit(1).cast("long").alias("n"), wrong.cast("long").alias("n_wrong"))
    cells = availability.groupBy("chain", "place_id", "week").agg(F.count_if("available").alias("there"))
    both = cells.join(baskets.select("chain", "place_id", "week", "items_available"), ["chain", "place_id", "week"], "left")
    return one.unionByName(both.agg(F.count("*").alias("n"),
        F.count_if(~F.col("there").eqNullSafe(F.col("items_available"))).alias("n_wrong")).select(F.lit("availability").alias("check"), "n", "n_wrong"))


def data_tests(tests: dict[str, DataFrame]) -> DataFrame:
    """test, n_failures of each test (a table of what breaks it)."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n_failures")).select(F.lit(name).alias("test"), "n_failures") for name, df in tests.items()])
