"""Delimited text with an explicit contract: inventory, headers, rejects, loads.

Files are inspected by Spark readers only, so any store that Spark reads will do.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import date_format_of

def _western() -> tuple[str, str]:
    """Characters that windows-1252 has where ISO-8859-1 has controls."""
    pairs = [(chr(b), bytes([b]).decode("windows-1252", "ignore")) for b in range(0x80, 0xA0)]
    pairs = [(a, b) for a, b in pairs if b]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_WESTERN = _western()


@dataclass(frozen=True)
class Dialect:
    """Of one file: what its readers must know."""

    encoding: str = "UTF-8"
    delimiter: str = ","
    multiline: bool = True


def file_inventory(spark: SparkSession, pattern: str) -> DataFrame:
    """file, bytes, crc32, sha256, bom, encoding, lines, crlf, quotes, header,
    delimiter: a row for each file.  The reader takes a whole file as one row, so a file over
    2 GB is an error: split it first."""
    raw = spark.read.format("binaryFile").load(pattern)
    c = F.col("content")
    bom = F.hex(F.substring(c, 1, 3)) == "EFBBBF"
    utf8 = F.is_valid_utf8(c.cast("string"))
    encoding = F.when(utf8, "UTF-8").otherwise("windows-1252")
    body = F.when(utf8, c.cast("string")).otherwise(F.decode(c, "ISO-8859-1"))
    breaks = F.length(body) - F.length(F.replace(body, F.lit("\n"), F.lit("")))
    lines = breaks + F.when((F.length(body) > 0) & ~body.endswith("\n"), 1).otherwise(0)
    header = F.regexp_replace(F.regexp_replace(F.substring_index(body, "\n", 1), "^﻿", ""), "\r$", "")
    times = lambda x: F.length(header) - F.length(F.replace(header, F.lit(x), F.lit("")))
    delimiter = F.max_by(F.col("d.c"), F.col("d.n"))
    rows = raw.select(
        F.col("path").alias("file"), F.col("length").alias("bytes"), F.crc32(c).alias("crc32"), F.sha2(c, 256).alias("sha256"), bom.alias("bom"), encoding.alias("encoding"),
        lines.cast("long").alias("lines"), body.contains("\r\n").alias("crlf"), (F.length(body) - F.length(F.replace(body, F.lit('"'),
            F.lit("")))).cast("long").alias("quotes"), header.alias("header"), F.array(*[F.struct(F.lit(x).alias("c"), times(x).alias("n")) for x in (",", ";", "\t", "|")]).alias("ds"),
    )
    best = rows.select("file", F.explode("ds").alias("d")).groupBy("file").agg(delimiter.alias("delimiter"))
    return rows.drop("ds").join(best, "file")


def check_headers(inventory: DataFrame, required: list[str], optional: list[str]) -> DataFrame:
    """file, columns, extra, status (ok, missing, moved, repeated, unknown): the
    required columns come first and in order, known optional ones may follow."""
    cols = F.transform(F.split("header", F.concat(F.lit(r"\Q"), F.col("delimiter"), F.lit(r"\E"))), lambda x: F.trim(F.replace(x, F.lit('"'), F.lit(""))))
    need, may = (F.array(*map(F.lit, x)) if x else F.array().cast("array<string>") for x in (required, optional))
    h = F.col("columns")
    status = (
        F.when(F.size(F.array_distinct(h)) < F.size(h), "repeated").when(F.size(F.array_except(need, h)) > 0, "missing")
        .when(F.slice(h, 1, len(required)) != need, "moved").when(F.size(F.array_except(h, F.concat(need, may))) > 0, "unknown").otherwise("ok")
    )
    return inventory.select("file", cols.alias("columns")).select("file", "columns", F.array_except(h, need).alias("extra"), status.alias("status"))


def read_text_table(spark: SparkSession, files: list[str], columns: list[str], dialect: Dialect = Dialect()) -> DataFrame:
    """All columns as text, with _corrupt (the line, if it doesn't fit) and the
    source_file of each row; files of one dialect in one read.  With ``multiline`` a file
    is one task's work: ``splits.read_split`` reads large files in many."""
    schema = StructType([StructField(c, StringType()) for c in [*columns, "_corrupt"]])
    western = dialect.encoding == "windows-1252"  # Spark reads its subset; the rest is mapped
    reader = spark.read.schema(schema).options(header=True, sep=dialect.delimiter, encoding="ISO-8859-1" if western else dialect.encoding, quote='"', escape='"',
        multiLine=dialect.multiline, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt", enforceSchema=True)
    rows = reader.csv(files).withColumn("source_file", F.col("_metadata.file_path"))
    return rows.withColumns({c: F.translate(c, *_WESTERN) for c in columns}) if western else rows


def read_with_rejects(spark: SparkSession, files: list[str], columns: list[str], dialect: Dialect = Dialect()) -> tuple[DataFrame, DataFrame]:
    """Rows that fit; and of lines that don't the file, the line, how many fields it
    has and what is wrong.  Readers of splits know no line numbers."""
    rows = read_text_table(spark, files, columns, dialect)
    # Naming all columns makes the parser look at whole lines whatever is selected.
    whole = F.length(F.concat_ws("", *columns)) >= 0
    fields = F.split(F.col("_corrupt"), F.concat(F.lit(r"\Q"), F.lit(dialect.delimiter), F.lit(r'\E(?=(?:[^"]*"[^"]*")*[^"]*$)')))
    good = rows.where(F.col("_corrupt").isNull() & whole).drop("_corrupt")
    return good, rows.where(F.col("_corrupt").isNotNull() & whole).select(
        "source_file", F.col("_corrupt").alias("line"), F.size(fields).alias("n_fields"), F.when(F.size(fields) < len(columns),
            "too few fields").when(F.size(fields) > len(columns), "too many fields").otherwise("not readable").alias("error")
    )


def reconcile_counts(rows: DataFrame, inventory: DataFrame) -> DataFrame:
    """file, n_rows, n_lines, agrees: rows against physical lines less the header."""
    n = rows.groupBy(F.col("source_file").alias("file")).agg(F.count("*").alias("n_rows"))
    name = F.regexp_replace("file", "^file:/*", "/")
    both = inventory.select(name.alias("file"), (F.col("lines") - 1).alias("n_lines")).join(n.withColumn("file", name), "file", "left")
    return both.select("file", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "n_lines").withColumn("agrees", F.col("n_rows") == F.col("n_lines"))


def load_plan(inventory: DataFrame, ledger: DataFrame) -> DataFrame:
    """file, status: new, unchanged, replaced or gone, by size and checksum."""
    a = inventory.select("file", F.col("crc32").alias("now"), F.col("bytes").alias("size"))
    b = ledger.select("file", F.col("crc32").alias("then"), F.col("bytes").alias("old_size"))
    same = (F.col("now") == F.col("then")) & (F.col("size") == F.col("old_size"))
    status = F.when(F.col("then").isNull(), "new").when(F.col("now").isNull(), "gone").when(same, "unchanged").otherwise("replaced")
    return a.join(b, "file", "full").select("file", status.alias("status"))


def physical_profile(spark: SparkSession, files: list[str], columns: list[str], date: str, dialect: Dialect = Dialect()) -> DataFrame:
    """source_file, date_format, n_rows, n_bad_width: rows by the format of their
    date, and lines with another number of fields."""
    rows = read_text_table(spark, files, columns, dialect)
    bad = F.col("_corrupt").isNotNull()
    whole = F.length(F.concat_ws("", *columns)) >= 0  # as in ``read_with_rejects``
    return rows.where(whole | bad).groupBy("source_file", date_format_of(F.col(date)).alias("date_format")).agg(F.count("*").alias("n_rows"), F.count_if(bad).alias("n_bad_width"))


def classify_versions(incoming: DataFrame, known: DataFrame, replace: bool = False) -> DataFrame:
    """file, state of each incoming or known file (file, sha256): new, unchanged,
    replaced (with ``replace``), pending (a new version that waits for a decision) or
    absent."""
    a, b = incoming.select("file", F.col("sha256").alias("now")), known.select("file", F.col("sha256").alias("then"))
    state = F.when(F.col("then").isNull(), "new").when(F.col("now").isNull(), "absent").when(F.col("now") == F.col("then"), "unchanged").otherwise("replaced" if replace else "pending")
    return a.join(b, "file", "full").select("file", state.alias("state"))


def merged_by_name(*tables: DataFrame) -> DataFrame:
    """Rows of several tables by column name; columns that one lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def verify_manifest(actual: DataFrame, declared: DataFrame, by: str = "sha256") -> DataFrame:
    """file, status: intact, corrupt, missing or undeclared, by size and SHA-256 (or, for files of any
    size, ``by`` the crc32 of ``splits.split_inventory``)."""
    a = actual.select("file", F.col(by).alias("now"), F.col("bytes").alias("size"))
    d = declared.select("file", F.col(by).alias("then"), F.col("bytes").alias("old"))
    status = F.when(F.col("then").isNull(), "undeclared").when(F.col("now").isNull(), "missing").when((F.col("now") == F.col("then")) & (F.col("size") == F.col("old")), "intact").otherwise("corrupt")
    return a.join(d, "file", "full").select("file", status.alias("status"))


def load_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small reference table with declared types."""
    return spark.read.schema(schema).option("header", True).csv(path)
