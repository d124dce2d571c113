"""A stored table of text rows that changes in one step.

A load writes its rows under its own id, then one manifest: a whole account of the table (each
file's entry and where its rows are, and the columns with their types).  A manifest
becomes version n + 1 by renaming a folder to that name, which one writer can do once.
Readers follow the highest version, so a load that stops anywhere leaves the state before it; what it wrote is named by no manifest
and goes with ``vacuum``.

Columns: those of a load are matched by name.  New ones are added at the end, and older rows have
nulls there; columns that a load lacks are null in its rows; another type is an error before
anything is written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.stats import small_side
from ..functions.storage import removed, shuffles_dropped, written
from .files import Dialect, check_headers, load_plan
from .splits import read_split

ENTRY = (
    "file string, crc32 long, bytes long, encoding string, bom boolean, lines long, n_rows long, extra array<string>, "
    "load_id string, loaded timestamp, rows_key string"
)


class LoadConflict(RuntimeError):
    """Another load was committed meanwhile; run this one again."""


class TextTable:
    """A table at ``path``: ``data/load_id=../rows_key=..`` and ``log/version=n``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _hadoop(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._hadoop(path)
        return [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []

    def version(self) -> int:
        """Of the last commit; 0 where there is none."""
        found = [n.partition("=")[2] for n in self._names(f"{self.path}/log") if n.startswith("version=")]
        return max(map(int, found), default=0)

    def manifest(self, version: int | None = None) -> DataFrame:
        """The entries of a version (the last one)."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(f"{self.path}/log/version={version}/entries")

    def schema(self, version: int | None = None) -> StructType:
        """The registered columns of a version."""
        version = self.version() if version is None else version
        if not version:
            return StructType()
        return StructType.fromJson(json.loads(self.spark.read.text(f"{self.path}/log/version={version}/schema").first()[0]))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version.  Rows that its manifest doesn't name are not read."""
        version = self.version() if version is None else version
        schema, entries = self.schema(version), self.manifest(version)
        names = [f.name for f in schema]
        if not version or entries.isEmpty():
            return self.spark.createDataFrame([], schema)
        own = schema.add("load_id", "string").add("rows_key", "string")
        rows = self.spark.read.schema(own).parquet(f"{self.path}/data")
        where = small_side(written(entries.select("load_id", "rows_key")))
        return rows.join(where, ["load_id", "rows_key"], "left_semi").select(*names)

    def evolved(self, incoming: StructType) -> StructType:
        """The registered columns with what ``incoming`` adds; another type is an error."""
        known = {f.name: f.dataType for f in self.schema()}
        if bad := [f.name for f in incoming if f.name in known and known[f.name] != f.dataType]:
            raise TypeError(f"columns of another type than the table's: {bad}")
        out = self.schema()
        for f in incoming:
            if f.name not in known:
                out = out.add(f.name, f.dataType, True)
        return out

    def commit(self, entries: DataFrame, schema: StructType, base: int) -> int:
        """Makes ``entries`` and ``schema`` the version after ``base``."""
        temporary = f"{self.path}/log/_{uuid.uuid4().hex}"
        self.spark.createDataFrame([], ENTRY).unionByName(entries).write.parquet(f"{temporary}/entries")
        self.spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(f"{temporary}/schema")
        fs, source = self._hadoop(temporary)
        _, target = self._hadoop(f"{self.path}/log/version={base + 1}")
        done = not fs.exists(target) and fs.rename(source, target)
        inside = self._hadoop(f"{target.toString()}/{source.getName()}")[1]  # some stores move it into a folder that is there
        if not done or fs.exists(inside):
            fs.delete(inside if done else source, True)
            raise LoadConflict(f"version {base + 1} is there already")
        return base + 1

    def load(self, rows: DataFrame, entries: DataFrame, gone: DataFrame, step: Callable[[str], None] = lambda name: None, whole: bool = False) -> int:
        """Rows (with source_file) of new or replaced files, their entries (file and its figures, n_rows
        left out) and the files that are gone (file), in one step; the new version.  ``step``
        is told what is done, for tests that stop there.  ``whole``: a file whose rows aren't as many as its
        lines without the header is an error, and what was written is removed."""
        base, load = self.version(), uuid.uuid4().hex
        schema = self.evolved(rows.schema)
        step("checked")
        keyed = rows.withColumns({"load_id": F.lit(load), "rows_key": F.md5("source_file")})
        with shuffles_dropped(self.spark):
            keyed.write.mode("append").partitionBy("load_id", "rows_key").option("compression", "zstd").parquet(f"{self.path}/data")
        step("rows written")
        counts = self._written_by(load).groupBy("rows_key").agg(F.count("*").alias("n_rows"))
        keyed = entries.withColumn("rows_key", F.md5("file")).join(counts, "rows_key", "left")
        fresh = keyed.withColumns({"n_rows": F.coalesce("n_rows", F.lit(0)), "load_id": F.lit(load), "loaded": F.current_timestamp()})
        if whole and (wrong := fresh.where("n_rows <> lines - 1").limit(5).collect()):
            removed(self.spark, f"{self.path}/data/load_id={load}")
            raise ValueError(f"rows don't agree with lines: {[(w.file, w.n_rows, w.lines - 1) for w in wrong]}")
        old = self.manifest(base).join(fresh.select("file").unionByName(gone.select("file")), "file", "left_anti")
        return self.commit(written(old.unionByName(fresh.select(*old.columns))), schema, base)

    def _written_by(self, load: str) -> DataFrame:
        """rows_key of each row that a load has written; files without rows have no folder."""
        if f"load_id={load}" not in self._names(f"{self.path}/data"):
            return self.spark.createDataFrame([], "rows_key string")
        return self.spark.read.schema("rows_key string").parquet(f"{self.path}/data/load_id={load}")

    def vacuum(self, keep: int = 1) -> list[str]:
        """Removes manifests but the last ``keep``, unfinished ones, and the rows of loads that no
        kept manifest names; the ids of those loads.  No load may run meanwhile."""
        last = self.version()
        kept = range(max(1, last - keep + 1), last + 1)
        named = {r.load_id for v in kept for r in self.manifest(v).select("load_id").distinct().toLocalIterator()}
        dropped = [n.partition("=")[2] for n in self._names(f"{self.path}/data") if n.startswith("load_id=") and n.partition("=")[2] not in named]
        old = [n for n in self._names(f"{self.path}/log") if n.startswith("_") or n.startswith("version=") and int(n.partition("=")[2]) not in kept]
        for path in [*(f"data/load_id={x}" for x in dropped), *(f"log/{n}" for n in old)]:
            fs, p = self._hadoop(f"{self.path}/{path}")
            fs.delete(p, True)
        return dropped


def _source_groups(fresh: DataFrame) -> dict[tuple, list[str]]:
    """Names of the files of one load, by columns, encoding and delimiter."""
    out: dict[tuple, list[str]] = {}
    for r in fresh.select("file", "columns", "encoding", "delimiter").toLocalIterator():
        out.setdefault((tuple(r.columns), r.encoding, r.delimiter), []).append(r.file)
    return out


def load_files(table: TextTable, inventory: DataFrame, required: list[str], optional: list[str] = (), step: Callable[[str], None] = lambda name: None) -> DataFrame:
    """An incremental load of delimited files: file, status (new, replaced, unchanged, gone) of each.

    Unchanged files (by size and checksum) are not read.  Headers are checked before anything is written,
    the number of rows against that of lines before the commit, and files that are gone leave
    with the same commit that brings the others.  Rows are written once, where the commit finds them.  Each run has an entry in ``<table>/runs``, begun
    before and ended after, also if it fails."""
    spark, load = table.spark, uuid.uuid4().hex
    run = "load_id string, state string, n_files int, message string"

    def note(state: str, n: int = 0, message: str | None = None) -> None:
        row = spark.createDataFrame([(load, state, n, message)], run).withColumn("at", F.current_timestamp())
        row.coalesce(1).write.mode("append").parquet(f"{table.path}/runs")

    note("running")
    try:
        plan = written(load_plan(inventory, table.manifest()))
        headers = check_headers(inventory, list(required), list(optional))
        if bad := headers.where("status <> 'ok'").limit(5).collect():
            raise ValueError(f"headers aren't those agreed on: {[(r.file, r.status) for r in bad]}")
        wanted = plan.where("status IN ('new', 'replaced')").select("file")
        fresh = written(inventory.join(headers.select("file", "columns", "extra"), "file").join(wanted, "file", "left_semi"))
        n = fresh.count()
        gone = plan.where("status = 'gone'").select("file")
        if n or not gone.isEmpty():
            _load_fresh(table, fresh, gone, list(required), step)
        note("ok", n)
    except Exception as error:
        note("failed", 0, str(error)[:2000])
        raise
    return plan


def _load_fresh(table: TextTable, fresh: DataFrame, gone: DataFrame, required: list[str], step: Callable[[str], None]) -> None:
    each = [read_split(table.spark, names, list(columns), Dialect(encoding, delimiter))[0] for (columns, encoding, delimiter), names in _source_groups(fresh).items()]
    if each:
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), each)
    else:
        schema = table.schema()
        rows = table.spark.createDataFrame([], schema if len(schema) else ", ".join(f"`{c}` string" for c in [*required, "source_file"]))
    entries = fresh.select("file", "crc32", "bytes", "encoding", "bom", "lines", "extra")
    table.load(rows, entries, gone, step, whole=True)
