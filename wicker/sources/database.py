"""Publication to a database over JDBC: staging tables, counts that are checked, and one
transaction that swaps all tables.

Executors write the rows of each table to ``<name>_load``, several connections side by
side.  Readers see the tables of the version before until the swap, which renames every table to
``<name>_before`` and every staging table to its name, and notes the publication, in
one transaction of the driver's.  Whatever fails before the commit leaves the published
tables as they were; the staging tables are dropped and the publication is noted as failed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions.storage import written
from .publish import PublishSpec

NOTES = "publications"


@dataclass(frozen=True)
class Database:
    """Where to publish.  ``options`` go to Spark's JDBC writer (user, password, batchsize,
    numPartitions, ...)."""

    url: str
    driver: str
    schema: str
    options: dict[str, str] = field(default_factory=dict, repr=False)  # may hold a password

    def named(self, table: str) -> str:
        if not (self.schema.isidentifier() and table.isidentifier()):
            raise ValueError(f"not an identifier: {self.schema}.{table}")
        return f"{self.schema}.{table}"

    def rename(self, old: str, new: str) -> str:
        if self.url.startswith("jdbc:derby:"):
            return f"RENAME TABLE {self.named(old)} TO {new}"
        return f"ALTER TABLE {self.named(old)} RENAME TO {new}"

    def index(self, name: str) -> str:
        """An index is named with its schema in Derby, and never elsewhere."""
        return self.named(name) if self.url.startswith("jdbc:derby:") else name

    @contextmanager
    def connection(self, spark: SparkSession) -> Iterator:
        """A connection of the driver's, by the same class loader as Spark's own."""
        jvm = spark._jvm
        properties = jvm.java.util.Properties()
        for key in ("user", "password"):
            if key in self.options:
                properties.setProperty(key, self.options[key])
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        none = spark.sparkContext._gateway.new_array
        made = loader.loadClass(self.driver).getDeclaredConstructor(none(jvm.java.lang.Class, 0)).newInstance(none(jvm.java.lang.Object, 0))
        connection = made.connect(self.url, properties)
        try:
            yield connection
        finally:
            if not connection.getAutoCommit():
                connection.rollback()  # does nothing after a commit
            connection.close()

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.format("jdbc").options(url=self.url, driver=self.driver, dbtable=self.named(table), **self.options).load()


def _run(connection, sql: str, *values: str) -> None:
    statement = connection.prepareStatement(sql)
    for i, v in enumerate(values, 1):
        statement.setString(i, v)
    statement.executeUpdate()
    statement.close()


def _count(connection, table: str) -> int:
    statement = connection.createStatement()
    rows = statement.executeQuery(f"SELECT count(*) FROM {table}")
    rows.next()
    n = rows.getLong(1)
    statement.close()
    return n


def _exists(connection, table: str) -> bool:
    """Whether a table can be read; outside any transaction."""
    try:
        _count(connection, table)
    except Exception as error:  # the driver's own kinds of error
        if "SQL" not in str(error):
            raise
        return False
    return True


def _prepare(connection, db: Database) -> None:
    try:
        _run(connection, f"CREATE SCHEMA {db.schema}")
    except Exception as error:
        if "exist" not in str(error):
            raise
    if not _exists(connection, db.named(NOTES)):
        columns = "id VARCHAR(64), state VARCHAR(16), begun TIMESTAMP, ended TIMESTAMP, counts VARCHAR(8000), metadata VARCHAR(8000), message VARCHAR(2000)"
        _run(connection, f"CREATE TABLE {db.named(NOTES)} ({columns})")


def publish_to_database(
    spark: SparkSession, specs: list[PublishSpec], db: Database, metadata: dict | None = None, step: Callable[[str], None] = lambda name: None
) -> dict[str, int]:
    """Rows of each published table.  Types are checked before the database is touched; ``step``
    is told what is done, for tests that interfere there."""
    rows, publication, counts = {s.name: s.rows() for s in specs}, uuid.uuid4().hex, {}
    with db.connection(spark) as c:
        _prepare(c, db)
        _run(c, f"INSERT INTO {db.named(NOTES)} VALUES (?, 'running', CURRENT_TIMESTAMP, NULL, NULL, ?, NULL)", publication, json.dumps(metadata or {}))
        try:
            for s in specs:
                staged = db.named(f"{s.name}_load")
                df = written(rows[s.name])  # worked out once; its files know their number of rows
                expected = df.count()
                df.write.format("jdbc").options(url=db.url, driver=db.driver, dbtable=staged, **db.options).mode("overwrite").save()
                step(f"{s.name} staged")
                if (n := _count(c, staged)) != expected:
                    raise ValueError(f"{s.name}: {n} rows in the database of {expected}")
                for i, columns in enumerate(s.indexes):
                    quoted = ", ".join(f'"{x}"' for x in columns)
                    _run(c, f"CREATE INDEX {db.index(f'ix_{publication[:8]}_{s.name}_{i}')} ON {staged} ({quoted})")
                counts[s.name] = n
            there = {s.name: (_exists(c, db.named(s.name)), _exists(c, db.named(f"{s.name}_before"))) for s in specs}
            step("staged")
            c.setAutoCommit(False)
            for s in specs:
                now, before = there[s.name]
                if before:
                    _run(c, f"DROP TABLE {db.named(f'{s.name}_before')}")
                if now:
                    _run(c, db.rename(s.name, f"{s.name}_before"))
                _run(c, db.rename(f"{s.name}_load", s.name))
                step(f"{s.name} swapped")
            _run(c, f"UPDATE {db.named(NOTES)} SET state = 'done', ended = CURRENT_TIMESTAMP, counts = ? WHERE id = ?", json.dumps(counts), publication)
            c.commit()
        except Exception as error:
            if not c.getAutoCommit():
                c.rollback()
                c.setAutoCommit(True)
            for s in specs:
                if _exists(c, db.named(f"{s.name}_load")):
                    _run(c, f"DROP TABLE {db.named(f'{s.name}_load')}")
            _run(c, f"UPDATE {db.named(NOTES)} SET state = 'failed', ended = CURRENT_TIMESTAMP, message = ? WHERE id = ?", str(error)[:2000], publication)
            raise
    return counts
