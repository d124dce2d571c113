"""Publication over JDBC, to the Derby that Spark brings along."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from wicker.sources.database import NOTES, Database, publish_to_database
from wicker.sources.publish import PublishSpec


@pytest.fixture
def db():
    return Database(f"jdbc:derby:memory:db{uuid.uuid4().hex};create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver", "prices", {"numPartitions": "3"})


@pytest.fixture
def costs(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(7 * (i % 10)), i, f"chain {i % 4}", i / 4, i % 2 == 0) for i in range(100)]
    return spark.createDataFrame(rows, "week date, n int, chain string, cost double, complete boolean").repartition(4)


def held(spark, db, table):
    return sorted(tuple(r) for r in db.read(spark, table).collect())


def states(spark, db):
    return [r.STATE for r in db.read(spark, NOTES).orderBy("BEGUN").collect()]


def test_tables_are_replaced_together_and_the_version_before_is_kept(spark, db, costs):
    specs = [PublishSpec("costs", costs, "n < 90", indexes=(("n",), ("week", "n"))), PublishSpec("latest", costs, recent_weeks=2)]
    assert publish_to_database(spark, specs, db, {"version": "v1"}) == {"costs": 90, "latest": 20}
    assert held(spark, db, "costs") == sorted(map(tuple, costs.where("n < 90").collect()))
    more = costs.withColumn("n", F.col("n") + 1000)
    assert publish_to_database(spark, [PublishSpec("costs", more), PublishSpec("latest", more, recent_weeks=1)], db) == {"costs": 100, "latest": 10}
    assert held(spark, db, "costs") == sorted(map(tuple, more.collect())) and len(held(spark, db, "costs_before")) == 90
    assert publish_to_database(spark, [PublishSpec("costs", costs.limit(0)), PublishSpec("latest", costs, recent_weeks=3)], db) == {"costs": 0, "latest": 30}
    assert len(held(spark, db, "costs_before")) == 100 and states(spark, db) == ["done"] * 3


@pytest.mark.parametrize("at", ["costs staged", "staged", "costs swapped", "latest swapped"])
def test_a_failure_at_any_step_leaves_the_published_tables(spark, db, costs, at):
    specs = [PublishSpec("costs", costs), PublishSpec("latest", costs, recent_weeks=2)]
    publish_to_database(spark, specs, db)

    def fail(name):
        if name == at:
            raise RuntimeError("stopped")

    changed = [PublishSpec(s.name, costs.withColumn("n", -F.col("n"))) for s in specs]
    with pytest.raises(RuntimeError, match="stopped"):
        publish_to_database(spark, changed, db, step=fail)
    assert held(spark, db, "costs") == sorted(map(tuple, costs.collect())) and len(held(spark, db, "latest")) == 20
    assert states(spark, db) == ["done", "failed"]
    with pytest.raises(Exception, match="(?i)latest_load"):
        held(spark, db, "latest_load")


def test_a_count_that_differs_leaves_the_published_tables(spark, db, costs):
    publish_to_database(spark, [PublishSpec("costs", costs)], db)

    def lose_a_row(name):
        if name == "costs staged":
            with db.connection(spark) as c:
                s = c.createStatement()
                s.executeUpdate('DELETE FROM prices.costs_load WHERE "n" = 5')
                s.close()

    with pytest.raises(ValueError, match="99 rows in the database of 100"):
        publish_to_database(spark, [PublishSpec("costs", costs)], db, step=lose_a_row)
    assert len(held(spark, db, "costs")) == 100 and states(spark, db) == ["done", "failed"]


def test_types_are_checked_before_the_database_is_touched(spark, db, costs):
    with pytest.raises(TypeError):
        publish_to_database(spark, [PublishSpec("costs", costs.withColumn("a", F.array("n")))], db)
    with pytest.raises(Exception):  # noqa: B017  nothing was made there
        db.read(spark, NOTES).count()
    with pytest.raises(ValueError, match="identifier"):
        db.named("costs; DROP TABLE costs")
