"""Mixing sources to target weights by Pfair scheduling.

Every source's rows are dealt into blocks.  With weight w, block i of a source
(from 1) is released at floor((i - 1) / w) and due at ceil(i / w); one block is
placed in each slot, always the released one with the earliest deadline.  With
weights that sum to 1 no deadline is missed, so at any slot each source is less
than one block away from its share.

Weights are exact: they become whole slots of a period, their common denominator.
Only weights with no common denominator up to ``resolution`` are rounded, to whole
slots of a period of that length (one slot at least).  A schedule repeats after each
period, so at most one period is worked out, on the driver, and every block finds
its slot by arithmetic.  When a source ends, a new phase begins in which the others
share its weight.  Sources of weight 0 follow after all others, in equal shares.
Every row is placed, once.

A null source counts as the empty name.  Repeated rows and null ids are placed
like any others; equal rows are interchangeable.  Texts aren't looked at.  Other
columns are kept, whatever their names.  An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import small, written

#: Slots of a period, at most.
RESOLUTION = 1_000_000
#: Rows of a block.
BLOCK_ROWS = 16
#: Rows that one task orders at once.
BUCKET_ROWS = 2048
#: Times as many make a bucket too full.
HOT = 8
#: Buckets of a source that are summed at once.
RUN = 4096


def quanta(weights: dict[str, float], resolution: int = RESOLUTION) -> dict[str, int]:
    """Slots of each source in a period: exact shares if they have a common
    denominator up to ``resolution``, else largest remainders, one at least."""
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    total = sum(exact.values())
    share = {s: w / total for s, w in exact.items()}
    length = math.lcm(*(x.denominator for x in share.values()))
    if length <= resolution:
        return {s: int(x * length) for s, x in share.items()}
    length = max(resolution, 4 * len(weights))
    out = {s: max(1, int(x * length)) for s, x in share.items()}
    for s in sorted(share, key=lambda s: (out[s] - share[s] * length, s))[: max(0, length - sum(out.values()))]:
        out[s] += 1
    return out


def period(slots: dict[str, int], left: dict[str, int] | None = None) -> dict[str, list[int]]:
    """Pfair schedule of one period: the slots of each source, in order.  With
    ``left`` (blocks of each source) it stops where the first source ends."""
    length = sum(slots.values())
    waiting = [(0, -(-length // n), s, 1) for s, n in slots.items()]  # release, deadline, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    out: dict[str, list[int]] = {s: [] for s in slots}
    for slot in range(length):
        while waiting and waiting[0][0] <= slot:
            _, due, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (due, s, i))
        _, s, i = heapq.heappop(ready)
        out[s].append(slot)
        if left and i == left[s]:
            break
        if i < slots[s]:
            heapq.heappush(waiting, (i * length // slots[s], -(-(i + 1) * length // slots[s]), s, i + 1))
    return out


def phases(blocks: dict[str, int], weights: dict[str, float], resolution: int = RESOLUTION) -> list[tuple]:
    """(source, phase, first block, end block, first slot, period, slots of the
    source in a period, those worked out): a row for each phase in which a source
    has blocks."""
    left = {s: n for s, n in blocks.items() if n}
    named = {s: weights[s] for s in left if weights[s]}
    shares = quanta(named, resolution) if named else {}
    done = dict.fromkeys(left, 0)
    base, out, number = 0, [], 0
    while left:
        own = {s: shares[s] for s in left if s in shares} or dict.fromkeys(left, 1)
        whole = math.gcd(*own.values())
        own = {s: n // whole for s, n in own.items()}
        length, at = sum(own.values()), period(own, left)
        ends = [(left[s] - 1) // n * length + at[s][(left[s] - 1) % n] + 1 for s, n in own.items() if (left[s] - 1) % n < len(at[s])]
        end = min(ends)
        for s in sorted(own):
            served = end // length * own[s] + sum(x < end % length for x in at[s])
            if served:
                out.append((s, number, done[s], done[s] + served, base, length, own[s], at[s]))
            done[s] += served
            left[s] -= served
        left = {s: n for s, n in left.items() if n}
        base, number = base + end, number + 1
    return out


def tempered(counts: dict[str, int], power: float = 0.5) -> dict[str, float]:
    """Weights that lean towards small sources: counts to a power, in millionths of
    their sum (one at least)."""
    raw = {s: n**power for s, n in counts.items()}
    total = sum(raw.values())
    return {s: max(1, round(1e6 * w / total)) / 1e6 for s, w in raw.items()}


def mix(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, block_rows: int = BLOCK_ROWS, resolution: int = RESOLUTION, source: str = "source",
    doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with mix_block (of its source), mix_phase, mix_release and
    mix_deadline (slots of the phase), mix_slot, mix_position (place in the mix,
    ascending with the slot); a name that ``docs`` has gets a number.  ``weights`` by source; without them, row counts to
    ``power``.  Sources that ``weights`` doesn't name, and negative weights, are an error."""
    taken = {c.lower() for c in docs.columns}
    own = lambda name: next(n for n in (name, *(f"{name}_{i}" for i in range(1, 1000))) if n.lower() not in taken)
    s, h, b, r, n, part = (own(f"mix__{x}") for x in ("s", "h", "b", "r", "n", "part"))
    block, phase, first, end, base, length, at = (own(f"mix__{x}") for x in ("block", "phase", "first", "end", "base", "length", "at"))
    spark = docs.sparkSession
    keyed = docs.withColumn(s, F.coalesce(F.col(source).cast("string"), F.lit(""))).withColumn(h, F.xxhash64(doc_id))
    counts = {row[s]: row["count"] for row in keyed.groupBy(s).count().collect()}  # one row for each source
    weights = weights or tempered(counts, power)
    if missing := [x for x in counts if weights.get(x, -1) < 0]:
        raise ValueError(f"no weight for {missing[:5]}")

    # Number the rows of each source: order within buckets, then sums over buckets.
    if not counts:
        plan_types = (("mix_block", "long"), ("mix_phase", "int"), ("mix_release", "long"), ("mix_deadline", "long"), ("mix_slot", "long"), ("mix_position", "long"))
        return docs.select("*", *(F.lit(None).cast(kind).alias(own(name)) for name, kind in plan_types))
    buckets = small(spark.createDataFrame([(x, -(-c // BUCKET_ROWS)) for x, c in counts.items()], f"{s} string, {n} long"))
    keyed = keyed.join(buckets, s).withColumn(b, F.pmod(h, n)).drop(n).withColumn(part, F.monotonically_increasing_id())
    # Null ids, and ids that come again and again, share a bucket; one with too many rows is dealt anew.
    full = keyed.groupBy(s, b).agg(F.count("*").alias(n)).where(F.col(n) > HOT * BUCKET_ROWS).select(s, b, F.ceil(F.col(n) / BUCKET_ROWS).alias(n))
    keyed = keyed.join(small(written(full)), [s, b], "left").withColumn(part, F.coalesce(F.pmod(part, n), F.lit(0))).drop(n)
    each = keyed.groupBy(s, b, part).agg(F.count("*").alias("rows")).withColumn("run", F.floor(F.col(b) / RUN))
    runs = each.groupBy(s, "run").agg(F.sum("rows").alias("run_rows"))

    def before(x: str, by: list[str], *order: str) -> Column:
        return F.coalesce(F.sum(x).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    runs = runs.select(s, "run", before("run_rows", [s], "run").alias("run_before"))
    each = each.withColumn("before", before("rows", [s, "run"], b, part)).join(runs, [s, "run"])
    each = each.select(s, b, part, (F.col("before") + F.col("run_before")).alias(n))
    in_bucket = F.row_number().over(Window.partitionBy(s, b, part).orderBy(h, doc_id)) - 1
    placed = keyed.withColumn(r, in_bucket).join(small(each), [s, b, part]).withColumn(r, F.col(r) + F.col(n)).drop(n, h, b, part)
    placed = placed.withColumn(block, F.floor(F.col(r) / block_rows))

    plan = phases({x: -(-c // block_rows) for x, c in counts.items()}, weights, resolution)
    table = spark.createDataFrame([x[:7] for x in plan], f"{s} string, {phase} int, {first} long, {end} long, {base} long, {length} long, {n} long")
    inside = (placed[s] == table[s]) & (F.col(block) >= F.col(first)) & (F.col(block) < F.col(end))
    out = placed.join(small(table), inside).drop(table[s]).withColumn(b, F.col(block) - F.col(first)).withColumn(h, F.expr(f"{b} % {n}"))
    size = [len(x[7]) for x in plan]
    slots = {s: pa.array([x[0] for x in plan]).take(np.repeat(np.arange(len(plan)), size)), phase: pa.array(np.repeat([x[1] for x in plan], size), pa.int32()),
        h: pa.array(np.concatenate([np.arange(k) for k in size])), at: pa.array(np.concatenate([x[7] for x in plan]), pa.int64())}
    out = out.join(small(spark.createDataFrame(pa.table(slots))), [s, phase, h])
    slot = F.expr(f"{base} + {b} div {n} * {length} + {at}")
    return out.select(
        *docs.columns,
        F.col(block).alias(own("mix_block")),
        F.col(phase).alias(own("mix_phase")),
        F.expr(f"{b} * {length} div {n}").alias(own("mix_release")),
        F.expr(f"(({b} + 1) * {length} + {n} - 1) div {n}").alias(own("mix_deadline")),
        slot.alias(own("mix_slot")),
        (slot * block_rows + F.col(r) % block_rows).alias(own("mix_position")),
    )


def in_order(docs: DataFrame, **how) -> DataFrame:
    """``docs`` in the order of their mix: partitions follow each other, and so do
    the rows of a partition.  The same rows always get the same order."""
    placed = mix(docs, **how)
    position = [c for c in placed.columns if c.startswith("mix_position")][-1]
    return placed.repartitionByRange(position).sortWithinPartitions(position).select(*docs.columns)
