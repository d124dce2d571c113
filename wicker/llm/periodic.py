"""Periodic runs: stretches of words that repeat with a period at least four times.

1. A document is cut into tiles for each octave of periods, from b = 2^e to 2b - 1.  Boundaries
   stand every b words; a tile has those of 256 words or 4b, and reaches b words back of the
   first and 7b ahead of the last, so tiles overlap.  A run of period q has a boundary with 3q words of the run from there on, whose first 2q
   come again q words later.  Boundaries without such words, and tiles without boundaries, go no
   further; blocks of 2b words are compared by hashes here, and a false match only lets a
   tile through.
2. Tiles are solved one by one, wherever they lie.  A Z-function ahead of each boundary and one
   behind it tell for every period how far the words repeat on either side.
   What reaches the tile's edge is a fragment of a longer run.
3. Fragments are shuffled by document and period and stitched where they share a period's
   length of words.
4. The runs of a document are put in order, and the words after the first period of each
   run go.

Only documents with tiles go through steps 2 to 4; the digests of the others are
worked out in step 1, so their texts don't move.  A document's tiles are rows of their own that are
dealt over the tasks, so a very long document isn't one task's work.

Null texts have no words.  Repeated rows and ids are documents of their own.  A null id
hashes as the empty string.  Texts without runs have four nulls.  Other columns may have
any names.  An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import row_ids, steps, text_of, written

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: A run has this many periods at least, and this many words.
TIMES, LEAST = 4, 6
#: Words over which a tile has boundaries: so many, or four times the octave's least period.
TILE_WORDS = 256
#: Words of one batch of tiles, and of the tiles that a task solves.
BATCH_WORDS, TASK_WORDS = 1 << 18, 1 << 19


def planted(doc_id: int | None, words: list[str]) -> list[str]:
    """The words of a document, of which every tenth repeats itself from a place on."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a : a + p]
    return words[:a] + (part * (-(-(n - a) // p)))[: n - a]


def names_of(documents: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, equal words alike, and where each document starts."""
    size = np.fromiter(map(len, documents), np.int64, len(documents))
    known: dict[str, int] = {}
    flat = np.fromiter((known.setdefault(w, len(known)) for words in documents for w in words), np.int32, int(size.sum()))
    return flat, np.cumsum(size) - size


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def candidates(names: np.ndarray, begin: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """b, document, boundary (counted from the document's first word): tiles in which the words from
    the boundary on repeat three times with a period from b to 2b - 1, octave by octave, of
    documents in which some go on as long as a run must."""
    with np.errstate(over="ignore"):
        h = _mix(names.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        b = 1
        while True:
            long = np.flatnonzero(size >= max(LEAST, TIMES * b))
            if not len(long):
                return
            # Hashes of blocks twice as long; those beyond a document's end are never used.
            h = _mix(h * np.uint64(3) + _mix(np.concatenate([h[b:], np.zeros(min(b, len(h)), np.uint64)]) + np.uint64(b)))
            each = (size[long] - 3 * b) // b + 1  # boundaries with 3b words from there on
            doc = np.repeat(long, each)
            at = (np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)) * b
            place, room = begin[doc] + at, (size[doc] - at) // 3  # periods up to room fit
            hit, strong = np.zeros(len(doc), bool), np.zeros(len(doc), bool)

            def repeats(i: np.ndarray, x: np.ndarray, q: np.ndarray | int) -> None:
                """Marks the boundaries i, at x, whose first b words came again q words later."""
                again = h[x + 2 * (q - b)] == h[x + 3 * q - 2 * b]  # noqa: B023
                i, x, q = i[again], x[again], q[again] if isinstance(q, np.ndarray) else q
                hit[i] = True  # noqa: B023
                # A run's first boundary has all but b - 1 of the words that a run must have.
                end = np.maximum(LEAST, TIMES * q) - b + 1  # noqa: B023
                tail = np.minimum(x + np.maximum(end - q - 2 * b, 0), len(h) - 1 - q)  # noqa: B023
                full = (at[i] + end <= size[doc[i]]) & (h[tail] == h[tail + q])
                strong[i[full]] = True  # noqa: B023

            if b < 64:
                own = h[place]
                for q in range(b, 2 * b):
                    i = np.flatnonzero((h[np.minimum(place + q, len(h) - 1)] == own) & (q <= room))
                    repeats(i, place[i], q)
            else:
                for i, (x, most) in enumerate(zip(place.tolist(), room.tolist(), strict=True)):
                    q = b + np.flatnonzero(h[x + b : x + min(2 * b, most + 1)] == h[x])
                    if len(q):
                        repeats(np.full(len(q), i), np.full(len(q), x), q)
            hit &= np.isin(doc, doc[strong])
            yield b, doc[hit], at[hit]
            b *= 2


def z_function(x: list, upto: int) -> list[int]:
    """For each lag below ``upto``, how many first items of x come again there."""
    n, z, left, right = len(x), [0] * upto, 0, 0
    for i in range(1, upto):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and x[k] == x[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


@functools.lru_cache(maxsize=1 << 16)
def _prime_factors(n: int) -> tuple[int, ...]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return (*out, n) if n > 1 else tuple(out)


def solve_boundary(words: list[int], m: int, b: int, open_left: bool, open_right: bool) -> Iterator[tuple[int, int, int]]:
    """start, end and period of the stretches over boundary ``m`` whose smallest period is
    from b to 2b - 1: whole runs, and fragments that reach an open edge."""
    n = len(words)
    ahead = z_function(words[m:], min(2 * b, n - m))
    # Behind: the reversed words before the boundary, then those before each lag.
    back, total = words[:m][::-1], min(n, m + 2 * b - 1)
    z = z_function([*back, None, *words[:total][::-1]], len(back) + 1 + total)
    for q in range(b, min(2 * b, n - m)):
        k = z[len(back) + 1 + total - m - q] if back and m + q <= total else 0
        start, end = m - k, m + q + ahead[q]
        if end - start < 2 * q or any(ahead[q // r] >= q - q // r for r in _prime_factors(q)):
            continue
        if end - start >= max(LEAST, TIMES * q) or (start == 0 and open_left) or (end == n and open_right):
            yield start, end, q


def solve_tile(words: list[int], boundaries: list[int], b: int, open_left: bool, open_right: bool) -> list[tuple[int, int, int]]:
    """start, end and period of what a tile holds: each boundary is solved over b words behind it and 7b
    ahead, and fragments that share a period's length of words are joined."""
    found: dict[int, list[list[int]]] = {}
    for m in boundaries:
        lo, hi = max(m - b, 0), min(m + 7 * b, len(words))
        for start, end, q in solve_boundary(words[lo:hi], m - lo, b, lo > 0 or open_left, hi < len(words) or open_right):
            own = found.setdefault(q, [])
            if own and lo + start + q <= own[-1][1]:
                own[-1][0], own[-1][1] = min(own[-1][0], lo + start), max(own[-1][1], lo + end)
            else:
                own.append([lo + start, lo + end])
    return [(start, end, q) for q, own in found.items() for start, end in own]


SPLIT = "row long, doc_id long, n long, sha string, text string, octave long, at array<int>, begin long, size long, names array<int>"


def split_tiles(docs: DataFrame, plant: bool, text: str, doc_id: str) -> DataFrame:
    """A row for each document (n words, and the SHA-256 of its words if it has no tile, or else
    its words), and one for each tile that may hold something."""

    def record(columns: dict[str, list], k: int) -> pa.RecordBatch:
        types = {"sha": pa.string(), "text": pa.string(), "at": pa.list_(pa.int32()), "names": pa.list_(pa.int32())}
        order = [x.split()[0] for x in SPLIT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(columns.get(c, [None] * k), types.get(c, pa.int64())) for c in order], order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = row_ids()
        for batch in steps(batches):
            ids = batch.column(0).to_pylist()
            words = [WORD.findall(t) for t in batch.column(1).to_pylist()]
            if plant:
                words = [planted(k, w) for k, w in zip(ids, words, strict=True)]
            rows = [next(number) for _ in ids]
            names, begin = names_of(words)
            size = np.array([len(w) for w in words], np.int64)
            tiled: set[int] = set()
            for b, doc, at in candidates(names, begin, size):
                if not len(doc):
                    continue
                tiled.update(doc.tolist())
                width = max(TILE_WORDS, 4 * b)
                new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (at[1:] // width != at[:-1] // width)))
                ends = np.append(new[1:], len(doc)) - 1
                for lo in range(0, len(new), step := max(1, BATCH_WORDS // (width + 8 * b))):
                    i, j = new[lo : lo + step], ends[lo : lo + step]
                    d, first, last = doc[i], np.maximum(at[i] - b, 0), np.minimum(at[j] + 7 * b, size[doc[i]])
                    pieces = [names[s + x : s + y] for s, x, y in zip(begin[d].tolist(), first.tolist(), last.tolist(), strict=True)]
                    inner = [at[x : y + 1] - f for x, y, f in zip(i.tolist(), j.tolist(), first.tolist(), strict=True)]
                    yield record({"row": [rows[k] for k in d.tolist()], "octave": [b] * len(d), "at": inner, "begin": first.tolist(), "size": size[d].tolist(), "names": pieces}, len(d))
            joined = [" ".join(w) for w in words]
            sha = [None if i in tiled else hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for i, t in enumerate(joined)]
            kept = [t if i in tiled else None for i, t in enumerate(joined)]
            yield record({"row": rows, "doc_id": ids, "n": size.tolist(), "sha": sha, "text": kept}, len(ids))

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return source.mapInArrow(run, SPLIT)


def fragments(tiles: DataFrame) -> DataFrame:
    """row, period, start, end of what each tile holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, b, at, begin, size, names in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for start, end, q in solve_tile(names, at, b, begin > 0, begin + len(names) < size):
                    out.append((row, q, begin + start, begin + end))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["row", "period", "start", "end"])

    return tiles.select("row", "octave", "at", "begin", "size", "names").mapInArrow(run, "row long, period long, start long, end long")


def stitched(pieces: DataFrame) -> DataFrame:
    """row, start, length, period of the runs: fragments of one document and period that share
    a period's length of words are one run."""
    each = Window.partitionBy("row", "period").orderBy("start", "end")
    before = F.max("end").over(each.rowsBetween(Window.unboundedPreceding, -1))
    marked = pieces.distinct().withColumn("new", F.when(F.col("start") + F.col("period") <= before, 0).otherwise(1))
    runs = marked.withColumn("run", F.sum("new").over(each)).groupBy("row", "period", "run")
    runs = runs.agg(F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("length"))
    return runs.where(F.col("length") >= F.greatest(F.lit(LEAST), TIMES * F.col("period"))).select("row", "start", "length", "period")


RESULT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
_NO_RUNS = hashlib.sha256(b"").hexdigest()


def digest(words: list[str], runs: list[tuple[int, int, int]]) -> tuple:
    """All columns of the result but doc_id, of runs (start, length, period)."""
    runs = sorted(runs, key=lambda r: (r[0], r[2]))
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    change = np.zeros(len(words) + 1, np.int64)
    for s, n, q in runs:
        change[s + q] += 1
        change[s + n] -= 1
    gone = np.cumsum(change[:-1]) > 0
    kept = " ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest()


def _digests(texts: DataFrame) -> DataFrame:
    """The result for rows of doc_id, text and runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [x.split() for x in RESULT.split(", ")]
        for batch in steps(batches):
            out = [(k, *digest(t.split(" ") if t else [], [(r["start"], r["length"], r["period"]) for r in rs])) for k, t, rs in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if t == "long" else pa.string()) for c, (_, t) in zip(zip(*out, strict=True), fields, strict=True)], [n for n, _ in fields])

    return texts.select("doc_id", "text", "runs").mapInArrow(run, RESULT)


def collapse_runs(docs: DataFrame, plant: bool = False, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_runs, the longest run (start, length, period, exponent_milli), runs_sha256 and
    collapsed_sha256 of every document; with ``plant``, of its planted form."""
    parts = written(split_tiles(docs, plant, text, doc_id))
    tiles = parts.where("octave IS NOT NULL")
    words = tiles.agg(F.sum(F.size("names"))).first()[0] or 0
    tiles = tiles.repartition(max(1, -(-words // TASK_WORDS)), "row", "octave", "begin")
    runs = stitched(fragments(tiles))
    own = runs.groupBy("row").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    texts = parts.where("octave IS NULL AND sha IS NULL").select("row", "doc_id", "text").join(own, "row", "left")
    texts = texts.withColumn("runs", F.coalesce("runs", F.array().cast("array<struct<start:bigint,length:bigint,period:bigint>>")))
    none = F.lit(None).cast("long")
    plain = parts.where("sha IS NOT NULL").select("doc_id", F.lit(0).cast("long").alias("n_runs"), *[none.alias(c) for c in ("start", "length", "period",
        "exponent_milli")], F.lit(_NO_RUNS).alias("runs_sha256"), F.col("sha").alias("collapsed_sha256"))
    return plain.unionByName(_digests(texts))
