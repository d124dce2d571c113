"""Suffix-array dedup: bytes covered by a string of ``SPAN`` bytes that also starts
elsewhere are removed.

1. Texts.  Different texts are kept once, with their number of copies, in a table
   bucketed by their SHA-256, which all later steps read without moving texts again.
2. Anchors.  In every window of SPAN bytes the ``GRAM``-byte strings with the least
   hash are anchors, so equal windows have equal anchors at equal places.  An anchor
   rules the windows in which it is the least; they are neighbours.  Anchors whose
   hash is found once can't lie in a repeat and go.
3. Contexts.  The windows that an anchor rules make up its context.  Equal contexts
   (by 128 bits of BLAKE2b) are counted; all windows of a context that
   comes twice are repeats, and one copy of it goes on.
4. Suffix arrays.  The different contexts of an anchor meet in one task, in blocks.
   They are cut into parts of ``PART`` windows by the distance to the anchor, and
   equal parts are kept once.  Suffixes smaller than their successors are sorted
   directly, the others are induced from them by scans over the buckets of first
   bytes.  Adjacent windows with a common prefix of SPAN bytes or more, at different
   places, are repeats.  An anchor with more than ``CHUNK`` contexts is split into
   chunks, and each pair of chunks has a block of its own.  Equal windows lie at the same
   distance from their anchor; of an anchor with more than ``MANY`` contexts, for which pairs of
   chunks would cost more, the windows are counted by anchor, distance and digest instead.
5. The spans of each text are merged and cut out.

Null texts are empty; texts shorter than SPAN keep all bytes.  Repeated rows (with
the same id too) are copies of each other.  Very long texts are read whole.  Other
columns may have any names.  An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, bucketed, map_batches, text_of, written

SPAN, GRAM = 200, 64
REACH = SPAN - GRAM  # of a window on either side of its anchor's bytes
CHUNK = 2048
MANY = 16 * CHUNK
PART = 32
HOT = 1024  # rows of a key that stay together
BLOCK_BYTES = 1 << 20
STRIDE = 8192  # suffixes whose bytes are compared at once
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


# --- hashes and anchors -------------------------------------------------------


@functools.lru_cache(maxsize=2)
def _tables(k: int) -> np.ndarray:
    return np.random.default_rng(k).integers(1, 1 << 63, 256, np.int64).astype(np.uint64) | np.uint64(1)


@functools.lru_cache(maxsize=4)
def _powers(k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASES[k] | 1, pow(_BASES[k] | 1, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Ranges:
    """64-bit hashes of byte ranges of one array; they choose anchors, and decide nothing."""

    def __init__(self, data: np.ndarray, k: int):
        up, self.down = _powers(k, 1 << max(10, len(data).bit_length()))
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_tables(k)[data] * up[: len(data)], out=self.total[1:])

    def grams(self, size: int) -> np.ndarray:
        n = len(self.total) - size
        h = (self.total[size:] - self.total[:n]) * self.down[:n]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


def sliding(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least or largest of each ``width`` neighbours: out[i] is of x[i:i + width]."""
    fold, fill = (np.minimum, np.iinfo(np.uint64).max) if least else (np.maximum, 0)
    n = len(x) - width + 1
    rows = -(-len(x) // width)
    grid = np.full(rows * width, fill, np.uint64)
    grid[: len(x)] = x
    grid = grid.reshape(rows, width)
    ahead = fold.accumulate(grid, axis=1).ravel()
    back = fold.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return fold(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each anchor in joined texts: its place, the hash of its gram, and the
    starts of the first and the last window that it rules."""
    none = np.zeros(0, np.int64)
    if len(data) < SPAN or size.max(initial=0) < SPAN:
        return none, none.astype(np.uint64), none, none
    h = Ranges(data, 0).grams(GRAM)
    width = REACH + 1
    valid = np.zeros(len(data) + 1, np.int64)  # windows inside one text
    long = size >= SPAN
    np.add.at(valid, begin[long], 1)
    np.add.at(valid, begin[long] + size[long] - SPAN + 1, -1)
    n = len(h) - width + 1
    ok = np.cumsum(valid)[:n] > 0
    low = np.where(ok, sliding(h, width, True), np.uint64(0))
    padded = np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)])
    best = sliding(padded, width, False)  # over the windows that hold each gram
    at = np.flatnonzero((best == h) & (best > 0))
    # Neighbouring windows with the same least hash, and the anchors inside them.
    start = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
    end = np.append(start[1:], n) - 1
    some = low[start] > 0
    start, end = start[some], end[some]
    first, after = np.searchsorted(at, start), np.searchsorted(at, end + width)
    each = after - first
    run = np.repeat(np.arange(len(start)), each)
    k = np.arange(len(run)) - np.repeat(np.cumsum(each) - each, each) + first[run]
    own = h[at[k]] == low[start[run]]
    k, run = k[own], run[own]
    order = np.argsort(k, kind="stable")
    k, run = k[order], run[order]
    at = at[k]
    return at, h[at], np.maximum(start[run], at - REACH), np.minimum(end[run], at)


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(size) - size, size


def _digest(content: bytes, left: int) -> bytes:
    """128 bits of BLAKE2b of a context and how far it reaches to its anchor's left."""
    return hashlib.blake2b(content, digest_size=16, salt=left.to_bytes(2, "little")).digest()


def anchor_table(texts: DataFrame, contexts: bool = True) -> DataFrame:
    """Of t, text, k (copies): a (gram hash) and k for each anchor and, with
    ``contexts``, t, c (digest of the context) and p: the anchor's place, how far the
    context reaches to its left, and the context's length, in one number."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = [t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
        data, begin, size = _joined(raw)
        at, a, first, last = anchors(data, begin, size)
        owner = np.searchsorted(begin, at, "right") - 1
        of, hashes, copies = pa.array(owner), pa.array(a.view(np.int64)), batch.column(2)
        if not contexts:
            return pa.RecordBatch.from_arrays([hashes, copies.take(of)], ["a", "k"])
        joined, left = data.tobytes(), (at - first).tolist()
        c = [_digest(joined[i : j + SPAN], k) for i, j, k in zip(first.tolist(), last.tolist(), left, strict=True)]
        p = (at - begin[owner]) << 20 | (at - first) << 10 | (last + SPAN - first)
        return pa.RecordBatch.from_arrays([batch.column(0).take(of), pa.array(p), hashes, pa.array(c, pa.binary()), copies.take(of)], ["t", "p", "a", "c", "k"])

    return map_batches(texts.select("t", "text", "k"), run, "t binary, p long, a long, c binary, k long" if contexts else "a long, k long")


def _size(p: str) -> Column:
    return F.col(p).bitwiseAND(F.lit(1023))


def _left(p: str) -> Column:
    return F.shiftright(p, 10).bitwiseAND(F.lit(1023))


def _low(p: str) -> Column:
    return (F.shiftright(p, 20) - _left(p)).cast("int")


# --- suffix arrays ------------------------------------------------------------


def sorted_suffixes(text: np.ndarray, wanted: np.ndarray, depth: int = SPAN) -> np.ndarray:
    """The ``wanted`` places of a text (a mask), and some that they need, in the
    order of their suffixes' first ``depth`` bytes, by two-stage sorting.  The text
    ends in ``depth`` + 16 zeros or more."""
    n = len(text)
    differs, up = text[1:] != text[:-1], text[1:] > text[:-1]
    change = np.flatnonzero(differs)
    nearest = np.cumsum(differs) - differs  # the first change from each place on
    small_ = np.zeros(n, bool)  # smaller than its successor
    inside = nearest < len(change)
    small_[:-1][inside] = up[change[nearest[inside]]]
    # A larger suffix is induced from its successor: take all up to the next small.
    index = np.where(small_, np.arange(n), n - 1)
    following = np.minimum.accumulate(index[::-1])[::-1]
    at = np.flatnonzero(wanted)
    reach = np.bincount(at, minlength=n + 1) - np.bincount(following[at] + 1, minlength=n + 1)
    use = np.cumsum(reach)[:n] > 0
    # Stage one: sort the small ones by their first ``depth`` bytes and a little more.
    place = np.flatnonzero(use & small_)
    rows = np.lib.stride_tricks.as_strided(text, (n - depth - 7, depth + 8), (1, 1))
    keys = np.ascontiguousarray(rows[place]).view(f"S{depth + 8}").ravel()
    place = place[np.argsort(keys, kind="stable")]
    # Stage two: scan the buckets of first bytes upwards; each suffix read puts the
    # one before it, if that is larger, at the end of its bucket.
    first = text[place]
    edge = np.searchsorted(first, np.arange(257))
    large: list[list[np.ndarray]] = [[] for _ in range(256)]
    out: list[np.ndarray] = []
    lead = n - 1 if not small_[n - 1] and use[n - 1] else None
    if lead is not None:
        large[int(text[lead])].append(np.array([lead]))

    def before(x: np.ndarray) -> np.ndarray:
        x = x[x > 0] - 1
        return x[use[x] & ~small_[x]]

    for c in range(256):
        read = []
        now = np.concatenate(large[c]) if large[c] else np.zeros(0, np.int64)
        while len(now):
            read.append(now)
            prev = before(now)
            now = prev[text[prev] == c]
        read.append(place[edge[c] : edge[c + 1]])
        scanned = np.concatenate(read)
        out.append(scanned)
        prev = before(scanned)
        prev = prev[text[prev] > c]
        if len(prev):
            order = np.argsort(text[prev], kind="stable")
            prev = prev[order]
            cuts_ = np.flatnonzero(np.diff(text[prev])) + 1
            for part in np.split(prev, cuts_):
                large[int(text[part[0]])].append(part)
    return np.concatenate(out)


def common_prefix(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Whether the suffixes at adjacent places of ``order`` share SPAN bytes."""
    rows = np.lib.stride_tricks.as_strided(text, (len(text) - SPAN + 1, SPAN), (1, 1))
    out = np.empty(len(order) - 1, bool)
    for i in range(0, len(out), STRIDE):
        words = rows[order[i : i + STRIDE + 1]].view(np.uint64)
        out[i : i + STRIDE] = (words[1:] == words[:-1]).all(1)
    return out


def repeated_windows(contexts: list[bytes], place: np.ndarray, several: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, first and last starts (in them) of the runs of windows that also
    start elsewhere in the block.  ``place`` numbers the place of each context's
    first byte in the corpus, ``several`` tells that it stands in other places too."""
    size = np.fromiter(map(len, contexts), np.int64, len(contexts))
    begin = np.cumsum(size + 1) - size - 1
    text = np.frombuffer(b"\0".join(contexts) + bytes(SPAN + 32), np.uint8)
    mask = np.cumsum(np.bincount(begin, minlength=len(text) + 1) - np.bincount(begin + size - SPAN + 1, minlength=len(text) + 1))[: len(text)] > 0
    order = sorted_suffixes(text, mask)
    order = order[mask[order]]
    run = np.append(0, np.cumsum(~common_prefix(text, order)))
    owner = np.searchsorted(begin, order, "right") - 1
    start = order - begin[owner]
    where = place[owner] + start
    heads = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    apart = (np.minimum.reduceat(where, heads) != np.maximum.reduceat(where, heads)) | np.logical_or.reduceat(several[owner], heads)
    hit = np.zeros(len(text) + 1, bool)
    hit[order[apart[run]]] = True
    edge = np.flatnonzero(np.diff(hit, prepend=False))  # separators are no windows
    low, high = edge[::2], edge[1::2] - 1
    owner = np.searchsorted(begin, low, "right") - 1
    return owner, low - begin[owner], high - begin[owner]


def compared(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a block of contexts (a, t, n, left, low, context): row number, low and
    high of the ranges of its text that are repeats, for rows with n = 1."""
    number: dict[bytes, int] = {}
    parts: dict[tuple[int, int, bytes], int] = {}
    groups: dict[tuple[int, int], int] = {}  # different parts at a distance from an anchor
    place: list[int] = []
    several: list[bool] = []
    part, row, offset = [], [], []
    for i, (a, t, _, left, low, context) in enumerate(rows):
        at = (number.setdefault(t, len(number)) << 40) + low
        last = left - len(context) + SPAN  # distance of the last window to the anchor
        for far in range(left | (PART - 1), last - 1, -PART):
            b = far // PART
            near = max(last, b * PART)
            far = min(left, far)
            key = (a, far, context[left - far : left - near + SPAN])
            j = parts.get(key)
            if j is None:
                j = parts[key] = len(place)
                place.append(at + left - far)
                several.append(False)
                groups[a, b] = groups.get((a, b), 0) + 1
            elif place[j] != at + left - far:
                several[j] = True
            part.append(j)
            row.append(i)
            offset.append(low + left - far)
    many = np.array(several)
    keys = list(parts)
    todo = [j for j, (a, far, _) in enumerate(keys) if groups[a, far // PART] > 1]
    sure = np.flatnonzero(many)
    size = np.fromiter((len(k[2]) for k in keys), np.int64, len(keys))
    found = [(sure, np.zeros(len(sure), np.int64), size[sure] - SPAN)]
    if todo:
        own, first, last = repeated_windows([keys[j][2] for j in todo], np.array(place, np.int64)[todo], many[todo])
        own = np.array(todo)[own]
        new = ~many[own]
        found.append((own[new], first[new], last[new]))
    own, first, last = (np.concatenate(x) for x in zip(*found, strict=True))
    # Back to the rows that hold each part.
    part_, row_, offset_ = np.array(part), np.array(row), np.array(offset, np.int64)
    keep = np.fromiter((r[2] == 1 for r in rows), bool, len(rows))[row_]
    part_, row_, offset_ = part_[keep], row_[keep], offset_[keep]
    by = np.argsort(part_, kind="stable")
    begin = np.searchsorted(part_[by], own)
    each = np.searchsorted(part_[by], own, "right") - begin
    at = by[np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(begin, each)]
    r, low, high = row_[at], offset_[at] + np.repeat(first, each), offset_[at] + np.repeat(last, each) + SPAN
    by = np.lexsort((low, r))
    r, low, high = r[by], low[by], high[by]
    if not len(r):
        return r, low, high
    # The ranges of a row are of much the same length and follow each other.
    top = np.maximum.accumulate(high + (r << 40))
    fresh = np.append(True, (r[1:] != r[:-1]) | (low[1:] + (r[1:] << 40) > top[:-1]))
    heads = np.flatnonzero(fresh)
    return r[heads], low[heads], np.maximum.reduceat(high, heads)


# --- the whole ----------------------------------------------------------------


def among(rows: DataFrame, keys: DataFrame, by: list[str], spread: str) -> DataFrame:
    """The rows whose key is among ``keys`` (by, m: rows of the key at most; each key
    once), with m.  Keys with more than a ``BROADCAST_ROWS``-th of all rows, so at most
    that many keys, are known to every task and dealt by ``spread`` to as many parts as
    they fill."""
    total = keys.agg(F.sum("m")).first()[0] or 0
    most = max(HOT, total // BROADCAST_ROWS)
    parts = F.ceil(F.col("m") / most)
    hot = F.broadcast(keys.where(F.col("m") > most).select(*by, parts.alias("parts")))
    part = F.coalesce(F.pmod(F.xxhash64(spread), "parts"), F.lit(0))
    dealt = keys.select(*by, "m", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
    return rows.join(hot, by, "left").withColumn("part", part).drop("parts").join(dealt, [*by, "part"]).drop("part")


def repeated_spans(texts: DataFrame) -> DataFrame:
    """Of t, text, k (a row for each different text, with its copies): t, spans
    (low and high of the ranges that repeat) for each text that has some."""
    again = written(anchor_table(texts, contexts=False).groupBy("a").agg(F.sum("k").alias("m")).where("m > 1"))
    found = written(among(anchor_table(texts), again, ["a"], "p").drop("m"))
    classes = written(found.groupBy("a", "c").agg(F.sum("k").alias("n"), F.min(F.struct("t", "p")).alias("r")))
    # Every window of a context that comes twice is a repeat.
    sure = among(found, classes.where("n > 1").select("a", "c", F.col("n").alias("m")), ["a", "c"], "p").select("t", _low("p").alias("low"), (_low("p") + _size("p")).cast("int").alias("high"))
    # Different contexts of one anchor are compared.
    mixed = written(classes.groupBy("a").agg(F.count("*").alias("m")).where("m > 1"))
    x = F.struct("a", "n", "m", _left("r.p").alias("left"), _low("r.p").alias("low"), _size("r.p").alias("size"))
    some = among(classes, mixed, ["a"], "c").select(F.col("r.t").alias("t"), x.alias("x")).groupBy("t").agg(F.collect_list("x").alias("xs"))

    def fetch(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(2)
        owner, x = lists.value_parent_indices(), lists.flatten()
        low, size = (x.field(n).to_pylist() for n in ("low", "size"))
        raw = [t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
        context = [raw[i][a : a + n] for i, a, n in zip(owner.to_pylist(), low, size, strict=True)]
        fields = {n: x.field(n) for n in ("a", "n", "m", "left", "low")}
        return pa.RecordBatch.from_pydict({"t": batch.column(0).take(owner), **fields, "context": pa.array(context, pa.binary())})

    got = map_batches(texts.join(some, "t").select("t", "text", "xs"), fetch, "t binary, a long, n long, m long, left long, low int, context binary")
    if not mixed.where(F.col("m") > MANY).isEmpty():
        got = written(got)
        sure = sure.unionByName(_counted_windows(got.where(F.col("m") > MANY)))
        got = got.where(F.col("m") <= MANY)
    chunks = F.ceil(F.col("m") / CHUNK)
    got = got.withColumn("k", F.pmod(F.xxhash64("context"), chunks)).withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
    got = got.select("a", "t", "n", "left", "low", "context", F.xxhash64("a", F.least("k", "o"), F.greatest("k", "o")).alias("g"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, group = 0, None

        def block(rows: list[tuple]) -> pa.RecordBatch:
            row, low, high = compared(rows)
            return pa.RecordBatch.from_arrays([pa.array([rows[i][1] for i in row.tolist()], pa.binary()), pa.array(low, pa.int32()), pa.array(high, pa.int32())], ["t", "low", "high"])

        for batch in batches:
            for *row, g in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= BLOCK_BYTES and g != group:
                    yield block(held)
                    held, size = [], 0
                held.append(tuple(row))
                size += len(row[5])
                group = g
        if held:
            yield block(held)

    more = got.repartition("g").sortWithinPartitions("g").mapInArrow(compare, "t binary, low int, high int")
    return sure.unionByName(more).groupBy("t").agg(F.collect_set(F.struct("low", "high")).alias("spans"))


def _counted_windows(contexts: DataFrame) -> DataFrame:
    """t, low, high of the repeated windows of contexts (a, t, n, left, low, context) that stand in
    one place each (n = 1): every window is a row, and equal ones are counted before they are joined."""

    def split(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for a, t, n, left, low, context in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows += [(a, left - i, _digest(context[i : i + SPAN], 0), t, low + i, n) for i in range(len(context) - SPAN + 1)]
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(zip(*rows, strict=True), types, strict=True)], ["a", "d", "w", "t", "low", "n"])

    source = contexts.select("a", "t", "n", "left", "low", "context")
    windows = map_batches(source, split, "a long, d long, w binary, t binary, low int, n long", column="context", limit=1 << 18)
    several = written(windows.groupBy("a", "d", "w").agg(F.sum("n").alias("m")).where("m > 1"))
    found = among(windows.where("n = 1"), several, ["a", "d", "w"], "t")
    return found.select("t", "low", (F.col("low") + SPAN).alias("high"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that the spans cover."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with ``keep_text``,
    kept (the bytes left) of every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    keyed = rows.select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("t"), "text")
    texts = bucketed(keyed, "t", F.first("text").alias("text"), F.count("*").alias("k"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for raw, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            data = raw.encode("utf-8", "surrogatepass")
            runs = merged([(x["low"], x["high"]) for x in own or []])
            parts, last = [], 0
            for a, b in runs:
                parts.append(data[last:a])
                last = b
            kept = b"".join([*parts, data[last:]])
            out.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept))
        columns = list(zip(*out, strict=True))
        arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())]
        return pa.RecordBatch.from_arrays(arrays + [pa.array(columns[4], pa.binary())] * keep_text, names)

    names = ["t", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_text
    joined = texts.join(repeated_spans(texts), "t", "left").select("t", "text", "spans")
    digests = map_batches(joined, run, "t binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text)
    return keyed.select("doc_id", "t").join(digests, "t").select("doc_id", *names[1:])
