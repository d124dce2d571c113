"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints: 64 bits by majority over the XXH64 hashes (seed 42) of a text's
4-word shingles.  Two texts link if their fingerprints differ in at most
``RADIUS`` bits.

Links: the distinct fingerprints are keyed so that any two within the radius
share a key (the bits are dealt into more blocks than may differ, and a key is
all but ``RADIUS`` of the blocks).  Rows of one key are lanes: bit plane p holds
bit p of every lane, a lane is compared with the one d places on by shifting the
planes, distances grow in carry-save counters, and words of 64 lanes are left as
soon as all their distances exceed the radius.  The fingerprints of a key with many are
keyed again by blocks of their other bits; only if a block has many still, it is split into
chunks, and every pair of chunks is compared in a task of its own.  A task returns a spanning star of each group it links, never all pairs.

Texts of a given Jaccard similarity (``keep_one`` with ``similarity``): a fingerprint of 64 bits
can't find these exactly, since 0.8 over five words means about 8 bits on average, and up to 13;
``similar`` finds them by their shingles.

Components: alternating large and small stars over the links, each round cut from
its lineage.  Exact copies share a fingerprint and are never compared.

Null and empty texts have fingerprint zero, which links like any other.  Repeated
rows get equal results.  A null id never names a component unless its component
has no other id.  Very long texts are hashed whole.  Other columns may have any
names.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, LongType, StructField, StructType
from pyspark.sql.window import Window

from .common import cut, map_batches, small, text_of

RADIUS, WORDS, SEED = 4, 4, 42
#: Of ``keep_one`` by similarity: words of a shingle, and the similarity that links.
SIMILAR_WORDS, SIMILARITY = 5, 0.8
#: Fingerprints of a group that are this near in its order are all paired.
BESIDE = 2
#: Fingerprints of one key that are compared in one place.
CHUNK = 4096
#: Lanes that a task compares at once, unless one group has more.
LANES = 1 << 16
#: Fingerprints that a key should have at most, if they were spread evenly.
PER_KEY = 2048
#: Edges of ``components`` in one partition.
EDGES = 200_000


def shingle_hashes(text: str, words: int = WORDS) -> list[int]:
    """XXH64 of each shingle of a text, A-Z lower-cased, split at ASCII space."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return []
    joined = b" ".join(found)
    if len(found) <= words:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    sizes = np.fromiter(map(len, found), np.int64, len(found)) + 1
    ends = np.cumsum(sizes)
    starts, stops = (ends - sizes)[: len(found) - words + 1].tolist(), (ends[words - 1 :] - 1).tolist()
    hash_ = xxhash.xxh64_intdigest
    return [hash_(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)]


def majority(hashes: list[list[int]]) -> np.ndarray:
    """For each list, the bits that over half of its hashes have."""
    n = np.array([len(h) for h in hashes], np.int64)
    some = np.flatnonzero(n)
    out = np.zeros(len(hashes), np.uint64)
    if not len(some):
        return out
    flat = np.array([x for h in hashes for x in h], np.uint64)
    begin = np.cumsum(n[some]) - n[some]
    bits = np.empty((64, len(some)), np.int64)
    for p in range(64):
        bits[p] = np.add.reduceat((flat >> np.uint64(p)) & np.uint64(1), begin, dtype=np.int64)
    over = bits * 2 > n[some]
    for p in range(64):
        out[some] |= over[p].astype(np.uint64) << np.uint64(p)
    return out


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", kind: str = "long") -> DataFrame:
    """doc_id (of type ``kind``) and fingerprint (as a signed long) of each row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = majority([shingle_hashes(t) for t in batch.column(1).to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    source = docs.select(F.col(doc_id).cast(kind).alias("doc_id"), text_of(text).alias("text"))
    return map_batches(source, run, f"doc_id {kind}, fp long")


# --- comparison ---------------------------------------------------------------


def bit_planes(fp: np.ndarray) -> np.ndarray:
    """64 rows of words; bit i of row p is bit p of fingerprint i."""
    words = len(fp) // 64 + 2
    bits = np.unpackbits(fp.view(np.uint8).reshape(len(fp), 8), axis=1, bitorder="little").T
    rows = np.zeros((64, words * 8), np.uint8)
    packed = np.packbits(bits, axis=1, bitorder="little")
    rows[:, : packed.shape[1]] = packed
    return rows.view(np.uint64)


def _full(a, b, c):
    u = a ^ b
    return u ^ c, (a & b) | (u & c)


def near(planes: np.ndarray, valid: np.ndarray, d: int, radius: int = RADIUS) -> np.ndarray:
    """Lanes i, among the bits of ``valid``, whose distance to lane i + d is at
    most ``radius`` (under 16)."""
    wide = radius > 7  # a fourth counter
    step, shift = divmod(d, 64)
    at = np.flatnonzero(valid)
    live = valid[at]
    ones = np.zeros(len(at), np.uint64)
    twos, fours, eights, over = ones.copy(), ones.copy(), ones.copy(), ones.copy()
    limit = [np.uint64(0xFFFFFFFFFFFFFFFF if radius >> k & 1 else 0) for k in range(4)]
    for p in range(0, 64, 7):
        some = planes[p : p + 7]
        right = some[:, at + step]
        if shift:
            right = (right >> np.uint64(shift)) | (some[:, np.minimum(at + step + 1, some.shape[1] - 1)] << np.uint64(64 - shift))
        x = some[:, at] ^ right
        if len(x) == 7:
            s1, c1 = _full(x[0], x[1], x[2])
            s2, c2 = _full(x[3], x[4], x[5])
            one, c3 = _full(s1, s2, x[6])
            two, four = _full(c1, c2, c3)
        else:
            one, two, four = x[0], np.uint64(0), np.uint64(0)
        carry = ones & one
        ones = ones ^ one
        twos, carry = _full(twos, two, carry)
        fours, carry = _full(fours, four, carry)
        if wide:
            eights, carry = eights ^ carry, eights & carry
        over |= carry
        # counter > radius, from the highest bit down
        more, same = over, ~over
        for bit, k in (((eights, 3),) if wide else ()) + ((fours, 2), (twos, 1), (ones, 0)):
            more = more | (same & bit & ~limit[k])
            same = same & ~(bit ^ limit[k])
        left = live & ~more
        keep = np.flatnonzero(left)
        if not len(keep):
            return np.zeros(0, np.int64)
        if len(keep) < len(at):  # words in which every distance exceeds the radius
            at, live, ones, twos, fours, eights, over, left = (x[keep] for x in (at, live, ones, twos, fours, eights, over, left))
    bits = np.unpackbits(left.view(np.uint8).reshape(len(left), 8), axis=1, bitorder="little")
    row, col = np.nonzero(bits)
    return at[row] * 64 + col


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def spanning(fp: np.ndarray, group: np.ndarray, radius: int = RADIUS, pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, root) that connect what lies within ``radius`` inside
    each group; ``group`` is sorted.  With ``pairs``, pairs within the radius instead: all of
    fingerprints at most ``BESIDE`` places apart, and those that connected something."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    size = np.diff(np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group)))
    order = np.argsort(-np.repeat(size, size), kind="stable")  # large groups first
    fp, group, size = fp[order], group[order], np.repeat(size, size)[order]
    parent, fp_all = np.arange(len(fp)), fp
    lane = np.arange(len(fp))  # of the whole, for each lane still compared
    planes, d, rebuilt = bit_planes(fp), 1, 1
    while True:
        n = int(np.searchsorted(-size, -d))  # lanes of groups with more than d
        if n <= d:
            break
        same = np.zeros(planes.shape[1] * 64, np.uint8)
        same[: n - d] = group[: n - d] == group[d:n]
        valid = np.packbits(same, bitorder="little").view(np.uint64)
        a = near(planes, valid, d, radius)
        if len(a):
            x, y = lane[a], lane[a + d]
            if pairs:
                parent = _roots(parent)
                own = slice(None) if d <= BESIDE else parent[x] != parent[y]
                found.append((fp_all[x[own]], fp_all[y[own]]))
            while True:
                parent = _roots(parent)
                low, high = np.minimum(parent[x], parent[y]), np.maximum(parent[x], parent[y])
                open_ = low < high
                if not open_.any():
                    break
                np.minimum.at(parent, high[open_], low[open_])
        d += 1
        if d >= 2 * rebuilt and not (pairs and d <= BESIDE):  # groups that are one component need no more
            rebuilt, parent = d, _roots(parent)
            root = parent[lane]
            begins = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            whole = np.minimum.reduceat(root, begins) == np.maximum.reduceat(root, begins)
            keep = ~np.repeat(whole, np.diff(np.append(begins, len(group)))) & (size > d)
            if not keep.any():
                break
            if keep.sum() < 0.9 * len(keep):
                group, size, lane = group[keep], size[keep], lane[keep]
                planes = bit_planes(fp[lane])
    if pairs:
        none = [(fp[:0], fp[:0])]
        return tuple(np.concatenate(x) for x in zip(*(found or none), strict=True))
    parent = _roots(parent)
    moved = np.flatnonzero(parent != np.arange(len(parent)))
    return fp[moved], fp[parent[moved]]


def key_masks(n: int, radius: int = RADIUS) -> list[int]:
    """Bit masks of which at least one leaves two fingerprints within the radius
    equal; more and longer ones for more fingerprints."""
    blocks = radius + 1
    while blocks < 2 * radius and n >> (64 * (blocks - radius) // blocks) > PER_KEY:
        blocks += 1
    edge = [64 * i // blocks for i in range(blocks + 1)]
    part = [(1 << edge[i + 1]) - (1 << edge[i]) for i in range(blocks)]
    return [reduce(int.__or__, c) for c in combinations(part, blocks - radius)]


def sampled_masks(n: int, bits: int = 64, differing: int = 10, missed: float = 0.05) -> list[int]:
    """Bit masks of which one leaves two fingerprints with ``differing`` different bits equal, but for a
    share ``missed`` of such pairs; longer and more ones for more fingerprints."""
    k = min(40, max(16, n.bit_length() - 2))
    equal = math.prod((bits - k - i) / (bits - i) for i in range(differing))
    rng = np.random.default_rng(SEED)
    return [sum(1 << int(b) for b in rng.permutation(bits)[:k]) for _ in range(math.ceil(math.log(missed) / math.log1p(-equal)))]


def _other_blocks(mask: int, radius: int) -> list[int]:
    """The bits outside a mask as ``radius`` + 1 masks (signed)."""
    bits = [p for p in range(64) if not mask >> p & 1]
    out = [sum(1 << p for p in bits[j :: radius + 1]) for j in range(radius + 1)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """a, b: links between the fingerprints ``fp`` that connect all within the
    radius of each other."""
    spread = groups(distinct, radius, key_masks(distinct.count(), radius))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0

        def flush(fp: np.ndarray, g: np.ndarray) -> pa.RecordBatch:
            a, b = spanning(fp, g, radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            fp, g = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            held.append((fp, g))
            count += len(g)
            if count >= LANES:
                fp, g = (np.concatenate(x) for x in zip(*held, strict=True))
                end = int(np.searchsorted(g, g[-1]))  # the last group may go on
                if end:
                    yield flush(fp[:end], g[:end])
                    fp, g = fp[end:], g[end:]
                held, count = [(fp, g)], len(g)
        if count:
            yield flush(*(np.concatenate(x) for x in zip(*held, strict=True)))

    grouped = spread.repartition("g").sortWithinPartitions("g", "fp")
    return grouped.mapInArrow(compare, "a long, b long").distinct()


def groups(distinct: DataFrame, radius: int, masks: list[int]) -> DataFrame:
    """fp, g: the groups in which fingerprints are compared; rows grow with the fingerprints
    of a key until ``CHUNK`` of them agree in a block of the other bits too."""
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(signed)])
    keyed = distinct.select("fp", F.inline(keys))
    full = cut(keyed.groupBy("t", "k").count().where(F.col("count") > CHUNK).select("t", "k", F.lit(True).alias("full")))
    if full.isEmpty():
        return keyed.select("fp", F.xxhash64("t", "k").alias("g"))
    # A key with too many: two of its fingerprints that are near agree in one of ``radius`` + 1
    # blocks of the other bits.  A block that still has too many is split into chunks.
    rest = F.array(*[F.array(*[F.lit(x) for x in _other_blocks(m, radius)]) for m in masks])
    j = F.when(F.col("full"), F.sequence(F.lit(1), F.lit(radius + 1))).otherwise(F.array(F.lit(0)))
    keyed = keyed.join(small(full), ["t", "k"], "left").withColumn("j", F.explode(j))
    block = F.when(F.col("j") > 0, F.col("fp").bitwiseAND(F.get(F.get(rest, "t"), F.col("j") - 1))).otherwise(0)
    keyed = keyed.select("fp", "t", "k", "j", block.alias("r"))
    by = ["t", "k", "j", "r"]
    hot = keyed.where("j > 0").groupBy(*by).count().where(F.col("count") > CHUNK).select(*by, F.ceil(F.col("count") / CHUNK).alias("chunks"))
    dealt = keyed.join(small(cut(hot)), by, "left").withColumn("c", F.pmod(F.xxhash64("fp"), F.coalesce("chunks", F.lit(1))))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("chunks", F.lit(1)) - 1))
    spread = dealt.select(*by, "fp", "c", other.alias("o"))
    return spread.select("fp", F.xxhash64(*by, F.least("c", "o"), F.greatest("c", "o")).alias("g"))


def jaccard(a: str, b: str, words: int = SIMILAR_WORDS) -> float:
    """Of the sets of ``words``-word shingles."""
    x, y = (set(shingle_hashes(t, words)) for t in (a, b))
    return len(x & y) / len(x | y) if x or y else 1.0


# --- components ---------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """fp, root: every node of the edges (a, b) with the least node it reaches."""
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    # Every step writes and deals all edges, so few edges are kept in few partitions.
    parts = edges.count() // EDGES + 1
    edges, mark = edges.coalesce(parts), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = cut(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")).coalesce(parts))
        large = cut(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct().coalesce(parts))
        low = cut(large.groupBy("a").agg(F.min("b").alias("m")).coalesce(parts))
        joined = large.join(low, "a")
        edges = cut(joined.select("a", F.col("m").alias("b")).unionByName(joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct().coalesce(parts))
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if now == mark:
            break
        mark = now
    return edges.select(F.col("a").alias("fp"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("fp"), F.col("b").alias("root")).distinct())


def rooted(first: DataFrame, found: DataFrame) -> DataFrame:
    """fp, root, component_id of each fingerprint of ``first`` (fp, id) by the links ``found``."""
    member = cut(components(found).join(first, "fp"))
    least = cut(member.groupBy("root").agg(F.min("id").alias("least")))
    named = member.join(least, "root").select("fp", "root", "least")
    return cut(first.join(named, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("least", "id").alias("component_id")))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (hex), component_id of each row."""
    found = cut(fingerprints(docs, text, doc_id))
    first = cut(found.groupBy("fp").agg(F.min("doc_id").alias("id")))
    named = rooted(first, links(first.select("fp"), radius))
    return found.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS, similarity: float | None = None) -> DataFrame:
    """One row of ``docs`` for each component: that with the least id (of equal ids the
    least fingerprint, of equal rows any; null ids last).  With ``similarity``, texts link by it and
    not by ``radius``; fp is then the signature of a text's set of shingles.  Ids are compared in their own
    type: fractions and texts cut to whole numbers would be found in no row."""
    from . import similar  # which takes shingles and components from here

    type_ = docs.schema[doc_id].dataType
    kind = "long" if isinstance(type_, IntegralType) else type_.simpleString()
    if similarity:
        source = docs.select(F.col(doc_id).cast(kind).alias("doc_id"), text_of(text).alias("text"))
        sets = cut(similar.prefixes(source, similarity))
        found = sets.select("doc_id", F.col("s").alias("fp"))
    else:
        found = cut(fingerprints(docs, text, doc_id, kind))
    first = cut(found.groupBy("fp").agg(F.min("doc_id").alias("id")))
    named = rooted(first, similar.similar_links(source, sets, first.withColumnRenamed("fp", "s"), similarity) if similarity else links(first.select("fp"), radius))
    if not found.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").limit(1).count():
        lost = cut(found.join(named, "fp").where("doc_id <> component_id").select(F.col("doc_id").alias("simhash__id")))
        return docs.join(small(lost), docs[doc_id] == lost["simhash__id"], "left_anti")
    # Ids that are null or come twice don't tell rows apart: their fingerprints do.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")
    best = found.join(named, "fp").groupBy("root").agg(F.min(order).alias("b")).select(F.col("b.doc_id").alias("simhash__id"), F.col("b.fp").alias("simhash__best"))
    name = "simhash__fp"
    while name in docs.columns:
        name += "_"

    def marked(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
        fp = similar.signatures(texts) if similarity else majority([shingle_hashes(t) for t in texts]).view(np.int64)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp)], [*batch.schema.names, name])

    all_ = map_batches(docs, marked, StructType([*docs.schema.fields, StructField(name, LongType())]), column=text)
    kept = all_.join(cut(best), all_[doc_id].eqNullSafe(F.col("simhash__id")) & (F.col(name) == F.col("simhash__best")))
    return kept.dropDuplicates([doc_id, name]).select(*docs.columns)
