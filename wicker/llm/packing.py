"""Packing by vector bin packing.

A sequence has several limits at once: tokens, segments and loss-bearing tokens.
Sequences are filled one at a time: among the waiting pieces that fit, the one
whose demand has the largest dot product with the room left (both as shares of
the limits) goes in next.  If no piece fits and cutting is allowed, the piece with
the largest dot product is cut so that its head fills the room.  Pieces wait in a
pool of bounded size, so a task's memory doesn't grow with its input, and no data
move between tasks: each task packs the rows of its own partition.

What a sequence holds that another limit than that of tokens has closed (as for very
short documents), or that is a task's last, is cut at powers of two, since a sequence
whose length is a power of two needs no padding.  Whole examples are never cut; one
that is over a limit has a sequence of its own.

Null texts count as empty (the end token alone).  Repeated rows and repeated or
null ids are packed like any others.  Very long texts are cut into full sequences
as they come.  An empty table gives no rows; other columns are left alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import steps, text_of
from .pretoken import Vocabulary, cuts, distinct, strings, vocabulary

#: Pieces that wait in a task for a place.
POOL = 1024
#: Distinct pre-tokens whose ids a worker remembers.
REMEMBERED = 1 << 20


@dataclass(frozen=True)
class Limits:
    """Of one sequence."""

    tokens: int = 2048
    segments: int = 128
    loss: int = 2048


class VectorPacker:
    """Fills sequences from a bounded pool of pieces (key, tokens, loss).

    ``add`` and ``finish`` yield sequences as lists of (key, start, length), where
    start counts from the beginning of the piece that was added.  With ``cut``,
    loss-bearing tokens are taken to be spread evenly over a piece."""

    def __init__(self, limits: Limits, cut: bool = True, pool: int = POOL):
        self.limits, self.cut, self.pool = limits, cut, pool
        self.scale = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.keys = np.zeros(2 * pool, np.int64)
        self.starts = np.zeros(2 * pool, np.int64)
        self.need = np.zeros((2 * pool, 3))
        self.n = 0

    def add(self, key: int, tokens: int, loss: int, start: int = 0) -> Iterator[list[tuple[int, int, int]]]:
        if not self.cut and (tokens > self.limits.tokens or loss > self.limits.loss):
            yield [(key, start, tokens)]
            return
        if tokens > self.limits.tokens or loss > self.limits.loss:  # full sequences first
            size = min(self.limits.tokens, tokens * self.limits.loss // max(loss, 1))
            while tokens > size:
                yield [(key, start, size)]
                loss -= loss * size // tokens
                start, tokens = start + size, tokens - size
        i, self.n = self.n, self.n + 1
        self.keys[i], self.starts[i], self.need[i] = key, start, (tokens, 1, loss)
        while self.n >= self.pool:
            yield self._fill()

    def finish(self) -> Iterator[list[tuple[int, int, int]]]:
        while self.n:
            yield self._fill()

    def _drop(self, i: int) -> None:
        self.n -= 1
        for a in (self.keys, self.starts, self.need):
            a[i] = a[self.n]

    def _fill(self) -> list[tuple[int, int, int]]:
        room, out = self.scale.copy(), []
        while self.n and room[0] > 0 and room[1] > 0 and room[2] >= 0:
            need = self.need[: self.n]
            score = need @ (room / self.scale**2)
            fits = (need <= room).all(1)
            if fits.any():
                i = int(np.argmax(np.where(fits, score, -1.0)))
                out.append((int(self.keys[i]), int(self.starts[i]), int(need[i, 0])))
                room -= need[i]
                self._drop(i)
                continue
            if not self.cut:
                break
            i = int(np.argmax(score))
            tokens, _, loss = need[i]
            size = int(min(room[0], tokens if not loss else room[2] * tokens // loss))
            if size < 1:
                break
            spent = loss * size // tokens
            out.append((int(self.keys[i]), int(self.starts[i]), size))
            self.starts[i] += size
            self.need[i, 0], self.need[i, 2] = tokens - size, loss - spent
            room -= (size, 1, spent)
        return out


def powers_of_two(pieces: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """The pieces, in order, in sequences whose lengths are powers of two."""
    left = sum(size for _, _, size in pieces)
    waiting = pieces[::-1]
    while left:
        room, out = 1 << (left.bit_length() - 1), []
        left -= room
        while room:
            key, start, size = waiting.pop()
            taken = min(room, size)
            out.append((key, start, taken))
            if taken < size:
                waiting.append((key, start + taken, size - taken))
            room -= taken
        yield out


def pack_examples(examples: DataFrame, limits: Limits, key: str, tokens: str, loss: str) -> DataFrame:
    """Whole examples, such as instruction data, under all limits at once: key,
    sequence_id, offset, length of each.  Null counts are zero.  No example is cut;
    one over a limit is alone in its sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, held, number = VectorPacker(limits, cut=False), {}, _first_sequence()
        for i, (k, t, x) in enumerate(row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True)):
            held[i] = k
            for bin_ in packer.add(i, t, x):
                yield _placed(bin_, held, number)
                number += 1
        for bin_ in packer.finish():
            yield _placed(bin_, held, number)
            number += 1

    source = examples.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(tokens).cast("long"), F.lit(0)), F.coalesce(F.col(loss).cast("long"), F.lit(0)))
    out = source.toDF("key", "tokens", "loss").mapInArrow(run, "key long, sequence_id long, offset long, length long")
    return out.withColumnRenamed("key", key)


def _first_sequence() -> int:
    context = TaskContext.get()
    return (context.partitionId() if context else 0) << 40


def _placed(bin_: list[tuple[int, int, int]], held: dict, number: int) -> pa.RecordBatch:
    size = [s for _, _, s in bin_]
    offset = np.cumsum([0, *size[:-1]])
    return pa.RecordBatch.from_arrays([pa.array([held.pop(k) for k, _, _ in bin_], pa.int64()), pa.array([number] * len(bin_), pa.int64()), pa.array(offset, pa.int64()),
        pa.array(size, pa.int64())], ["key", "sequence_id", "offset", "length"])


class Encoder:
    """Ids of whole texts; the ids of a distinct pre-token are looked up once a
    batch and worked out once as long as the worker remembers them."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.known: dict[str, np.ndarray] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts, owner, special = self.vocab.parts(texts)
        p = cuts(parts)
        first, kind = distinct(p)
        if len(self.known) + len(first) > REMEMBERED:
            self.known.clear()
        known, ids = self.known, []
        for s in strings(p, first):
            got = known.get(s)
            if got is None:
                got = known[s] = np.array(self.vocab.ids(s), np.uint32)
            ids.append(got)
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        begin = np.cumsum(size) - size
        each = size[kind]
        total = np.cumsum(each)
        at = np.repeat(begin[kind] - total + each, each) + np.arange(int(total[-1]) if len(total) else 0)
        joined = flat[at]
        ends = np.cumsum(np.bincount(p.owner, each, len(parts))).astype(np.int64)
        pieces = [joined[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
        if not special:
            return pieces
        marks = {part: id_ for part, id_ in special}
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for i, ids_ in enumerate(pieces):
            out[owner[i]].append(ids_)
            if i in marks:
                out[owner[i]].append(np.array([marks[i]], np.uint32))
        return [np.concatenate(x) for x in out]


def conversation_examples(turns: DataFrame, vocab: str, end_id: int = 1, conversation: str = "conv_id", role: str = "role", text: str = "text", learned: str = "assistant") -> DataFrame:
    """conversation, tokens, loss of each conversation: the tokens of its turns with
    an end token each; those of the role ``learned`` bear loss.  Null texts are
    empty; turns without a conversation make up one example."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(vocab))
        for batch in steps(batches):
            size = [len(x) + 1 for x in encoder.encode(batch.column(1).to_pylist())]
            loss = [n if own else 0 for n, own in zip(size, batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(loss, pa.int64())], ["key", "tokens", "loss"])

    source = turns.select(F.col(conversation).cast("long").alias("key"), text_of(text).alias("text"), F.col(role).eqNullSafe(learned).alias("own"))
    each = source.mapInArrow(run, "key long, tokens long, loss long").groupBy("key").agg(F.sum("tokens").alias("tokens"), F.sum("loss").alias("loss"))
    return each.withColumnRenamed("key", conversation)


def pack_documents(docs: DataFrame, vocab: str, limits: Limits, end_id: int = 1, text: str = "text", doc_id: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, with ``keep_ids``, its ids.  Every token bears loss."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = Encoder(vocabulary(vocab)), VectorPacker(limits)
        held: dict[int, list] = {}
        key, number, rows = 0, _first_sequence(), []

        def place(bin_: list[tuple[int, int, int]]) -> None:
            nonlocal number
            offset = 0
            for k, start, size in bin_:
                doc = held[k]
                ids = doc[1][start : start + size].astype("<u4")
                raw = ids.tobytes()
                rows.append((doc[0], start, size, zlib.crc32(raw), len(doc[1]), number, offset, ids if keep_ids else None))
                offset += size
                doc[2] -= size
                if not doc[2]:
                    del held[k]
            number += 1

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
            if keep_ids:
                arrays.append(pa.array([c.astype(np.int32) for c in columns[7]], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names)

        def placed(bin_: list[tuple[int, int, int]]) -> None:
            if sum(size for _, _, size in bin_) == limits.tokens:
                place(bin_)
            else:
                for part in powers_of_two(bin_):
                    place(part)

        for batch in steps(batches):
            for id_, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist()), strict=True):
                ids = np.append(ids, np.uint32(end_id))
                held[key] = [id_, ids, len(ids)]
                for bin_ in packer.add(key, len(ids), len(ids)):
                    placed(bin_)
                key += 1
            if rows:
                yield flushed()
        for bin_ in packer.finish():
            placed(bin_)
        if rows:
            yield flushed()

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * keep_ids
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    schema = ", ".join(f"{n} long" for n in names[:7]) + ", ids array<int>" * keep_ids
    return source.mapInArrow(run, schema)
