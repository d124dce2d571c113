"""Token counts without materialising ids.

1. Every text is cut into pre-tokens; each distinct pre-token of the corpus and
   its number of occurrences come from one partially aggregated grouping.
2. The vocabulary's pieces are counted once for each distinct pre-token.
3. Per-document pre-token frequencies are joined to those counts and summed.
   The most frequent ``HEAD`` pre-tokens, which are most of all occurrences and
   the only hot join keys, are joined inside the tasks against a table of at most
   ``HEAD`` BLAKE2b digests of 128 bits and counts (20 bytes each); the rest meet theirs in a shuffled
   join, where no key is hot, because a key outside the head is rarer than all
   keys in it.

Null texts count as empty (no tokens).  Repeated rows and repeated or null ids
each give their own row.  Other columns of the input are left alone and may have
any names.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, row_ids, steps, text_of, written
from .pretoken import cuts, digests, distinct, strings, vocabulary

#: Pre-tokens whose counts travel to every task: 20 bytes each, 20 MB at most.
HEAD = 1 << 20


def pretoken_table(docs: DataFrame, vocab: str, text: str = "text") -> DataFrame:
    """pretoken, n (occurrences), pieces, h and g (the halves of a 128-bit digest): one
    row for each distinct pre-token of all texts."""

    def split(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts, _, _ = vocabulary(vocab).parts(batch.column(0).to_pylist())
        p = cuts(parts)
        first, kind = distinct(p)
        return pa.RecordBatch.from_arrays([pa.array(strings(p, first), pa.string()), pa.array(np.bincount(kind, minlength=len(first)), pa.int64())], ["pretoken", "n"])

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = batch.column(0).to_pylist()
        v, d = vocabulary(vocab), digests(words).view(np.int64)
        columns = [batch.column(0), batch.column(1), pa.array([v.count(w) for w in words], pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1])]
        return pa.RecordBatch.from_arrays(columns, ["pretoken", "n", "pieces", "h", "g"])

    found = map_batches(docs.select(text_of(text).alias("text")), split, "pretoken string, n long")
    merged = found.groupBy("pretoken").agg(F.sum("n").alias("n"))
    return written(map_batches(merged, count, "pretoken string, n long, pieces long, h long, g long", column="pretoken"))


def head_of(table: DataFrame, most: int = HEAD) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """The least number of occurrences in the head, and the head's digests, sorted, in
    halves, and piece counts; never more than ``most`` entries."""
    by_n = table.groupBy(F.least("n", F.lit(1 << 20)).alias("n")).count().orderBy(F.desc("n")).collect()  # 2^20 rows at most
    least, held = (1 << 20) + 1, 0
    for n, rows in by_n:
        if held + rows > most:
            break
        least, held = n, held + rows
    got = table.where(F.col("n") >= least).select("h", "g", "pieces").toArrow()
    h, g, pieces = (got.column(i).to_numpy() for i in range(3))
    order = np.argsort(h.view(np.uint64))
    return least, h.view(np.uint64)[order], g.view(np.uint64)[order], pieces[order].astype(np.int32)


def count_tokens(docs: DataFrame, vocab: str, limit: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every row."""
    table = pretoken_table(docs, vocab, text)
    least, *head = head_of(table)
    shared = docs.sparkSession.sparkContext.broadcast(head)

    def frequencies(batch: pa.RecordBatch, numbers: Iterator[int]) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        rows = pa.array([next(numbers) for _ in texts], pa.int64())
        parts, owner, special = vocabulary(vocab).parts(texts)
        p = cuts(parts)
        first, kind = distinct(p)
        at, check, pieces = shared.value
        d = digests(strings(p, first))
        h, g = d[:, 0], d[:, 1]
        known = np.zeros(len(first), np.int64)
        if len(at):
            i = np.minimum(np.searchsorted(at, h), len(at) - 1)
            known = np.where((at[i] == h) & (check[i] == g), pieces[i], 0).astype(np.int64)
        doc = owner[p.owner]
        tokens = np.bincount(doc, known[kind], len(texts)).astype(np.int64)
        for part, _ in special:
            tokens[owner[part]] += 1
        rest = np.flatnonzero(known[kind] == 0)
        pairs, times = np.unique(doc[rest] * len(first) + kind[rest], return_counts=True)
        of, which = np.divmod(pairs, max(1, len(first)))
        size = np.array([len(t.encode("utf-8")) for t in texts], np.int64)
        n, m = len(texts), len(pairs)
        ids = pa.concat_arrays([batch.column(0), pa.nulls(m, pa.int64())])
        row = pa.concat_arrays([rows, rows.take(pa.array(of))])
        sizes = pa.array(np.concatenate([size, np.zeros(m, np.int64)]))
        # A row for each document holds what its head gave; its key is in no text
        # and in no other row.
        keys = pa.array([f"\0{r}" for r in rows.to_pylist()] + strings(p, first[which]), pa.string())
        return pa.RecordBatch.from_arrays([row, ids, sizes, pa.array(np.concatenate([tokens, times])), keys, pa.array(np.arange(n + m) < n)], ["row", "doc_id", "n_bytes", "n", "pretoken", "own"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = row_ids()
        for batch in steps(batches):
            yield frequencies(batch, numbers)

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    freq = source.mapInArrow(run, "row long, doc_id long, n_bytes long, n long, pretoken string, own boolean")
    rare = table.where(F.col("n") < least).select("pretoken", "pieces")
    joined = freq.join(rare, "pretoken", "left")
    times = F.when(F.col("own"), F.lit(1)).otherwise(F.col("pieces"))
    out = joined.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum(F.col("n") * times).alias("n_tokens"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
