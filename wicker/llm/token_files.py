"""Token ids in flat files, read through memory maps.

A folder holds, for every part of the corpus (documents in ascending order of id),

* ``data/kind=ids/part=K``: the ids of the part's documents, one after the other, as
  flat little-endian unsigned integers of 2 or 4 bytes,
* ``offsets/part=K``: a flat 64-bit little-endian number for each document, how many ids
  of the corpus stand before it, and one more for the part's end,
* ``documents``: part, row and doc_id, and ``manifest``: part, documents and ids before
  it (the bases), its own documents and ids, and the bytes of an id, as Parquet.

Spark's text writer makes the flat files, so its commit protocol replaces what a lost
executor left half written, in any store: a record's last byte, which is zero in
all records, is the line separator.  (The number of ids is below 2^56 and the end id has
a zero as its top byte in the width that is chosen.)

1. Documents are dealt by ranges of (doc_id, hash of the text, place in the input), so
   one id with a third of all rows is split too; null ids come first.
2. Each task encodes its range; ids and lengths are written in one go.
3. A part's base is the exclusive prefix sum of the totals of the parts before it, and
   offsets are the base and the running sum inside the part.

A reader maps a part's files and looks at the documents it wants only.  Null texts are
empty (the end id alone).  Repeated rows and ids have ids of their own, in the order of
step 1.  Long texts are encoded whole.  An empty table gives no parts.  Other columns may have
any names.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.storage import exclusive_prefix, written
from .common import steps, text_of
from .packing import Encoder
from .pretoken import vocabulary

#: Text bytes of a part, and the least that is worth a task.
PART_BYTES, LEAST_BYTES = 64 << 20, 1 << 20
SEPARATOR = "\0"


def id_bytes(vocab: str, end_id: int) -> int:
    """2 if the vocabulary and the end id allow it, else 4."""
    most = max(vocabulary(vocab).tokenizer.get_vocab_size(True) - 1, end_id)
    if end_id >= 1 << 24 or most >= 1 << 32:
        raise ValueError("the end id must have a zero as its top byte")
    return 2 if most < 1 << 16 and end_id < 1 << 8 else 4


def _flat(x: Column) -> Column:
    """The seven low bytes of a number below 2^56, the lowest first."""
    bytes_ = [F.lpad(F.hex(F.shiftrightunsigned(x, 8 * i).bitwiseAND(F.lit(255))), 2, "0") for i in range(7)]
    return F.unhex(F.concat(*bytes_)).cast("string")


def _flat_files(rows: DataFrame, path: str, *folders: str) -> None:
    """``value`` of rows, which are in order inside each of their folders."""
    rows.write.partitionBy(*folders).option("lineSep", SEPARATOR).option("compression", "none").text(path)


def write_token_files(docs: DataFrame, path: str, vocab: str, end_id: int, text: str = "text", doc_id: str = "doc_id") -> None:
    """Writes the folder ``path``, which must not exist yet."""
    spark, width = docs.sparkSession, id_bytes(vocab, end_id)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(-(-total // PART_BYTES), min(spark.sparkContext.defaultParallelism, -(-total // LEAST_BYTES)), 1)
    numbered = source.withColumns({"tie": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    dealt = numbered.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "tie", "place")
    dealt = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "place").select("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, row = Encoder(vocabulary(vocab)), TaskContext.get().partitionId(), 0
        end, kinds = np.array([end_id], np.uint32), pa.array(["ids", "documents"])
        for batch in steps(batches):
            ids = [np.append(x, end).astype(f"<u{width}") for x in encoder.encode(batch.column(1).to_pylist())]
            keys = batch.column(0).to_pylist()
            n = len(ids)
            rows = pa.array(np.tile(np.arange(row, row + n), 2), pa.int64())
            lines = [f"{row + i},{'' if k is None else k},{len(x)}".encode() for i, (k, x) in enumerate(zip(keys, ids, strict=True))]
            values = pa.array([x.tobytes()[:-1] for x in ids] + lines, pa.binary())
            kind = kinds.take(pa.array(np.repeat([0, 1], n)))
            yield pa.RecordBatch.from_arrays([kind, pa.array(np.full(2 * n, part), pa.int64()), rows, values], ["kind", "part", "row", "value"])
            row += n

    pieces = dealt.mapInArrow(encode, "kind string, part long, row long, value binary")
    pieces = pieces.withColumn("value", F.col("value").cast("string")).sortWithinPartitions("kind", "part", "row")
    _flat_files(pieces.drop("row"), f"{path}/data", "kind", "part")
    _write_offsets(spark, path, width, total)


def _write_offsets(spark: SparkSession, path: str, width: int, total: int) -> None:
    """Bases of parts by prefix sums, offsets of documents, and the manifest."""
    schema, none = "value string, part long", "part long, row long, doc_id long, n long"
    try:
        lines = spark.read.schema(schema).option("lineSep", SEPARATOR).text(f"{path}/data/kind=documents")
    except Exception as error:  # no document, so no part was written
        if "PATH_NOT_FOUND" not in str(error):
            raise
        docs = spark.createDataFrame([], none)
    else:
        field = F.split("value", ",")
        docs = lines.select("part", field[0].cast("long").alias("row"), field[1].try_cast("long").alias("doc_id"), field[2].cast("long").alias("n"))
    docs = written(docs)
    totals = docs.groupBy("part").agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_ids"))
    manifest = written(exclusive_prefix(totals, "part", {"n_docs": "docs_before", "n_ids": "ids_before"}).withColumn("id_bytes", F.lit(width)))
    running = F.sum("n").over(Window.partitionBy("part").orderBy("row")) - F.col("n")
    starts = docs.withColumn("start", running).join(manifest.select("part", "ids_before"), "part")
    starts = starts.select("part", "row", (F.col("ids_before") + F.col("start")).alias("start"))
    ends = manifest.select("part", F.col("n_docs").alias("row"), (F.col("ids_before") + F.col("n_ids")).alias("start"))
    all_ = starts.unionByName(ends).repartition("part").sortWithinPartitions("part", "row")
    _flat_files(all_.select("part", _flat(F.col("start")).alias("value")), f"{path}/offsets", "part")
    docs.select("part", "row", "doc_id").write.parquet(f"{path}/documents")
    manifest.write.parquet(f"{path}/manifest")


class Part:
    """One part's files, mapped into memory."""

    def __init__(self, folder: str, part: int, width: int):
        self.offsets = np.memmap(_only(f"{folder}/offsets/part={part}"), "<u8", "r")
        self.ids = np.memmap(_only(f"{folder}/data/kind=ids/part={part}"), f"<u{width}", "r")

    def of(self, row: int) -> tuple[int, np.ndarray]:
        """Of a document: how many ids of the corpus are before it, and its ids."""
        first, start, end = int(self.offsets[0]), int(self.offsets[row]), int(self.offsets[row + 1])
        return start, self.ids[start - first : end - first]


class HeldPart(Part):
    """One part's files, as bytes."""

    def __init__(self, offsets: bytes, ids: bytes, width: int):
        self.offsets, self.ids = np.frombuffer(offsets, "<u8"), np.frombuffer(ids, f"<u{width}")


def _only(folder: str) -> str:
    """The file of a part's folder."""
    return next(f"{folder}/{name}" for name in os.listdir(folder) if name.startswith("part-"))


def mounted(path: str) -> str | None:
    """The folder as tasks can open it, if its store is mounted."""
    url = urlparse(path)
    return unquote(url.path) if url.scheme in ("", "file") else None


def read_token_files(spark: SparkSession, path: str, of: Callable[[int, np.ndarray], tuple], fields: str, mapped: bool = True) -> DataFrame:
    """doc_id and what ``of`` (ids before the document, its ids) gives for every document, as
    ``fields``.  Tasks look documents up in mapped files if the store is mounted; else (or
    unless ``mapped``) each part's two files are read by Spark and used by one task."""
    docs, manifest = spark.read.parquet(f"{path}/documents"), spark.read.parquet(f"{path}/manifest")
    width = (manifest.agg(F.max("id_bytes")).first()[0]) or 4
    schema = f"doc_id long, {fields}"
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64() if " long" in x else pa.binary() for x in schema.split(", ")]
    folder = mounted(path) if mapped else None

    def rows(part: Part, rows_: list[int], ids: list[int | None]) -> pa.RecordBatch:
        out = [(k, *of(*part.of(r))) for r, k in zip(rows_, ids, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    def by_map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, each, ids = (c.to_pylist() for c in batch.columns)
            at = 0
            while at < len(parts):  # neighbours are mostly of one part
                end = at
                while end < len(parts) and parts[end] == parts[at]:
                    end += 1
                yield rows(Part(folder, parts[at], width), each[at:end], ids[at:end])
                at = end

    def by_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for offsets, ids, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield rows(HeldPart(offsets, ids, width), [x["row"] for x in own], [x["doc_id"] for x in own])

    if folder is not None:
        return docs.select("part", "row", "doc_id").mapInArrow(by_map, schema)
    files = lambda sub, name: spark.read.format("binaryFile").load(f"{path}/{sub}").select("part", F.col("content").alias(name))
    own = docs.groupBy("part").agg(F.collect_list(F.struct("row", "doc_id")).alias("own"))
    both = files("offsets", "offsets").join(files("data/kind=ids", "ids"), "part").join(own, "part")
    return both.select("offsets", "ids", "own").mapInArrow(by_bytes, schema)


def ids_crc(before: int, ids: np.ndarray) -> tuple[int, int, int]:
    """start, n_tokens and the CRC-32 of ids as 32-bit integers."""
    return before, len(ids), zlib.crc32(ids.astype("<u4").tobytes())


def token_file_digests(docs: DataFrame, path: str, vocab: str, end_id: int = 2) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files."""
    write_token_files(docs, path, vocab, end_id)
    return read_token_files(docs.sparkSession, path, ids_crc, "start long, n_tokens long, ids_crc32 long")
