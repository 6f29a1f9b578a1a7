"""Token-ID files in patched frame-of-reference blocks.

A shard is one byte string (little-endian):

    magic "PFR1", block size u32, values u64, blocks u32, exceptions u32
    minimum u32, width u8 and number of exceptions u8 of every block
    block starts u32, one more than there are blocks, in the packed area
    packed area: values minus the block's minimum, low `width` bits each
    exception places u8 (in the block) and high parts u32 (what is above `width` bits)

The width of a block holds the given percentile of its values; larger ones are
exceptions. Any block is decoded alone through the index of block starts. Shards are
rows of a Parquet table that Spark writes and reads, so they live wherever Spark's readers
reach, with the keys and lengths of their documents beside them.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.llm.shipping import send_code
from faultline.llm.tokens import encode_all

MAGIC = b"PFR1"
BLOCK = 128
PERCENTILE = 0.9
#: A shard is closed once it holds this many values; documents are never split.
SHARD_VALUES = 1 << 18
_HEAD = struct.Struct("<4sIQII")


def encode(values: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> bytes:
    """One shard. `block` is a multiple of 8 and at most 248."""
    values = np.ascontiguousarray(values, dtype=np.uint32)
    n = len(values)
    blocks = -(-n // block)
    table = np.empty((blocks, block), np.uint32)
    table.ravel()[:n] = values
    if n:
        table.ravel()[n:] = values[-1]
    low = table.min(axis=1) if n else np.zeros(0, np.uint32)
    table -= low[:, None]
    place = min(int(np.ceil(percentile * block)), block) - 1
    typical = np.partition(table, place, axis=1)[:, place] if n else low
    width = np.ceil(np.log2(typical.astype(np.float64) + 1)).astype(np.uint8)
    size = block // 8 * width.astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(size)]).astype(np.uint32)
    packed = np.zeros(int(starts[-1]), np.uint8)
    high = table >> np.minimum(width, 31)[:, None].astype(np.uint32)
    high[width == 32] = 0
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        bits = (table[own][:, :, None] >> np.arange(w, dtype=np.uint32)) & np.uint32(1)
        rows = np.packbits(bits.astype(np.uint8).reshape(len(own), -1), axis=1, bitorder="little")
        packed[starts[own].astype(np.int64)[:, None] + np.arange(rows.shape[1])] = rows
    row, spot = np.nonzero(high)
    counts = np.bincount(row, minlength=blocks).astype(np.uint8)
    parts = [
        _HEAD.pack(MAGIC, block, n, blocks, len(row)),
        low.astype("<u4").tobytes(),
        width.tobytes(),
        counts.tobytes(),
        starts.astype("<u4").tobytes(),
        packed.tobytes(),
        spot.astype(np.uint8).tobytes(),
        high[row, spot].astype("<u4").tobytes(),
    ]
    return b"".join(parts)


class Shard:
    """Reads a shard, whole or block by block."""

    def __init__(self, payload: bytes):
        magic, self.block, self.n, self.blocks, exceptions = _HEAD.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = _HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(payload, kind, count, at)
            at += found.nbytes
            return found

        self.low = take("<u4", self.blocks)
        self.width = take("u1", self.blocks)
        counts = take("u1", self.blocks).astype(np.int64)
        self.starts = take("<u4", self.blocks + 1).astype(np.int64)
        self.packed = take("u1", int(self.starts[-1]))
        self.spots = take("u1", exceptions)
        self.high = take("<u4", exceptions)
        self.patches = np.concatenate([[0], np.cumsum(counts)])

    def decode(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """The values of blocks first..last (exclusive)."""
        last = self.blocks if last is None else last
        width = self.width[first:last]
        out = np.zeros((last - first, self.block), np.uint32)
        for w in np.unique(width[width > 0]).tolist():
            own = np.flatnonzero(width == w)
            size = self.block // 8 * w
            rows = self.packed[self.starts[first + own][:, None] + np.arange(size)]
            bits = np.unpackbits(rows, axis=1, bitorder="little").reshape(len(own), self.block, w)
            value = np.zeros((len(own), self.block), np.uint32)
            for bit in range(w):
                value |= bits[:, :, bit].astype(np.uint32) << np.uint32(bit)
            out[own] = value
        a, b = self.patches[first], self.patches[last]
        row = np.repeat(np.arange(last - first), np.diff(self.patches[first : last + 1]))
        out[row, self.spots[a:b]] |= self.high[a:b] << width[row].astype(np.uint32)
        out += self.low[first:last, None]
        return out.ravel()[: max(min(self.n, last * self.block) - first * self.block, 0)]


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    *,
    end_id: int = 1,
    blanks: bool = False,
    shard_values: int = SHARD_VALUES,
) -> None:
    """Writes the ids of all rows in ascending key order as a table of shards at `path`.

    Spark range-partitions the rows by key and sorts them in each part; a part's task
    tokenizes and encodes them. Every row is a document: its ids and then `end_id`. Null
    and empty texts are the end id alone; null keys come first; rows with equal keys are
    kept, in the order of their texts. Other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    send_code(docs.sparkSession)
    names = ["part", "shard", "values", "keys", "counts", "payload"]

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, shard = TaskContext.get().partitionId(), 0
        keys, held, size, kind_of = [], [], 0, None

        def close() -> pa.RecordBatch:
            values = np.concatenate(held)
            counts = [len(x) for x in held]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int64()),
                    pa.array([shard], pa.int64()),
                    pa.array([len(values)], pa.int64()),
                    pa.array([keys], pa.list_(kind_of)),
                    pa.array([counts], pa.list_(pa.int64())),
                    pa.array([encode(values)], pa.binary()),
                ],
                names=names,
            )

        for batch in batches:
            kind_of = batch.column(0).type
            own_keys = batch.column(0).to_pylist()
            for own, ids in zip(own_keys, encode_all(batch.column(1), tokenizer, blanks), strict=True):
                keys.append(own)
                held.append(np.append(ids, np.uint32(end_id)))
                size += len(ids) + 1
                if size >= shard_values:
                    yield close()
                    keys, held, size, shard = [], [], 0, shard + 1
        if held:
            yield close()

    # A repeated key is split by its texts, equal rows by their places: no key is one task.
    rows = docs.select(
        F.col(key).alias("key"),
        F.col(text).alias("text"),
        F.xxhash64(text).alias("print"),
        F.monotonically_increasing_id().alias("place"),
    )
    order = ("key", "print", "place")
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.select("key", "text").mapInArrow(
        shards,
        f"part long, shard long, values long, keys array<{kind}>, counts array<long>, payload binary",
    ).write.parquet(path)


def read_tokens(spark: SparkSession, path: str, key: str = "doc_id", *, keep_ids: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids_crc32 [, ids]) of every document in the shards at `path`."""
    send_code(spark)
    shards = spark.read.parquet(path)
    kind = shards.schema["keys"].dataType.elementType.simpleString()
    sizes = shards.select("part", "shard", "values")
    # One row per written part: sums of parts before, then of shards before within the part.
    parts = sizes.groupBy("part").agg(F.sum("values").alias("n"))
    before = parts.select(
        F.col("part").alias("p"),
        (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"),
    )
    inside = F.sum("values").over(Window.partitionBy("part").orderBy("shard")) - F.col("values")
    begin = sizes.select("part", "shard", inside.alias("inside")).join(
        before, F.col("part") == F.col("p")
    )
    begin = begin.select(
        F.col("part").alias("p"), F.col("shard").alias("s"), (F.col("inside") + F.col("before")).alias("begin")
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                values = Shard(batch.column(2)[i].as_py()).decode().astype("<u4")
                counts = np.array(batch.column(1)[i].as_py(), np.int64)
                ends = np.cumsum(counts)
                own = [values[a:b] for a, b in zip(ends - counts, ends, strict=True)]
                columns = [
                    batch.column(0)[i].values,
                    pa.array(ends - counts),
                    pa.array(counts),
                    pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64()),
                    pa.array([batch.column(3)[i].as_py()] * len(own), pa.int64()),
                    pa.array([batch.column(4)[i].as_py()] * len(own), pa.int64()),
                ]
                if keep_ids:
                    columns.append(pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(
                    columns, names=["key", "inside", "n_tokens", "ids_crc32", "p", "s", "ids"][: len(columns)]
                )

    schema = f"key {kind}, inside long, n_tokens long, ids_crc32 long, p long, s long"
    found = shards.select("keys", "counts", "payload", "part", "shard").mapInArrow(
        documents, schema + (", ids array<long>" if keep_ids else "")
    )
    return found.join(begin, ["p", "s"]).select(
        F.col("key").alias(key),
        (F.col("inside") + F.col("begin")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *(["ids"] if keep_ids else []),
    )
