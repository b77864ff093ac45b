"""Training order: fixed-length sequences of token ids in shards of fixed-stride records, permuted by a keyed Feistel network.

Each partition's texts are joined, an end mark after each, and cut into sequences, so that only a partition's last one is padded. Sequence
number ``i`` of ``n`` goes to slot ``permuted(i)``: a Feistel network permutes the next power of four, and numbers that land at
``n`` or beyond are put through again until they land below. Every slot is filled once, so record ``s`` stands in shard
``s // per_shard`` at byte ``(s % per_shard) * stride``: a reader that knows its step can go on from it.

Shards are written by Spark's text writer, one record a line: its commit protocol leaves whole files only, on any
file system. So each record ends with a line feed; ``stride`` counts it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelane.llm.words import mix, plain

ROUNDS = 4


def permuted(number: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slots of some of the numbers below ``n``; all of them together are a permutation. ``key``: 64 bits."""
    half = max(1, -(-max(1, n - 1).bit_length() // 2))
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xC2B2AE3D27D4EB4F) % 2**64) for r in range(ROUNDS)]
    out = number.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _cut(length: int, width: int, end: bytes, pad: bytes, starts: dict[int, tuple[int, int]], n: int, key: int):
    """Join and cut a partition's texts; its number tells where its sequences begin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, due = starts.get(TaskContext.get().partitionId(), (0, 0))
        size, rest, done = length * width, bytearray(), 0

        def records(data: bytes, count: int):
            nonlocal done
            number = np.arange(at + done, at + done + count)
            done += count
            made = pa.Array.from_buffers(pa.binary(), count, [None, pa.py_buffer((np.arange(count + 1) * size).astype(np.int32)), pa.py_buffer(data)])
            return pa.RecordBatch.from_arrays([pa.array(number), pa.array(permuted(number, n, key)), made], ["number", "slot", "record"])

        for batch in batches:
            for text in plain(batch["tokens"]).to_pylist():
                rest += text + end
                if (count := len(rest) // size) and len(rest) > 1 << 20:
                    yield records(bytes(rest[: count * size]), count)
                    del rest[: count * size]
        if rest:
            count = -(-len(rest) // size)
            yield records(bytes(rest) + pad * (count * length - len(rest) // width), count)
        if done != due:
            raise RuntimeError(f"a partition gave {done} sequences when written and {due} when counted; write its input first")

    return run


def _count(length: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(sum(b["size"].to_pylist()) for b in batches)
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([-(-total // (length * width))], pa.int64())], ["part", "n"])

    return run


def write_order(docs: DataFrame, path: str, length: int = 2047, width: int = 1, end: int = 255, pad: int = 254, per_shard: int = 8192, key: int = 1) -> int:
    """Write the sequences of all texts to ``path`` and return their number.

    ``docs.tokens`` is binary: little-endian token ids of ``width`` bytes each; null is empty, and an empty text still
    has its end mark. A sequence has ``length`` ids; a record is one byte longer. Other columns are ignored, equal rows
    count each, and no rows give no records. ``docs`` must give the same rows in the same partitions twice, as a scan of files
    does; if a partition's sequences have become more or fewer meanwhile, the job fails.
    """
    if length < 1 or width not in (1, 2, 4):
        raise ValueError("length must be at least 1 and width 1, 2 or 4")
    sized = docs.select((F.coalesce(F.octet_length("tokens"), F.lit(0)) + F.lit(width)).cast("long").alias("size"))
    counts = {r.part: r.n for r in sized.mapInArrow(_count(length, width), "part long, n long").collect()}
    starts, n = {}, 0
    for part in sorted(counts):
        starts[part] = (n, counts[part])
        n += counts[part]
    cut = _cut(length, width, end.to_bytes(width, "little"), pad.to_bytes(width, "little"), starts, max(n, 1), key)
    records = docs.select("tokens").mapInArrow(cut, "number long, slot long, record binary")
    shards = max(1, -(-n // per_shard))
    # A record of any bytes is written as it is: the cast changes the type only.
    placed = records.select(F.floor(F.col("slot") / per_shard).alias("shard"), "slot", F.col("record").cast("string").alias("value"))
    # Slots are the numbers below n, so the ranges need no sample of the data: a task holds whole shards, next to each other.
    tasks = min(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4)
    ranged = placed.withColumn("range", F.floor(F.col("shard") * tasks / shards).cast("int")).repartitionById(tasks, "range")
    ranged.sortWithinPartitions("shard", "slot").select("value", "shard").write.partitionBy("shard").text(path)
    return n


def _split(stride: int, width: int, pad: int, per_shard: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch["shard"].to_pylist(), batch["content"], strict=True):
                data = np.frombuffer(content.as_buffer(), np.uint8)
                if len(data) % stride or (data[stride - 1 :: stride] != 10).any():
                    raise ValueError(f"shard {shard} is no whole number of records")
                for at in range(0, len(data), stride * 512):
                    part = data[at : at + stride * 512].reshape(-1, stride)[:, :-1]
                    ids = np.ascontiguousarray(part).view(f"<u{width}")
                    offset = at + np.arange(len(part)) * stride
                    raw = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer((np.arange(len(part) + 1) * (stride - 1)).astype(np.int32)), pa.py_buffer(ids.tobytes())])
                    crc = pa.array([zlib.crc32(x) for x in raw.to_pylist()], pa.int64())
                    columns = [pa.array(shard * per_shard + offset // stride), pa.array(np.full(len(part), shard)), pa.array(offset), pa.array((ids != pad).sum(1)), crc, raw]
                    yield pa.RecordBatch.from_arrays(columns, ["slot", "shard", "byte_offset", "n_tokens", "crc32", "tokens"])

    return run


def read_order(spark: SparkSession, path: str, length: int = 2047, width: int = 1, pad: int = 254, per_shard: int = 8192, since: int = 0) -> DataFrame:
    """All records from slot ``since`` on: slot, shard, byte offset, tokens without padding, CRC-32 and the ids as bytes.

    Only shards that can hold such slots are read. A shard is read whole by one task; its size is ``per_shard`` records.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").schema("path string, modificationTime timestamp, length long, content binary, shard long")
    read = files.load(path).where(F.col("shard") >= since // per_shard).select("shard", "content")
    out = read.mapInArrow(_split(length * width + 1, width, pad, per_shard), "slot long, shard long, byte_offset long, n_tokens long, crc32 long, tokens binary")
    return out.where(F.col("slot") >= since)
