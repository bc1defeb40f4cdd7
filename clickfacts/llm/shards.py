"""Token sequences in training order: fixed-stride binary shards, ordered by a keyed permutation.

Documents are encoded, closed by an end mark and cut into sequences of ``length`` tokens. Sequences are numbered
without gaps: each task counts its own, and the counts of the tasks before it are added. A Feistel network over the
smallest even number of bits, walked along its cycle until it falls into range, permutes the numbers: every sequence
gets one global slot, every slot one sequence, and anyone with the key can compute both ways without a table.

Shard ``k`` holds the slots from ``k * per_shard`` on, one record per slot in order, all of the same stride; slot ``s``
begins at byte ``(s mod per_shard) * stride`` of shard ``s div per_shard``. So a reader can stop and resume at any slot
with one seek. Shards are written by Spark's text sink (its line feed is the last byte of the stride): a lost task is
repeated, and a failed job leaves no shards behind. The records of a third of the shards are shuffled at a time, so
that never more than those are on disk besides the staged tokens and the shards.

A record is: document key (int64), sequence number in the document (int32), 1 for a null key else 0 (uint16), number of
tokens (uint16), ``length`` token ids (uint16, zeros after the last), line feed; all little-endian. Null and empty
texts are one sequence that holds the end mark only; very long texts become many sequences, in their order.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickfacts.llm.bpe import Ranks
from clickfacts.llm.common import chunks, cut, shared_dir

LENGTH, PER_SHARD, ROUNDS = 256, 1 << 15, 6
MOST_TASKS = 100_000
#: Actions that write the shards, each a range of them.
WRITES = 3
_HEADER = 16


def stride(length: int = LENGTH) -> int:
    return _HEADER + 2 * length + 1


def _round_keys(key: str) -> np.ndarray:
    return np.frombuffer(hashlib.blake2b(key.encode(), digest_size=8 * ROUNDS).digest(), np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(numbers: np.ndarray, size: int, key: str, inverse: bool = False) -> np.ndarray:
    """Where the keyed permutation of ``range(size)`` takes the numbers, or with ``inverse`` where they come from."""
    half = np.uint64(max(1, (max(size - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = _round_keys(key)
    out = np.array(numbers, np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> half, out[walking] & mask
        for i in range(ROUNDS):
            if inverse:
                left, right = right ^ (_mixed(left ^ keys[ROUNDS - 1 - i]) & mask), left
            else:
                left, right = right, left ^ (_mixed(right ^ keys[i]) & mask)
        out[walking] = left << half | right
        walking = walking[out[walking] >= size]
    return out.astype(np.int64)


def _encoded(documents: DataFrame, path: str, end: int, length: int) -> DataFrame:
    """``id, task, before, sequences, ids``: token ids as bytes, and the sequences of the task's rows before."""

    ranks = Ranks(documents.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, task, before = ranks.get(), TaskContext.get().partitionId(), 0
        for part, texts in chunks(batches, "text"):
            ids, counts = known.encode(texts)
            ids = ids.astype("<u2")
            stops = np.cumsum(counts)
            mark = np.array([end], "<u2").tobytes()
            rows = [ids[e - c : e].tobytes() + mark for e, c in zip(stops, counts, strict=True)]
            sequences = -(-(counts + 1) // length)
            firsts = before + np.cumsum(sequences) - sequences
            before += int(sequences.sum())
            yield pa.RecordBatch.from_pydict(
                {
                    "id": part.column(0),
                    "task": pa.array(np.full(len(rows), task, np.int64)),
                    "before": pa.array(firsts.astype(np.int64)),
                    "sequences": pa.array(sequences.astype(np.int64)),
                    "ids": pa.array(rows, pa.binary()),
                }
            )

    return documents.mapInArrow(run, "id long, task long, before long, sequences long, ids binary")


def _rows(table: np.ndarray) -> pa.Array:
    """The rows of a table of bytes as binary values."""
    n, size = table.shape
    buffers = [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * np.int32(size)), pa.py_buffer(table)]
    return pa.Array.from_buffers(pa.binary(), n, buffers)


def _records(rows: DataFrame, total: int, key: str, length: int, per_shard: int, low: int, high: int) -> DataFrame:
    """``shard, slot, record`` of every sequence of the rows ``id, first, sequences, ids`` in the shards ``low`` to ``high``
    (exclusive)."""
    size = stride(length) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                counts = part.column(2).to_numpy(zero_copy_only=False)
                n = int(counts.sum())
                owner = np.repeat(np.arange(part.num_rows), counts)
                number = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
                slots = permuted(part.column(1).to_numpy(zero_copy_only=False)[owner] + number, total, key)
                table = np.zeros((n, size), np.uint8)
                keys = part.column(0)
                missing = np.array(keys.is_null())
                header = np.zeros(n, [("id", "<i8"), ("number", "<i4"), ("none", "<u2"), ("tokens", "<u2")])
                header["id"] = np.array(keys.fill_null(0))[owner]
                header["number"], header["none"] = number, missing[owner]
                at = 0
                for data, count in zip(part.column(3).to_pylist(), counts.tolist(), strict=True):
                    padded = np.zeros(count * length * 2, np.uint8)
                    padded[: len(data)] = np.frombuffer(data, np.uint8)
                    table[at : at + count, _HEADER:] = padded.reshape(count, -1)
                    header["tokens"][at : at + count] = length
                    header["tokens"][at + count - 1] = len(data) // 2 - (count - 1) * length
                    at += count
                table[:, :_HEADER] = header.view(np.uint8).reshape(n, _HEADER)
                own = np.flatnonzero((slots >= low * per_shard) & (slots < high * per_shard))
                slots, record = slots[own], _rows(table[own])
                yield pa.RecordBatch.from_arrays([pa.array(slots // per_shard), pa.array(slots), record], ["shard", "slot", "record"])

    return rows.mapInArrow(run, "shard long, slot long, record binary")


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(documents: DataFrame, path: str, vocabulary_path: str, end: int, key: str, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, per_shard: int = PER_SHARD) -> int:
    """Write the shards of ``documents`` below ``path`` and return the number of sequences.

    Token ids and ``end`` must be below 65,536. Documents are encoded once, into a table beside the shards that is
    removed afterwards, because the permutation needs the number of all sequences.
    """
    spark = documents.sparkSession
    staged = f"{path}-tokens"
    texts = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    _encoded(texts, vocabulary_path, end, length).write.option("compression", "zstd").parquet(staged)
    tokens = spark.read.schema("id long, task long, before long, sequences long, ids binary").parquet(staged)
    tasks = cut(tokens.groupBy("task").agg(F.sum("sequences").alias("own")))
    so_far = F.sum("own").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = tasks.select("task", F.coalesce(so_far, F.lit(0)).alias("offset"))
    total, known = tasks.agg(F.coalesce(F.sum("own"), F.lit(0)), F.count("*")).first()
    # One short row per task of the scan: broadcast while that is certainly small, else joined by a shuffle.
    if known <= MOST_TASKS:
        offsets = F.broadcast(offsets)
    numbered = tokens.join(offsets, "task").select("id", (F.col("before") + F.col("offset")).alias("first"), "sequences", "ids")
    count = max(1, -(-total // per_shard))
    writes, written = min(WRITES, count), 0
    try:
        for low, high in pairwise(count * i // writes for i in range(writes + 1)):
            records = _records(numbered, total, key, length, per_shard, low, high)
            # A task for each shard: dealt by hash, some would get several.
            dealt = records.repartitionById(high - low, (F.col("shard") - low).cast("int"))
            lines = dealt.sortWithinPartitions("shard", "slot")
            lines = lines.select("shard", F.col("record").cast("string").alias("value"))
            sink = lines.write.mode("append" if written else "errorifexists").partitionBy("shard").option("compression", "none")
            # The mark of success comes with the last shards.
            sink.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(high == count).lower()).text(path)
            written = high
    except BaseException:
        if written:
            _delete(spark, path)
        raise
    _delete(spark, staged)
    return total


def read(spark: SparkSession, path: str, length: int = LENGTH, per_shard: int = PER_SHARD, from_slot: int = 0) -> DataFrame:
    """``slot, shard, begin, id, number, n_tokens, record`` of the records from ``from_slot`` on, by their places.

    Shards before that of ``from_slot`` are not opened, and in its shard reading begins at the record of ``from_slot``.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    if "shard" not in files.columns:
        # No document, no shard folder to discover the column from.
        files = files.withColumn("shard", F.lit(None).cast("long"))
    files = files.where(F.col("shard") >= from_slot // per_shard).select(F.col("shard").cast("long"), "content")
    size = stride(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                table = np.frombuffer(content.as_buffer(), np.uint8).reshape(-1, size)
                for at in range(max(0, from_slot - number * per_shard), len(table), 4096):
                    part = np.ascontiguousarray(table[at : at + 4096])
                    n = len(part)
                    header = part[:, :_HEADER].copy().view([("id", "<i8"), ("number", "<i4"), ("none", "<u2"), ("tokens", "<u2")]).ravel()
                    begins = np.arange(at, at + n) * size
                    yield pa.RecordBatch.from_pydict(
                        {
                            "slot": pa.array(number * per_shard + np.arange(at, at + n)),
                            "shard": pa.array(np.full(n, number, np.int64)),
                            "begin": pa.array(begins),
                            "id": pa.array(header["id"].copy(), mask=header["none"] == 1),
                            "number": pa.array(header["number"].copy()),
                            "n_tokens": pa.array(header["tokens"].astype(np.int32)),
                            "record": _rows(part),
                        }
                    )

    return files.mapInArrow(run, "slot long, shard long, begin long, id long, number int, n_tokens int, record binary")


def fresh_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/clickfacts-llm/shards-{uuid.uuid4().hex}"
