"""Stupid-backoff language-model scores of every document, from n-gram counts over all documents.

A word's score given the two before it is count(w1 w2 w3) / count(w1 w2) where the trigram occurs at least
``MIN_COUNT`` times in the corpus, else 0.4 count(w2 w3) / count(w2) where the bigram does, else 0.16 count(w3) / N;
the first words of a text start at the order they have. A document's score is the mean natural logarithm.

The n-gram rows are kept in columns of numbers instead of a row per occurrence:

1. Each scan task takes stretches of documents (chunks) and counts their n-grams; a chunk holds a distinct n-gram once.
2. Its n-grams go to the count tables, which are partitioned by ranges of the n-gram's hash: one row per chunk, order
   and range, with the sorted hashes as differences. A frequent n-gram is one number per chunk, so no range is hot.
3. Each range joins its count table to the n-grams that asked, and answers every chunk with the totals.
4. The answers meet their chunk again, whose documents travel as numbers of the chunk's own word list, and each
   document is summed.

A range has about ``RANGE_GRAMS`` n-grams at every input size, a chunk about ``CHUNK_WORDS`` words (a longer document
is a chunk of its own). Null texts and texts without words have no score (null) and zero words. Repeated rows count
each time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfacts.llm.common import chunks
from clickfacts.llm.omh import word_codes

ORDER, MIN_COUNT, DISCOUNT = 3, 2, 0.4
CHUNK_WORDS, RANGE_GRAMS = 1 << 20, 1 << 21
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _grams(codes: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Per order the hash of the n-gram that ends at each word; 0 where the text has fewer words before."""
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = []
    for n in range(1, ORDER + 1):
        mixed = np.full(len(codes), n, np.uint64)
        for back in range(n - 1, -1, -1):
            shifted = np.concatenate([np.zeros(min(back, len(codes)), np.uint64), codes[: len(codes) - back]])
            mixed = (mixed ^ shifted) * _GOLDEN
            mixed ^= mixed >> np.uint64(32)
        out.append(np.where(place >= n - 1, np.maximum(mixed, np.uint64(1)), np.uint64(0)))
    return out


def _packed(values: np.ndarray, kind: type) -> bytes:
    """Numbers with their bytes in planes, compressed: the high bytes of small ones take no room."""
    return zlib.compress(np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(len(values), -1).T).tobytes(), 1)


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


class _Chunk:
    """Documents in a row: their ids, word codes and sizes."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.codes: list[np.ndarray] = []

    @property
    def words(self) -> int:
        return sum(map(len, self.codes))

    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(self.codes), np.array([len(c) for c in self.codes])


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, _Chunk]]:
    """Numbered chunks of the documents of this task; the numbers are the same in every run of the same scan."""
    now, count, words = _Chunk(), 0, 0
    first = TaskContext.get().partitionId() << 32
    for part, texts in chunks(batches, "text"):
        for key, text in zip(part.column(0).to_pylist(), texts, strict=True):
            own = word_codes(text)
            if now.ids and words + len(own) > CHUNK_WORDS:
                yield first + count, now
                now, count, words = _Chunk(), count + 1, 0
            now.ids.append(key)
            now.codes.append(own)
            words += len(own)
    if now.ids:
        yield first + count, now


def _range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


_ASKED = "chunk long, gram_order int, part int, hashes binary, counts binary"


def _asked(documents: DataFrame, ranges: int) -> DataFrame:
    """The distinct n-grams of every chunk, a row per order and range of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in _chunked(batches):
            codes, sizes = chunk.flat()
            for order, grams in enumerate(_grams(codes, sizes), 1):
                distinct, counts = np.unique(grams[grams > 0], return_counts=True)
                if not len(distinct):
                    continue
                edges = np.searchsorted(_range_of(distinct, ranges), np.arange(ranges + 1))
                parts = np.flatnonzero(np.diff(edges))
                # Differences of sorted hashes need fewer bytes than the hashes.
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": pa.array([number] * len(parts), pa.int64()),
                        "gram_order": pa.array([order] * len(parts), pa.int32()),
                        "part": pa.array(parts, pa.int32()),
                        "hashes": pa.array([_packed(np.diff(distinct[edges[p] : edges[p + 1]], prepend=np.uint64(0)), np.uint64) for p in parts], pa.binary()),
                        "counts": pa.array([_packed(counts[edges[p] : edges[p + 1]], np.uint32) for p in parts], pa.binary()),
                    }
                )

    return documents.mapInArrow(run, _ASKED)


_ANSWERED = "chunk long, gram_order int, part int, ids binary, sizes binary, numbers binary, totals binary"
_ANSWER = pa.schema(
    [("chunk", pa.int64()), ("gram_order", pa.int32()), ("part", pa.int32())]
    + [(c, pa.binary()) for c in ("ids", "sizes", "numbers", "totals")]
)


def _answered(asked: DataFrame) -> DataFrame:
    """Totals over all chunks for the n-grams each chunk asked for, in the order it asked."""

    def run(rows: pa.Table) -> pa.Table:
        lists = [np.cumsum(_unpacked(h, np.uint64)) for h in rows.column("hashes").to_pylist()]
        counts = np.concatenate([_unpacked(c, np.uint32) for c in rows.column("counts").to_pylist()])
        distinct, where = np.unique(np.concatenate(lists), return_inverse=True)
        totals = np.bincount(where, counts, len(distinct))[where].astype(np.uint64)
        ends = np.cumsum([len(x) for x in lists])
        found = [_packed(t, np.uint64) for t in np.split(totals, ends[:-1])]
        nulls = pa.nulls(len(found), pa.binary())
        return pa.table(
            [rows.column("chunk"), rows.column("gram_order"), rows.column("part"), nulls, nulls, nulls, pa.array(found, pa.binary())],
            schema=_ANSWER,
        )

    return asked.groupBy("gram_order", "part").applyInArrow(run, _ANSWERED)


def _carried(documents: DataFrame) -> DataFrame:
    """The documents of every chunk: ids, sizes, and words as numbers of the chunk's own sorted word list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in _chunked(batches):
            codes, sizes = chunk.flat()
            words, own = np.unique(codes, return_inverse=True)
            ids = np.array([(key or 0, key is None) for key in chunk.ids], np.int64).ravel()
            row = [number, 0, 0, _packed(ids, np.int64), _packed(sizes, np.uint32), _packed(own, np.uint32), _packed(words, np.uint64)]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ANSWER, strict=True)], schema=_ANSWER)

    return documents.mapInArrow(run, _ANSWERED)


def _sums(codes: np.ndarray, sizes: np.ndarray, totals: list[np.ndarray], corpus: int) -> np.ndarray:
    """The summed logarithms of each document; ``totals`` by order are those of the sorted distinct n-grams."""
    grams = _grams(codes, sizes)
    count = []
    for order, own in enumerate(grams):
        distinct, where = np.unique(own[own > 0], return_inverse=True)
        if len(distinct) != len(totals[order]):
            raise RuntimeError("the two scans of the documents differ; pass a frame whose partitions do not change")
        found = np.zeros(len(own))
        found[own > 0] = totals[order][where]
        count.append(found)
    before = lambda values: np.concatenate([[corpus], values[:-1]])
    scores = np.log(np.maximum(count[0], 1) / max(corpus, 1))
    for order in range(1, ORDER):
        there = count[order] >= MIN_COUNT
        exists = grams[order] > 0
        direct = np.log(np.maximum(count[order], 1) / np.maximum(before(count[order - 1]), 1))
        scores = np.where(there, direct, np.where(exists, scores + np.log(DISCOUNT), scores))
    # Summed document by document, so that the result does not depend on its neighbours.
    return np.array([scores[end - size : end].sum() for end, size in zip(np.cumsum(sizes), sizes, strict=True)])


def _scored(rows: DataFrame, corpus: int, key: str) -> DataFrame:
    def run(rows: pa.Table) -> pa.Table:
        kept = sorted(rows.to_pylist(), key=lambda r: (r["gram_order"], r["part"]))
        document, answers = kept[0], kept[1:]
        ids = _unpacked(document["ids"], np.int64).reshape(-1, 2)
        sizes = _unpacked(document["sizes"], np.uint32).astype(np.int64)
        codes = _unpacked(document["totals"], np.uint64)[_unpacked(document["numbers"], np.uint32)]
        totals = [
            np.concatenate([np.empty(0, np.uint64), *(_unpacked(a["totals"], np.uint64) for a in answers if a["gram_order"] == n)])
            for n in range(1, ORDER + 1)
        ]
        sums = _sums(codes, sizes, totals, corpus)
        means = np.round(sums / np.maximum(sizes, 1), 6)
        return pa.table(
            {
                key: pa.array([None if missing else int(i) for i, missing in ids], pa.int64()),
                "n_words": pa.array(sizes),
                "score": pa.array([m if s else None for m, s in zip(means.tolist(), sizes, strict=True)], pa.float64()),
            }
        )

    return rows.groupBy("chunk").applyInArrow(run, f"{key} long, n_words long, score double")


def score(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, score`` of every row of ``documents``.

    The documents are scanned three times and must be in the same partitions each time, as files are.
    """
    texts = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in chunks(batches, "text"):
            yield pa.RecordBatch.from_pydict({"words": pa.array([sum(len(word_codes(t)) for t in own)], pa.int64())})

    corpus = texts.mapInArrow(sizes, "words long").agg(F.sum("words")).first()[0] or 0
    ranges = max(1, corpus // RANGE_GRAMS)
    answers = _answered(_asked(texts, ranges))
    return _scored(_carried(texts).unionByName(answers), corpus, key)
