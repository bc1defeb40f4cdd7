"""Ranked lexical search: best-first splitting of document intervals bounded by range maxima of posting lists.

Every task turns its documents into segments: per query term a posting list (documents in the order of the segment, and
their impacts, the term's share of the score), and over all lists a sparse table of the position of the largest impact in
every stretch of a power of two. The largest impact of a term among any interval of documents is then one look-up of two
stretches, and the sum of these maxima over the terms of a query bounds the score of every document in the interval.

A search begins with the whole segment. The intervals of highest bound are split at the document that holds the
largest single impact in them: that document is scored exactly, and the parts left and right of it get their own, tighter
bounds. Intervals whose bound is below the k-th best score so far are done; so are those that can only equal it with
larger ids. The k best so far go on to the next segment of the task, and the tasks' results are ranked once more.

Terms, weights and scores are integers: terms are runs of ASCII letters and digits and of all characters beyond ASCII,
A-Z in lower case; the formulas are at ``_impacts`` and ``_weights``. Corpus figures (N, L, df) are counted over all documents
first, in the pass that also reads the texts; the second pass reads term numbers only. Terms are compared by two
independent 64-bit multilinear hashes.

Items are taken in blocks of ``BLOCK_BYTES`` of text, which are sent to the workers; every block is searched in all
documents. A null or empty text (document or item) has no term: it counts for nothing and finds nothing. Texts of any
length are read whole; a longer item is a block of its own. Equal scores are ranked by ascending id, rows with a null id
last; repeated documents rank one by one; every row of the items is an item, and its repeated terms count once. An empty
table on either side gives an empty result. Further columns, whatever their names, are not read. Ids are integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickfacts.llm.common import cut

#: Bytes of item texts searched together, of document texts handled at a time, and postings of a segment.
BLOCK_BYTES, CHUNK_BYTES, SEGMENT_POSTINGS = 4 << 20, 1 << 20, 1 << 20
#: Positions (intervals times terms) worked on in a round.
ROUND_POSITIONS = 1 << 13
_NO_ID = np.iinfo(np.int64).max


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to terms, and every byte with A-Z in lower case."""
    inside = np.zeros(256, bool)
    for low, high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        inside[low : high + 1] = True
    folded = np.arange(256, dtype=np.uint8)
    folded[0x41:0x5B] += 0x20
    return inside, folded


_INSIDE, _FOLDED = _byte_tables()
_factors = np.empty((2, 0), np.uint64)


def _multipliers(length: int) -> np.ndarray:
    """Fixed random multipliers of the two hashes for the places of a term of ``length`` bytes."""
    global _factors
    if _factors.shape[1] < length:
        size = 1 << max(8, length.bit_length())
        _factors = np.stack([np.random.default_rng(seed).integers(0, 1 << 64, size, np.uint64) for seed in (11, 23)]) | np.uint64(1)
    return _factors


def term_runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts of the terms in the bytes of several texts: the text each lies in, and its two hashes.

    Text ``i`` is ``data[bounds[i]:bounds[i + 1]]``.
    """
    at = np.flatnonzero(_INSIDE[data])
    if not len(at):
        none = np.empty(0, np.uint64)
        return np.empty(0, np.int64), none, none
    opens = np.ones(len(at), bool)
    opens[1:] = np.diff(at) > 1
    # A text that begins inside a run of bytes begins a term.
    first = np.searchsorted(at, bounds[:-1])
    first = first[first < len(at)]
    opens[first] = True
    begins = np.flatnonzero(opens)
    lengths = np.diff(begins, append=len(at))
    place = np.arange(len(at)) - np.repeat(begins, lengths)
    factors = _multipliers(int(lengths.max()))
    values = _FOLDED[data[at]].astype(np.uint64) + np.uint64(1)
    hashes = [np.add.reduceat(values * f[place], begins) for f in factors]
    return np.searchsorted(bounds, at[begins], "right") - 1, hashes[0], hashes[1]


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts without copying, and the bounds of its rows; a null row is empty."""
    wide = pc.cast(column, pa.large_binary())
    bounds = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = np.frombuffer(wide.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


class Terms:
    """The distinct terms of a block of items."""

    def __init__(self, texts: list[str]):
        data, bounds = _bytes_of(pa.array(texts, pa.string()))
        owner, one, two = term_runs(data, bounds)
        pairs, which = np.unique(np.stack([one, two], axis=1), axis=0, return_inverse=True)
        self.one, self.two = np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])
        self._alike = int(np.unique(self.one, return_counts=True)[1].max(initial=1)) - 1
        #: Numbers of the terms of every item, each once.
        which = which.ravel()
        ends = np.searchsorted(owner, np.arange(len(texts) + 1))
        self.of_item = [np.unique(which[a:b]) for a, b in zip(ends, ends[1:], strict=False)]

    def __len__(self) -> int:
        return len(self.one)

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Number of the term with these hashes, -1 where there is none."""
        if not len(self):
            return np.full(len(one), -1)
        at = np.searchsorted(self.one, one).clip(max=len(self) - 1)
        # Terms that share the first hash follow one another; there is hardly ever a second.
        for _ in range(self._alike):
            at = np.where((self.one[at] == one) & (self.two[at] < two), np.minimum(at + 1, len(self) - 1), at)
        return np.where((self.one[at] == one) & (self.two[at] == two), at, -1)


def _postings(docs: DataFrame, key: str, text: str, terms: object) -> DataFrame:
    """``doc, n, terms, tfs`` of every document with a term: all its terms with repeats, and those the items ask for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = terms.value
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            chunk = (np.cumsum(sizes) - sizes) // CHUNK_BYTES
            edges = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), batch.num_rows]
            for begin, end in zip(edges, edges[1:], strict=False):
                part = batch.slice(begin, end - begin)
                owner, one, two = term_runs(*_bytes_of(part.column(1)))
                counts = np.bincount(owner, minlength=part.num_rows)
                found = known.find(one, two)
                hit = found >= 0
                pairs, tfs = np.unique(owner[hit] * max(1, len(known)) + found[hit], return_counts=True)
                of, number = np.divmod(pairs, max(1, len(known)))
                offsets = pa.array(np.searchsorted(of, np.arange(part.num_rows + 1)).astype(np.int32))
                made = {
                    "doc": part.column(0),
                    "n": pa.array(counts.astype(np.int64)),
                    "terms": pa.ListArray.from_arrays(offsets, pa.array(number.astype(np.int32))),
                    "tfs": pa.ListArray.from_arrays(offsets, pa.array(tfs.astype(np.int32))),
                }
                yield pa.RecordBatch.from_pydict(made).filter(pa.array(counts > 0))

    slim = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("text"))
    return slim.mapInArrow(run, "doc long, n long, terms array<int>, tfs array<int>")


def _weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2df + 1))) per term."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def _impacts(weights: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """w * (10^9 tf div (1000 tf + 8 m)) with m = 10 + (90 n N) div L, in 64-bit integers."""
    m = 10 + (90 * n * n_docs) // n_terms
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def _sparse_table(values: np.ndarray, longest: int) -> np.ndarray:
    """By level and position: where the largest value lies in the stretch of ``2 ** level`` that begins there."""
    levels = [np.arange(len(values), dtype=np.int32)]
    for level in range(1, max(1, longest).bit_length()):
        last, half = levels[-1], 1 << (level - 1)
        after = np.concatenate([last[half:], last[len(last) - half :]])
        levels.append(np.where(values[last] >= values[after], last, after))
    return np.stack(levels)


def _largest(table: np.ndarray, values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Position of the largest value in each ``[low, high)``; -1 for an empty one."""
    width = high - low
    level = np.frexp(np.maximum(width, 1))[1] - 1
    some = width > 0
    left = table[level, np.where(some, low, 0)]
    right = table[level, np.where(some, high - (1 << level), 0)]
    return np.where(some, np.where(values[left] >= values[right], left, right), -1)


class Best:
    """The k best documents of an item so far: scores, highest first, and ids, lowest first."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]

    @property
    def least(self) -> tuple[int, int]:
        """Score and id a further document has to beat; a score of 0 never counts."""
        return (int(self.scores[-1]), int(self.ids[-1])) if len(self.scores) == self.k else (0, -1)


class Segment:
    """Posting lists of some documents with their sparse table."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, terms: np.ndarray, impacts: np.ndarray):
        owner = np.repeat(np.arange(len(ids)), counts)
        order = np.lexsort((owner, terms))
        self.ids, self.n = ids, len(ids)
        self.docs, self.impacts = owner[order].astype(np.int32), impacts[order]
        self.places = terms[order].astype(np.int64) * self.n + self.docs
        used, sizes = np.unique(terms, return_counts=True)
        self.used = used
        self.table = _sparse_table(self.impacts, int(sizes.max(initial=0)))
        rank = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
        self.ranks = -rank
        self.rank_table = _sparse_table(self.ranks, self.n)

    def _bounded(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bound, and term and position of the largest impact, of the intervals with these list positions."""
        at = _largest(self.table, self.impacts, low, high)
        best = np.where(at >= 0, self.impacts[at], 0)
        top = best.argmax(axis=1)
        return best.sum(axis=1), top, at[np.arange(len(at)), top]

    def _smallest_id(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.ids[_largest(self.rank_table, self.ranks, begin, end)]

    def search(self, terms: np.ndarray, best: Best) -> None:
        """Adds the documents of the segment to the k best of an item with these terms."""
        terms = terms[np.isin(terms, self.used)]
        if not len(terms):
            return
        base = terms.astype(np.int64) * self.n
        at_once = max(1, ROUND_POSITIONS // len(terms))
        low, high = np.searchsorted(self.places, base)[None], np.searchsorted(self.places, base + self.n)[None]
        bound, _, top = self._bounded(low, high)
        # Open intervals: bound, first document, end, and the position of the largest impact.
        open_ = np.stack([bound, np.zeros(1, np.int64), np.full(1, self.n), top])
        while open_.shape[1]:
            score, last_id = best.least
            hopeful = open_[0] > score
            level = np.flatnonzero(open_[0] == score)
            if score and len(level):
                hopeful[level] = self._smallest_id(open_[1, level], open_[2, level]) < last_id
            open_ = open_[:, hopeful]
            if open_.shape[1] > at_once:
                order = np.argpartition(-open_[0], at_once - 1)
                now, open_ = open_[:, order[:at_once]], open_[:, order[at_once:]]
            else:
                now, open_ = open_, open_[:, :0]
            if not now.shape[1]:
                break
            begin, end, doc = now[1], now[2], self.docs[now[3]].astype(np.int64)
            low, high, middle = (np.searchsorted(self.places, base[None] + x[:, None]) for x in (begin, end, doc))
            clipped = np.minimum(middle, len(self.docs) - 1)
            here = (middle < high) & (self.docs[clipped] == doc[:, None])
            best.add(np.where(here, self.impacts[clipped], 0).sum(axis=1), self.ids[doc])
            parts = ((low, middle, begin, doc), (middle + here, high, doc + 1, end))
            for left, right, first, stop in parts:
                bound, _, top = self._bounded(left, right)
                some = bound > max(0, best.least[0] - 1)
                open_ = np.concatenate([open_, np.stack([bound, first, stop, top])[:, some]], axis=1)


def _found(postings: DataFrame, asked: object, k: int) -> DataFrame:
    """The k best documents of every item in every task: ``item, doc, score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_item, weights, n_docs, n_terms = asked.value
        best = [Best(k) for _ in of_item]

        def search(parts: list[pa.RecordBatch]) -> None:
            rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            ids = pc.fill_null(rows.column(0), _NO_ID).to_numpy(zero_copy_only=False)
            counts = pc.list_value_length(rows.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
            terms = rows.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            tf = rows.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            n = np.repeat(rows.column(1).to_numpy(zero_copy_only=False), counts)
            segment = Segment(ids, counts, terms, _impacts(weights[terms], tf, n, n_docs, n_terms))
            for item, own in zip(best, of_item, strict=True):
                segment.search(own, item)

        parts, size = [], 0
        for batch in batches:
            parts.append(batch)
            size += len(batch.column(2).flatten())
            if size >= SEGMENT_POSTINGS:
                search(parts)
                parts, size = [], 0
        if size:
            search(parts)
        sizes = [len(b.scores) for b in best]
        if sum(sizes):
            ids, scores = np.concatenate([b.ids for b in best]), np.concatenate([b.scores for b in best])
            yield pa.RecordBatch.from_pydict(
                {
                    "item": pa.array(np.repeat(np.arange(len(best)), sizes).astype(np.int32)),
                    "doc": pa.array(ids, mask=ids == _NO_ID),
                    "score": pa.array(scores),
                }
            )

    return postings.where(F.size("terms") > 0).mapInArrow(run, "item int, doc long, score long")


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of the items, ``BLOCK_BYTES`` of text (or a longer one) at a time."""
    ids, texts, size = [], [], 0
    for row in items.select(key, text).where(F.length(text) > 0).toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len(row[1].encode("utf-8", "surrogatepass")) + 64
        if size >= BLOCK_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _search_block(docs: DataFrame, ids: list, texts: list[str], k: int, key: str, item_type: T.DataType, text: str) -> DataFrame:
    context = docs.sparkSession.sparkContext
    terms = Terms(texts)
    postings = cut(_postings(docs, key, text, context.broadcast(terms)))
    n_docs, n_terms = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # A row for every term of the block at most.
    holding = np.zeros(len(terms), np.int64)
    for number, count in postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        holding[number] = count
    asked = context.broadcast((terms.of_item, _weights(holding, n_docs), n_docs, max(1, n_terms)))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
    ranked = _found(postings, asked, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = docs.sparkSession.createDataFrame(
        list(enumerate(ids)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", item_type)])
    )
    # The items of a block: bounded by its bytes.
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc", "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", item_key: str = "item_id", text: str = "text"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` highest-scoring documents of every item, score above 0."""
    spark, kind = docs.sparkSession, items.schema[item_key].dataType
    parts = [_search_block(docs, ids, texts, k, key, kind, text) for ids, texts in _blocks(items, item_key, text)]
    nothing = spark.createDataFrame(
        [], T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()),
                          T.StructField("doc", T.LongType()), T.StructField("score", T.LongType())])
    )
    found = reduce(DataFrame.unionAll, parts) if parts else nothing
    return found.select(F.col("item_id").alias(item_key), "rank", F.col("doc").alias(key), "score")
