"""Alignment of two tokenizers over whole texts, with corpus-wide counts of linked token pairs by external spill counting.

Both tokenizers cut the same bytes. Every stretch between two neighbouring token ends, of whichever side, lies in exactly
one token of each side, so these stretches are the links; ends that both sides share cut a document into groups. All of
that is array work on token ends (``links_of``).

Counting links by pair of ids is the external part:

1. A task cuts its documents into runs of about ``RUN_BYTES``. The (pair, document, times) records of a run are sorted by
   the id of side B, then A, radix-partitioned by B, and spilled as zstd pages of at most ``PAGE`` pairs to a table in the
   shared folder. The pairs of a page and how often the run links them are one column, the documents another.
2. Runs of one radix are merged, ``FAN`` at a time and level by level: a heap holds the first pair of every page not read
   yet, so only pages that reach the front are unpacked, and pairs before the front are counted. What merges is pairs,
   not documents: a pair that all documents share is one number per run.
3. The last level leaves each radix in B-major order, so the largest count of a B id is known when its pairs have passed.
4. Counts go back to the spilled records by radix and group of runs, are summed per document there, and the sums of a
   run's radixes meet its documents.

Side A is a byte-level vocabulary (``tokenizers`` JSON; merged by ``tiktoken``, which gives the same ids), side B a
``sentencepiece`` model; both files are sent to the workers. Special tokens are plain text. A null or empty text, and one whose
tokens on either side do not spell a space and the text, has no tokens: zeros and an empty digest. Texts are read whole; a
long one is a run of its own. Repeated rows count as often as they occur; all pairs with the largest count of their B id
are best, ties included. An empty table gives an empty result. Further columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfacts.llm.common import cut, shared_dir

#: Bytes of text in a run, pairs in a page, radixes of the B ids, runs merged at a time, and pairs held while merging.
RUN_BYTES, PAGE, RADIXES, FAN, HELD = 1 << 20, 1 << 15, 16, 64, 1 << 18
#: Ids of both sides lie below 2 ** 16.
_SIDE = 16
# Fixed value: the split pattern of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write every byte as one printable character; the others follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers, and the bytes of their ids."""

    def __init__(self, vocabulary: bytes, model: bytes):
        letters = _byte_of_character()
        entries = json.loads(vocabulary)["model"]["vocab"]
        spelled = {t: bytes(letters[c] for c in t) for t in entries if all(c in letters for c in t)}
        # Ids follow the order of the merges. Special tokens have no merge and are never made.
        ranks = {spelled[t]: i for t, i in entries.items() if t in spelled and not (t.startswith("<|") and t.endswith("|>"))}
        self._a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.a_bytes = _Spelling({i: t for t, i in ranks.items()})
        pieces = range(self._b.get_piece_size())
        self.b_bytes = _Spelling(
            {
                i: bytes([int(self._b.id_to_piece(i)[3:5], 16)]) if self._b.is_byte(i)
                else self._b.id_to_piece(i).replace("▁", " ").encode()
                for i in pieces
            }
        )
        if max(len(self.a_bytes.sizes), len(self.b_bytes.sizes)) > 1 << _SIDE:
            raise ValueError("ids must lie below 65,536")

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides of every text; none for an empty one."""
        a = [self._a.encode_ordinary(" " + t) if t else [] for t in texts]
        b = [ids if t else [] for t, ids in zip(texts, self._b.encode(texts, num_threads=1), strict=True)]
        return a, b


class _Spelling:
    """The bytes of all ids one after the other."""

    def __init__(self, of_id: dict[int, bytes]):
        spelled = [of_id.get(i, b"") for i in range(max(of_id) + 1)]
        self.flat = np.frombuffer(b"".join(spelled), np.uint8)
        self.sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def join(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        before = np.cumsum(sizes) - sizes
        return self.flat[np.repeat(self.starts[ids] - before, sizes) + np.arange(int(sizes.sum()))].tobytes()


@lru_cache(maxsize=1)
def _tokenizers(vocabulary: bytes, model: bytes) -> Tokenizers:
    """One pair of tokenizers per Python worker."""
    return Tokenizers(vocabulary, model)


def _texts_of_ids(bound: int) -> tuple[list[str], int]:
    """An id as text with the separator that follows it, by id and one of four separators."""
    return [f"{i}{sep}" for sep in ",|,;" for i in range(bound)], bound


_WRITTEN, _BOUND = _texts_of_ids(1 << _SIDE)


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.fromiter((i for row in rows for i in row), np.int64, int(counts.sum())), counts


def links_of(known: Tokenizers, texts: list[str]) -> tuple[dict[str, np.ndarray], list[str], np.ndarray, np.ndarray]:
    """Alignment of every text: its numbers, the digest of its groups, and its links as pair of ids and text.

    A pair is the id of B times 2 ** 16 plus the id of A.
    """
    a_rows, b_rows = known.encode(texts)
    for i, text in enumerate(texts):
        if a_rows[i]:
            whole = (" " + text).encode("utf-8", "surrogatepass")
            if known.b_bytes.join(np.array(b_rows[i])) != whole or known.a_bytes.join(np.array(a_rows[i])) != whole:
                a_rows[i], b_rows[i] = [], []
        else:
            b_rows[i] = []
    (a, n_a), (b, n_b) = _flat(a_rows), _flat(b_rows)
    a_ends, b_ends = np.cumsum(known.a_bytes.sizes[a]), np.cumsum(known.b_bytes.sizes[b])
    ends = np.union1d(a_ends, b_ends)
    of_a, of_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
    text_of_a = np.repeat(np.arange(len(texts)), n_a)
    owner = text_of_a[of_a]
    shared = np.intersect1d(a_ends, b_ends, assume_unique=True)
    n_groups = np.bincount(text_of_a[np.searchsorted(a_ends, shared)], minlength=len(texts))
    # Tokens in the order of the written groups: A's of a group, then B's.
    group_of_a, group_of_b = np.searchsorted(shared, a_ends), np.searchsorted(shared, b_ends)
    written = np.empty(len(a) + len(b), np.int64)
    last_a, last_b = np.diff(group_of_a, append=-1) != 0, np.diff(group_of_b, append=-1) != 0
    written[np.arange(len(a)) + np.searchsorted(group_of_b, group_of_a)] = a + _BOUND * last_a
    written[np.arange(len(b)) + np.searchsorted(group_of_a, group_of_b, "right")] = b + _BOUND * (2 + last_b)
    words = list(map(_WRITTEN.__getitem__, written.tolist()))
    stops = list(accumulate((n_a + n_b).tolist()))
    digests = [
        hashlib.sha256("".join(words[stop - n : stop])[:-1].encode()).hexdigest() if n else ""
        for stop, n in zip(stops, (n_a + n_b).tolist(), strict=True)
    ]
    numbers = {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": np.bincount(owner, minlength=len(texts))}
    return numbers, digests, b[of_b] << _SIDE | a[of_a], owner


def _pack(*arrays: np.ndarray) -> bytes:
    """Numbers below 2 ** 63 as zstd bytes, equal places of the numbers together."""
    planes = [np.ascontiguousarray(x, np.int64).view(np.uint8).reshape(-1, 8).T.tobytes() for x in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpack(page: bytes, *counts: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(page, max_output_size=8 * sum(counts)), np.uint8)
    out, at = [], 0
    for n in counts:
        out.append(np.ascontiguousarray(raw[at : at + 8 * n].reshape(8, n).T).view(np.int64).ravel())
        at += 8 * n
    return out


#: A spilled page: its pairs ascending (as differences) with their counts, and by pair the documents of the run.
PAGES = "run long, radix int, first long, n_pairs int, n_records int, pairs binary, records binary, docs binary"


def _pages(pairs: np.ndarray, owner: np.ndarray) -> Iterator[dict]:
    """Pages of a run's links, radix by radix, pairs ascending."""
    key = pairs << 32 | owner
    distinct, times = np.unique(key, return_counts=True)
    pair, doc = distinct >> 32, distinct & 0xFFFFFFFF
    radix = (pair >> _SIDE) % RADIXES
    order = np.argsort(radix, kind="stable")
    pair, doc, times, radix = pair[order], doc[order], times[order], radix[order]
    opens = np.flatnonzero(np.diff(pair, prepend=-1))
    stops = np.append(opens[1:], len(pair))
    own, own_radix = pair[opens], radix[opens]
    totals = np.add.reduceat(times, opens) if len(opens) else times
    for r in range(RADIXES):
        low, high = np.searchsorted(own_radix, [r, r + 1])
        for begin in range(low, high, PAGE):
            end = min(begin + PAGE, high)
            a, b = opens[begin], stops[end - 1]
            yield {
                "radix": r,
                "first": int(own[begin]),
                "n_pairs": int(end - begin),
                "n_records": int(b - a),
                "pairs": _pack(np.diff(own[begin:end], prepend=0), totals[begin:end]),
                "records": _pack(stops[begin:end] - opens[begin:end], doc[a:b], times[a:b]),
            }


_DOC_ROWS = pa.schema(
    [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
     ("groups_sha256", pa.string())]
)
_PAGE_ROWS = pa.schema(
    [("run", pa.int64()), ("radix", pa.int32()), ("first", pa.int64()), ("n_pairs", pa.int32()), ("n_records", pa.int32()),
     ("pairs", pa.binary()), ("records", pa.binary()), ("docs", pa.binary())]
)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts (null as empty) of a run."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for begin in range(0, batch.num_rows, 64):
            part = batch.slice(begin, 64)
            for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                ids.append(key)
                texts.append(text or "")
                size += len(texts[-1]) + 64
                if size >= RUN_BYTES:
                    yield ids, texts
                    ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _spill(docs: DataFrame, vocabulary: str, model: str) -> DataFrame:
    """The pages of all runs, and for every run a row (radix -1) with its documents."""
    context = docs.sparkSession.sparkContext
    files = [context.broadcast(open(path, "rb").read()) for path in (vocabulary, model)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _tokenizers(*[f.value for f in files])
        for number, (ids, texts) in enumerate(_runs(batches)):
            numbers, digests, pairs, owner = links_of(known, texts)
            rows = pa.RecordBatch.from_pydict({"doc_id": ids, **numbers, "groups_sha256": digests}, _DOC_ROWS)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, _DOC_ROWS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_batch(rows)
            name = TaskContext.get().partitionId() << 32 | number
            pages = [{"radix": -1, "docs": sink.getvalue().to_pybytes()}, *_pages(pairs, owner)]
            yield pa.RecordBatch.from_pylist([{"run": name, **page} for page in pages], _PAGE_ROWS)

    return docs.mapInArrow(run, PAGES)


class _Merge:
    """k-way merge of pages by a heap: pairs ascending, counts of equal pairs added."""

    def __init__(self, runs: list[int], firsts: list[int], sizes: list[int], pages: list[bytes]):
        # Pages of a run ascend and do not overlap; a page enters the heap when the one before it is read.
        order = sorted(range(len(pages)), key=lambda i: (runs[i], firsts[i]))
        self.after = {i: j for i, j in zip(order, order[1:], strict=False) if runs[i] == runs[j]}
        later = set(self.after.values())
        self.heap = [(firsts[i], i) for i in order if i not in later]
        heapq.heapify(self.heap)
        self.firsts, self.sizes, self.pages = firsts, sizes, pages

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        held, counts, size = [], [], 0
        while self.heap:
            _, i = heapq.heappop(self.heap)
            if i in self.after:
                j = self.after[i]
                heapq.heappush(self.heap, (self.firsts[j], j))
            gaps, times = _unpack(self.pages[i], self.sizes[i], self.sizes[i])
            held.append(np.cumsum(gaps))
            counts.append(times)
            size += len(gaps)
            if size >= HELD and self.heap:
                pairs, sums = _added(held, counts)
                ready = int(np.searchsorted(pairs, self.heap[0][0]))
                yield pairs[:ready], sums[:ready]
                held, counts, size = [pairs[ready:]], [sums[ready:]], 0
        if held:
            yield _added(held, counts)


def _added(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    all_pairs, all_counts = np.concatenate(pairs), np.concatenate(counts)
    order = np.argsort(all_pairs, kind="stable")
    all_pairs = all_pairs[order]
    opens = np.flatnonzero(np.diff(all_pairs, prepend=-1))
    return all_pairs[opens], np.add.reduceat(all_counts[order], opens) if len(opens) else all_counts


def _merged(table: pa.Table) -> _Merge:
    column = {n: table.column(n).to_pylist() for n in ("run", "first", "n_pairs", "pairs")}
    return _Merge(column["run"], column["first"], column["n_pairs"], column["pairs"])


_COUNTS = "run long, radix int, first long, n_pairs int, pairs binary"


def _merge_level(pages: DataFrame, groups: int) -> DataFrame:
    """Runs of a radix merged into ``groups`` runs."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        made = []
        for pairs, counts in _merged(table):
            for begin in range(0, len(pairs), PAGE):
                own, times = pairs[begin : begin + PAGE], counts[begin : begin + PAGE]
                page = _pack(np.diff(own, prepend=0), times)
                made.append({"run": key[1].as_py(), "radix": key[0].as_py(), "first": int(own[0]), "n_pairs": len(own), "pairs": page})
        return pa.Table.from_pylist(made, pa.schema([f for f in _PAGE_ROWS if f.name in ("run", "radix", "first", "n_pairs", "pairs")]))

    group = F.pmod(F.xxhash64("run"), F.lit(groups)).alias("group")
    return pages.groupBy("radix", group).applyInArrow(run, _COUNTS)


_FINAL = "radix int, n_pairs int, counted binary"


def _final_counts(pages: DataFrame) -> DataFrame:
    """Per radix the pairs with their counts, and whether a count is the largest of its B id."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        made = []
        tail, tail_counts = np.empty(0, np.int64), np.empty(0, np.int64)

        def passed(pairs: np.ndarray, counts: np.ndarray) -> None:
            if len(pairs):
                opens = np.flatnonzero(np.diff(pairs >> _SIDE, prepend=-1))
                most = np.repeat(np.maximum.reduceat(counts, opens), np.diff(opens, append=len(pairs)))
                page = _pack(np.diff(pairs, prepend=0), counts, counts == most)
                made.append({"radix": key[0].as_py(), "n_pairs": len(pairs), "counted": page})

        for pairs, counts in _merged(table):
            pairs, counts = np.concatenate([tail, pairs]), np.concatenate([tail_counts, counts])
            # All but the last B id have passed.
            done = int(np.searchsorted(pairs >> _SIDE, pairs[-1] >> _SIDE)) if len(pairs) else 0
            passed(pairs[:done], counts[:done])
            tail, tail_counts = pairs[done:], counts[done:]
        passed(tail, tail_counts)
        return pa.Table.from_pylist(made, pa.schema([("radix", pa.int32()), ("n_pairs", pa.int32()), ("counted", pa.binary())]))

    return pages.groupBy("radix").applyInArrow(run, _FINAL)


_SUMS = "run long, docs array<int>, sums array<long>, best array<long>"
_SUM_ROWS = pa.schema([("run", pa.int64()), ("docs", pa.list_(pa.int32())), ("sums", pa.list_(pa.int64())), ("best", pa.list_(pa.int64()))])


def _contributions(pages: DataFrame, counted: DataFrame, groups: int) -> DataFrame:
    """What the links of a radix add to the documents of every run."""

    def run(key: tuple, pages: pa.Table, counted: pa.Table) -> pa.Table:
        parts = [_unpack(p, n, n, n) for p, n in zip(counted.column("counted").to_pylist(), counted.column("n_pairs").to_pylist(), strict=True)]
        pairs = np.concatenate([np.cumsum(p[0]) for p in parts]) if parts else np.empty(0, np.int64)
        counts, best = (np.concatenate([p[i] for p in parts]) if parts else pairs for i in (1, 2))
        order = np.argsort(pairs, kind="stable")
        pairs, counts, best = pairs[order], counts[order], best[order]
        by_run: dict[int, list[tuple[np.ndarray, ...]]] = {}
        column = {n: pages.column(n).to_pylist() for n in ("run", "n_pairs", "n_records", "pairs", "records")}
        for name, n_pairs, n_records, own, records in zip(*column.values(), strict=True):
            gaps, _ = _unpack(own, n_pairs, n_pairs)
            sizes, docs, times = _unpack(records, n_pairs, n_records, n_records)
            at = np.repeat(np.searchsorted(pairs, np.cumsum(gaps)), sizes)
            by_run.setdefault(name, []).append((docs, times * counts[at], times * best[at]))
        rows = []
        for name, added in by_run.items():
            docs, sums, most = (np.concatenate([x[i] for x in added]) for i in range(3))
            touched, which = np.unique(docs, return_inverse=True)
            total = np.zeros((2, len(touched)), np.int64)
            np.add.at(total[0], which, sums)
            np.add.at(total[1], which, most)
            rows.append({"run": name, "docs": touched.astype(np.int32), "sums": total[0], "best": total[1]})
        return pa.Table.from_pylist(rows, _SUM_ROWS)

    group = F.pmod(F.xxhash64("run"), F.lit(groups)).cast("int")
    left = pages.withColumn("group", group).select("radix", "group", "run", "n_pairs", "n_records", "pairs", "records")
    right = counted.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return left.groupBy("radix", "group").cogroup(right.groupBy("radix", "group")).applyInArrow(run, _SUMS)


RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _finish(docs: DataFrame, sums: DataFrame) -> DataFrame:
    """The documents of every run with the sums of its radixes."""

    def run(table: pa.Table) -> pa.Table:
        packed = [d for d in table.column("documents").to_pylist() if d is not None][0]
        rows = pa.ipc.open_stream(packed).read_all()
        total = np.zeros((2, rows.num_rows), np.int64)
        flat = [pc.list_flatten(table.column(n)).to_numpy() for n in ("docs", "sums", "best")]
        for i in (0, 1):
            np.add.at(total[i], flat[0], flat[i + 1])
        named = {n: rows.column(n) for n in rows.schema.names}
        named |= {"n_best": pa.array(total[1]), "count_sum": pa.array(total[0])}
        return pa.table({f.split()[0]: named[f.split()[0]] for f in RESULT.split(", ")})

    none = [F.lit(None).cast(t).alias(n) for n, t in (("docs", "array<int>"), ("sums", "array<long>"), ("best", "array<long>"))]
    both = docs.select("run", F.col("docs").alias("documents"), *none).unionByName(sums.withColumn("documents", F.lit(None).cast("binary")))
    return both.groupBy("run").applyInArrow(run, RESULT)


def _discard(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def align(docs: DataFrame, vocabulary: str, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Numbers of tokens, groups and links of every document, and what the corpus says about its links.

    ``n_best`` links have the largest count of their B id in the corpus, ``count_sum`` is the sum of the counts.
    """
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/clickfacts-llm/spill-{uuid.uuid4().hex}"
    slim = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    _spill(slim, vocabulary, model).write.parquet(path)
    spilled = spark.read.schema(PAGES).parquet(path)
    pages = spilled.where("radix >= 0")
    runs = spilled.where("radix < 0").count()
    level, left = pages.select("run", "radix", "first", "n_pairs", "pairs"), runs
    while left > FAN:
        left = -(-left // FAN)
        level = cut(_merge_level(level, left))
    counted = cut(_final_counts(level))
    sums = _contributions(pages, counted, max(1, -(-runs // FAN)))
    done = cut(_finish(spilled.where("radix < 0").select("run", "docs"), sums))
    _discard(spark, path)
    return done.withColumnRenamed("doc_id", key)
