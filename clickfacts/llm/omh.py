"""Near-duplicate texts by order MinHash, verified by banded alignment.

A text is its sequence of five-word shingles, each labelled with its occurrence number. A sketch takes the shingles
with the smallest hashes and keeps them in text order, so two texts share it if the same shingles are smallest and lie
in the same order: likely for texts at a small edit distance. Texts that agree in at least two sketches are
candidates; the similarity is then exact:

    matched / (n + m - matched), matched = shingles that an alignment of the two sequences pairs up,

the Jaccard similarity of five-word shingles with order respected, and 0.8 or more is a link. The alignment is a
dynamic program within the band that a similarity of 0.8 allows, for many pairs at a time.

No group is expanded into all its pairs. Equal texts (after lower-casing and dropping punctuation) are one
representative. In each bucket every text is compared with one hub, the text whose buckets are largest; components of
these links are found, and only texts of a bucket that are still in different components are compared further: those
pairs whose shingles that occur in several of the components would suffice for the similarity.

Null texts and texts without words belong to no group. Texts with fewer than five words are one shingle, so they are
duplicates only of equal ones. Very long texts are processed whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickfacts.llm.common import chunks, cut
from clickfacts.llm.components import components

SHINGLE, THRESHOLD = 5, 0.8
#: Sketches of long texts and their shingles each. At similarity 0.8 two texts agree in a sketch with probability
#: 0.8 ** 5, and in fewer than two of 32 with probability below 0.0001.
SKETCHES, ORDER = 32, 5
#: Texts of up to SHORT_MOST shingles also have these (0.8 ** 2 each); those of up to SHORT_ONLY have nothing else.
SHORT_SKETCHES, SHORT_ORDER, SHORT_ONLY, SHORT_MOST = 16, 2, 24, 32
AGREE = 2
#: Parts of the hash space by which shared shingles are counted before an alignment.
CELLS = 64
#: Characters of a text whose words are coded at a time.
BLOCK_CHARS = 1 << 19
_WORD = re.compile(r"[^\W_]+")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@cache
def _in_words() -> np.ndarray:
    """Which codepoints words consist of."""
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


def word_codes(text: str) -> np.ndarray:
    """64-bit codes of the words of ``text`` in their order, the same in every process.

    The code of a word sums up one mixed number per character and place, so no word is looked at on its own.
    """
    characters = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    out, at = [], 0
    while at < len(characters):
        part = characters[at : at + BLOCK_CHARS]
        inside = _in_words()[part]
        if at + len(part) < len(characters):
            # A block ends behind its last break, unless it is one long word: that is taken whole.
            breaks = np.flatnonzero(~inside)
            if not len(breaks):
                rest = ~_in_words()[characters[at + len(part) :]]
                end = at + len(part) + int(rest.argmax()) if rest.any() else len(characters)
                part = characters[at:end]
                inside = np.ones(len(part), bool)
            else:
                part, inside = part[: breaks[-1] + 1], inside[: breaks[-1] + 1]
        at += len(part)
        where = np.flatnonzero(inside)
        if not len(where):
            continue
        firsts = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1] + 1]))
        lengths = np.diff(np.append(firsts, len(where)))
        places = np.arange(len(where)) - np.repeat(firsts, lengths)
        numbers = _mixed((part[where].astype(np.uint64) + (places.astype(np.uint64) << np.uint64(21)) + np.uint64(1)) * _GOLDEN)
        out.append(_mixed((np.add.reduceat(numbers, firsts) + lengths.astype(np.uint64)) * _GOLDEN))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingles(codes: np.ndarray) -> np.ndarray:
    """Codes of the five-word shingles in text order; a shorter text is one shingle."""
    n = max(1, len(codes) - SHINGLE + 1) if len(codes) else 0
    width = min(SHINGLE, len(codes))
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = _mixed((out + codes[i : n + i]) * _GOLDEN)
    return out


def _labelled(found: np.ndarray) -> np.ndarray:
    """Shingles told apart by how often each occurred before."""
    order = np.argsort(found, kind="stable")
    ordered = found[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    if first.all():
        return found
    begins = np.maximum.accumulate(np.where(first, np.arange(len(found)), 0))
    occurrence = np.empty(len(found), np.uint64)
    occurrence[order] = (np.arange(len(found)) - begins).astype(np.uint64)
    return np.where(occurrence > 0, _mixed(found + occurrence * _GOLDEN), found)


def _least(ranks: np.ndarray, order: int) -> np.ndarray:
    """Places of the ``order`` smallest numbers of every row, ascending."""
    bound = np.partition(ranks, order - 1, axis=1)[:, order - 1, None]
    places = np.flatnonzero(ranks <= bound)
    if len(places) != len(ranks) * order:
        # Equal numbers at the bound: the first ones count.
        return np.sort(np.argsort(ranks, axis=1, kind="stable")[:, :order], axis=1)
    return (places % ranks.shape[1]).reshape(len(ranks), order)


def _sketch(found: np.ndarray, count: int, order: int, seed: int) -> np.ndarray:
    draw = np.random.default_rng(seed)
    salts = draw.integers(1, 1 << 32, count, dtype=np.uint32)
    factors = draw.integers(1, 1 << 32, count, dtype=np.uint32) | np.uint32(1)
    out = np.full(count, seed, np.uint64)
    # Half of a code ranks the shingles; the sketch is made of whole ones.
    halves = (found >> np.uint64(32)).astype(np.uint32)
    order = min(order, len(found))
    # As many sketches at a time as keep the table of ranks in the processor's cache, also for a very long text.
    step = max(1, (1 << 17) // len(found))
    for i in range(0, count, step):
        least = _least((halves ^ salts[i : i + step, None]) * factors[i : i + step, None], order)
        for j in range(order):
            out[i : i + step] = _mixed((out[i : i + step] + found[least[:, j]]) * _GOLDEN)
    # The number of the sketch is part of its key.
    return _mixed(out + np.arange(count, dtype=np.uint64) * _GOLDEN)


def sketch_keys(found: np.ndarray) -> np.ndarray:
    n = len(found)
    keys = []
    if 2 <= n <= SHORT_MOST:
        keys.append(_sketch(_labelled(found), SHORT_SKETCHES, SHORT_ORDER, 2))
    if n > SHORT_ONLY:
        keys.append(_sketch(_labelled(found), SKETCHES, ORDER, 5))
    return np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)


_SKETCHED = "id long, digest binary, n int, keys array<long>"


def _sketched(texts: DataFrame) -> DataFrame:
    """``id, digest, n, keys`` of the texts ``id, text`` that have words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in chunks(batches, "text"):
            ids, digests, sizes, keys = [], [], [], []
            for key, text in zip(part.column(0).to_pylist(), own, strict=True):
                if key is None or not len(codes := word_codes(text)):
                    continue
                found = shingles(codes)
                ids.append(key)
                digests.append(hashlib.blake2b(codes.tobytes(), digest_size=16).digest())
                sizes.append(len(found))
                keys.append(sketch_keys(found))
            yield pa.RecordBatch.from_pydict(
                {
                    "id": pa.array(ids, pa.int64()),
                    "digest": pa.array(digests, pa.binary()),
                    "n": pa.array(sizes, pa.int32()),
                    "keys": pa.array(keys, pa.list_(pa.int64())),
                }
            )

    return texts.mapInArrow(run, _SKETCHED)


def _coded(texts: DataFrame) -> DataFrame:
    """``id, codes``: the word codes of the texts ``id, text`` as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in chunks(batches, "text"):
            # Half of a code is enough for the alignment and halves what is shuffled.
            found = [word_codes(t).astype(np.uint32).tobytes() for t in own]
            yield pa.RecordBatch.from_pydict({"id": part.column(0), "codes": pa.array(found, pa.binary())})

    return texts.mapInArrow(run, "id long, codes binary")


def _distances(pairs: list[tuple[np.ndarray, np.ndarray]], band: int) -> np.ndarray:
    """Insertions and deletions that turn one sequence into the other, exact up to ``band``, for many pairs at once."""
    rows = max(len(a) for a, _ in pairs)
    width = 2 * band + 1
    left = np.zeros((len(pairs), rows), np.uint64)
    right = np.ones((len(pairs), rows + width), np.uint64)
    for i, (a, b) in enumerate(pairs):
        left[i, : len(a)] = a
        keep = min(len(b), rows + band)
        right[i, band : band + keep] = b[:keep]
    lengths = np.array([len(a) for a, _ in pairs])
    ends = np.array([len(b) - len(a) + band for a, b in pairs])
    inside = (ends >= 0) & (ends < width)
    result = np.full(len(pairs), 2 * band + 2)
    steps = np.arange(width, dtype=np.int32)
    far = np.int32(1 << 28)
    # Cell k of row i is the distance of the first i of one and the first i + k - band of the other.
    now = np.where(steps >= band, steps - band, far)[None, :].repeat(len(pairs), axis=0).astype(np.int32)
    for i in range(rows + 1):
        if i:
            differ = left[:, i - 1, None] != right[:, i - 1 : i - 1 + width]
            step = now + np.where(differ, far, 0).astype(np.int32)
            step[:, :-1] = np.minimum(step[:, :-1], now[:, 1:] + 1)
            if i <= band:
                # Before the beginning of the other sequence there is nothing; at it, all of this one is deleted.
                step[:, : band - i] = far
                step[:, band - i] = i
            now = np.minimum(np.minimum.accumulate(step - steps, axis=1) + steps, far)
        done = np.flatnonzero((lengths == i) & inside)
        result[done] = now[done, ends[done]]
    return result


def similarities(pairs: list[tuple[np.ndarray, np.ndarray]], threshold: float = THRESHOLD) -> np.ndarray:
    """Alignment similarity of pairs of shingle sequences; 0 where it is surely below ``threshold``."""
    out = np.zeros(len(pairs))
    todo = []
    for i, (a, b) in enumerate(pairs):
        # Not even an alignment of all common shingles would do.
        values, where = np.unique(np.concatenate([a, b]), return_inverse=True)
        common = np.minimum(np.bincount(where[: len(a)], minlength=len(values)), np.bincount(where[len(a) :], minlength=len(values))).sum()
        if common >= threshold * (len(a) + len(b) - common) - 1e-9 and common:
            todo.append(i)
    total = np.array([len(a) + len(b) for a, b in pairs])
    # A similarity of at least t allows (n + m)(1 - t) / (1 + t) insertions and deletions.
    allowed = np.floor(total * (1 - threshold) / (1 + threshold) + 1e-9).astype(int)
    for attempt in (24, None):
        rest = []
        todo.sort(key=lambda i: (len(pairs[i][0]), allowed[i]))
        at = 0
        while at < len(todo):
            band = int(allowed[todo[at]]) if attempt is None else attempt
            group = [todo[at]]
            while at + len(group) < len(todo):
                new = todo[at + len(group)]
                wide = max(band, int(allowed[new])) if attempt is None else band
                if (len(group) + 1) * (2 * wide + 1) > 1 << 16 or len(pairs[new][0]) > 1.3 * len(pairs[todo[at]][0]) + 8:
                    break
                band = wide
                group.append(new)
            at += len(group)
            found = _distances([pairs[i] for i in group], band)
            for i, d in zip(group, found, strict=True):
                if d <= band:
                    matched = (total[i] - d) / 2
                    out[i] = matched / (total[i] - matched)
                elif attempt is not None and allowed[i] > band:
                    rest.append(i)
        todo = rest
    return out


def _verified(pairs: DataFrame, coded: DataFrame, threshold: float) -> DataFrame:
    """The links ``a, b`` among candidate pairs, with their similarity."""
    both = pairs.join(coded.select(F.col("id").alias("a"), F.col("codes").alias("left")), "a").join(
        coded.select(F.col("id").alias("b"), F.col("codes").alias("right")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                left, right = (
                    [shingles(np.frombuffer(c, np.uint32).astype(np.uint64)) for c in part.column(i).to_pylist()] for i in (2, 3)
                )
                sim = similarities(list(zip(left, right, strict=True)), threshold)
                keep = pa.array(sim >= threshold - 1e-9)
                yield pa.RecordBatch.from_pydict(
                    {"a": part.column(0), "b": part.column(1), "similarity": pa.array(sim)}
                ).filter(keep)

    return both.select("a", "b", "left", "right").mapInArrow(run, "a long, b long, similarity double")


def _sharable(placed: DataFrame, coded: DataFrame) -> DataFrame:
    """``id, most, cells``: how many shingles of a text an alignment with texts of other components can match at most.

    ``placed`` holds ``id, component`` of the texts in question; a shingle that only one component of them has cannot
    be matched outside it. ``cells`` counts the others by parts of the hash space: two texts cannot match more than the
    sum of the smaller counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [_labelled(shingles(np.frombuffer(c, np.uint32).astype(np.uint64))).view(np.int64) for c in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_pydict({"id": part.column(0), "component": part.column(1), "found": pa.array(found, pa.list_(pa.int64()))})

    found = placed.join(coded, "id").select("id", "component", "codes").mapInArrow(run, "id long, component long, found array<long>")
    single = cut(found.select("id", "component", F.explode("found").alias("shingle")))
    ends = single.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    across = single.join(ends.where("low <> high").select("shingle"), "shingle", "left_semi")
    # Texts without such a shingle are left out: nothing can match them.
    counted = across.groupBy("id", F.pmod("shingle", F.lit(CELLS)).cast("int").alias("cell")).agg(F.count("*").cast("int").alias("own"))
    per_cell = counted.groupBy("id").agg(F.sum("own").alias("most"), F.map_from_entries(F.collect_list(F.struct("cell", "own"))).alias("own"))
    cells = F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), lambda c: F.coalesce(F.try_element_at("own", c), F.lit(0)))
    return per_cell.select("id", "most", cells.alias("cells"))


def duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``key, class_id, n_copies, kept`` of every row of ``documents``.

    ``class_id`` is the smallest key that a chain of links of similarity ``threshold`` or more reaches, ``n_copies``
    the rows with the same words, and the row whose key is the class id is kept. Rows that repeat a key are treated
    as copies of each other. Rows without words or without a key are their own class.
    """
    texts = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    sketched = cut(_sketched(texts))
    # The smallest key among rows with equal words stands for them.
    same = sketched.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("n_copies"))
    members = sketched.select("id", "digest").join(same, "digest").select("id", "rep", "n_copies").distinct()
    reps = sketched.join(same.select(F.col("rep").alias("id"), "digest"), ["id", "digest"], "left_semi").select("id", "n", "keys")
    reps = cut(reps.dropDuplicates(["id"]))
    # Bucket rows are slim: sizes and sketches are joined where pairs need them.
    rows = reps.select("id", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    bucketed = cut(rows.join(shared, "key"))
    central = bucketed.groupBy("id").agg(F.sum(F.log("size")).alias("weight"))
    hubs = bucketed.join(central, "id").groupBy("key").agg(F.max(F.struct("weight", (-F.col("id")).alias("lowest"))).alias("hub"))
    hubs = hubs.select("key", (-F.col("hub.lowest")).alias("hub"))
    agree = lambda x, y: F.size(F.array_intersect(x, y)) >= AGREE
    alike = lambda n, m: F.least(n, m) >= threshold * F.greatest(n, m)

    def candidates(pairs: DataFrame) -> DataFrame:
        """Distinct pairs whose sizes and sketches allow the similarity."""
        first = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
        left = reps.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("keys").alias("keys_a"))
        right = reps.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("keys").alias("keys_b"))
        return first.join(left, "a").join(right, "b").where(alike(F.col("n_a"), F.col("n_b")) & agree("keys_a", "keys_b")).select("a", "b")

    stars = bucketed.join(hubs, "key").select(F.col("id").alias("a"), F.col("hub").alias("b"))
    starred = cut(candidates(stars))
    # Texts are read again only where a pair is possible, once for both rounds.
    possible = bucketed.groupBy("id").agg(F.count("*").alias("shared")).where(F.col("shared") >= AGREE).select("id")
    coded = cut(_coded(texts.join(possible, "id", "left_semi")))
    links = cut(_verified(starred, coded, threshold))
    found = components(links)
    # Whatever a bucket still holds of several components is compared across them.
    placed = bucketed.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    torn = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    open_ = cut(placed.join(torn, "key", "left_semi").select("key", "id", "component"))
    most = _sharable(open_.select("id", "component").distinct(), coded)
    # Not even all shingles that a text shares with other components would do for a text of its own size or smaller.
    fit = cut(reps.join(most, "id").where(F.col("most") >= threshold * F.col("n") - 1e-9))
    open_ = cut(open_.join(fit, "id"))
    # Of a component only the hub's links are known, so every row of a smaller one meets every row of another.
    sizes = open_.groupBy("key", "component").agg(F.count("*").alias("members"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("members", "component")).alias("top")).select("key", F.col("top.component").alias("main"))
    marked = open_.join(largest, "key")
    a = marked.where("component <> main").select("key", F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("keys").alias("keys_a"), F.col("most").alias("most_a"), F.col("cells").alias("cells_a"), F.col("component").alias("c_a"), "main")
    b = open_.select("key", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("keys").alias("keys_b"), F.col("most").alias("most_b"), F.col("cells").alias("cells_b"), F.col("component").alias("c_b"))
    enough = lambda common: common >= threshold * (F.col("n_a") + F.col("n_b") - common) - 1e-9
    in_cells = F.aggregate(F.zip_with("cells_a", "cells_b", lambda x, y: F.least(x, y)), F.lit(0), lambda total, c: total + c)
    across = a.join(b, "key").where(
        (F.col("c_a") != F.col("c_b"))
        & ((F.col("c_b") == F.col("main")) | (F.col("a") < F.col("b")))
        & alike(F.col("n_a"), F.col("n_b"))
        & enough(F.least("most_a", "most_b"))
        & enough(in_cells)
        & agree("keys_a", "keys_b")
    )
    more = across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    tried = cut(more.join(starred, ["a", "b"], "left_anti"))
    late = cut(_verified(tried, coded, threshold))
    classes = components(links.select("a", "b").union(late.select("a", "b")))
    grouped = members.join(classes.select(F.col("id").alias("rep"), "component"), "rep", "left").select(
        "id", F.coalesce("component", "rep").alias("class_id"), "n_copies"
    )
    per_key = grouped.groupBy("id").agg(F.min("class_id").alias("class_id"), F.sum("n_copies").alias("n_copies"))
    keyed = documents.select(F.col(key).cast("long").alias("id"))
    return keyed.join(per_key, "id", "left").select(
        F.col("id").alias(key),
        F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce(F.coalesce("class_id", "id") == F.col("id"), F.lit(True)).alias("kept"),
    )


def keep_one(documents: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` without near duplicates: the one with the smallest key of each class.

    Of rows that repeat a key one stays; rows without a key stay."""
    kept = cut(duplicates(documents.select(key, text), key, text, threshold).where(F.col("kept") & F.col(key).isNotNull()).select(key))
    single = documents.join(kept.distinct(), key, "left_semi").select(documents.columns)
    if not kept.groupBy(key).count().where("count > 1").isEmpty():
        single = single.dropDuplicates([key])
    return single.union(documents.where(F.col(key).isNull()))
