"""Near-duplicate vectors by spherical-cap filters from random product codes.

A filter direction is the concatenation of one codeword from each of two random codes, one per half of a randomly
rotated vector; so ``CODEWORDS`` squared directions are searched by looking at twice ``CODEWORDS`` inner products. A
vector is listed at every direction with which its cosine exceeds a bound (list decoding: the codewords of the first
half that can still reach the bound, then for each a prefix of the second half's codewords in falling order). Similar
vectors exceed it at the same directions; dissimilar ones hardly ever do. Vectors of one label that share a direction
are candidates, and the cosine in double precision decides.

The number of directions grows with the number of vectors and the bound with it, so that a vector has about ``LISTED``
directions in each of several independent codes and a direction has few vectors, at every input size. Two vectors at
the threshold share a direction of one code less often the more directions it has, so the number of codes (tables)
follows from that share, measured on random pairs: of pairs at the threshold no more than ``MISSED`` are expected to
be missed, at every input size, length of vectors and threshold.

Equal vectors of a label are one representative with a weight. Representatives whose nearest direction is the same are
a tile (several, where they exceed ``TILE_BYTES``), so a group of near copies is a few tiles. Tiles whose members share a
direction are compared once, as a product of two matrices. What leaves a comparison is one row per member that has a
link, with the weight of what it links with and the smallest member it is connected to: link counts are sums of these
rows and components follow from them, so pairs of vectors are never rows. The cosines within a group of near copies still
are as many as its links.

Vectors that are null, zero or empty, hold null or non-finite components, or have no label link with nothing; vectors of
different lengths do not link. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickfacts.llm.common import appended, cut
from clickfacts.llm.components import components

THRESHOLD = 0.93
#: Tables at least, and those beyond which short vectors, which share few of many directions, get fewer directions.
TABLES, TABLES_MOST, LISTED = 5, 16, 16
#: Expected part of the pairs at the threshold that is missed; random pairs that measure it; tables a number can name.
MISSED, PROBES, STRIDE = 0.001, 1000, 1 << 12
#: Below this length a half has one component and all its codewords are two; a grid takes the place of the codes.
SHORT = 4
#: Bytes of the vectors of a tile.
TILE_BYTES = 1 << 20
#: Directions per vector of the input, and the codewords of a half at most (the code is then searched in full).
DIRECTIONS_PER_ROW, CODEWORDS_LEAST, CODEWORDS_MOST = 8, 64, 1 << 15


class Filters:
    """The directions of one table for vectors of one length, and the bound that lists ``LISTED`` of them on average."""

    def __init__(self, length: int, codewords: int, table: int):
        draw = np.random.default_rng([length, codewords, table])
        self.rotation = np.linalg.qr(draw.standard_normal((length, length)))[0]
        self.half = max(1, length // 2)
        sizes = (self.half, length - self.half)
        self.codes = [self._unit(draw.standard_normal((codewords, s))) * np.sqrt(s / length) for s in sizes]
        probes = self._unit(draw.standard_normal((200, length)))
        self.bound = self._bound(probes)

    @staticmethod
    def _unit(rows: np.ndarray) -> np.ndarray:
        if rows.shape[1] == 0:
            return rows
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)

    def _halves(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        turned = units @ self.rotation
        return turned[:, : self.half] @ self.codes[0].T, turned[:, self.half :] @ self.codes[1].T

    @staticmethod
    def _count(left: np.ndarray, right: np.ndarray, bound: float) -> int:
        return int((len(right) - np.searchsorted(right, bound - left)).sum())

    def _bound(self, probes: np.ndarray) -> float:
        """By bisection: the cosine that random directions exceed ``LISTED`` times on average."""
        left, right = self._halves(probes)
        right.sort(axis=1)
        low, high = -1.0, 1.0
        for _ in range(25):
            middle = (low + high) / 2
            listed = np.mean([self._count(a, b, middle) for a, b in zip(left, right, strict=True)])
            low, high = (middle, high) if listed > LISTED else (low, middle)
        return high

    def listed(self, units: np.ndarray) -> list[np.ndarray]:
        """Numbers of the directions each unit vector is listed at."""
        out = []
        size = len(self.codes[1])
        step = max(1, (1 << 22) // size)
        for begin in range(0, len(units), step):
            for a, b in zip(*self._halves(units[begin : begin + step]), strict=True):
                firsts = np.flatnonzero(a >= self.bound - b.max())
                order = np.flatnonzero(b >= self.bound - a.max())
                order = order[np.argsort(-b[order], kind="stable")]
                many = np.searchsorted(-b[order], a[firsts] - self.bound, side="right")
                own = np.repeat(firsts, many) * size
                own += order[np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)]
                out.append(own)
        return out

    def nearest(self, units: np.ndarray) -> np.ndarray:
        """The number of the direction nearest to each unit vector."""
        size = len(self.codes[1])
        step = max(1, (1 << 22) // size)
        parts = [self._halves(units[begin : begin + step]) for begin in range(0, len(units), step)]
        return np.concatenate([a.argmax(1) * size + b.argmax(1) for a, b in parts])


@lru_cache(maxsize=TABLES_MOST)
def filters(length: int, codewords: int, table: int) -> Filters:
    return Filters(length, codewords, table)


def shared(known: Filters, length: int, threshold: float, probes: int = PROBES) -> np.ndarray:
    """For random pairs at the threshold, the same ones for all tables, whether they share a direction."""
    draw = np.random.default_rng([length, probes])
    x = Filters._unit(draw.standard_normal((probes, length)))
    across = draw.standard_normal((probes, length))
    across = Filters._unit(across - (across * x).sum(1, keepdims=True) * x)
    y = threshold * x + np.sqrt(max(0.0, 1 - threshold**2)) * across
    return np.array([len(np.intersect1d(a, b)) > 0 for a, b in zip(known.listed(x), known.listed(y), strict=True)])


@lru_cache(maxsize=64)
def plan(length: int, codewords: int, threshold: float) -> tuple[int, int]:
    """Codewords of a half and tables for vectors of one length."""
    while True:
        share = shared(filters(length, codewords, 0), length, threshold).mean()
        tables = STRIDE if share == 0 else int(np.ceil(np.log(MISSED) / np.log(max(1 - share, 1e-9))))
        if tables <= TABLES_MOST or codewords <= CODEWORDS_LEAST:
            return codewords, min(STRIDE, max(TABLES, tables))
        codewords //= 2


def cells(units: np.ndarray, threshold: float) -> list[np.ndarray]:
    """For vectors too short for the codes: the cells of a grid that two vectors at the threshold surely share.

    The cells are as wide as the distance of such a pair, and each vector is listed at all within half of it, so both
    are listed at the cell of their midpoint.
    """
    width = np.sqrt(max(0.0, 2 - 2 * threshold)) * (1 + 1e-6) + 1e-6
    low, high = (np.floor(units / width + side).astype(np.int64) + (1 << 20) for side in (-0.5, 0.5))
    numbers = np.zeros((len(units), 1), np.int64)
    for i in range(units.shape[1]):
        ends = np.stack([low[:, i], high[:, i]], axis=1)
        numbers = (numbers[:, :, None] * (1 << 21) + ends[:, None, :]).reshape(len(units), -1)
    return [np.unique(x) for x in numbers]


def _units(rows: np.ndarray) -> np.ndarray:
    """The rows at length one; scaled by their largest components first, so squares neither overflow nor vanish."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _listed(vectors: DataFrame, codewords: int, threshold: float) -> DataFrame:
    """``vectors`` with the directions of every vector, those of each table apart from the others', and the nearest."""
    at = vectors.columns.index("vector")
    fields = [T.StructField("home", T.LongType()), T.StructField("listed", T.ArrayType(T.LongType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                rows = part.column(at).to_pylist()
                found: list[list[np.ndarray]] = [[] for _ in rows]
                homes = np.zeros(len(rows), np.int64)
                by_length: dict[int, list[int]] = {}
                for i, row in enumerate(rows):
                    by_length.setdefault(len(row), []).append(i)
                for length, own in by_length.items():
                    units = _units(np.array([rows[i] for i in own], np.float64))
                    if length < SHORT:
                        for i, numbers in zip(own, cells(units, threshold), strict=True):
                            found[i].append(numbers)
                            homes[i] = numbers[0]
                        continue
                    own_codewords, tables = plan(length, codewords, threshold)
                    homes[own] = filters(length, own_codewords, 0).nearest(units) * STRIDE
                    for table in range(tables):
                        known = filters(length, own_codewords, table)
                        for i, numbers in zip(own, known.listed(units), strict=True):
                            found[i].append(numbers * STRIDE + table)
                lists = pa.array([np.concatenate(x) for x in found], pa.list_(pa.int64()))
                yield appended(part, {"home": pa.array(homes), "listed": lists})

    return vectors.mapInArrow(run, T.StructType([*vectors.schema.fields, *fields]))


class _Side:
    """The members of the tiles in one column: where each tile begins, and keys, weights and components of members."""

    def __init__(self, column: pa.Array):
        self.counts = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        members = column.flatten()
        self.reps = members.field("rep").to_numpy(zero_copy_only=False)
        self.weights = members.field("weight").to_numpy(zero_copy_only=False)
        vectors = members.field("vector")
        self.lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
        self.at = np.cumsum(self.lengths) - self.lengths
        self.values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)

    def rows(self, members: np.ndarray) -> np.ndarray:
        """The vectors of members of one length."""
        return self.values[self.at[members][:, None] + np.arange(self.lengths[members[0]])]

    def tile(self, row: int) -> np.ndarray:
        return self.starts[row] + np.arange(self.counts[row])


def _paired(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of the rows of two tables, one by one, in double precision."""
    x, y = (side / np.abs(side).max(axis=1, keepdims=True) for side in (x, y))
    return (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1))


def _linked(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of ``x`` reach the threshold with which of ``y``."""
    cosines = _units(x) @ _units(y).T
    links = cosines >= threshold
    # Where the order of summation could decide, it is that of a single pair.
    for i, j in np.argwhere(np.abs(cosines - threshold) < 1e-9):
        links[i, j] = _paired(x[i : i + 1], y[j : j + 1])[0] >= threshold
    return links


def connected(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components of the graph between rows and columns: a number for each row and column, -1 without a link."""
    left, right = np.full(links.shape[0], -1), np.full(links.shape[1], -1)
    number = 0
    for i in np.flatnonzero(links.any(1)):
        if left[i] >= 0:
            continue
        rows = np.array([i])
        left[i] = number
        while len(rows):
            columns = np.flatnonzero(links[rows].any(0) & (right < 0))
            right[columns] = number
            rows = np.flatnonzero(links[:, columns].any(1) & (left < 0))
            left[rows] = number
        number += 1
    return left, right


def _compared(tiles: DataFrame, threshold: float) -> DataFrame:
    """``rep, root, others`` of ``same, left, right``: tiles compared with each other, or with themselves if ``same``.

    One row for each member with a link: the smallest member it is connected to there, and the weight it links with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = batch.column(0).to_numpy(zero_copy_only=False)
            a, b = _Side(batch.column(1)), _Side(batch.column(2))
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            single = ~same & (a.counts == 1) & (b.counts == 1)
            lengths = a.lengths[a.starts]
            for length in np.unique(lengths[single]):
                own = np.flatnonzero(single & (lengths == length))
                x, y = a.starts[own], b.starts[own]
                hit = _paired(a.rows(x), b.rows(y)) >= threshold
                x, y = x[hit], y[hit]
                root = np.minimum(a.reps[x], b.reps[y])
                out += [(a.reps[x], root, b.weights[y]), (b.reps[y], root, a.weights[x])]
            for row in np.flatnonzero(~single):
                x, y = a.tile(row), b.tile(row)
                links = _linked(a.rows(x), b.rows(y), threshold)
                if same[row]:
                    np.fill_diagonal(links, False)
                others = links @ b.weights[y], links.T @ a.weights[x]
                if same[row]:
                    # A member is itself on both sides.
                    np.fill_diagonal(links, links.any(1))
                numbers = connected(links)
                roots = np.full(max(1, len(x) + len(y)), np.iinfo(np.int64).max)
                for side, members, number in ((a, x, numbers[0]), (b, y, numbers[1])):
                    np.minimum.at(roots, number[number >= 0], side.reps[members[number >= 0]])
                sides = ((a, x, numbers[0], others[0]), (b, y, numbers[1], others[1]))
                for side, members, number, weight in sides[: 1 if same[row] else 2]:
                    has = number >= 0
                    out.append((side.reps[members[has]], roots[number[has]], weight[has]))
            if out:
                columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["rep", "root", "others"])

    return tiles.select("same", "left", "right").mapInArrow(run, "rep long, root long, others long")


def codewords_for(rows: int) -> int:
    """Codewords of a half: a power of two whose square is at least ``DIRECTIONS_PER_ROW`` times the rows."""
    wanted = int(np.ceil(np.sqrt(max(1, rows) * DIRECTIONS_PER_ROW)))
    return min(CODEWORDS_MOST, max(CODEWORDS_LEAST, 1 << (wanted - 1).bit_length()))


def duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """``key, n_links, component_id, kept`` of every row of ``df``.

    ``n_links`` counts the other rows at a cosine of ``threshold`` or more within the label, ``component_id`` is the
    smallest key that links reach, and the row with that key is kept. Rows that repeat a key count as rows of their
    own; a row without a key links with nothing.
    """
    rows = df.select(
        F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), F.col(label).cast("string").alias("label")
    )
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    usable = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & fine)
    # -0.0 and 0.0 are one value in a grouping key, as they are for the cosine.
    classes = usable.groupBy("label", "vector").agg(F.min("id").alias("least"), F.count("*").alias("weight"))
    # A key of its own, since a repeated row key may be the smallest of several classes.
    classes = cut(classes.withColumn("rep", F.xxhash64("label", "vector")))
    codewords = codewords_for(classes.count())
    listed = cut(_listed(classes.select("rep", "label", "vector", "weight"), codewords, threshold))
    kind = [F.col("label"), F.size("vector").alias("length")]
    # Only homes with more vectors than a tile holds are split, and only they are looked up.
    parts = F.ceil(F.sum(F.size("vector")) * 8 / TILE_BYTES).alias("parts")
    large = listed.groupBy(*kind, "home").agg(parts).where("parts > 1")
    placed = listed.select("rep", "weight", "vector", *kind, "home", "listed").join(large, ["label", "length", "home"], "left")
    part = F.pmod(F.xxhash64("rep"), F.coalesce("parts", F.lit(1)))
    placed = cut(placed.withColumn("tile", F.xxhash64("label", "length", "home", part)))
    member = F.struct("rep", "weight", "vector")
    tiles = cut(placed.groupBy("label", "length", "tile").agg(F.collect_list(member).alias("members")))
    # Keys are hashes: one that two kinds share makes a candidate too many, which the kinds below decide.
    directions = F.explode(F.array_union("listed", F.array("home"))).alias("direction")
    entries = placed.select("label", "length", "tile", directions)
    entries = entries.select(F.xxhash64("label", "length", "direction").alias("key"), "tile").distinct()
    others = entries.withColumnRenamed("tile", "other")
    met = entries.join(others, "key").where("tile < other").select("tile", "other").distinct()
    left = tiles.select("label", "length", "tile", F.col("members").alias("left"))
    right = tiles.select(
        F.col("label").alias("label_b"), F.col("length").alias("length_b"), F.col("tile").alias("other"), F.col("members").alias("right")
    )
    alike = (F.col("label") == F.col("label_b")) & (F.col("length") == F.col("length_b"))
    across = met.join(left, "tile").join(right, "other").where(alike).select(F.lit(False).alias("same"), "left", "right")
    within = left.where(F.size("left") > 1).select(F.lit(True).alias("same"), "left", F.col("left").alias("right"))
    compared = cut(_compared(across.union(within), threshold))
    links = compared.select(F.col("rep").alias("a"), F.col("root").alias("b"))
    linked = compared.groupBy("rep").agg(F.sum("others").alias("others"))
    joined = components(links).withColumnRenamed("id", "rep").join(classes.select("rep", "least"), "rep")
    lowest = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    found = joined.join(lowest, "component").select("rep", "component_id")
    results = cut(
        classes.join(linked, "rep", "left").join(found, "rep", "left").select(
            "label",
            "vector",
            (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component_id", "least").alias("component_id"),
        )
    )
    # Rows that link with nothing have a null in the join key and keep to themselves.
    keyed = rows.withColumn("usable", F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & fine, F.lit(False)))
    alone = keyed.where(~F.col("usable")).select(F.col("id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    grouped = keyed.where("usable").join(results, ["label", "vector"]).select("id", "n_links", "component_id")
    return grouped.union(alone).select(
        F.col("id").alias(key), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")
    )
