"""K-d tree partitioning: rows go to shards of nearly equal bytes by recursive splits at weighted medians.

Every node takes the metadata dimension that is widest over its rows and splits there, so that each side holds the
bytes of its share of the leaves. A row's place along a dimension is the key (dimension, ties), where ``ties`` is the
CRC of the text, then a hash of the row's id: equal texts lie side by side and stay in one shard unless a cut has to
pass through a group that is too heavy for one side.

The weighted median is found without sorting rows: the 96 bits of the key are six digits, and each pass sums bytes by
node and digit, keeps the digit in which the cut falls, and looks inside it only while it weighs more than
``tolerance`` of a leaf. A pass is one aggregation with partial sums, whose result has at most 65,536 rows a node
whatever the input; the driver sees one row per node. Only DataFrame operations are used.

Null texts weigh as empty ones, null dimensions sort first, repeated rows are placed like any other row and an empty
input gives no shards. Columns of the input whose names are used here are not carried along; the result has exactly
the columns its docstring names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickfacts.llm.common import crc32, cut

_DIGITS = 6
_BASE = 1 << 16
#: Rows of a shard that are numbered in one task.
NUMBERED_ROWS = 20_000


def _of_node(values: dict[int, int], default: int = 0) -> Column:
    """The value of the row's node; nodes are few (two per leaf at most)."""
    numbers = F.array(*[F.lit(int(values.get(n, default))).cast("long") for n in range(max(values, default=0) + 1)])
    return F.get(numbers, F.col("node").cast("int"))


def _key_digits(dimensions: int, chosen: dict[int, int]) -> list[Column]:
    """The six digits of the key: two of the node's dimension, four of the ties."""
    along = F.get(F.array(*[F.col(f"dim{i}") for i in range(dimensions)]), _of_node(chosen).cast("int"))
    digit = lambda c, shift: F.shiftright(c, shift).bitwiseAND(F.lit(_BASE - 1))
    return [digit(along, 16), digit(along, 0), *(digit(F.col(f"tie{i}"), s) for i in (0, 1) for s in (16, 0))]


def _widest(rows: DataFrame, dimensions: int, extent: list[int]) -> dict[int, int]:
    """The dimension of each node with the largest spread, relative to the spread over all rows."""
    spreads = [
        ((F.max(f"dim{i}") - F.min(f"dim{i}")) / F.lit(float(max(1, extent[i])))).alias(f"s{i}") for i in range(dimensions)
    ]
    found = rows.groupBy("node").agg(*spreads).collect()
    return {r["node"]: max(range(dimensions), key=lambda i: (r[f"s{i}"], -i)) for r in found}


def _cuts(rows: DataFrame, dimensions: int, chosen: dict[int, int], wanted: dict[int, float], slack: float) -> dict[int, list[int]]:
    """Per node the digits of the first key that goes right; ``wanted`` is the bytes that go left."""
    prefix: dict[int, list[int]] = {n: [] for n in wanted}
    before = dict.fromkeys(wanted, 0)
    done: dict[int, list[int]] = {}
    for depth in range(_DIGITS):
        digits = _key_digits(dimensions, chosen)
        inside = [F.lit(True)] + [digits[i] == _of_node({n: p[i] for n, p in prefix.items()}) for i in range(depth)]
        is_open = F.col("node").isin(list(prefix))
        sums = (
            rows.where(is_open & reduce(Column.__and__, inside))
            .groupBy("node", digits[depth].alias("digit"))
            .agg(F.sum("weight").alias("weight"))
            .withColumn("upto", F.sum("weight").over(Window.partitionBy("node").orderBy("digit")) + _of_node(before))
        )
        # The digit in which the wanted sum falls: the first that reaches it.
        target = F.get(F.array(*[F.lit(float(wanted.get(n, 0.0))) for n in range(max(wanted) + 1)]), F.col("node").cast("int"))
        reached = sums.where(F.col("upto") >= target).groupBy("node").agg(F.min(F.struct("digit", "upto", "weight")).alias("cut"))
        for row in reached.collect():
            n, (digit, upto, weight) = row["node"], row["cut"]
            low, high = upto - weight, upto
            if weight <= slack or depth == _DIGITS - 1:
                # Cut beside the whole digit, on the side that is nearer.
                keep_left = abs(high - wanted[n]) <= abs(wanted[n] - low)
                done[n] = prefix.pop(n) + [digit + 1 if keep_left else digit]
            else:
                prefix[n] = prefix[n] + [digit]
                before[n] = low
        if not prefix:
            break
    return done


def _right(dimensions: int, chosen: dict[int, int], cuts: dict[int, list[int]]) -> Column:
    """Whether the row's key is at or above the cut of its node."""
    digits = _key_digits(dimensions, chosen)
    full = {n: c + [0] * (_DIGITS - len(c)) for n, c in cuts.items()}
    key = F.struct(*digits)
    bound = F.struct(*[_of_node({n: c[i] for n, c in full.items()}) for i in range(_DIGITS)])
    return key >= bound


def place(df: DataFrame, shards: int, key: str, weight: Column, dimensions: list[Column], ties: list[Column], tolerance: float = 0.002) -> DataFrame:
    """Rows ``key, weight, tie0, shard``: leaves 0 to ``shards - 1`` in tree order.

    ``dimensions`` and the two ``ties`` are unsigned 32-bit numbers as longs; ``weight`` is a positive long. Cuts pass
    beside groups lighter than ``tolerance`` of a leaf's bytes and through heavier ones.
    """
    count = len(dimensions)
    slim = df.select(
        F.col(key).alias("row_key"),
        weight.cast("long").alias("weight"),
        *[F.coalesce(d.cast("long"), F.lit(0)).alias(f"dim{i}") for i, d in enumerate(dimensions)],
        *[t.cast("long").alias(f"tie{i}") for i, t in enumerate(ties)],
        F.lit(0).cast("long").alias("node"),
    )
    rows = cut(slim)
    totals = rows.agg(
        F.sum("weight").alias("w"), *[(F.max(f"dim{i}") - F.min(f"dim{i}")).alias(f"d{i}") for i in range(count)]
    ).first()
    leaves, first, weights = {0: shards}, {0: 0}, {0: float(totals["w"] or 0)}
    extent = [totals[f"d{i}"] or 0 for i in range(count)]
    slack = weights[0] / shards * tolerance
    # Nodes of a level are numbered anew, left to right; a leaf stays a node of its own.
    while totals["w"] and any(n > 1 for n in leaves.values()):
        open_ = [n for n, k in leaves.items() if k > 1]
        chosen = _widest(rows.where(F.col("node").isin(open_)), count, extent)
        open_ = [n for n in open_ if n in chosen]
        if not open_:
            break
        share = {n: weights[n] * (leaves[n] // 2) / leaves[n] for n in open_}
        cuts = _cuts(rows, count, chosen, share, slack)
        left = {n: 2 * n for n in leaves}
        goes_right = F.when(F.col("node").isin(list(cuts)), _right(count, chosen, cuts)).otherwise(False)
        # Materialised per level: the next level's filters would otherwise repeat the tests of all levels above.
        rows = cut(rows.withColumn("node", (2 * F.col("node") + goes_right.cast("int")).cast("long")))
        new_leaves, new_first = {}, {}
        for n, k in leaves.items():
            half = k // 2 if n in cuts else k
            new_leaves[left[n]], new_first[left[n]] = half, first[n]
            if n in cuts:
                new_leaves[left[n] + 1], new_first[left[n] + 1] = k - half, first[n] + half
        leaves, first = new_leaves, new_first
        weights = {r["node"]: float(r["w"]) for r in rows.groupBy("node").agg(F.sum("weight").alias("w")).collect()}
        weights = {n: weights.get(n, 0.0) for n in leaves}
    return rows.select(F.col("row_key").alias(key), "weight", "tie0", _of_node(first).cast("int").alias("shard"))


def numbered(placed: DataFrame, key: str, total: int, shards: int) -> DataFrame:
    """``placed`` with ``slot``, gapless from 0 in each shard; no task numbers a whole shard."""
    parts = max(1, total // (shards * NUMBERED_ROWS))
    part = F.pmod(F.xxhash64(key), F.lit(parts)).alias("part")
    rows = placed.select("*", part)
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", "part").agg(F.count("*").alias("n")).select(
        "shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy(key, "weight", "tie0")) - 1
    ranked = rows.withColumn("inside", inside)
    return ranked.join(offsets, ["shard", "part"]).withColumn("slot", (F.col("offset") + F.col("inside")).cast("long")).drop("part", "inside", "offset")


def shard_documents(documents: DataFrame, shards: int = 40, text: str = "text", key: str = "doc_id", metadata: tuple[str, ...] = ("lang",)) -> DataFrame:
    """``key, size, text_crc32, law, shard, slot, grown_shard`` of every document, by the law ``bytes``.

    Size is the UTF-8 bytes of the text (null: none) plus 16. Dimensions are the size on a logarithmic scale, the
    codepoints beyond ASCII per text, and the CRC of each column in ``metadata``; ties are the CRC of the text, so
    equal texts with equal metadata are neighbours.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    size = F.octet_length(body).cast("long") + 16
    wide = F.octet_length(body) - F.char_length(body)
    scaled = lambda c: F.least(F.round(F.log2(c + 1) * F.lit(float(1 << 26))), F.lit(float((1 << 32) - 1))).cast("long")
    dimensions = [scaled(size), scaled(wide), *(crc32(F.col(c).cast("string")) for c in metadata)]
    ties = [crc32(F.col(text)), F.xxhash64(key).bitwiseAND(F.lit((1 << 32) - 1))]
    placed = place(documents, shards, key, size, dimensions, ties)
    rows = numbered(placed, key, placed.count(), shards)
    return rows.select(
        key,
        F.col("weight").alias("size"),
        F.col("tie0").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
