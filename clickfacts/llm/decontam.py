"""Documents that contain benchmark items: SimHash of item-sized windows, multi-index Hamming search, exact check.

Words are maximal runs of letters and digits in lower case; shingles are five words, or all words of a shorter item.

1. Windows. A window as long as an item can only be similar to it if they share a shingle, and that shingle says where
   the window begins. So windows are laid at every shared shingle, one for each item length and offset in which the
   shingle occurs: an exact pruning that leaves a few windows per passage instead of one per position and length.
2. Fingerprints. Each window and item gets a 64-bit SimHash of its words, a repeated word counting each time.
3. Search. Fingerprints are cut into four blocks of 16 bits. Two fingerprints at most ``RADIUS`` = 11 bits apart differ
   by at most two bits in one block at least, so joining each window's blocks to the items' blocks with up to two bits
   flipped finds all of them, whatever the number of items.
4. Rare shingles. Similar texts can have fingerprints farther apart: a tenth of the words changed at the head or the
   tail may flip more than ``RADIUS`` bits. So windows are also joined to the items by shingles. A window that reaches
   the threshold holds at least that share of an item's shingles, so it cannot miss all of the remaining ones and one
   more; of each item only so many are joined, those that the fewest items have. This search is exact: no pair is lost.
5. Check. The weighted Jaccard similarity of the shingles, each weighing as often as it occurs, must reach the
   threshold.

All steps are DataFrame operations. The shingles of a passage that a third of the documents share meet a row each of
the benchmark, and each document keeps a few windows of it; nothing is grouped by passage.

Null and empty texts and items match nothing. Repeated items are reported each; repeated rows of a document count
once. The input may have further columns; only key and text are read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickfacts.llm.common import cut, words

SHINGLE, THRESHOLD = 5, 0.8
BLOCKS, BLOCK_BITS, FLIPS = 4, 16, 2
#: Two fingerprints this close agree up to FLIPS bits in one block, by the pigeonhole principle.
RADIUS = BLOCKS * (FLIPS + 1) - 1


def _shingles(all_words: Column, size: Column | int) -> Column:
    """The shingles of ``size`` words, joined by spaces, in text order."""
    starts = F.sequence(F.lit(0), F.size(all_words) - size)
    return F.when(
        F.size(all_words) >= size, F.transform(starts, lambda i: F.array_join(F.slice(all_words, i + 1, size), " "))
    ).otherwise(F.array().cast("array<string>"))


def simhash(all_words: Column) -> Column:
    """64 bits: a bit is set where most word hashes have it set."""
    hashes = F.transform(all_words, lambda w: F.xxhash64(w))

    def bit(b: Column) -> Column:
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), b.cast("int"))
        ones = F.size(F.filter(hashes, lambda h: h.bitwiseAND(mask) != 0))
        return F.when(2 * ones > F.size(hashes), mask).otherwise(F.lit(0).cast("long"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda acc, b: acc.bitwiseOR(bit(b)))


def _block(fingerprint: Column, number: int) -> Column:
    return F.shiftright(fingerprint, BLOCK_BITS * number).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def _flips() -> list[int]:
    """All patterns of up to FLIPS bits of a block."""
    return [sum(1 << b for b in bits) for n in range(FLIPS + 1) for bits in combinations(range(BLOCK_BITS), n)]


def _weight_shared(left: Column, right: Column) -> Column:
    """Sum over distinct shingles of the smaller number of occurrences."""
    times = lambda all_, s: F.size(F.filter(all_, lambda x: x == s))
    return F.aggregate(F.array_distinct(left), F.lit(0), lambda acc, s: acc + F.least(times(left, s), times(right, s)))


def _by_rare_shingles(windows: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """``id, begin, length, k, item`` of all pairs that can reach the threshold, and of few others."""
    total = F.size("item_shingles").alias("total")
    asked = items.select("item", "k", total, F.posexplode("item_shingles").alias("offset", "shingle"))
    asked = asked.select("item", "k", "total", "offset", F.xxhash64("shingle").alias("hash"))
    spread = asked.groupBy("k", "hash").agg(F.count_distinct("item").alias("n_items"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy("n_items", "hash", "offset"))
    ranked = asked.join(spread, ["k", "hash"]).withColumn("rank", rank)
    # Without the occurrences up to this rank the rest of the item is below the threshold. Both quotients are rounded
    # as the similarity is, so a pair that reaches the threshold passes them.
    rare = ranked.where((F.col("total") - F.col("rank") + 1) / F.col("total") >= threshold)
    rare = rare.select("item", "k", "hash", "total").distinct()
    hashes = F.array_distinct(F.transform("shingles", lambda s: F.xxhash64(s)))
    held = windows.select(
        "id", "begin", "k", F.size("words").alias("length"), F.size("shingles").alias("own"), F.explode(hashes).alias("hash")
    )
    near = held.join(rare, ["k", "hash"])
    near = near.where(F.least("own", "total") / F.greatest("own", "total") >= threshold)
    return near.select("id", "begin", "length", "k", "item")


def leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``key, item, begin, n_words, similarity`` of every document and item that it contains.

    ``begin`` is the first word of the most similar window (the first of equally similar ones) and ``n_words`` its
    length; similarity is rounded to six places.
    """
    items = benchmark.select(F.col(item).alias("item"), words(F.col(item_text)).alias("item_words")).withColumn(
        "n", F.size("item_words")
    )
    items = items.where("n > 0").withColumn("k", F.least("n", F.lit(SHINGLE)))
    items = cut(items.withColumn("item_shingles", _shingles(F.col("item_words"), F.col("k"))))
    anchors = items.select("n", "k", F.posexplode("item_shingles").alias("offset", "shingle"))
    anchors = anchors.select("n", "k", "offset", F.xxhash64("shingle").alias("hash")).distinct()
    worded = documents.select(F.col(key).alias("id"), words(F.col(text)).alias("words")).where(F.size("words") > 0)
    found = None
    # At most five shingle sizes: items of five words and more share one.
    for (k,) in items.select("k").distinct().collect():
        hashes = F.transform(_shingles(F.col("words"), k), lambda s: F.xxhash64(s))
        placed = worded.select("id", F.size("words").alias("n_words"), F.posexplode(hashes).alias("at", "hash"))
        hits = placed.join(anchors.where(F.col("k") == k), "hash")
        begin = F.greatest(F.col("at") - F.col("offset"), F.lit(0))
        end = F.least(F.col("at") - F.col("offset") + F.col("n"), F.col("n_words"))
        spots = hits.select("id", "k", begin.alias("begin"), (end - begin).alias("length")).distinct()
        found = spots if found is None else found.union(spots)
    if found is None:
        found = worded.select("id", *[F.lit(0).alias(c) for c in ("k", "begin", "length")]).limit(0)
    spots = cut(found)
    texts = worded.join(spots.select("id").distinct(), "id", "left_semi")
    # Rows that repeat a key with different texts may give windows beyond a text's end; those are dropped.
    windows = (
        texts.join(spots, "id")
        .where(F.col("begin") + F.col("length") <= F.size("words"))
        .select("id", "k", "begin", F.slice("words", F.col("begin") + 1, F.col("length")).alias("words"))
        .distinct()
    )
    windows = cut(
        windows.withColumn("fingerprint", simhash(F.col("words"))).withColumn("shingles", _shingles(F.col("words"), F.col("k")))
    )
    marked = items.withColumn("item_fingerprint", simhash(F.col("item_words")))
    flips = F.explode(F.array(*[F.lit(x).cast("long") for x in _flips()]))
    blocks = lambda c: F.array(*[F.struct(F.lit(b).alias("block"), _block(c, b).alias("value")) for b in range(BLOCKS)])
    probes = windows.select("id", "begin", "k", "words", "fingerprint", F.explode(blocks(F.col("fingerprint"))).alias("p"))
    probes = probes.select("id", "begin", "k", F.size("words").alias("length"), "fingerprint", "p.block", "p.value")
    targets = (
        marked.select("item", "k", "item_fingerprint", F.explode(blocks(F.col("item_fingerprint"))).alias("p"))
        .select("item", "k", "item_fingerprint", "p.block", "p.value", flips.alias("flip"))
        .select("item", "k", "item_fingerprint", "block", F.col("value").bitwiseXOR(F.col("flip")).alias("value"))
    )
    near = probes.join(targets, ["block", "value", "k"]).where(
        F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint"))) <= RADIUS
    )
    near = near.select("id", "begin", "length", "k", "item")
    pairs = near.union(_by_rare_shingles(windows, items, threshold)).distinct()
    checked = pairs.join(items.select("item", "k", "item_shingles").distinct(), ["item", "k"]).join(
        windows.select("id", "begin", "k", F.size("words").alias("length"), "shingles"), ["id", "begin", "k", "length"]
    )
    shared = _weight_shared(F.col("shingles"), F.col("item_shingles"))
    similarity = (shared / (F.size("shingles") + F.size("item_shingles") - shared)).alias("similarity")
    best = (
        checked.select("id", "item", "begin", "length", similarity)
        .where(F.col("similarity") >= threshold)
        .groupBy("id", "item")
        .agg(F.max(F.struct("similarity", (-F.col("begin")).alias("first"), "length")).alias("best"))
    )
    return best.select(
        F.col("id").alias(key),
        F.col("item").alias(item),
        (-F.col("best.first")).alias("begin"),
        F.col("best.length").alias("n_words"),
        F.round("best.similarity", 6).alias("similarity"),
    )
