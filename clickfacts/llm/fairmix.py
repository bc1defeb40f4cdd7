"""Mixing of sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a keyed random order, repeated up to ``repeats`` times. A document's virtual
finish time is the number of words its source has given out up to and including it, divided by the source's target.
Served in the order of these times, all sources advance at the pace of their targets; the global order is cut where
the words reach the budget, so that the last document may give only its first words.

Targets share ``share`` of all words by weight. A source cannot give more than ``repeats`` times its words: its target
stops there, and what it leaves goes to the others by weight, until none is above. That is a common level of words per
unit of weight, the largest over all numbers of stopped sources, so no iteration is needed.

The size of a document is the number of its words: runs of characters other than space and U+0009 to U+000D. Null,
empty and blank texts have size 0; they are part of the result, take nothing and do not queue. A null source is a source of
its own, the last one. Repeated rows (equal ids, even equal rows) queue separately; the order is by a keyed digest of id and
text, then by id and size, so that equal ids do not tie and equal rows may trade places without a trace. Texts of any length are
counted whole. An empty table gives an empty result. Further columns of the documents, whatever their names, are not read.

Only DataFrame operations: running totals over a global order are range partitions, a total per partition, and a
window inside each partition, so neither a source nor the whole order is ever in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickfacts.llm.common import cut

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Words to give out, as a share of all words, and how often a document may be given out.
SHARE, REPEATS = 1.5, 2


def _running(df: DataFrame, order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with inclusive running totals over the global ``order``.

    Totals of the range partitions come first, a row per partition; inside a partition a window adds them up.
    """
    placed = cut(df.repartitionByRange(*order)).withColumn("_part", F.spark_partition_id())
    totals = placed.groupBy("_part").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_part", *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in sums])
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumns({f"_own_{n}": F.sum(c).over(inside) for n, c in sums.items()})
    # One row per partition, so the size is bounded by the number of tasks.
    joined = local.join(F.broadcast(before), "_part")
    return joined.select(*df.columns, *[(F.col(f"_{n}") + F.col(f"_own_{n}")).alias(n) for n in sums])


def _weight(rank: Column) -> Column:
    """Weight of the source of a rank counted from 1."""
    return F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((rank - 1) % len(WEIGHTS) + 1).cast("int"))


def targets(sizes: DataFrame, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """``source, rank, source_size, before, target`` of every source in ``sizes`` (source, size).

    ``before`` holds the words of the sources ahead in code point order.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = _running(total, [F.col("source").asc_nulls_last()], {"rank": F.lit(1), "through": F.col("source_size")})
    weighed = cut(
        ranked.select(
            "source", "rank", "source_size", (F.col("through") - F.col("source_size")).alias("before"),
            _weight(F.col("rank")).alias("weight"), (F.col("source_size") * repeats).alias("most"),
        )
    )
    order = [F.col("most") / F.col("weight"), F.col("rank")]
    stopped = _running(weighed, order, {"most_through": F.col("most"), "weight_through": F.col("weight")})
    # Single numbers: the words to give out, the sum of the weights, the level.
    budget, weights = weighed.agg(F.sum("source_size") * share, F.sum("weight")).first()
    level = (F.lit(budget) - (F.col("most_through") - F.col("most"))) / (
        F.lit(weights) - (F.col("weight_through") - F.col("weight"))
    )
    best = stopped.agg(F.max(level)).first()[0]
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.lit(best))
    return weighed.select("source", "rank", "source_size", "before", target.alias("target"))


def _queued(docs: DataFrame, key: str, seed: str, share: float, repeats: int) -> DataFrame:
    """Every document with its row number, its source's target, and the words its source gives out up to it."""
    text = F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string"), F.md5(text.cast("binary"))).cast("binary"))
    slim = cut(docs.select(F.col(key), "source", F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"), digest.alias("_order")))
    sources = cut(targets(slim, share, repeats))
    # Sources are few beside the documents, but not provably so: the optimizer picks the join by their size.
    placed = slim.withColumnRenamed("source", "_source").join(sources, F.col("_source").eqNullSafe(F.col("source"))).drop("_source")
    order = [F.col("rank"), F.col("_order"), F.col(key), F.col("size")]
    run = _running(placed, order, {"_through": F.col("size"), "_row": F.lit(1)})
    return run.withColumn("_given", F.col("_through") - F.col("before")).drop("_through", "before")


def _served(queued: DataFrame, key: str, share: float, repeats: int) -> DataFrame:
    """The given-out documents in their order: ``_row``, ``epoch``, ``finish``, ``begin`` and ``taken`` words."""
    turn = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("epoch")
    finish = (F.col("_given") + F.col("epoch") * F.col("source_size")) / F.col("target")
    asked = queued.where("size > 0").select(key, "source", "size", "source_size", "rank", "_row", "_given", "target", turn)
    timed = asked.withColumn("finish", finish)
    run = _running(timed, [F.col("finish"), F.col("rank"), F.col("epoch"), F.col("_row")], {"_through": F.col("size")})
    budget = queued.agg(F.floor(F.sum("size") * share)).first()[0]
    begin = F.col("_through") - F.col("size")
    taken = F.greatest(F.lit(0), F.least(F.col("size"), F.lit(budget) - begin))
    return run.withColumns({"begin": begin, "taken": taken.cast("bigint")}).where("taken > 0")


def mix(docs: DataFrame, key: str = "doc_id", seed: str = "mix", share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """The mix itself: a row for every time a document is given out, with ``begin``, its first word's place in the mix.

    ``taken`` is the number of its words; only the last document of the mix may have fewer than ``size``.
    """
    served = _served(cut(_queued(docs, key, seed, share, repeats)), key, share, repeats)
    return served.select(key, "source", "size", "epoch", "finish", "begin", "taken")


def shares(docs: DataFrame, key: str = "doc_id", seed: str = "mix", share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """Every document with its size, its source's words and target, and the words the mix takes of it."""
    queued = cut(_queued(docs, key, seed, share, repeats))
    taken = _served(queued, key, share, repeats).groupBy("_row").agg(F.sum("taken").alias("taken"))
    return queued.join(taken, "_row", "left").select(
        key, "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")
    )
