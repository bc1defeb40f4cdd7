"""Mixing of sources by weighted fair queueing."""

import pytest
from pyspark.sql import functions as F

from clickfacts.llm import fairmix

SCHEMA = "doc_id long, text string, source string, size string"


def filled(sizes, budget, weights=fairmix.WEIGHTS, most=fairmix.REPEATS):
    """Targets by handing the excess of stopped sources round until none is above."""
    target, open_, rest = {}, dict(enumerate(sizes)), budget
    while open_:
        level = rest / sum(weights[i % 3] for i in open_)
        stopped = [i for i, s in open_.items() if weights[i % 3] * level >= most * s]
        if not stopped:
            target |= {i: weights[i % 3] * level for i in open_}
            break
        for i in stopped:
            target[i] = most * open_.pop(i)
            rest -= target[i]
    return target


def rows(n_by_source):
    made = []
    for source, counts in n_by_source.items():
        made += [(len(made) + i, " ".join(["w"] * n), source, "clash") for i, n in enumerate(counts)]
    return made


def test_targets_and_taken(spark):
    docs = rows({"b": [9] * 200, "a": [3] * 40, None: [5] * 100, "c": [7] * 300, "d": [0, 0], "e": [20] * 100})
    got = fairmix.shares(spark.createDataFrame(docs, SCHEMA)).collect()
    assert len(got) == len(docs)
    sources = ["a", "b", "c", "d", "e", None]
    size = {s: sum(len((t or "").split()) for _, t, x, _ in docs if x == s) for s in sources}
    want = filled([size[s] for s in sources], 1.5 * sum(size.values()))
    by_id = {d: s for d, _, s, _ in docs}
    taken = dict.fromkeys(sources, 0)
    for r in got:
        s = by_id[r.doc_id]
        assert r.target == pytest.approx(want[sources.index(s)])
        assert r.source_size == size[s] and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert sum(taken.values()) == sum(size.values()) * 3 // 2
    longest = max(len((t or "").split()) for _, t, _, _ in docs)
    for i, s in enumerate(sources):
        assert abs(taken[s] - want[i]) <= longest + 1


def test_order_by_brute_force(spark):
    """The mix is the order of the finish times, cut at the budget."""
    docs = spark.createDataFrame(rows({"a": [1, 4, 2, 6], "b": [3, 3, 5], None: [8, 1]}), SCHEMA)
    mixed = sorted(fairmix.mix(docs).collect(), key=lambda r: r.begin)
    finish = [r.finish for r in mixed]
    assert finish == sorted(finish)
    place = 0
    for r in mixed:
        assert r.begin == place and r.taken <= r.size
        place += r.taken
    assert all(r.taken == r.size for r in mixed[:-1]) and place == 33 * 3 // 2
    for s in ("a", "b", None):
        given = 0
        queue = [r for r in mixed if r.source == s]
        for r in queue:
            given += r.size
            target = {t.source: t.target for t in _targets(docs)}[s]
            assert r.finish == given / target


def _targets(docs):
    return fairmix.targets(docs.select("source", F.regexp_count("text", F.lit(fairmix.WORD)).cast("bigint").alias("size"))).collect()


def test_reruns_and_layout_agree(spark):
    docs = spark.createDataFrame(rows({"a": [5] * 50, "b": list(range(60))}), SCHEMA)
    first = sorted(map(tuple, fairmix.shares(docs).collect()))
    assert first == sorted(map(tuple, fairmix.shares(docs.repartition(7)).collect()))


def test_odd_rows(spark):
    made = [(None, None, None, ""), (1, "", "a", ""), (1, "x  y\tz\x0bq r", "a", ""), (1, "x  y\tz\x0bq r", "a", ""), (2, "w " * 30000, "b", "")]
    got = fairmix.shares(spark.createDataFrame(made, SCHEMA)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == [(False, 1, 0), (False, 1, 4), (False, 1, 4), (False, 2, 30000), (True, 0, 0)]
    assert all(r.taken <= 2 * r.size for r in got)


def test_empty_tables(spark):
    assert fairmix.shares(spark.createDataFrame([], SCHEMA)).count() == 0
    blank = fairmix.shares(spark.createDataFrame([(1, " ", "a", "")], SCHEMA)).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)]
