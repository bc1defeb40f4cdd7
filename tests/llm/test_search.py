"""Ranked search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from clickfacts.llm import rmqsearch
from clickfacts.llm.common import ship

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
DOCS, ITEMS = "doc_id long, text string, score string, item_id string", "item_id long, text string, rank string"


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k):
    found = [(d, Counter(terms(t))) for d, t in docs]
    found = [(d, c, sum(c.values())) for d, c in found if c]
    n_docs, n_terms = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        ranked = []
        for d, c, n in found:
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                ranked.append((-score, d is None, d or 0, d))
        out += [(item, i, d, -s) for i, (s, _, _, d) in enumerate(sorted(ranked)[:k], 1)]
    return out


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _table(spark, docs, items):
    ship(spark)
    return (
        spark.createDataFrame([(d, t, "x", "y") for d, t in docs], DOCS),
        spark.createDataFrame([(i, t, "z") for i, t in items], ITEMS),
    )


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(5)
    vocabulary = ["".join(draw.choices("abcdeÉñ漢0", k=draw.randint(1, 4))) for _ in range(300)]
    shares = [1 / (i + 1) for i in range(300)]
    text = lambda n: draw.choice([" ", ", ", "\0", "-"]).join(draw.choices(vocabulary, shares, k=n))
    docs = [(i, text(draw.randint(0, 60))) for i in range(400)]
    docs += [(1000 - i, docs[7][1].upper()) for i in range(40)]
    docs += [(2000, None), (2001, ""), (2002, " \t,."), (None, docs[7][1]), (None, docs[7][1]), (7, docs[7][1]), (3000, text(40_000))]
    items = [(i, text(draw.randint(1, 25))) for i in range(25)]
    items += [(100, docs[7][1]), (101, None), (102, "..."), (103, "zzzz unknown"), (104, items[0][1]), (105, "a a A a")]
    return docs, items


@pytest.mark.parametrize("postings,block", [(1 << 20, 1 << 22), (500, 300)])
def test_equals_brute_force(spark, corpus, monkeypatch, postings, block):
    """Also with many small segments per task and several blocks of items."""
    monkeypatch.setattr(rmqsearch, "BLOCK_BYTES", block)
    docs, items = corpus
    segment = rmqsearch.SEGMENT_POSTINGS
    rmqsearch._found.__globals__["SEGMENT_POSTINGS"] = postings
    try:
        got = _rows(rmqsearch.search(*_table(spark, docs, items)))
    finally:
        rmqsearch._found.__globals__["SEGMENT_POSTINGS"] = segment
    assert got == sorted(brute(docs, items, 10), key=repr)


def test_segment_search_prunes_and_loses_nothing():
    """Every item over several small segments equals the ranking of all sums."""
    draw = np.random.default_rng(2)
    best, sums = [rmqsearch.Best(5) for _ in range(20)], [[] for _ in range(20)]
    asked = [np.unique(draw.integers(0, 50, 8)) for _ in best]
    for first in (0, 500, 200):
        has = draw.random((200, 50)) < draw.random(50) * 0.5
        owner, term = np.nonzero(has)
        impact = draw.integers(1, 40, len(owner))
        ids = draw.permutation(np.arange(first, first + 200))
        segment = rmqsearch.Segment(ids, has.sum(axis=1), term, impact)
        for item, own, all_ in zip(best, asked, sums, strict=True):
            segment.search(own, item)
            score = np.bincount(owner, np.where(np.isin(term, own), impact, 0), 200).astype(int)
            all_ += [(-s, i) for s, i in zip(score.tolist(), ids.tolist(), strict=True) if s]
    for item, all_ in zip(best, sums, strict=True):
        assert [(-s, i) for s, i in zip(item.scores.tolist(), item.ids.tolist(), strict=True)] == sorted(all_)[:5]


def test_term_runs_end_with_their_text():
    texts = ["ab", "cd", "", "É9", "x y"]
    owner, one, two = rmqsearch.term_runs(*rmqsearch._bytes_of(rmqsearch.pa.array(texts)))
    assert owner.tolist() == [0, 1, 3, 4, 4] and len(set(one.tolist())) == 5


def test_empty_tables(spark):
    docs, items = _table(spark, [(1, "a b")], [(1, "a")])
    assert rmqsearch.search(docs.limit(0), items).count() == 0
    assert rmqsearch.search(docs, items.limit(0)).count() == 0
    assert _rows(rmqsearch.search(docs, items)) == brute([(1, "a b")], [(1, "a")], 10)
