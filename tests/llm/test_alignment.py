"""Alignment of two tokenizers against brute force with the tokenizer libraries."""

import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from clickfacts.llm import queries, spillalign
from clickfacts.llm.common import ship

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, run string, radix string"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(rows, libraries):
    a_lib, b_lib = libraries
    letters = spillalign._byte_of_character()
    linked, out = [], []
    for key, text in rows:
        whole = (" " + (text or "")).encode()
        a = [(i, bytes(letters[c] for c in a_lib.id_to_token(i))) for i in a_lib.encode(whole.decode(), add_special_tokens=False).ids]
        b = []
        for i in b_lib.encode(text or ""):
            piece = b_lib.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if b_lib.is_byte(i) else piece.replace("▁", " ").encode()))
        if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            linked.append([])
            out.append([key, 0, 0, 0, 0, ""])
            continue
        spans = []
        for side in (a, b):
            at, own = 0, []
            for i, x in side:
                own.append((at, at + len(x), i))
                at += len(x)
            spans.append(own)
        links, j = [], 0
        for low, high, i in spans[0]:
            while spans[1][j][1] <= low:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < high:
                links.append((i, spans[1][k][2]))
                k += 1
        cuts = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        sides = [[[] for _ in cuts] for _ in spans]
        for own, kept in zip(spans, sides, strict=True):
            for _, high, i in own:
                kept[bisect.bisect_left(cuts, high)].append(str(i))
        groups = [",".join(x) + "|" + ",".join(y) for x, y in zip(*sides, strict=True)]
        linked.append(links)
        out.append([key, len(a), len(b), len(cuts), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest()])
    counts = Counter(p for links in linked for p in links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    done = []
    for row, links in zip(out, linked, strict=True):
        best = sum(counts[p] == most[p[1]] for p in links)
        done.append((*row[:5], best, sum(counts[p] for p in links), row[5]))
    return sorted(done, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.select([f.split()[0] for f in spillalign.RESULT.split(", ")]).collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(3)
    words = ["the", "straße", "naïve", "漢字かな", "don't", "<|endoftext|>", "</s>", "<unk>", "▁", "x" * 70, "  ", "\n\n", "1234567", "😀", "é", " ", "ﬁ"]
    texts = [" ".join(draw.choices(words, k=draw.randint(1, 25))) for _ in range(150)]
    texts += [None, "", " ", "  lead", "trail  ", "a\tb", "<0x41>", "the the the", texts[3], texts[3], " ".join(draw.choices(words[:5], k=9000))]
    rows = list(enumerate(texts))
    return [*rows, rows[4], (None, "no id")]


@pytest.mark.parametrize("run_bytes,page,fan,held", [(1 << 20, 1 << 15, 64, 1 << 18), (700, 7, 3, 20)])
def test_equals_brute_force(spark, corpus, libraries, monkeypatch, run_bytes, page, fan, held):
    """Also with many small runs and pages and several levels of merging."""
    ship(spark)
    for name, value in (("RUN_BYTES", run_bytes), ("PAGE", page), ("FAN", fan), ("HELD", held)):
        monkeypatch.setattr(spillalign, name, value)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in corpus], SCHEMA).repartition(5)
    assert rows_of(spillalign.align(docs, A, B)) == brute(corpus, libraries)


def test_merge_by_heap(monkeypatch):
    """Pages of many runs, unpacked as they reach the front."""
    monkeypatch.setattr(spillalign, "HELD", 50)
    draw = np.random.default_rng(1)
    want, pages = Counter(), []
    for run in range(30):
        pairs = np.unique(draw.integers(0, 500, draw.integers(1, 200)))
        counts = draw.integers(1, 9, len(pairs))
        want.update(dict(zip(pairs.tolist(), counts.tolist(), strict=True)))
        for begin in range(0, len(pairs), 16):
            own = pairs[begin : begin + 16]
            pages.append((run, int(own[0]), len(own), spillalign._pack(np.diff(own, prepend=0), counts[begin : begin + 16])))
    draw.shuffle(order := list(range(len(pages))))
    merged = list(spillalign._Merge(*[list(c) for c in zip(*[pages[i] for i in order], strict=True)]))
    got = [p for pairs, counts in merged for p in zip(pairs.tolist(), counts.tolist(), strict=True)]
    assert got == sorted(want.items()) and len(merged) > 3


def test_registered_query(spark, libraries):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(queries.QUERIES["op12_token_alignment"](spark, "/root/testdata/sf0.001")) == brute(rows, libraries)


def test_empty_table(spark):
    ship(spark)
    assert spillalign.align(spark.createDataFrame([], SCHEMA), A, B).count() == 0
