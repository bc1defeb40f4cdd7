"""Operators on whole tables: near duplicates, vectors, decontamination, scores, shards."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from clickfacts.llm import backoff, caps, decontam, kdtree, omh, queries, shards
from clickfacts.llm.common import ship
from clickfacts.llm.components import components
from tests import oracle

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, extra string"


def _find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def _classes(ids, links):
    parent = {i: i for i in ids}
    for a, b in links:
        a, b = _find(parent, a), _find(parent, b)
        parent[max(a, b)] = min(a, b)
    return {i: _find(parent, i) for i in ids}


def test_components(spark):
    draw = random.Random(4)
    edges = [(i, i + 1) for i in range(1000, 1040)] + [(draw.randrange(300), draw.randrange(300)) for _ in range(150)]
    edges += [(5000, i) for i in range(5001, 5300)] + [(7, 7), (7, 9), (7, 9)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = _classes({x for e in edges for x in e}, edges)
    assert got == {i: c for i, c in want.items() if i in got}
    assert set(got) == {x for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def _similarity(a, b):
    c = _lcs(a, b)
    return c / (len(a) + len(b) - c)


def test_banded_alignment():
    draw = random.Random(3)
    pairs = []
    for _ in range(300):
        a = [draw.randint(0, draw.choice([5, 1000])) for _ in range(draw.randint(1, 70))]
        b = list(a)
        for _ in range(draw.randint(0, 6)):
            i = draw.randrange(len(b) + 1)
            b[i : i + draw.randint(0, 1)] = [draw.randint(0, 1000)] * draw.randint(0, 1)
        pairs.append((np.array(a, np.uint64), np.array(b or [1], np.uint64)))
    got = omh.similarities(pairs)
    want = np.array([_similarity(a.tolist(), b.tolist()) for a, b in pairs])
    high = want >= 0.8 - 1e-9
    assert high.sum() > 50 and np.allclose(got[high], want[high]) and (got[~high] < 0.8).all()


def _near_copies():
    """Texts with copies and near copies in chains, short ones, and a passage that many share."""
    draw = random.Random(8)
    word = lambda: "".join(draw.choices("abcdefgh", k=draw.randint(2, 7)))
    passage = [word() for _ in range(60)]
    texts = [[word() for _ in range(draw.choice([1, 4, 7, 12, 30, 80, 200]))] for _ in range(60)]
    texts += [passage + [word() for _ in range(120)] for _ in range(20)]
    base = [word() for _ in range(150)]
    for i in range(40):
        copy = list(base if i % 3 else texts[-1])
        for _ in range(draw.randint(0, 3)):
            copy[draw.randrange(len(copy))] = word()
        texts.append(copy)
    for text in texts[:20]:
        copy = list(text)
        if len(copy) > 20:
            copy.insert(3, word())
        texts.append(copy)
    return [(i * 7 % 1009, " ".join(t)) for i, t in enumerate(texts)]


def test_duplicates_equal_brute_force(spark):
    ship(spark)
    texts = _near_copies()
    # Case and punctuation do not matter.
    texts += [(2000 + i, t.upper().replace(" ", ", ")) for i, t in texts[::9]]
    rows = [(i, t, None) for i, t in texts]
    rows += [(3000, None, "x"), (3001, "", "x"), (3002, " !? ", "x"), (None, "a b c d e f g", "x"), (3003, "a b c d e f g", "x")]
    rows += [rows[0], rows[0]]
    df = spark.createDataFrame(rows, DOCS).withColumn("class_id", F.lit("clash"))
    got = omh.duplicates(df).collect()
    assert len(got) == len(rows)
    sequences = {}
    for i, t, _ in rows:
        if i is not None and t and omh.words_of(t):
            w = omh.words_of(t)
            sequences[i] = [tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))]
    ids = sorted(sequences)
    links = []
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sequences[a], sequences[b]
            if min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and len(set(x) & set(y)) >= 0.6 * len(set(x)) and _similarity(x, y) >= 0.8 - 1e-9:
                links.append((a, b))
    want = _classes(ids, links) | {3000: 3000, 3001: 3001, 3002: 3002}
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == want
    assert all(r.kept == (r.class_id == r.doc_id) for r in got if r.doc_id is not None)
    kept = omh.keep_one(df)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({*want.values(), None})
    assert omh.duplicates(df.limit(0)).count() == 0


def _vectors():
    draw = np.random.default_rng(6)
    rows = []
    for i in range(160):
        x = draw.normal(size=16)
        rows.append((i, x, i % 3))
        for j in range(i % 4):
            c = draw.uniform(0.9, 0.99)
            z = draw.normal(size=16)
            z -= (z @ x) / (x @ x) * x
            rows.append((1000 + 10 * i + j, c * x / np.linalg.norm(x) + math.sqrt(1 - c * c) * z / np.linalg.norm(z), i % 3))
    rows += [(5000 + k, rows[3][1], rows[3][2]) for k in range(4)] + [(6000, rows[3][1] * 3, rows[3][2]), (6001, rows[3][1], 99)]
    return [(i, [float(np.float32(v)) for v in x], label) for i, x, label in rows]


def test_caps_equal_brute_force(spark):
    ship(spark)
    rows = _vectors()
    odd = [(7000, None, 1), (7001, [0.0] * 16, 1), (7002, [math.nan] * 16, 1), (7003, [math.inf] + [0.0] * 15, 1)]
    odd += [(7004, rows[0][1], None), (7005, [None] * 16, 1), (7006, [], 1), (None, rows[0][1], 0), (7007, rows[0][1][:8], rows[0][2])]
    every = rows + odd + [rows[1], (rows[2][0], rows[9][1], rows[9][2])]
    df = spark.createDataFrame(every, "vec_id long, embedding array<float>, label int").withColumn("n_links", F.lit("clash"))
    got = caps.duplicates(df).collect()
    assert len(got) == len(every)
    usable = [r for r in every if r[0] is not None and r[1] and len(r[1]) in (8, 16) and r[2] is not None and None not in r[1]]
    usable = [r for r in usable if np.isfinite(r[1]).all() and any(r[1])]
    links, linked = Counter(), []
    for n, (a, x, p) in enumerate(usable):
        for m, (b, y, q) in enumerate(usable):
            if n != m and p == q and len(x) == len(y):
                x_, y_ = np.array(x, np.float64), np.array(y, np.float64)
                if x_ @ y_ / math.sqrt((x_ @ x_) * (y_ @ y_)) >= 0.93:
                    links[n] += 1
                    linked.append((n, m))
    groups = _classes(range(len(usable)), linked)
    least = {}
    for n, g in groups.items():
        least[g] = min(least.get(g, 1 << 60), usable[n][0])
    want = Counter((r[0], links[n], least[groups[n]]) for n, r in enumerate(usable))
    alone = [r[0] for r in every if not any(r is u for u in usable)]
    want += Counter((i, 0, i) for i in alone)
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == want
    assert caps.duplicates(df.limit(0)).count() == 0


def test_caps_equal_sql_where_there_are_links(spark, tmp_path):
    rows = _vectors() + [(7000, None, 1), (7001, [0.0] * 16, 1), (7002, [math.nan] * 16, 1), (7004, _vectors()[0][1], None)]
    path = str(tmp_path / "embeddings.parquet")
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(path)
    got = queries.QUERIES["op6_cap_filters"](spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}/*.parquet')")
    want = con.execute(queries.ORACLES["op6_cap_filters"]).fetchall()
    assert sum(n for _, n, _, _ in want) > 300
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == sorted(want)


def test_caps_split_a_large_home(spark, monkeypatch):
    """A group of near copies that fills many tiles: every link counts once, within tiles and across them."""
    ship(spark)
    monkeypatch.setattr(caps, "TILE_BYTES", 8 * 16 * 6)
    draw = np.random.default_rng(8)
    base = draw.normal(size=16)
    rows = [(i, [float(v) for v in base + draw.normal(size=16) * (0.02 if i % 3 else 0.35)], i % 2) for i in range(240)]
    rows += [(900 + i, rows[0][1], rows[0][2]) for i in range(5)]
    got = {r.vec_id: r for r in caps.duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    links = (x @ x.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(links, False)
    groups = _classes([r[0] for r in rows], [(rows[i][0], rows[j][0]) for i, j in np.argwhere(links)])
    assert links.sum() > 10_000
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == {r[0]: (int(links[n].sum()), groups[r[0]]) for n, r in enumerate(rows)}


def test_connected():
    links = np.zeros((5, 6), bool)
    links[[0, 1, 1, 3], [2, 2, 4, 0]] = True
    left, right = caps.connected(links)
    assert left.tolist() == [0, 0, -1, 1, -1] and right.tolist() == [1, -1, 0, -1, 0, -1]


def test_cap_lists_are_complete():
    """List decoding finds exactly the directions above the bound, and near vectors share one."""
    draw = np.random.default_rng(0)
    x = draw.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tables = [caps.Filters(64, 128, t) for t in range(caps.TABLES)]
    left, right = tables[0]._halves(x[:40])
    for a, b, got in zip(left, right, tables[0].listed(x[:40]), strict=True):
        assert set(got.tolist()) == set(np.flatnonzero((a[:, None] + b).ravel() >= tables[0].bound).tolist())
    z = draw.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    y = 0.93 * x + math.sqrt(1 - 0.93**2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    both = [list(zip(t.listed(x), t.listed(y), strict=True)) for t in tables]
    assert np.mean([any(len(np.intersect1d(*t[i])) for t in both) for i in range(len(x))]) >= 0.99


def test_cap_recall_does_not_fall_with_size():
    """Pairs at the threshold share a direction as often with the codewords of many vectors as with those of few."""
    assert caps.plan(64, 512, 0.93)[1] <= caps.plan(64, 16384, 0.93)[1]
    for length, codewords in ((64, 16384), (16, 4096), (64, 512), (4, 64)):
        own, tables = caps.plan(length, codewords, 0.93)
        found = np.zeros(2000, bool)
        for t in range(tables):
            found |= caps.shared(caps.Filters(length, own, t), length, 0.93, 2000)
        assert found.mean() >= 0.9975, (length, codewords, tables)


@pytest.mark.parametrize("length", [1, 2, 3])
def test_cells_of_short_vectors_are_exact(length):
    x = np.random.default_rng(length).normal(size=(300, length))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    listed = caps.cells(x, 0.93)
    for a, b in zip(*np.nonzero(x @ x.T >= 0.93), strict=True):
        assert len(np.intersect1d(listed[a], listed[b]))


def _brute_leaks(documents, items):
    """Best window of an item's length by the weighted shingle similarity, over all positions."""
    cut = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    found = {}
    for i, text in documents:
        words = cut(text)
        for item, other in items:
            own = cut(other)
            if not own or not words:
                continue
            k = min(5, len(own))
            target = Counter(tuple(own[j : j + k]) for j in range(len(own) - k + 1))
            for begin in range(max(1, len(words) - len(own) + 1)):
                window = words[begin : begin + len(own)]
                here = Counter(tuple(window[j : j + k]) for j in range(len(window) - k + 1))
                shared = sum((here & target).values())
                s = shared / max(1, sum((here | target).values()))
                if s >= 0.8:
                    found[i, item] = max(found.get((i, item), 0), round(s, 6))
    return found


def test_leaks_equal_brute_force(spark):
    draw = random.Random(5)
    word = lambda: "".join(draw.choices("abcdefghij", k=draw.randint(2, 6)))
    items = [(n, " ".join(word() for _ in range(draw.choice([1, 3, 5, 9, 25, 60])))) for n in range(12)] + [(90, None), (91, ""), (92, "!!")]
    items.append((93, items[4][1]))
    documents = []
    for i in range(60):
        words = [word() for _ in range(draw.choice([0, 3, 40, 200]))]
        if i % 2:
            passage = items[i % 12][1].split()
            if i % 3 == 0 and len(passage) > 20:
                passage[0] = word()
            at = draw.randint(0, len(words))
            words[at:at] = passage
        documents.append((i, ", ".join(words).title()))
    documents += [(100, None), (101, ""), documents[1]]
    df = spark.createDataFrame([(i, t, "x") for i, t in documents], DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.leaks(df, bench).collect()}
    assert got == _brute_leaks(documents, items)
    assert decontam.leaks(df.limit(0), bench).count() == 0
    assert decontam.leaks(df, bench.limit(0)).count() == 0


def test_leaks_with_changed_ends_equal_sql(spark):
    """Heads and tails replaced as far as similarity 0.80 to 0.90 allows, over many items, against the query's SQL."""
    duckdb = pytest.importorskip("duckdb")
    draw = random.Random(12)
    word = lambda: "".join(draw.choices("abcdefghijklmnop", k=draw.randint(3, 8)))
    items, documents = [], []
    for n in range(240):
        own = [word() for _ in range(draw.randint(24, 70))]
        items.append((n, " ".join(own)))
        shingles = len(own) - 4
        worst = shingles // 9
        # The most changed words that keep the similarity at 0.8, and about half as many.
        for i, changed in enumerate((worst, max(1, worst // 2))):
            other = [word() for _ in range(changed)]
            text = other + own[changed:] if n % 2 else own[: len(own) - changed] + other
            around = [word() for _ in range(30)]
            documents.append((2 * n + i, " ".join(around[:15] + text + around[15:])))
    # An item that shares most shingles with another one, and one of a single repeated shingle.
    items += [(500, items[0][1] + " end"), (501, "again " * 30)]
    documents.append((900, "x " * 9 + "again " * 27 + "y " * 9))
    df = spark.createDataFrame([(i, t, "x") for i, t in documents], DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    with duckdb.connect() as db:
        for name, rows in (("documents", documents), ("benchmark", items)):
            key = "doc_id" if name == "documents" else "item_id"
            db.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
            db.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
        want = sorted(db.execute(queries.ORACLES["op10_simhash_windows"]).fetchall())
    got = sorted(tuple(r) for r in decontam.leaks(df, bench).collect())
    assert len(want) > 480
    assert got == want


def test_blocks_cover_the_radius():
    """Any two fingerprints within the radius agree up to the flips in one block."""
    draw = random.Random(1)
    flips = set(decontam._flips())
    for _ in range(2000):
        diff = sum(1 << b for b in draw.sample(range(64), decontam.RADIUS))
        assert any(diff >> 16 * b & 0xFFFF in flips for b in range(4))


def test_backoff_equals_brute_force(spark):
    ship(spark)
    draw = random.Random(2)
    rows = [(i, " ".join(draw.choices(["aa", "bb", "cc", "dd", "e", "f_g"], k=draw.randint(0, 30))), "x") for i in range(50)]
    rows += [(60, None, "x"), (61, "", "x"), rows[3], (None, "aa bb cc", "x"), (62, "aa bb " * 3000, "x")]
    got = Counter((r.doc_id, r.n_words, r.score) for r in backoff.score(spark.createDataFrame(rows, DOCS).withColumn("score", F.lit(1))).collect())
    texts = [(i, omh.words_of(t or "")) for i, t, _ in rows]
    count = Counter(tuple(w[j : j + n]) for _, w in texts for n in (1, 2, 3) for j in range(len(w) - n + 1))
    total = sum(len(w) for _, w in texts)

    def logscore(gram):
        if len(gram) == 1:
            return math.log(count[gram] / total)
        return math.log(count[gram] / count[gram[:-1]]) if count[gram] >= 2 else math.log(0.4) + logscore(gram[1:])

    want = Counter()
    for i, w in texts:
        sums = [logscore(tuple(w[max(0, j - 2) : j + 1])) for j in range(len(w))]
        want[i, len(w), round(sum(sums) / len(w), 6) if w else None] += 1
    near = lambda c: sorted((i if i is not None else -1, n, round(s, 5) if s is not None else 0.0) for i, n, s in c.elements())
    assert np.allclose(np.array(near(got)), np.array(near(want)), atol=2e-5)
    assert backoff.score(spark.createDataFrame([], DOCS)).count() == 0


def test_order_permutes():
    for n in (0, 1, 2, 3, 16, 17, 1000, 4097):
        out = shards.permuted(np.arange(n), n, "k")
        assert sorted(out.tolist()) == list(range(n))
        assert shards.permuted(out, n, "k", inverse=True).tolist() == list(range(n))
    assert shards.permuted(np.arange(50), 50, "a").tolist() != shards.permuted(np.arange(50), 50, "b").tolist()


def test_shards_round_trip(spark, tmp_path):
    from clickfacts.llm import bpe

    ship(spark)
    rows = [(i, "word " * (i * 7 % 40), "x") for i in range(30)] + [(40, None, "x"), (41, "", "x"), (None, "né\n\n", "x"), (0, "", "x")]
    path = str(tmp_path / "out")
    total = shards.materialise(spark.createDataFrame(rows, DOCS), path, queries.BYTE_BPE, 50256, "k", length=8, per_shard=16)
    back = shards.read(spark, path, 8, 16).collect()
    assert sorted(r.slot for r in back) == list(range(total))
    assert all(r.shard == r.slot // 16 and r.begin == r.slot % 16 * shards.stride(8) for r in back)
    known = bpe.vocabulary(queries.BYTE_BPE)
    found = {}
    for r in back:
        ids = np.frombuffer(r.record, "<u2")[8 : 8 + r.n_tokens] if len(r.record) % 2 == 0 else np.frombuffer(r.record[:-1], "<u2")[8 : 8 + r.n_tokens]
        found.setdefault(r.id, []).append((r.number, ids.tolist()))
    for i, text, _ in rows:
        if i == 0:
            continue
        want = known.encode([text or ""])[0].tolist() + [50256]
        assert sum((ids for _, ids in sorted(found[i])), []) == want
    assert len(found[0]) == 2
    later = shards.read(spark, path, 8, 16, from_slot=20).collect()
    assert {r.slot: r.record for r in later} == {r.slot: r.record for r in back if r.slot >= 20}
    assert {(r.shard, r.begin) for r in later} == {(r.shard, r.begin) for r in back if r.slot >= 20}
    # Shards before the wanted one are pruned by their folder.
    files = shards.read(spark, path, 8, 16, from_slot=total - 1).select("slot")
    assert files.collect()[0].slot == total - 1 and files.count() == 1
    plan = shards.read(spark, path, 8, 16, from_slot=20)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*shard#\d+[^\]]* >= 1", plan)
    empty = str(tmp_path / "none")
    assert shards.materialise(spark.createDataFrame([], DOCS), empty, queries.BYTE_BPE, 50256, "k") == 0
    assert shards.read(spark, empty).count() == 0


def test_shards_are_shuffled_a_third_at_a_time(spark, tmp_path, monkeypatch):
    """Every write takes a range of the shards; when one fails, the shards of those before it go, earlier files stay."""
    ship(spark)
    rows = spark.createDataFrame([(i, "word " * (i * 7 % 40), "x") for i in range(60)], DOCS)
    own, ranges = shards._records, []
    monkeypatch.setattr(shards, "_records", lambda *a: ranges.append(a[-2:]) or own(*a))
    path = tmp_path / "out"
    total = shards.materialise(rows, str(path), queries.BYTE_BPE, 50256, "k", length=8, per_shard=16)
    count = -(-total // 16)
    assert [low for low, _ in ranges] == [0, *(high for _, high in ranges[:-1])] and ranges[-1][1] == count
    assert count > 3 and max(high - low for low, high in ranges) <= -(-count // 3)
    assert sorted(r.slot for r in shards.read(spark, str(path), 8, 16).collect()) == list(range(total))
    assert (path / "_SUCCESS").exists() and not (tmp_path / "out-tokens").exists()

    def failing(*a):
        if a[-2]:
            assert not (tmp_path / "failed" / "_SUCCESS").exists()
            raise RuntimeError("lost")
        return own(*a)

    monkeypatch.setattr(shards, "_records", failing)
    with pytest.raises(RuntimeError, match="lost"):
        shards.materialise(rows, str(tmp_path / "failed"), queries.BYTE_BPE, 50256, "k", length=8, per_shard=16)
    assert not (tmp_path / "failed").exists()
    monkeypatch.setattr(shards, "_records", own)
    with pytest.raises(Exception, match="(?i)exists"):
        shards.materialise(rows, str(path), queries.BYTE_BPE, 50256, "k", length=8, per_shard=16)
    assert sorted(r.slot for r in shards.read(spark, str(path), 8, 16).collect()) == list(range(total))


def _sharded(rows):
    out = {}
    for r in rows:
        out.setdefault(r.shard, []).append(r)
    return out


def test_kdtree_shards(spark):
    draw = random.Random(3)
    rows = [(i, "x" * int(draw.expovariate(1 / 300)), draw.choice(["de", "en", None])) for i in range(900)]
    rows += [(1000 + i, "copy " * 30, "en") for i in range(450)] + [(2000, None, "de"), (2001, "", "de"), rows[0], (None, "k", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("shard", F.lit("clash"))
    got = kdtree.shard_documents(df, shards=12).collect()
    assert len(got) == len(rows)
    texts = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == texts
    found = _sharded(got)
    assert sorted(found) == list(range(12))
    assert all(sorted(r.slot for r in own) == list(range(len(own))) for own in found.values())
    sizes = [sum(r.size for r in own) for own in found.values()]
    assert max(sizes) - min(sizes) <= 3 * max(r.size for r in got)
    # The copies, a third of the rows, are cut only where a shard is full.
    copies = zlib.crc32(("copy " * 30).encode())
    holding = [own for own in found.values() if any(r.text_crc32 == copies for r in own)]
    assert len(holding) <= math.ceil(450 * 166 / (sum(sizes) / 12)) + 2
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    assert kdtree.shard_documents(df.limit(0)).count() == 0


def test_kdtree_splits_at_weighted_medians(spark):
    """A single split is the weighted median along the wider dimension."""
    draw = np.random.default_rng(2)
    rows = [(i, int(w), int(a), int(b)) for i, (w, a, b) in enumerate(zip(draw.integers(1, 50, 300), draw.integers(0, 1 << 20, 300), draw.integers(0, 9, 300), strict=True))]
    df = spark.createDataFrame(rows, "id long, w long, a long, b long")
    ties = [F.crc32(F.col("id").cast("string").cast("binary")), F.lit(0)]
    got = {r.id: r.shard for r in kdtree.place(df, 2, "id", F.col("w"), [F.col("a"), F.col("b") * 0], ties, tolerance=0.0).collect()}
    order = sorted(rows, key=lambda r: r[2])
    half, total = sum(r[1] for r in rows) / 2, 0
    best = min(range(len(order) + 1), key=lambda n: abs(sum(r[1] for r in order[:n]) - half))
    assert {i for i, s in got.items() if s == 0} == {r[0] for r in order[:best]}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    result = oracle.connect(SMALL).execute(queries.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert oracle.spark_rows(df.select(*columns)) == oracle.rows(columns, result.fetchall())


def test_bpe_query(spark):
    import base64

    import public_tokenizers
    import tiktoken

    with open(queries.BYTE_BPE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    documents = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = queries.QUERIES["op9_byte_bpe"](spark, SMALL).collect()
    assert len(got) == len(documents)
    for r in got:
        ids = library.encode_ordinary(documents[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(documents[r.doc_id].encode()).hexdigest()


def test_word_codes_name_the_words_of_a_text_across_blocks(monkeypatch):
    draw = random.Random(5)
    texts = ["", " ,", "x" * 70, "a " * 40, "x²_É ß"] + ["".join(draw.choice("ab é_ßİ½ ²1\U00010400 ,\n") for _ in range(draw.randrange(90))) for _ in range(300)]
    whole = [omh.word_codes(t).tolist() for t in texts]
    monkeypatch.setattr(omh, "BLOCK_CHARS", 16)
    known: dict[str, int] = {}
    for t, codes in zip(texts, whole, strict=True):
        assert omh.word_codes(t).tolist() == codes
        words = omh.words_of(t)
        assert len(words) == len(codes) and all(known.setdefault(w, c) == c for w, c in zip(words, codes, strict=True))
    assert len(set(known.values())) == len(known)


def test_least_places_with_equal_numbers():
    ranks = np.random.default_rng(2).integers(0, 40, (64, 30)).astype(np.uint32)
    expected = np.sort(np.argsort(ranks, axis=1, kind="stable")[:, :5], axis=1)
    assert all((omh._least(r[None], 5)[0] == e).all() for r, e in zip(ranks, expected, strict=True))


def test_near_copies_of_one_text_link_as_all_pairs_do(spark):
    draw = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(60):
        words = list(base)
        for at in draw.sample(range(60), draw.randrange(6)):
            words[at] = f"v{draw.randrange(400)}"
        texts.append((i, " ".join(words)))
    found = {r.doc_id: r.class_id for r in omh.duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    sequences = [omh._labelled(omh.shingles(omh.word_codes(t))) for _, t in texts]
    pairs = [(a, b) for a in range(60) for b in range(a)]
    alike = omh.similarities([(sequences[a], sequences[b]) for a, b in pairs])
    classes = list(range(60))
    for (a, b), s in zip(pairs, alike, strict=True):
        if s >= omh.THRESHOLD - 1e-9 and classes[a] != classes[b]:
            low, high = sorted((classes[a], classes[b]))
            classes = [low if c == high else c for c in classes]
    assert found == dict(enumerate(classes)) and len(set(classes)) > 3
