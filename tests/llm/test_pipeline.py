"""The pipeline: order, columns, decisions, and awkward rows."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickfacts.llm import crf, decontam, omh, pii
from clickfacts.llm.common import ship

SMALL = "/root/testdata/sf0.001"


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "MinHash near-dedup", "benchmark decontamination", "PII", "byte-level BPE",
    ]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    """Documents with every odd case, a benchmark, and the folder of both."""
    draw = random.Random(9)
    word = lambda a: "".join(draw.choices(a, k=draw.randint(2, 7)))
    text = lambda n, a="abcdefg": " ".join(word(a) for _ in range(n))
    item = text(30, "abc")
    base = text(200)
    rows = [(i, text(60), "aa", "s", 1) for i in range(40)] + [(100 + i, text(60, "tuvwxyz"), "bb", "s", 1) for i in range(40)]
    rows += [(200, base, "aa", "s", 1), (201, base, "aa", "s", 1), (202, base.upper(), None, "s", 1), (203, base + " end", "aa", "s", 1)]
    rows += [(300, f"{text(20)} {item} {text(20)}", "aa", "s", 1), (301, f"{text(20)} mail a.b@c.org or 10.20.30.40", "aa", None, None)]
    rows += [(400, None, "aa", "s", 0), (401, "", "aa", "s", 0), (402, "12 34 !?", None, "s", 9), (None, text(50), "aa", "s", 1), rows[0]]
    rows += [(403, text(9000), None, "s", 1)]
    folder = str(tmp_path_factory.mktemp("docs"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.coalesce(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def test_run(spark, awkward):
    folder, rows = awkward
    got = corpus_pipeline.run(spark, folder).collect()
    ids = [r.doc_id for r in got]
    # One copy of a repeated row and of each class stays; rows without a key stay.
    assert sorted(i for i in ids if i is not None) == sorted([*range(40), *range(100, 140), 200, 301, 403])
    assert ids.count(None) == 1
    by = {r.doc_id: r for r in got}
    texts = {i: t for i, t, *_ in rows}
    assert by[5].text == texts[5] and by[403].lang == "aa"
    assert "a.b@c.org" not in by[301].text and "10.20.30.40" not in by[301].text and by[301].n_chars == len(by[301].text)
    assert all(r.n_tokens == len(r.token_ids) > 0 for r in got)


def test_stages_equal_brute_force(spark):
    """Every stage's decisions against the operator's own rules, row by row."""
    ship(spark)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    field = crf.fit(docs)
    labeller = crf.Labeller(field)
    want = set()
    for i, r in rows.items():
        words = crf.words_of(r.text or "")
        if words and labeller.chances([words])[0].mean(0).max() >= corpus_pipeline.LEAST_SHARE:
            want.add(i)
    named = corpus_pipeline.language(spark, docs, SMALL)
    assert named.columns == docs.columns and {r.doc_id for r in named.collect()} == want
    kept = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    classes = {r.doc_id: r.class_id for r in omh.duplicates(docs).collect()}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(classes.values())
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    leaked = {r.doc_id for r in decontam.leaks(docs, bench).collect()}
    clean = corpus_pipeline.decontamination(spark, docs, SMALL)
    assert leaked and clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == set(rows) - leaked
    names = pii.Pseudonyms(corpus_pipeline.PSEUDONYM_KEY)
    fresh = corpus_pipeline.personal_data(spark, docs, SMALL)
    assert fresh.columns == docs.columns
    assert {r.doc_id: r.text for r in fresh.collect()} == {i: names.replace(r.text)[0] for i, r in rows.items()}


def test_empty(spark, awkward):
    folder, _ = awkward
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0).withColumn("score", F.lit("clash"))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


def test_no_shuffle_file_outlives_its_action(spark, awkward, tmp_path):
    """Each stage leaves none of its shuffle files on the local disks, without the driver collecting garbage."""
    folder, _ = awkward
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def kept():
        found = set()
        for top in disk.localDirsString():
            for _, _, names in os.walk(top):
                found |= {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}
        return found

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, until = kept(), time.monotonic() + 10
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{number}")
        while kept() - before and time.monotonic() < until:
            time.sleep(0.1)
        assert not kept() - before
        docs = spark.read.parquet(f"{tmp_path}/{number}")
