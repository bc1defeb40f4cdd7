"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

Every stage works on all rows that its predecessor kept, and all but the last return the columns of ``documents``:

* language: rows without words or without a prevailing language go; a missing ``lang`` is filled in;
* near duplicates: one document of each class stays;
* decontamination: documents that contain a benchmark item go;
* personal data: values are replaced by pseudonyms, ``n_chars`` follows the new text;
* tokens: ``token_ids`` and digests are added, and ``text`` is what the tokens decode to.

Rows with a null text have no language and go in the first stage, as do empty texts; extra columns are carried along.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfacts.llm import bpe, crf, decontam, omh, pii
from clickfacts.llm.common import shared_dir, ship, table, tidy

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: A deployment passes its own secret to ``pii.pseudonymise``.
PSEUDONYM_KEY = "corpus"
#: Share of a text's words in its main language below which no language prevails.
LEAST_SHARE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    field = crf.fit(docs)
    named = crf.label(docs, field)
    kept = named.where((F.col("lang_pred") != crf.UNKNOWN) & (F.col("score") >= LEAST_SHARE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return omh.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tidy(spark)
    found = decontam.leaks(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    clean = pii.pseudonymise(docs, PSEUDONYM_KEY, spans=False)
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    coded = bpe.round_trip(docs, BYTE_BPE)
    ids = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return coded.select(
        *[F.col("decoded").cast("string").alias("text") if c == "text" else F.col(c) for c in docs.columns],
        F.size("token_ids").cast("long").alias("n_tokens"),
        "token_ids",
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language ID", language),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("byte-level BPE", tokens),
]
#: No SQL counterpart: the classifier, the sketches and the permutations have none. Tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared folder and read by the next."""
    docs = table(tidy(spark), sf_dir, "documents")
    folder = f"{shared_dir(spark)}/clickfacts-llm/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
