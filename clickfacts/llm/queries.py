"""Registered queries of the operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfacts.llm import backoff, bpe, caps, crf, decontam, fairmix, kdtree, nbsvm, omh, pii, rmqsearch, shards, spillalign
from clickfacts.llm.common import ship, table

Runner = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Runner] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: For tests and checks; a deployment passes its own secret to ``pii.pseudonymise``.
PSEUDONYM_KEY = "check"
QUALITY_THRESHOLD = 0.3
#: The id the byte-level vocabulary leaves free, and the key of the training order.
END_OF_TEXT, ORDER_KEY = 50256, "epoch-1"


def query(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a query under ``name``; without ``sql`` it is tested against a brute-force version instead."""

    def register(run: Runner) -> Runner:
        QUERIES[name] = lambda spark, sf_dir: run(ship(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run

    return register


@query("op9_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and what they decode to, as digests."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return bpe.round_trip(documents, BYTE_BPE).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op8_kdtree_shards")
def kdtree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in forty shards of nearly equal bytes."""
    return kdtree.shard_documents(table(spark, sf_dir, "documents"), shards=40)


@query("op5_pseudonyms")
def pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by pseudonyms of the same format."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(documents, PSEUDONYM_KEY).withColumn("n_found", F.size("pii_spans").cast("long"))


def _remainder(n: int) -> Column:
    """CRC-32 of the id as text, modulo ``n``: the folds of the classifiers."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


@query("op1_crf_language")
def crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; every fourth one is held out from learning."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (_remainder(4) == 2).alias("held_out"))
    field = crf.fit(documents.where(~F.col("held_out")))
    return crf.label(documents.drop("lang"), field, spans=True, keep_text=False)


@query("op7_nb_svm_quality")
def nb_svm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; every fifth one is held out from learning."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", (_remainder(5) == 0).alias("held_out"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = nbsvm.fit(documents.where(~F.col("held_out")).join(labels, "doc_id"))
    scored = nbsvm.score(documents, model, keep_text=False)
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_THRESHOLD).cast("int"))


@query("op2_order_minhash")
def order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document; one document of each class is kept."""
    return omh.duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(
    "op10_simhash_windows",
    """
    WITH d AS (
      SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS ws
      FROM documents
    ),
    b AS (
      SELECT item_id, ws, len(ws) AS n, least(len(ws), 5) AS k FROM (
        SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS ws
        FROM benchmark
      ) WHERE len(ws) > 0
    ),
    anchors AS (
      SELECT item_id, n, k, o, array_to_string(ws[o + 1 : o + k], ' ') AS s
      FROM (SELECT *, unnest(range(0, n - k + 1)) AS o FROM b)
    ),
    places AS (
      SELECT doc_id, n_words, k, p, array_to_string(ws[p + 1 : p + k], ' ') AS s
      FROM (SELECT doc_id, ws, len(ws) AS n_words, k, unnest(range(0, len(ws) - k + 1)) AS p
            FROM d, (SELECT DISTINCT k FROM b) WHERE len(ws) >= k)
    ),
    windows AS (
      SELECT DISTINCT doc_id, k, greatest(p - o, 0) AS b0, least(p - o + n, n_words) - greatest(p - o, 0) AS n_words
      FROM places JOIN anchors USING (k, s)
    ),
    held AS (
      SELECT w.doc_id, w.k, w.b0, w.n_words, places.s, count(*) AS c
      FROM windows w JOIN places ON places.doc_id = w.doc_id AND places.k = w.k
           AND p >= b0 AND p + w.k <= b0 + w.n_words
      GROUP BY ALL
    ),
    asked AS (SELECT item_id, n, k, s, count(*) AS c FROM anchors GROUP BY ALL),
    shared AS (
      SELECT doc_id, b0, n_words, item_id, n, k, sum(least(held.c, asked.c)) AS hits
      FROM held JOIN asked USING (k, s) GROUP BY ALL
    ),
    rated AS (
      SELECT *, hits / (n_words - k + 1 + n - k + 1 - hits) AS similarity FROM shared
    )
    SELECT doc_id, item_id, b0::INT AS begin, n_words::INT AS n_words, round(similarity, 6) AS similarity
    FROM rated WHERE similarity >= 0.8
    QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, b0, n_words DESC) = 1
    """,
)
def simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain an item of the benchmark, and where."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.leaks(documents, table(spark, sf_dir, "benchmark"))


@query(
    "op6_cap_filters",
    """
    WITH RECURSIVE v AS (
      SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ),
    links AS (
      SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.93 ELSE false END
    ),
    reached AS (
      SELECT a AS vec_id, b AS other FROM links
      UNION
      SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other
    ),
    counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a),
    lowest AS (SELECT vec_id, min(other) AS low FROM reached GROUP BY vec_id)
    SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
           low IS NULL OR low >= vec_id AS kept
    FROM embeddings LEFT JOIN counted USING (vec_id) LEFT JOIN lowest USING (vec_id)
    """,
)
def cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of near-equal vectors of a label."""
    return caps.duplicates(table(spark, sf_dir, "embeddings"))


@query(
    "op3_stupid_backoff",
    """
    WITH w AS (
      SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS ws
      FROM documents
    ),
    p AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
    g AS (
      SELECT doc_id, i, ws[i] AS w1,
             CASE WHEN i > 1 THEN ws[i - 1] || ' ' || ws[i] END AS w2,
             CASE WHEN i > 2 THEN ws[i - 2] || ' ' || ws[i - 1] || ' ' || ws[i] END AS w3,
             CASE WHEN i > 1 THEN ws[i - 1] END AS c1,
             CASE WHEN i > 2 THEN ws[i - 2] || ' ' || ws[i - 1] END AS c2
      FROM p
    ),
    n AS (SELECT count(*) AS n FROM g),
    n1 AS (SELECT w1 AS k, count(*) AS c FROM g GROUP BY 1),
    n2 AS (SELECT w2 AS k, count(*) AS c FROM g WHERE w2 IS NOT NULL GROUP BY 1),
    n3 AS (SELECT w3 AS k, count(*) AS c FROM g WHERE w3 IS NOT NULL GROUP BY 1),
    s AS (
      SELECT g.doc_id, count(*) AS n_words,
             sum(CASE WHEN a3.c >= 2 THEN ln(a3.c / b2.c)
                      WHEN a2.c >= 2 THEN ln(a2.c / b1.c) + CASE WHEN g.w3 IS NOT NULL THEN ln(0.4) ELSE 0 END
                      ELSE ln(a1.c / n.n) + CASE WHEN g.w3 IS NOT NULL THEN 2 * ln(0.4)
                                                 WHEN g.w2 IS NOT NULL THEN ln(0.4) ELSE 0 END END) AS total
      FROM g CROSS JOIN n JOIN n1 a1 ON a1.k = g.w1
      LEFT JOIN n2 a2 ON a2.k = g.w2 LEFT JOIN n3 a3 ON a3.k = g.w3
      LEFT JOIN n1 b1 ON b1.k = g.c1 LEFT JOIN n2 b2 ON b2.k = g.c2
      GROUP BY 1
    )
    SELECT d.doc_id, coalesce(s.n_words, 0)::BIGINT AS n_words, round(s.total / s.n_words, 6) AS score
    FROM documents d LEFT JOIN s USING (doc_id)
    """,
)
def stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean log score of every document under the n-gram counts of all documents."""
    return backoff.score(table(spark, sf_dir, "documents"))


@query("op4_training_order")
def training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token sequence of the documents, read back from the shards it was written to."""
    path = shards.fresh_path(spark)
    shards.materialise(table(spark, sf_dir, "documents"), path, BYTE_BPE, END_OF_TEXT, ORDER_KEY)
    return shards.read(spark, path).select(
        F.col("id").alias("doc_id"),
        F.col("number").alias("sequence"),
        "n_tokens",
        "slot",
        "shard",
        F.col("begin").alias("byte_begin"),
        F.sha2("record", 256).alias("record_sha256"),
    )


@query(
    "op13_fair_mix",
    """
    WITH d AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
             md5(concat_ws('|', 'mix', doc_id::VARCHAR, md5(coalesce(text, '')))) AS o
      FROM documents
    ),
    s AS (
      SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
      FROM d GROUP BY source
    ),
    w AS (SELECT *, ([3, 1, 2])[(rank - 1) % 3 + 1] AS weight, 2 * source_size AS most FROM s),
    l AS (
      SELECT (SELECT 1.5::DOUBLE * sum(source_size) FROM w) - coalesce(sum(most) OVER before, 0) AS rest,
             (SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER before, 0) AS weights
      FROM w WINDOW before AS (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ),
    t AS (
      SELECT *, least(most::DOUBLE, weight * (SELECT max(rest / weights) FROM l)) AS target FROM w
    ),
    q AS (
      SELECT d.*, t.source_size, t.target, t.rank,
             sum(size) OVER (PARTITION BY t.rank ORDER BY o, doc_id, size ROWS UNBOUNDED PRECEDING) AS given,
             row_number() OVER (ORDER BY t.rank, o, doc_id, size) AS r
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    ),
    e AS (
      SELECT r, size, epoch, (given + epoch * source_size)::DOUBLE / target AS finish, rank
      FROM q, (VALUES (0), (1)) AS x(epoch) WHERE size > 0
    ),
    m AS (
      SELECT r, greatest(0, least(size, (SELECT sum(size) * 3 // 2 FROM d) - (sum(size) OVER served - size))) AS taken
      FROM e WINDOW served AS (ORDER BY finish, rank, epoch, r ROWS UNBOUNDED PRECEDING)
    )
    SELECT doc_id, size, source_size, target, coalesce(m.taken, 0)::BIGINT AS taken
    FROM q LEFT JOIN (SELECT r, sum(taken) AS taken FROM m GROUP BY r) m USING (r)
    """,
)
def fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document; sources come near their targets."""
    return fairmix.shares(table(spark, sf_dir, "documents"))


@query(
    "op11_rmq_search",
    """
    WITH t AS (
      SELECT doc_id, row_number() OVER () AS d, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
      FROM documents
    ),
    p AS (SELECT doc_id, d, term, count(*) AS tf FROM t GROUP BY ALL),
    n AS (SELECT d, sum(tf)::BIGINT AS n FROM p GROUP BY d),
    c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
    w AS (
      SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, c GROUP BY term, docs
    ),
    i AS (
      SELECT DISTINCT item_id, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
      FROM benchmark
    ),
    s AS (
      SELECT item_id, doc_id, d,
             sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
      FROM i JOIN p USING (term) JOIN w USING (term) JOIN n USING (d), c
      GROUP BY ALL
    )
    SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
    FROM s WHERE score > 0
    QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
    """,
)
def rmq_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every item of the benchmark."""
    return rmqsearch.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_token_alignment")
def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned by bytes, and how common the pairs of every document are in the corpus."""
    documents = table(spark, sf_dir, "documents")
    return spillalign.align(documents, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
