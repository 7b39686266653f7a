"""The corpus queries as registered, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm import (
    exact_dedup,
    hard_negatives,
    lexical_search,
    licenses,
    packing,
    pieces,
    pii,
    quality_knn,
    secret_scan,
    simhash,
    spherical,
    suffix_dedup,
    toxicity,
)
from tablesync.llm.common import benchmark, documents, embeddings, labels
from tablesync.session import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir))


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(documents(spark, sf_dir))


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.report(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_duplicates(documents(spark, sf_dir), Scratch(spark), keep="largest")
    return rows.withColumnRenamed("id", "doc_id")


ORACLES["op7_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                               'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
WINDOW g AS (PARTITION BY norm)
"""


@query
def op2_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_knn.report(documents(spark, sf_dir), labels(spark, sf_dir))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(documents(spark, sf_dir), Scratch(spark))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(documents(spark, sf_dir), labels(spark, sf_dir))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.packed(documents(spark, sf_dir), Scratch(spark), vocabulary, keep_ids=False)


@query
def op9_spherical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spherical.similar_vectors(embeddings(spark, sf_dir), Scratch(spark))


def file_tree(docs: DataFrame) -> DataFrame:
    """Documents as files: source/language/number.txt, some of them as licence files.

    Numbers that end in 50 are the licence file of their language's directory, those that
    end in 00 of their source's. Every document is one file, with its whole text.
    """
    ending = F.pmod("doc_id", F.lit(100))
    name = F.when(ending.isin(0, 50), F.concat(F.lit("LICENSE-"), "doc_id")).otherwise(
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    )
    place = F.when(ending == 0, F.col("source")).otherwise(F.concat_ws("/", "source", "lang"))
    return docs.select("doc_id", F.concat_ws("/", place, name).alias("path"), "text")


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(file_tree(documents(spark, sf_dir)), Scratch(spark))


@query
def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(documents(spark, sf_dir), Scratch(spark)).drop("kept")


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(documents(spark, sf_dir), benchmark(spark, sf_dir), Scratch(spark))


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLES["op13_lexical_search"] = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
     whole AS (SELECT count(*) AS n_docs, sum(len(terms)) AS n_terms FROM doc WHERE len(terms) > 0),
     item AS (SELECT item_id, t, count(*) AS times FROM
                (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY ALL),
     held AS (SELECT r, doc_id, n, t, count(*) AS tf FROM
                (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS t FROM doc)
              WHERE t IN (SELECT t FROM item) GROUP BY ALL),
     weight AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
                FROM held, whole GROUP BY t, n_docs),
     score AS (SELECT item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf)
                 // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
               FROM item JOIN weight USING (t) JOIN held USING (t), whole GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM score WHERE score > 0) WHERE rank <= 20
"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings(spark, sf_dir).withColumn("label", shifted)
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0, Scratch(spark))


ORACLES["op12_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                  CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
           FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
     p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM (SELECT anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
             row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
      FROM p JOIN s USING (anchor_id)
      WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
WHERE rank <= 5
"""
