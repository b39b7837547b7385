"""Corpus pipeline: quality filter, near-duplicates, pseudonyms, mixture, tokens.

``STAGES`` are applied in order to the documents table. A stage reads what its predecessor wrote as Parquet into the session's
shared folder, works on all of it, and returns the columns of documents; the last one returns the tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kalends.llm import mixture, pieces, pseudonyms, quality, queries, simhash
from kalends.llm.common import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the classifier does not reject; it learns from the labels beside the documents."""
    labels = queries.table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels)
    return quality.score(docs, model, others=COLUMNS[1:]).where("predicted = 1").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of texts linked by a Jaccard similarity of 0.8 or more of their five-word shingles.

    256-bit SimHash prints find the pairs to check. At 0.8 they differ in 39 bits on average with a deviation of 6, in 48 where a
    text has only four or five shingles; ``limit`` is over four deviations above either, and so is 26 for the first 64 bits, which the
    trees search. The one with the smallest id stays; of rows that repeat it, one; of a group without ids, one.
    """
    return simhash.representatives(docs, shingle=5, radius=26, sketch=4, wide=3, limit=76, least=0.8, most=1024, others=COLUMNS[1:]).select(*COLUMNS)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data and secrets by keyed pseudonyms of the same format."""
    out = pseudonyms.pseudonymise(docs, queries.PUBLIC_KEY, others=("lang", "source"))
    return out.select("doc_id", "text", "lang", "source", F.char_length("text").cast("long").alias("n_chars"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take every source to its target weight: whole documents repeat or stay away as the mix has it."""
    planned = mixture.plan(docs, others=("text", "lang", "source"))
    out = mixture.copies(planned, whole=True)
    return out.select("doc_id", "text", "lang", "source", F.char_length("text").cast("long").alias("n_chars"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, little-endian unsigned 32-bit, and digests of them and of the text that they decode to."""
    coded = pieces.encode_decode(docs, queries.model_path())
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_classifier", quality_filter),
    ("simhash_near_dedup", near_duplicates),
    ("pseudonyms", private_data),
    ("source_mixture", mixing),
    ("sentencepiece", tokens),
]

#: SQL has no counterpart of the trained classifier, the fingerprints or the permutations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what each returns is written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
