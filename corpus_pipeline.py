"""A training corpus from raw documents, in five stages.

Each stage takes the documents that its predecessor kept and returns the
columns of documents, whatever their names; the last returns the pieces of
packed sequences.  Stages read nothing else but the table ``labels``.  An empty
table goes through all of them and stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import exact_dedup, mixing, packing, simhash, toxicity
from cohortlens.llm.common import col, free_name, ship, written
from cohortlens.llm.tokens import public_vocabulary

#: Documents with a score of this or more are rejected.
TOXIC = 0.5
SHINGLE_WORDS, MAX_BITS = 3, 3
END_ID = 2
#: Words that a tokenizing task remembers: little, since workers serve all the stages.
REMEMBERED_WORDS = 100_000


def keep_ordinary(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the models, trained on the labelled ones outside the held-out fold, don't reject.

    Null and empty texts stay, and rows that repeat are scored alike; long
    texts are scored whole.
    """
    labels = ship(spark).read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels)
    name = free_name("_score", docs)
    return toxicity.score(docs, model, name=name).where(F.col(name) < TOXIC).select(*[col(c) for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest original, then the smallest id (null last).

    Null, empty and white-space texts are one group.
    """
    ship(spark)
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: that of the smallest id (null last).

    Texts without words, null ones too, have fingerprint zero; of rows that are
    equal in all columns one stays.
    """
    ship(spark)
    return simhash.representatives(docs, width=SHINGLE_WORDS, max_bits=MAX_BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each copy of a document, or of the part of it, that the targets take.

    Documents without words are not taken; null is a source of its own.
    """
    ship(spark)
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are their end id alone; rows that repeat are packed
    each; long texts become pieces.
    """
    ship(spark)
    return packing.pack(packing.tokenize(docs, public_vocabulary(), end=END_ID, remembered=REMEMBERED_WORDS))


STAGES = [
    ("toxicity", keep_ordinary),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Models, fingerprints and token ids aren't SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents``; each stage's result is written before the next reads it."""
    docs = ship(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
