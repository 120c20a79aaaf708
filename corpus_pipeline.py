"""A corpus pipeline of five operators, each stage applied to all that the stage before has kept.

toxicity -> SimHash near-dedup -> substring dedup -> mixing sources -> packing

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to the shared folder and reads it
again as the next stage's documents, so a lost executor costs tasks of one stage. All stages but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import mixing, packing, simhash, substrings, toxicity
from tidemart.llm.common import stored
from tidemart.llm.queries import tokenizer_path
from tidemart.session import load


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. It learns from the labels outside the held-out fifth."""
    return toxicity.keep_clean(docs, toxicity.train(docs, load(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints of 4-word shingles within 4 bits one stays, the one with the smallest doc_id."""
    return simhash.keep_first(docs, simhash.SHINGLE, simhash.RADIUS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words covered by a 35-word window that also starts elsewhere go."""
    return substrings.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with the words that the mix takes of it."""
    return mixing.mix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed token sequences."""
    return packing.packed(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("substrings", drop_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

# Trained models, tokenizers and pseudorandom permutations have no SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
