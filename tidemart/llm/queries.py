"""The operators applied to the whole provided tables, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import conversations, fingerprints, mixing, neighbours, packing, quality, sharding, simhash, substrings, toxicity, urls, variants, warc
from tidemart.llm.common import documents
from tidemart.llm.statements import SQL
from tidemart.session import load, scratch_path

SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, folder))
    return found.select("doc_id", simhash.hexed(F.col("fp")).alias("fingerprint"), "component_id")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(documents(spark, folder), tokenizer_path())


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, folder))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sizes(documents(spark, folder))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    done = quality.assess(documents(spark, folder).select("doc_id", "text"))
    return done.select("doc_id", "votes", "label_posterior", "quality_score", "keep")


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    model = toxicity.train(docs, load(spark, folder, "labels"))
    done = toxicity.score(docs, model)
    return done.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = load(spark, folder, "pages").select("page_id", "url")
    return urls.judge(pages).select("page_id", "host", "path", "rule", "verdict", "block_score")


def op8_substrings(spark: SparkSession, folder: str) -> DataFrame:
    done = substrings.remove_repeats(documents(spark, folder).select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    rows = load(spark, folder, "embeddings")
    return neighbours.nearest(rows, rows.where(F.col("vec_id") % 50 == 0))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's slot and shard, and its shard should the last shard be taken away."""
    placed = sharding.place(documents(spark, folder), ["doc_id"], SHARDS, without=SHARDS[-1:])
    return placed.select("doc_id", "slot", "shard", "shard_without")


def op11_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair_damaged(load(spark, folder, "conversations"))


def op12_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.variants(variants.vocabulary(documents(spark, folder)))


def op13_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to archives in the shared folder and read back from them."""
    archives = scratch_path(spark, "warc")
    warc.write(load(spark, folder, "pages"), archives)
    found = warc.resolve(warc.read_records(spark, archives))
    ids = [F.col(c).cast("long").alias(c) for c in ("page_id", "refers_to")]
    return found.select(ids[0], "payload_bytes", "payload_digest", "record_type", ids[1])


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_packing": op2_packing,
    "op3_fingerprints": op3_fingerprints,
    "op4_mixing": op4_mixing,
    "op5_quality": op5_quality,
    "op6_toxicity": op6_toxicity,
    "op7_url_filter": op7_url_filter,
    "op8_substrings": op8_substrings,
    "op9_neighbours": op9_neighbours,
    "op10_sharding": op10_sharding,
    "op11_conversations": op11_conversations,
    "op12_variants": op12_variants,
    "op13_warc": op13_warc,
    "pipeline": pipeline,
}

__all__ = ["QUERIES", "SQL"]
