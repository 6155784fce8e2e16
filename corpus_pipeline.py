"""The corpus pipeline: quality rules, line dedup, near-dedup, source mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written and
read again as the next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.llm import byte_bpe, line_dedup, minhash, mixing, quality
from martline.llm.queries import PATTERN, RANKS
from martline.sources.staging import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the default policy."""
    return quality.ledger(docs, into="quality ledger").where(~quality.rejected(quality.DEFAULT, into="quality ledger")).select(*docs.columns)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that their source repeats; ``n_chars`` follows the text."""
    cleaned = line_dedup.drop_lines(docs, host="source")
    return cleaned.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id."""
    return minhash.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a row per draw, shard after shard."""
    return mixing.mixture(docs, mixing.plan(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every drawn document, with the check that they decode to its bytes."""
    tokens = byte_bpe.encode(docs, RANKS, PATTERN, checked="round_trip")
    return tokens.select("doc_id", "source", "lang", (F.octet_length("tokens") / 4).cast("long").alias("n_tokens"), "tokens", "round_trip")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", drop_boilerplate),
    ("near-dedup", near_dedup),
    ("source mixing", mix_sources),
    ("byte-level BPE", encode),
]

#: Sketches, hash draws and merges of a rank file are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
