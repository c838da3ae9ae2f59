"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept and returns a frame that is written as Parquet and read back as the next
stage's ``docs``.  All but the last return the columns of ``documents``.

1. quality rules: rejected documents go;
2. SimHash near-dedup: of each group of near copies the document of least id
   stays (of equal ids, one of them);
3. PII: spans are replaced by their kind in brackets;
4. mixing: rows are dropped or repeated to fit the domain targets;
5. packing: pieces of sequences of at most 4096 tokens.

Null, empty and very long texts, repeated rows and extra columns are handled
as the operators say; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from silverline.llm import mixing, packing, pii, quality, simhash
from silverline.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, size=4, distance=4)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("PII", private_data),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: Tokenisers, fingerprints and learned models are not SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each stored in the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{at}")
    return docs
