"""The training-data pipeline: documents to packed sequences, each stage one operator.

A stage takes (spark, docs, sf_dir) and returns what it keeps; each result is written as
Parquet and read back as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvox.llm._shared import materialize
from corvox.llm.exact_dedup import dedup_rows
from corvox.llm.mixing import mix
from corvox.llm.ngram_join import one_of_each
from corvox.llm.packing import pack
from corvox.llm.registry import remainder, table
from corvox.llm.toxicity import toxicity

MIXTURE, BUDGET, LEAST, MOST = {"clean": 0.92, "junk": 0.08}, 1.25, 1.0, 4.0


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. Labels with crc32(id) mod 5 = 0 stay held out."""
    scored = toxicity(docs, table(spark, sf_dir, "labels"), held_out=remainder("doc_id", 5) == 0)
    return scored.where("predicted = 0").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the one with the largest id stays."""
    return dedup_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles (Jaccard 0.8 or more), the one with the smallest id stays."""
    return one_of_each(docs)


def mix_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat until clean and junk tokens stand at the target weights. No rate is
    below one, so this stage loses no document; where junk is over a tenth of the tokens, its
    weight is out of reach of the budget, and the operator logs that."""
    quality = F.when(F.col("quality") == 1, "clean").when(F.col("quality") == 0, "junk")
    return mix(docs, table(spark, sf_dir, "labels"), quality, MIXTURE, budget=BUDGET, low=LEAST, high=MOST)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and offset."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_quality),
    ("packing", pack_sequences),
]

#: Trained models, a tokenizer and iterative fits have no SQL; a test compares each stage over a small table with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
