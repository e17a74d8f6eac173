"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's rows as Parquet into the shared checkpoint folder and reads them back as the next
one's documents.  All but the last return the columns of documents.

1. quality rules: rejected documents go;
2. MinHash near-duplicates (five words, similarity 0.8): one document of a group stays;
3. secret scans: secrets are replaced in the text, n_chars follows;
4. mixing: each document appears as often as its source's target takes it (0 to 3 times);
5. SentencePiece: token ids of every document, with their decoded text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolift.llm import mixing, neardup, pieces, quality, secrets
from promolift.llm.common import keep, read


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_duplicates(docs, width=5, percent=80)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), passed=("doc_id", "lang", "source"))
    return coded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), "decoded")


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("secret scans", hide_secrets),
    ("source mixing", mix_sources),
    ("sentencepiece", tokenize),
]

#: Near duplicates, the knapsack and the tokenizer have no SQL; tests hold the stages
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
