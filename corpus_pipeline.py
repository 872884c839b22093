"""A text collection from raw documents to token files, in five stages.

``STAGES`` are (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's documents. All but the last return the columns of ``documents``.

1. ``language_id``: documents without a letter go, and those of any length
   that are no more like a learned language than chance.
2. ``ngram_jaccard_join``: of each class of near duplicates the document with
   the least id stays.
3. ``benchmark_decontamination``: documents that contain a benchmark item go.
4. ``mixing``: the sources are brought to their target weights; a document
   that is taken several times is as many rows.
5. ``token_files``: token ids in files; one row per document read back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, langid, mixing, ngramjoin, tokenfile
from tessera.llm.common import read_table, written
from tessera.llm.queries import END_ID, TOKENIZER


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    columns = [F.col(f"`{c}`") for c in docs.columns]
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))), dim=langid.LIKE_DIM)
    judged = docs.select(F.struct(*columns).alias("row"), langid.alike(model, "text").alias("alike"))
    return judged.where("alike").select("row.*")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngramjoin.one_of_each_class(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = tokenfile.write_tokens(docs, public_tokenizers.path(TOKENIZER), end_id=END_ID)
    return tokenfile.read_tokens(spark, path, with_ids=False)


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing", mixing_sources),
    ("token_files", token_files),
]

# The learned profiles and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
