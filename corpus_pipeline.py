"""Corpus pipeline: documents through five of the operators, stage by stage.

Each stage gets what its predecessor kept, as Parquet in the shared folder, and
learns its models and statistics from that input alone (the benchmark is a table of its
own).  All but the last return the columns of ``documents``.

1. ``language_id``: documents that no trained language explains, or none surely, go.
2. ``near_duplicates``: of each group of near copies the document with the least doc_id stays.
3. ``decontamination``: documents that hold a benchmark passage go.
4. ``personal_data``: personal data is replaced by its kind; no document goes.
5. ``tokens``: every text as SentencePiece ids, and whether they decode to it.

Null texts pass stages 2 to 5 as texts without words; stage 1 judges every row by its own text, whatever its doc_id.  Empty
tables pass as empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from saltkv.llm import decontam, langid, ngram_join, pii, spm
from saltkv.llm.common import ship_package, table, written
from saltkv.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return langid.keep_identified(docs, langid.train_text_model(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return ngram_join.keep_first_of_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return pii.redact_documents(docs, pii.train_pii(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_crc32, decoded_chars, round_trip`` and the ids."""
    ship_package(spark)
    return spm.op5_sentencepiece(spark, docs, tokenizer_path("piece_bpe_32k.model"), with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: Language models, boosted trees and tokenizers have no SQL form; tests hold the
#: stages against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
