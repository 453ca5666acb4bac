"""Stages that turn raw documents into encoded training data, each on what the one before kept.

Every stage works on the rows it is given and on nothing else of ``documents``; models are
learned from them (and from ``labels``).  The driver of the pipeline writes each result as
Parquet and hands what it reads back to the next stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormgauge.llm import bpe, jaccard, langid, mixing, toxicity
from stormgauge.llm.common import fold, staged, table

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents with a score below one half stay."""
    usable = fold("doc_id") != 0
    languages = langid.fit_language_model(docs, usable)
    model = toxicity.fit_toxicity_model(docs, table(spark, sf_dir, "labels"), usable, languages)
    return docs.where(toxicity.rate(model, languages, docs) < 0.5)


def drop_undetermined(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents whose language is determined with enough certainty stay."""
    model = langid.fit_language_model(docs, fold("doc_id") != 0)
    return docs.where(langid.identify(model, docs)["accepted"])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: one document of each group of near duplicates stays."""
    return jaccard.one_per_component(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: a sample with raked shares of sources, languages and topics."""
    return mixing.mixed(docs).where("kept").select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: ids of every kept text, ready to be written out for training."""
    made = bpe.encoded(docs.select("doc_id", "source", "lang", "text"), WORD_VOCABULARY)
    return made.select("doc_id", "source", "lang", F.size("ids").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_undetermined),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# toxicity and language are trained models, and the encoding needs a vocabulary file
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage is written as Parquet and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
