"""The corpus pipeline: documents in, packed training sequences out.

Each stage works on all documents that the one before it kept; ``run`` writes every
stage's rows to the shared folder and reads them back, so a lost executor costs one stage.
All stages but the last return the columns of documents.
"""

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import mixing, neardup, packing, substrings, toxicity
from orderloom.llm.common import Scratch, from_parquet
from orderloom.llm.queries import tokenizer_file


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    return toxicity.without_toxic(docs, from_parquet(spark, sf_dir, "labels"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the least doc_id."""
    return neardup.one_of_each(docs)


def remove_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document holds."""
    return substrings.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix; one that is read twice is there twice."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts with their sequence and place in it."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("toxicity", remove_toxic),
    ("near duplicates", remove_near_duplicates),
    ("substring dedup", remove_repeated_spans),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Classifier, components and tokenizer have no SQL form; tests hold a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = from_parquet(spark, sf_dir, "documents"), []
    scratch = Scratch(docs, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        scratch.drop(*before)
        before = [name.replace(" ", "-")]
    return STAGES[-1][1](spark, docs, sf_dir)
