"""From documents to packed training sequences: five stages, each written and read again."""

from pyspark.sql import DataFrame, SparkSession

from skyloom.llm import mixing, neardup, packing, quality, templates
from skyloom.llm.common import written
from skyloom.llm.suite import TOKENIZER
from skyloom.tables import table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from ``labels``, does not reject."""
    return quality.good_rows(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines whose template recurs across them."""
    return templates.cleaned(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, 0.8 or more in common."""
    return neardup.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights, as many words in all as came in; a source may be read twice."""
    return mixing.mixed_rows(docs, share=1.0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 4096."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality classifier", classify),
    ("line dedup", drop_lines),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

ORACLE_SQL = None  # the classifier and the tokenizer are no SQL; tests hold the stages against plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = written(docs, f"stage-{place}")
    return docs
