"""From raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from surveylake.llm.common import save
from surveylake.llm.decontamination import decontaminated
from surveylake.llm.lines import cut_documents
from surveylake.llm.packing import pack, token_pieces
from surveylake.llm.quality import quality_filter
from surveylake.llm.queries import table, tokenizer_file
from surveylake.llm.simhash import one_of_each

#: Words in a shingle of the near-duplicate stage.
SHINGLE = 5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and all certified cutoffs of their language."""
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeats of runs of lines; one that had nothing else goes. Others keep their text as it is."""
    return cut_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates."""
    return one_of_each(docs, SHINGLE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and places."""
    return pack(token_pieces(docs, tokenizer_file()))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL cannot express the learned and iterative stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir))
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
