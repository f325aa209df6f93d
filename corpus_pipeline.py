"""The corpus pipeline: documents in, packed token pieces out.

Each stage works on all that the one before kept; ``run`` writes every result as
Parquet to the shared folder and reads it again. Stages but the last return the columns
of their input; ``n_chars`` follows the text. A stage's documents are read from files as
they lie there, so it finds its rows again without writing their texts once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sellerbooks.llm import lines, mixing, packing, quality, simhash
from sellerbooks.llm.common import read_table, ship_package
from sellerbooks.session import materialise


def _as_documents(changed: DataFrame, docs: DataFrame) -> DataFrame:
    count = F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return changed.select(*[count.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier rejects."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop repeats of lines that stand on many sites; every document stays."""
    return _as_documents(lines.dedup_lines(docs, in_files=True), docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    ship_package(spark)
    return simhash.one_of_each_group(docs, in_files=True)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mix the sources to their target weights; a document may come more than once, or in part."""
    ship_package(spark)
    return _as_documents(mixing.mixed_documents(docs, in_files=True), docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in the packed sequences."""
    ship_package(spark)
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("mixing sources to target weights", source_mixing),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs


#: The classifier, SimHash, the random mix and the packing have no SQL; tests compare them with brute force.
ORACLE_SQL = None
