"""A training corpus from ``documents``: five stages, each over all that the one before kept."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnout.llm.decontaminate import contamination
from turnout.llm.jaccard_join import one_of_each
from turnout.llm.line_dedup import dedup_lines
from turnout.llm.packing import pack_pieces, token_pieces
from turnout.llm.quality import fit_quality, score_quality
from turnout.llm.queries import WORD_VOCABULARY
from turnout.llm.tables import ROW, row_numbers, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    weights = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, weights).filter("predicted = 1").select("doc.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less the later occurrences of passages of three lines."""
    columns = docs.columns
    left = dedup_lines(docs).select("doc.*")
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return left.withColumn("n_chars", length).select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than traces of benchmark items."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.filter("not contaminated").select("doc.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents, their ``ids`` and their places in sequences.

    Pieces are packed by their lengths alone; the ids are joined back by the number of the piece.
    """
    pieces = stored(token_pieces(docs, WORD_VOCABULARY, keep_ids=True), "pieces")
    light = [F.col(name) for name in pieces.columns if name != "ids"]
    packed = pack_pieces(row_numbers(pieces, *light))
    return packed.join(row_numbers(pieces, F.col("ids")), ROW).drop(ROW)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

#: SQL cannot express the classifier, the tokenizer and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
