"""From raw documents to packed training sequences, a stage at a time.

Each stage gets what its predecessor kept, as a table written in the shared folder, so a
lost executor costs part of one stage. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import line_dedup, packing, quality, set_join, toxicity
from clickloom.llm.common import table
from clickloom.sources.shared import discard, stage

# Near copies: shingles of so many words, at least so similar in per cent.
NEAR_WORDS = 5
NEAR_SIMILARITY = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules and forests keep."""
    return quality.filter_quality(docs, table(spark, sf_dir, "labels"))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; n_chars follows the text."""
    inside = {c: f"c{n}" for n, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    kept = line_dedup.dedup_lines(docs.toDF(*[inside.get(c, c) for c in docs.columns]))
    columns = {c: F.col(inside.get(c, c)) for c in docs.columns}
    if "n_chars" in inside:
        size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("n_dropped") > 0, size).otherwise(columns["n_chars"])
    return kept.select(*[column.alias(name) for name, column in columns.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the rows with the smallest id.

    Rows without an id are kept. Rows that share an id are judged each by its own text.
    """
    found = set_join.jaccard_components(docs, NEAR_WORDS, NEAR_SIMILARITY, by_row=True)
    others = found.where("component_id <> doc_id").select("doc_id", "text_hash").distinct()
    same = (docs["doc_id"] == others["doc_id"]) & (set_join.text_hash(docs["text"]) == others["text_hash"])
    return docs.join(others, same, "left_anti")


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents in training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("line dedup", shared_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("best-fit packing", packed_sequences),
]

# Forests, the classifier and the packing cannot be told in SQL; tests hold the stages
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs, held = table(spark, sf_dir, "documents"), []
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(*held)
        held = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
