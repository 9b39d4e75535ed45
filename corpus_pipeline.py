"""From raw documents to packed training sequences: a few stages, each one of the operators.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from volspark.llm import jaccard, quality, toxicity
from volspark.llm.corpus import fold, table
from volspark.llm.queries import packed


#: Words that a packing task remembers; executors still hold what the stages before it took.
REMEMBERED = 80_000


def _training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where(fold("doc_id", 3) != 1)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    everything = table(spark, sf_dir, "documents")
    model = quality.fit(everything, _training_labels(spark, sf_dir))
    return docs.where(quality.score(model) >= quality.THRESHOLD)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    everything = table(spark, sf_dir, "documents")
    model = toxicity.fit(everything, _training_labels(spark, sf_dir))
    return docs.where(toxicity.score(model) < toxicity.THRESHOLD)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near copies; rows repeated as a whole stay once.

    Ids are taken to be unique. Where one repeats, or is null, its rows count as one document: all
    of its different texts stay if any of them is the kept one of its group.
    """
    groups = jaccard.join(docs, size=5, percent=80)
    first = groups.where("doc_id <=> component_id").select(groups["doc_id"].alias("_kept")).distinct()
    kept = docs.join(first, docs["doc_id"].eqNullSafe(first["_kept"]), "left_semi")
    return kept.dropDuplicates(["doc_id", "text"])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens."""
    return packed(docs, REMEMBERED)


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("near copies", one_of_each_group),
    ("packing", pack_sequences),
]

#: SQL cannot express trained models and tokenizers; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
