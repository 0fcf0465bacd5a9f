"""Corpus pipeline: language ID, quality classifier, SimHash near-dedup, best-fit packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its
predecessor kept. ``run`` writes every stage's result to the shared folder and
reads it back as the next one's input. All stages but the last return the
columns of ``documents``.

Defined results, stage by stage. Null, empty and letterless texts go in the first. Repeated rows are judged alike; the third
stage keeps one of them. Null ids take part as any other row: the classifiers do not learn from them (a null id has no remainder), and
a component without an id keeps one row. Null languages are not learned from, null sources not read. Further columns stay,
whatever their names. An empty table passes through all stages; without labels every score is 0.5 and no document goes.
Texts of any length are judged and packed whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatscope.llm import bpe, lang_id, packing, quality_crf, simhash
from chatscope.llm.common import crc32_mod, materialize, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, those far less probable under every learned language than its training
    rows are (``lang_id.with_floors``), and those whose language stays uncertain (posterior below 0.3).
    """
    rows = docs.where(crc32_mod("doc_id", 4) != 2)
    return lang_id.keep_confident(docs, lang_id.with_floors(rows, lang_id.train(rows)))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that the line field scores below 0.3; it learns from the labelled documents among ``docs``."""
    labels = table(spark, sf_dir, "labels").where(crc32_mod("doc_id", 5) != 0)
    return quality_crf.keep_good(docs, quality_crf.train(docs, labels))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of fingerprints at most two bits apart."""
    return simhash.keep_one(docs, shingle=3, radius=2)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 2048 tokens."""
    return packing.pack(docs, bpe.encoder)


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Tokenisation, the classifiers and single-linkage components are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
