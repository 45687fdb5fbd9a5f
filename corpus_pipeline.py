"""Corpus pipeline: language ID, toxicity, near-duplicates, decontamination, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
works on all documents that its predecessor kept.  All but the last return the
columns of ``documents``; the last returns packed pieces.

Defined cases: a null, empty or blank text, or one without letters, goes in the
language stage; rows of a null ``doc_id`` are documents of their own; of rows of
one ``doc_id`` one stays after the near-duplicate stage; further columns pass
through unchanged, whatever their names, up to the packing stage, which ignores
them; texts of any length are worked on whole; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrec.llm import decontam, langid, neardup, packing, toxicity
from sparkrec.llm.common import staged, table
from sparkrec.llm.queries import TOXIC_FROM, tokenizer_path
from sparkrec.session import ship_package

#: Bits per byte from which no learned language explains a text: as long as the text itself.
INCOMPRESSIBLE = 8.0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and texts that no learned language makes shorter."""
    ship_package(spark)
    scored = langid.predict(docs, langid.train(docs), docs.columns)
    known = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("bits_per_byte") < INCOMPRESSIBLE)
    return scored.filter(known).select("row.*")


def clean_speech(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose toxicity score reaches the threshold."""
    ship_package(spark)
    grammar = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.predict(docs, grammar, docs.columns).filter(F.col("score") < TOXIC_FROM).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate class."""
    ship_package(spark)
    return neardup.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a benchmark item."""
    ship_package(spark)
    return decontam.without_items(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of what is left."""
    ship_package(spark)
    return packing.digest(packing.pack(docs, tokenizer_path("word_bpe_49k.json"), end_id=1, added_tokens=True))


STAGES = [("language", language), ("toxicity", clean_speech), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("packing", packed)]

#: SQL cannot express the stages' models; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
