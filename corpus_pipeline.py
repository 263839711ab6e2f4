"""Documents to packed training sequences, in stages that are written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.decontaminate import without_contaminated
from tallyloom.llm.line_dedup import without_boilerplate
from tallyloom.llm.packing import packed, with_lengths
from tallyloom.llm.simhash import one_per_group
from tallyloom.llm.toxicity import without_toxic
from tallyloom.session import require_conf, stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return require_conf(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go.

    Null and empty texts stay, as nothing speaks against them; very long texts are read
    whole; repeated rows and rows without an id are judged by their texts. Other columns may
    have any names. No documents give none.
    """
    return without_toxic(docs, _table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go from its texts; documents stay.

    A null text stays null; one of nothing but boilerplate becomes empty. A null source is
    one of its own. Repeated rows are pages of their own. Other columns may have any names.
    No documents give none.
    """
    require_conf(spark)
    kept = without_boilerplate(docs)
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", changed).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id stays.

    Null texts and texts without words are one group. Of rows that repeat the id that stays,
    one stays; rows without an id all stay. Very long texts are compared whole. Other columns
    may have any names. No documents give none.
    """
    require_conf(spark)
    return one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover a benchmark item go.

    Null and empty texts cover nothing and stay; very long texts are read whole; repeated
    rows and rows without an id are judged by their texts. Other columns may have any names.
    No documents, or no benchmark, drop none.
    """
    return without_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left, in pieces placed in sequences.

    Null and empty texts have an end mark only; long documents are cut to pieces; repeated
    rows and rows without an id are packed each on its own. Other columns are not returned.
    No documents give no rows.
    """
    require_conf(spark)
    return packed(with_lengths(docs))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Toxicity is a fitted model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
