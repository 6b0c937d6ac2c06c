"""From raw documents to packed training sequences, stage by stage.

Every stage takes the session, the documents its predecessor kept and the folder
of the tables.  All but the last return the columns of ``documents``.  Extra columns,
whatever their names, are carried by all but the last; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tableflow.llm import mixture, ngram_join, packing, pii, quality_ledger
from tableflow.llm.common import prepared, table
from tableflow.llm.queries import POLICY, TOKENIZER, tokenizer_path, weight_by_place
from tableflow.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy rejects go, null, empty and short texts among them.

    Null ids and repeated rows are judged like any others.
    """
    prepared(spark)
    return quality_ledger.keep_good(docs, quality_ledger.policy_mask(quality_ledger.POLICIES[POLICY]))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays (five words, similarity 0.8): the smallest id, null last.

    Of rows alike in id and text one stays; texts without words have no class and stay.
    """
    return ngram_join.keep_one(docs, 5, 80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind, in whole texts; null texts stay null, and no row goes."""
    return pii.redacted(docs, chars_col="n_chars")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, the last time cut after its last word taken.

    Null and empty texts are never taken; null is a source; each of several rows alike has its own share.
    """
    prepared(spark)
    return mixture.mixed_rows(docs, weight_by_place, chars_col="n_chars")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the mix with their places in sequences; a null or empty text is its end token alone."""
    return packing.pack_documents(docs, tokenizer_path(TOKENIZER))


STAGES = [("quality_rules", quality_rules), ("ngram_jaccard", ngram_jaccard), ("personal_data", personal_data),
          ("source_mix", source_mix), ("best_fit_packing", best_fit_packing)]

#: Packing and hashing have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
