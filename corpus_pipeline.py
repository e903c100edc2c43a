"""Training-corpus pipeline: five stages over ``documents``, each written and reread as the next one's input.

1. ``quality_classifier``: documents above their language's perplexity threshold go (labels of the input folder train it);
2. ``quality_rules``: documents that fail a rule, or whose host is blocked, go;
3. ``ngram_join``: of each class of near duplicates the document with the least id stays;
4. ``pii``: personal data becomes pseudonyms;
5. ``best_fit_packing``: the texts' token ids are packed into sequences of at most 1024.

All but the last return the columns of ``documents``. Stages cope with null and
empty texts, repeated rows and empty tables as their operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trendlens.llm import kneser_ney, ngram_join, packing, pii, quality_rules
from trendlens.llm.queries import VOCABULARY
from trendlens.session import materialize


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kneser_ney.keep_good(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one_of_each(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(docs)


def best_fit_packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, VOCABULARY)


STAGES = [
    ("quality_classifier", quality_classifier_stage),
    ("quality_rules", quality_rules_stage),
    ("ngram_join", ngram_join_stage),
    ("pii", pii_stage),
    ("best_fit_packing", best_fit_packing_stage),
]

#: The tokenizer and the trained model are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
