"""The registered queries of this subpackage: one per operator, each over its whole table.

The operators keep their own interfaces; what is here selects the columns of
each query's contract from their results. ``SQL`` holds the DuckDB form of
those that SQL can express.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from . import decontamination as leaks, divergence as audit, fingerprints as prints, kneser_ney as lm, lexical_search, licenses, ngram_join as near, packing, pii, quality_rules as rules, suffix_pieces, token_store as tokens, url_filter as urls
from .sql import OP1, OP8, OP11, OP12, OP13

QUERIES: dict = {}
SQL: dict[str, str] = {}
#: Where the vocabulary files are; the operators take them as a parameter.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_query(OP1)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures, base verdict and host-aware verdict of every document."""
    judged = rules.quality_rules(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "host_blocked", "kept")


@_query()
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-permutation MinHash fingerprints of every document, its edited text and their likeness."""
    return prints.edited_pairs(_table(spark, sf_dir, "documents"))


@_query(OP8)
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or host reputation verdict of every page; a page's label is that of the same id."""
    labels = _table(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return urls.url_filter(_table(spark, sf_dir, "pages"), outcomes)


@_query()
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases, tags and expressions found in every document."""
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


@_query()
def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans and checksums of all documents' ids, read back from the token files."""
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(_table(spark, sf_dir, "documents"), path, VOCABULARY)
    return tokens.token_spans(tokens.read_tokens(spark, path))


@_query()
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of at most 1024 tokens."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"), VOCABULARY)


@_query()
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with personal data pseudonymized, and how many values were replaced."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return pii.pseudonymize(docs, found_col="n_replaced").drop("lang")


@_query()
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under its language's model of trusted text, and the verdict."""
    judged = lm.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), keep=["doc_id"])
    return judged.select(F.col("row.doc_id").alias("doc_id"), "model", "symbols", "perplexity", "threshold", "kept")


@_query()
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's SentencePiece ids, as count and checksum, and whether decoding gives the text back."""
    coded = suffix_pieces.encode(_table(spark, sf_dir, "documents"), PIECES)
    back = suffix_pieces.decoded(F.col("ids"), PIECES)
    return coded.select("doc_id", "n_tokens", "ids_crc32", (back == F.replace(F.coalesce("text", F.lit("")), F.lit("▁"), F.lit(" "))).alias("round_trip"))


@_query()
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and near-duplicate class of every document."""
    return near.jaccard_classes(_table(spark, sf_dir, "documents"))


@_query(OP12)
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of every document that stand in a window of a benchmark item, and those items."""
    return leaks.digest(leaks.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


@_query(OP13)
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every source's term shares are from the other sources', and its leading terms."""
    return audit.divergence(_table(spark, sf_dir, "documents"))


@_query(OP11)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents of every benchmark item, by weighted terms."""
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
