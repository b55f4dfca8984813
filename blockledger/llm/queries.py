"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockledger.llm import (
    byte_cnn,
    language,
    link_trust,
    mixing,
    ngram_join,
    phrases,
    rule_cascade,
    token_counts,
    token_shards,
    tool_chat,
    toxicity,
    variants,
    winnowing,
)
from blockledger.llm.common import table, training_row

RANKS = "byte_bpe_multi_50k.tiktoken"
COUNTED = "word_bpe_49k.json"


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near copies (Jaccard of 3-word shingles at least 0.9) over all documents."""
    return ngram_join.near_duplicate_components(table(spark, sf_dir, "documents"))


def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    names, logp = language.train(docs, F.col("lang"), training_row(F.col("doc_id")))
    found = language.identify(docs.select("doc_id", "text"), names, logp)
    return found.select("row.doc_id", (~training_row(F.col("row.doc_id"))).alias("held_out"),
                        "lang_pred", "score", "languages", "shares")


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token sequences of all documents in permuted order, in fixed-stride shards; one row a sequence."""
    return token_shards.materialise(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS),
                                    public_tokenizers.PATTERN)


def op4_systematic_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    # The row itself need not move: only the id goes through the operator with the text and the source.
    return mixing.copies(docs, keep=["doc_id"]).select(
        "row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op5_tool_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of all conversations as linked, ordered and validated tool events in canonical JSON."""
    events = tool_chat.as_events(table(spark, sf_dir, "conversations"))
    return tool_chat.linked(events).withColumn("errors", F.array_join("errors", ","))


def op6_byte_cnn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from labels of rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = byte_cnn.train(docs, table(spark, sf_dir, "labels"), training_row)
    return byte_cnn.scored(docs, model).select(
        "doc_id", (~training_row(F.col("doc_id"))).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op7_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality signals and verdict of every document."""
    return rule_cascade.judged(table(spark, sf_dir, "documents")).drop("n_lines")


def op8_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url, by rule or else by the host's standing in the link graph."""
    return link_trust.judged(table(spark, sf_dir, "pages"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(COUNTED))


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of benchmark items."""
    return winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_son_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of each language, mined in shards and counted exactly over all documents."""
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its form, its root and the number of words one edit away."""
    return variants.spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_toxic_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels of rows that are not held out, and its likeliest sentence."""
    learned_from = lambda i: F.crc32(i.cast("string").cast("binary")) % 5 != 0
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), learned_from)
    return toxicity.scored(docs, model).select(
        "doc_id", (~learned_from(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "n_sentences", "worst", "worst_score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_language_mixture, op3_token_shards, op4_systematic_mixing, op5_tool_chat,
    op6_byte_cnn_quality, op7_rule_cascade, op8_link_trust, op9_token_counts, op10_winnowing,
    op11_son_phrases, op12_spelling_variants, op13_toxic_sentences)}

ORACLE: dict[str, str] = {
    "op4_systematic_mixing": mixing.SQL,
    "op5_tool_chat": tool_chat.SQL,
    "op7_rule_cascade": rule_cascade.SQL,
    "op10_winnowing": winnowing.SQL,
    "op11_son_phrases": phrases.SQL,
}
