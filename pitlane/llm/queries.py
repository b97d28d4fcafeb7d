"""The operators applied to the given tables, one query each, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitlane.llm import conversation_trie, exact_dedup, filter_audit, html_extract, mixing, packing, prefix_hash, quality, secrets, simhash, token_counts, toxicity, word_contexts
from pitlane.llm.common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: 3-word shingles, 3 bits."""
    return simhash.simhash_dedup(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of all documents, learned from the toxic labels."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), packing.TOKENIZER)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents, learned from the quality labels."""
    docs = table(spark, sf_dir, "documents")
    return quality.quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the sources' target weights."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of all documents under a model of four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    return word_contexts.score(docs, word_contexts.train(docs))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts, with likenesses."""
    return prefix_hash.fingerprints(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents up to white space."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret candidates of all documents with the forest's probability."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removals of five filters over all documents in all 120 orders, by source."""
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of all conversations, rebuilt to share beginnings."""
    return conversation_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents under the byte-level tokenizer."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), "byte_bpe_50k.json")


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_toxicity": op2_toxicity,
    "op3_html_extraction": op3_html_extraction,
    "op4_packing": op4_packing,
    "op5_quality": op5_quality,
    "op6_mixing": op6_mixing,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_fingerprints": op8_fingerprints,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_filter_audit": op11_filter_audit,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_token_counts": op13_token_counts,
}

ORACLE = {"op9_exact_dedup": exact_dedup.SQL, "op11_filter_audit": filter_audit.SQL, "op12_conversation_trie": conversation_trie.SQL}
