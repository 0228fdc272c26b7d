"""The contract queries ``opN_<name>``: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from disparo.llm.collocations import collocation_report
from disparo.llm.common import documents, ship_package
from disparo.llm.conversation_trie import conversation_trie
from disparo.llm.decontaminate import contamination_report
from disparo.llm.exact_dedup import duplicate_report
from disparo.llm import quality
from disparo.llm.html_extract import main_text
from disparo.llm.jaccard_join import jaccard_components
from disparo.llm.langid import train_and_identify
from disparo.llm.sentencepiece import encode_documents
from disparo.llm.sharding import shard_documents
from disparo.llm.simhash import simhash_components
from disparo.llm.substring_dedup import remove_repeats
from disparo.llm.token_counts import token_counts


def op1_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    return quality.rate(docs, quality.fit(docs, quality.graded(documents(spark, d, "labels"))))


def op2_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    return encode_documents(documents(spark, d))


def op3_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    return main_text(documents(spark, d, "pages")).select("page_id", "url", "text", "n_chars")


def op4_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return duplicate_report(documents(spark, d))


def op5_benchmark_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return contamination_report(documents(spark, d), documents(spark, d, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_ngram_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return jaccard_components(documents(spark, d))


def op7_sharding(spark: SparkSession, d: str) -> DataFrame:
    return shard_documents(documents(spark, d), shards=16)


def op8_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return remove_repeats(documents(spark, d), with_text=False)


def op9_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts(documents(spark, d))


def op10_language_id(spark: SparkSession, d: str) -> DataFrame:
    return train_and_identify(documents(spark, d)).select("doc_id", "held_out", "lang_pred", "score")


def op11_conversation_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    return conversation_trie(documents(spark, d, "conversations"))


def op12_simhash_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return simhash_components(documents(spark, d))


def op13_phrase_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocation_report(documents(spark, d))


def _query(fn):
    def run(spark: SparkSession, d: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, d)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


_ALL = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_html_extraction": op3_html_extraction,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_sharding": op7_sharding,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_language_id": op10_language_id,
    "op11_conversation_prefix_trie": op11_conversation_prefix_trie,
    "op12_simhash_near_dedup": op12_simhash_near_dedup,
    "op13_phrase_collocations": op13_phrase_collocations,
}

QUERIES = {name: _query(fn) for name, fn in _ALL.items()}
