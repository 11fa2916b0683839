"""One query per corpus operator over its whole table, and SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burnish.llm import ann, chat, decontaminate, divergence, html, langid, mixing, pii, quality, secrets, simhash, trie, urls
from burnish.llm.common import table
from burnish.session import prepare_session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare_session(spark), sf_dir)

        run.__name__ = name
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return wrap


@_query("op1_pii_skip_chain")
def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query("op2_simhash_near_dedup")
def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query("op8_mix_sources", mixing.OP8_SQL)
def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), without=("source", "text"))


@_query("op10_chat_rotation", chat.OP10_SQL)
def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


@_query("op3_url_filter")
def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


@_query("op4_html_text")
def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(table(spark, sf_dir, "pages"))


@_query("op5_nearest_vectors")
def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


@_query("op6_language_id")
def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


@_query("op7_decontaminate", decontaminate.OP7_SQL)
def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    found = decontaminate.judged(decontaminate.mark(docs, bench, without=("text",)))
    digest = F.sha2(F.concat_ws(",", F.array_sort("hit_items")), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"), digest.alias("items_sha256"), "contaminated")


@_query("op9_quality_votes")
def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))


@_query("op11_secret_ownership", secrets.OP11_SQL)
def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


@_query("op12_prefix_trie", trie.OP12_SQL)
def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


@_query("op13_source_divergence", divergence.OP13_SQL)
def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))
