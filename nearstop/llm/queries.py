"""The registered queries of the operators in this folder, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from nearstop.llm import (
    chat,
    collocations,
    exact,
    fingerprints,
    jaccard,
    licences,
    mixing,
    outliers,
    packing,
    prefix_trie,
    secrets,
    toxicity,
    warc,
)
from nearstop.llm.common import table

#: What ``labels`` holds, in the order of the chain.
CATEGORIES = ["low_quality", "toxic"]


def toxicity_labels(spark, sf):
    return table(spark, sf, "labels").select(
        "doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic"
    )


def op1_secret_scan(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text", "source")
    return secrets.scan_secrets(documents).drop("token")


def op2_mix_sources(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text", "source")
    plan = mixing.plan_mix(documents, mixing.ranked_schedule())
    return plan.select(
        "doc_id", "source", "size", "source_size", "target", "taken",
        F.get("copies", F.lit(0))["position"].alias("position"),
    )


def op3_fingerprints(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return fingerprints.fingerprint_documents(documents)


def op4_warc_archive(spark, sf):
    return warc.archive_pages(table(spark, sf, "pages"))


def op5_ngram_jaccard(spark, sf):
    return jaccard.similar_components(table(spark, sf, "documents").select("doc_id", "text"))


def op6_toxicity_chain(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return toxicity.toxic_documents(documents, toxicity_labels(spark, sf), CATEGORIES).drop("text")


def op7_licence_scan(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return licences.scan_licences(documents, licences.known_licences(spark))


def op8_quality_outliers(spark, sf):
    return outliers.robust_outliers(outliers.text_statistics(table(spark, sf, "documents")))


def op9_pack_sequences(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return packing.pack_documents(documents, public_tokenizers.path("word_bpe_49k.json"))


def op10_chat_repair(spark, sf):
    return chat.repair_chats(table(spark, sf, "conversations"))


def op11_collocations(spark, sf):
    return collocations.collocations(table(spark, sf, "documents").select("lang", "text"))


def op12_exact_dedup(spark, sf):
    return exact.exact_groups(table(spark, sf, "documents").select("doc_id", "text"))


def op13_prefix_trie(spark, sf):
    return prefix_trie.prefix_trie(table(spark, sf, "conversations"))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_mix_sources": op2_mix_sources,
    "op3_fingerprints": op3_fingerprints,
    "op4_warc_archive": op4_warc_archive,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_toxicity_chain": op6_toxicity_chain,
    "op7_licence_scan": op7_licence_scan,
    "op8_quality_outliers": op8_quality_outliers,
    "op9_pack_sequences": op9_pack_sequences,
    "op10_chat_repair": op10_chat_repair,
    "op11_collocations": op11_collocations,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_prefix_trie": op13_prefix_trie,
}
