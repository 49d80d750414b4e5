"""A training-data pipeline over ``documents``, stage by stage.

Each stage is a name and a function of (spark, docs, sf_dir) that returns a DataFrame, which is
written as Parquet and read again as the next stage's docs. All but the last return the columns of
``documents``.

1. toxicity: documents that the classifier chain rejects go.
2. near_duplicates: of each component of linked documents the one with the least doc_id stays.
3. secrets: confirmed secrets are masked in the text.
4. mixing: documents are repeated, cut or left out as the mix asks, in training order.
5. packing: the documents are packed into sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearstop.llm import jaccard, mixing, packing, queries, secrets, toxicity
from nearstop.scratch import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the chain, trained on the labelled ones among them, does not reject."""
    # The document travels as one column, so no name of its columns can clash.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    judged = toxicity.toxic_documents(
        docs.select("doc_id", "text", whole), queries.toxicity_labels(spark, sf_dir),
        queries.CATEGORIES,
    )
    return judged.where("NOT toxic").select("_doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: that with the least doc_id.

    Documents without words are linked with nothing and stay, as do rows without a doc_id. Rows
    that repeat an id stay or go together; fully equal rows among them become one.
    """
    found = materialise(jaccard.similar_components(docs), "components")
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    repeated = materialise(
        found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
        .select("doc_id"), "repeated",
    )
    if repeated.isEmpty():
        return kept
    single = kept.join(repeated, "doc_id", "left_anti")
    copies = kept.join(repeated, "doc_id", "left_semi").dropDuplicates()
    return single.select(docs.columns).unionByName(copies.select(docs.columns))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets that the forest confirms masked."""
    return secrets.redact_secrets(docs, secrets.scan_secrets(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources in the order of training positions."""
    return mixing.mix(docs, mixing.ranked_schedule())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mixed documents with their sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: The forest, the linear models and the tokenizer have no SQL form; tests/llm tests the
#: operators of the stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each stored before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
