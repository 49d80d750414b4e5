"""Toxicity by a chain of linear classifiers.

The categories are predicted one after the other. Each later model also sees the probabilities of
the earlier categories; in training these are out-of-fold, so no model learns from predictions on
rows that the model behind them has seen.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearstop.llm.common import WEIGHT, sample_by_label
from nearstop.scratch import materialise

#: Bound on the labelled rows that are trained on, chosen by a hash of doc_id.
TRAINING_ROWS = 10_000
#: Words with the strongest link to a category that its models see.
VOCABULARY = 1_000
#: Lengths of word beginnings that count besides whole words, so that inflected forms are met.
STEMS = (4, 5)
#: Least chi-squared statistic of a word (one degree of freedom): a chance of 1 in 500,000.
LEAST_LINK = 22.6
FOLDS = 3
THRESHOLD = 0.5


def _words(text: Column) -> Column:
    """The distinct lower-case words of letters of a text, and the stems of longer ones."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+")
    words = F.array_distinct(F.array_remove(parts, ""))

    def with_stems(found: Column) -> Column:
        stems = [F.array_distinct(F.transform(
            F.filter(found, lambda w: F.length(w) > size),
            lambda w: F.concat(F.substring(w, 1, size), F.lit("-")),
        )) for size in STEMS]
        return F.concat(found, *stems)

    return F.element_at(F.transform(F.array(words), with_stems), 1)


@dataclass
class Link:
    """One model of the chain; a category with rows of one kind only has a fixed probability."""

    category: str
    model: LogisticRegressionModel | None
    constant: float


@dataclass
class Chain:
    vocabulary: list[str]
    links: list[Link]


def sample_labels(labels: DataFrame, categories: list[str], rows: int) -> DataFrame:
    """One row per labelled doc_id and its weight, at most about ``rows``.

    A category is met if any row of the id meets it. The rows that meet a category and those that
    do not have an equal part each, as far as there are. Rows with a null id or a null category are
    not labelled.
    """
    clean = labels.where(" AND ".join(f"{c} IS NOT NULL" for c in ["doc_id", *categories]))
    single = clean.groupBy("doc_id").agg(
        *[F.max(F.col(c).cast("int")).alias(c) for c in categories]
    )
    return sample_by_label(single, categories, rows, ["doc_id"])


def _sums(categories: list[str]) -> list[Column]:
    """For each fold the rows, their weight and the weight of those that meet each category."""
    def fold(n: int, value: Column, name: str) -> Column:
        return F.sum(F.when(F.col("_fold") == n, value).otherwise(0)).alias(f"{name}_{n}")

    return [column for n in range(FOLDS) for column in (
        fold(n, F.lit(1), "rows"), fold(n, F.col(WEIGHT), "n"),
        *[fold(n, F.col(c) * F.col(WEIGHT), c) for c in categories],
    )]


def _vocabularies(
    examples: DataFrame, categories: list[str], size: int, without: list[int | None]
) -> list[list[str]]:
    """The words with the highest chi-squared statistic for any category, at most ``size`` each.

    One list for each of ``without``, from the rows outside that fold, or from all rows. Rows count
    by their weight, which is scaled so that all together count as many as there are. Words are
    counted once, by fold.
    """
    totals = examples.agg(*_sums(categories)).first()
    counts = materialise(examples.select(
        F.explode("_words").alias("word"), WEIGHT, "_fold", *categories
    ).groupBy("word").agg(*_sums(categories)), "words")

    def best_words(left_out: int | None) -> list[str]:
        folds = [n for n in range(FOLDS) if n != left_out]

        def total(name: str) -> float:
            return float(sum(totals[f"{name}_{n}"] or 0 for n in folds))

        def held(name: str) -> Column:
            return reduce(lambda a, b: a + b, [F.col(f"{name}_{n}") for n in folds])

        scale = total("n") / total("rows") if total("rows") else 1.0
        all_, chosen = total("rows"), set()
        for c in categories:
            met = total(c) / scale
            if not 0 < met < all_:
                continue
            n = held("n") / scale
            expected = n * met / all_
            score = (held(c) / scale - expected) ** 2 / (expected * (1 - n / (all_ + 1)))
            linked = counts.where(held("rows") >= 3).withColumn("_score", score).where(
                F.col("_score") >= LEAST_LINK
            )
            best = linked.orderBy(F.col("_score").desc(), "word").limit(size)
            chosen.update(row["word"] for row in best.select("word").collect())
        return sorted(chosen)

    return [best_words(left_out) for left_out in without]


def _features(rows: DataFrame, vocabulary: list[str]) -> DataFrame:
    model = CountVectorizerModel.from_vocabulary(
        vocabulary or ["\u0001"], inputCol="_words", outputCol="_x"
    ).setBinary(True)
    return model.transform(rows)


def _inputs(rows: DataFrame, earlier: list[str]) -> DataFrame:
    """Word features and the probabilities of earlier categories as one vector."""
    return VectorAssembler(
        inputCols=["_x", *[f"p_{c}" for c in earlier]], outputCol="_in"
    ).transform(rows)


def _predicted(rows: DataFrame, link: Link, earlier: list[str]) -> DataFrame:
    """Add the probability of the link's category as ``p_<category>``."""
    name = f"p_{link.category}"
    if link.model is None:
        return rows.withColumn(name, F.lit(link.constant))
    scored = link.model.transform(_inputs(rows, earlier))
    return scored.withColumn(name, F.round(vector_to_array("_p")[1], 6)).drop("_in", "_raw", "_p", "_y")


def _fit(rows: DataFrame, category: str, earlier: list[str]) -> Link:
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(category).alias("met")).first()
    met = float(totals["met"] or 0)
    if met in (0.0, float(totals["n"])):
        return Link(category, None, met / totals["n"] if totals["n"] else 0.0)
    model = LogisticRegression(
        featuresCol="_in", labelCol=category, weightCol=WEIGHT, probabilityCol="_p", rawPredictionCol="_raw",
        predictionCol="_y", regParam=0.0003, elasticNetParam=0.0, maxIter=80, standardization=False,
    ).fit(_inputs(rows, earlier))
    return Link(category, model, 0.0)


def train_chain(
    documents: DataFrame, labels: DataFrame, categories: list[str], rows: int = TRAINING_ROWS
) -> Chain:
    """Train the models of ``categories`` in order on at most about ``rows`` labelled documents.

    ``labels`` has doc_id and a 0/1 column per category. Only labelled documents that exist count;
    of rows that share an id each counts.
    """
    sampled = sample_labels(labels, categories, rows)
    # At most about TRAINING_ROWS rows of an id and small numbers: bounded.
    examples = documents.select("doc_id", "text").join(F.broadcast(sampled), "doc_id").select(
        "doc_id", _words(F.col("text")).alias("_words"),
        F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).alias("_fold"), WEIGHT, *categories,
    )
    table = materialise(examples.coalesce(8), "examples")
    # What a fold is held out from does not choose its words either.
    folds = list(range(FOLDS)) if len(categories) > 1 else []
    vocabulary, *words = _vocabularies(table, categories, VOCABULARY, [None, *folds])
    links: list[Link] = []
    for n, category in enumerate(categories):
        earlier = categories[:n]
        links.append(_fit(_features(table, vocabulary), category, earlier))
        if category == categories[-1]:
            break
        held_out = None
        for fold in range(FOLDS):
            seen = _features(table.where(F.col("_fold") != fold), words[fold])
            link = _fit(seen, category, earlier)
            unseen = _features(table.where(F.col("_fold") == fold), words[fold])
            part = _predicted(unseen, link, earlier).drop("_x")
            held_out = part if held_out is None else held_out.unionByName(part)
        table = materialise(held_out.coalesce(8), f"fold{n}")
    return Chain(vocabulary, links)


def apply_chain(documents: DataFrame, chain: Chain) -> DataFrame:
    """All columns of ``documents`` with the probability ``p_<category>`` of every category.

    A column of ``documents`` that has such a name comes back as ``given_<name>``.
    """
    # The document travels as one column, so no name of its columns can clash.
    whole = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_doc"))
    rows = _features(whole.withColumn("_words", _words(F.col("_doc.text"))), chain.vocabulary)
    earlier: list[str] = []
    for link in chain.links:
        rows = _predicted(rows, link, earlier)
        earlier.append(link.category)
    added = [f"p_{category}" for category in earlier]
    return rows.select(*_apart("_doc", documents.columns, added), *added)


def _apart(struct: str, names: list[str], added: list[str]) -> list[Column]:
    """The fields of a struct; those with the name of an added column as ``given_<name>``."""
    return [
        F.col(f"{struct}.`{name}`").alias(f"given_{name}" if name in added else name)
        for name in names
    ]


def toxic_documents(
    documents: DataFrame, labels: DataFrame, categories: list[str], threshold: float = THRESHOLD
) -> DataFrame:
    """Add p_<category> per category and ``toxic``, whether the last category is likely.

    ``documents`` has doc_id and text, ``labels`` doc_id and the categories. Other columns come back
    as they are; one that has the name of an added column comes back as ``given_<name>``. A null or
    empty text has no words and is judged by what the models make of that. Without labelled
    documents, or if all are of one kind, the probability is their share (0 without any). Rows that
    share an id are judged one by one. An empty table gives an empty result.
    """
    chain = train_chain(documents, labels, categories)
    verdict = "toxic"
    if verdict in documents.columns:
        documents = documents.withColumnRenamed(verdict, f"given_{verdict}")
    scored = apply_chain(documents, chain)
    return scored.withColumn(verdict, F.col(f"p_{categories[-1]}") >= threshold)
