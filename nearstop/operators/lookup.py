"""Lookups: joins with reference tables and calls of a lookup service, whose answers can be stored."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from nearstop.scratch import materialise
from nearstop.sinks.tables import append_run
from nearstop.sources.files import SourceNotFound
from nearstop.sources.tables import read_table

NULL_SPREAD = 64  # parts over which rows without a key are spread
PIECE = 64  # keys of a failing batch that are tried together before each is tried by itself
ERROR = "_error"  # column in which a service may tell what went wrong for a key


def lookup_join(
    left: DataFrame, right: DataFrame, on: dict[str, str], row_id: str
) -> DataFrame:
    """Left join of ``left`` with a reference table; ``on`` maps left to right key columns.

    Rows with a null key match nothing but would all be sent to one task. A second key part,
    always 0 for rows with a key, spreads them by ``row_id``, a column that differs between rows.
    Rows sharing one real key are left to the skew handling of adaptive execution, which can split
    the left side of this join, and a reference table that turns out small is broadcast by it. All
    columns of both sides are kept; the key columns need different names.
    """
    no_key = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in on])
    spread = F.when(no_key, F.pmod(F.xxhash64(row_id), F.lit(NULL_SPREAD - 1)) + 1)
    a = left.withColumn("_part", F.coalesce(spread, F.lit(0)))
    b = right.withColumn("_right_part", F.lit(0).cast("long"))
    same = [F.col(name) == F.col(other) for name, other in [*on.items(), ("_part", "_right_part")]]
    return a.join(b, same, "left").drop("_part", "_right_part")


def one_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``, then by all other columns.

    An aggregate rather than a window: the rows of a key are reduced before they are shuffled.
    """
    rest = [name for name in df.columns if name not in [*keys, *order]]
    first = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select(*keys, "_first.*").select(*df.columns)


class WrongAnswers(ValueError):
    """A service returned another number of answers than it was asked for."""


def ask(
    asked: DataFrame,
    keys: list[str],
    fetch: Callable[[pd.DataFrame], pd.DataFrame],
    result: str,
    parallelism: int | None = None,
) -> DataFrame:
    """One row for each distinct key: the key, the columns of ``result`` and ``ERROR``.

    ``fetch`` gets a pandas frame of keys and returns one row of results for each, in order; another
    number of rows is a mistake of the caller's and raises. Its result may have a column ``ERROR``
    with what went wrong for a key. If it raises, the batch is tried again in pieces, and a failing
    piece key by key; a key that fails has null results and the error. The keys are dealt over
    ``parallelism`` tasks, by default one for each core: that many calls run at a time.
    """
    fields = StructType.fromDDL(result)
    names = fields.names
    distinct = asked.select(*keys).dropna().distinct()
    tasks = parallelism or asked.sparkSession.sparkContext.defaultParallelism
    # A number of partitions given so is not merged by adaptive execution.
    dealt = distinct.repartition(tasks)

    def answered(asked: pd.DataFrame) -> dict[str, list]:
        answer = fetch(asked)
        if len(answer) != len(asked):
            raise WrongAnswers(f"{len(answer)} answers for {len(asked)} keys")
        told = list(answer[ERROR]) if ERROR in answer else [None] * len(asked)
        return {name: list(answer[name]) for name in names} | {ERROR: told}

    def answers_for(asked: pd.DataFrame) -> pd.DataFrame:
        found = {name: [] for name in [*names, ERROR]}
        waiting = [(0, len(asked))]
        while waiting:
            begin, end = waiting.pop(0)
            try:
                part = answered(asked.iloc[begin:end].reset_index(drop=True))
            except WrongAnswers:
                raise
            except Exception as failure:
                if end - begin > 1:
                    step = PIECE if end - begin > PIECE else 1
                    waiting[:0] = [(n, min(n + step, end)) for n in range(begin, end, step)]
                    continue
                part = {name: [None] for name in names}
                part[ERROR] = [f"{type(failure).__name__}: {failure}"]
            for name, values in part.items():
                found[name].extend(values)
        return asked.assign(**found)

    def fetch_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield answers_for(batch)

    key_fields = [distinct.schema[name] for name in keys]
    return dealt.mapInPandas(fetch_batches, StructType(
        [*key_fields, *fields.fields, StructField(ERROR, StringType())]
    ))


def _with_answers(df, answers, keys, row_id, error) -> DataFrame:
    answers = answers.withColumnRenamed(ERROR, error) if error else answers.drop(ERROR)
    keyed = answers.withColumnsRenamed({name: f"_key_{name}" for name in keys})
    joined = lookup_join(df, keyed, {name: f"_key_{name}" for name in keys}, row_id)
    return joined.drop(*[f"_key_{name}" for name in keys])


def call_lookup(
    df: DataFrame,
    keys: list[str],
    fetch: Callable[[pd.DataFrame], pd.DataFrame],
    result: str,
    row_id: str,
    parallelism: int | None = None,
    error: str | None = None,
) -> DataFrame:
    """Add the columns of DDL schema ``result`` by calling ``fetch`` on batches of distinct keys.

    Each key is looked up once, however often it occurs, see ``ask``. The results of keys that fail
    are null and can be retried; ``error``, if given, names a column for what they raised.
    ``row_id`` is a column that differs between rows.
    """
    return _with_answers(df, ask(df, keys, fetch, result, parallelism), keys, row_id, error)


def stored_answers(
    asked: DataFrame,
    keys: list[str],
    fetch: Callable[[pd.DataFrame], pd.DataFrame],
    result: str,
    root: str,
    name: str,
    parallelism: int | None = None,
    pieces: int = 1,
) -> DataFrame:
    """The answers to all distinct keys of ``asked``, of which only new ones are asked for.

    Answers are kept in table ``name`` below ``root``. Keys with an answer there are not asked
    again, those that failed are. ``pieces`` are asked and stored one after the other, so that a
    run that breaks off loses one of them at most and the next run goes on with the rest. Returns
    the keys, the columns of ``result`` and ``ERROR``, one row per key: an answer if any run had one.
    """
    spark = asked.sparkSession
    wanted = asked.select(*keys).dropna().distinct()

    def stored() -> DataFrame | None:
        try:
            return read_table(spark, name, root)
        except SourceNotFound:
            return None

    known = stored()
    if known is not None:
        answered = known.where(F.col(ERROR).isNull()).select(*keys).distinct()
        wanted = wanted.join(answered, keys, "left_anti")
    wanted = materialise(wanted, "asked")
    for piece in range(pieces):
        part = wanted.where(F.pmod(F.xxhash64(*keys), F.lit(pieces)) == piece)
        if not part.isEmpty():
            append_run(ask(part, keys, fetch, result, parallelism), name, root, uuid.uuid4().hex)
    answers = stored()
    if answers is None:
        return ask(wanted, keys, fetch, result, parallelism)
    asked_for = asked.select(*keys).dropna().distinct()
    mine = answers.withColumn("_failed", F.col(ERROR).isNotNull()).join(asked_for, keys, "left_semi")
    return one_per_key(mine, keys, ["_failed", *StructType.fromDDL(result).names]).drop("_failed")


def stored_lookup(
    df: DataFrame,
    keys: list[str],
    fetch: Callable[[pd.DataFrame], pd.DataFrame],
    result: str,
    row_id: str,
    root: str,
    name: str,
    parallelism: int | None = None,
    error: str | None = None,
    pieces: int = 1,
) -> DataFrame:
    """``call_lookup`` with answers kept in table ``name`` below ``root``, see ``stored_answers``."""
    answers = stored_answers(df, keys, fetch, result, root, name, parallelism, pieces)
    return _with_answers(df, answers, keys, row_id, error)
