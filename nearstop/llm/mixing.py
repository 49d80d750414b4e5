"""Mix sources to target weights along a time-varying curriculum, with SQL functions only.

Each source has a piecewise linear weight over training time 0 to 1. Its integral is the source's
share of the mix. The words a source supplies up to a time follow the integral up to that time, so
inverting it turns a word's place in its source into a training position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearstop.llm.common import GAP, WORD, group_key, row_hash, with_row_number
from nearstop.scratch import materialise

#: Documents of one source that a window sorts together, on average.
BUCKET_ROWS = 1024
#: Digits of a bucket that are summed at once: so many hex digits make a window of 4,096 rows.
LEVEL_DIGITS = 3


def with_schedule(sources: DataFrame, knots: Column) -> DataFrame:
    """Add ``segments`` (of the weight curve) and ``weight`` (its integral) from the knots.

    ``knots`` is an array of (t, w) by rising t from 0 to 1, with w of 0 or more.
    """
    step = (
        "named_struct('t0', knots[i].t, 'w0', knots[i].w, 't1', knots[i+1].t,"
        " 'w1', knots[i+1].w, 'c0', acc.area)"
    )
    area = "acc.area + (knots[i].w + knots[i+1].w) * (knots[i+1].t - knots[i].t) / 2"
    begin = (
        "named_struct('area', 0D, 'done', cast(array() as array<struct<t0:double,w0:double,"
        "t1:double,w1:double,c0:double>>))"
    )
    walk = F.expr(
        f"aggregate(sequence(0, size(knots) - 2), {begin}, (acc, i) -> "
        f"named_struct('area', {area}, 'done', concat(acc.done, array({step}))))"
    )
    return sources.withColumn("knots", knots).withColumn("_walk", walk).select(
        *[F.col(f"`{c}`") for c in sources.columns],
        F.col("_walk.done").alias("segments"), F.col("_walk.area").alias("weight"),
    )


def with_targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """Add ``target``: ``share`` of all sizes by weight, at most ``most`` times a source's size.

    What a full source cannot take is shared among the others by weight. The common level rises
    until no further source is full; each round is one aggregate of the source table.
    """
    full = F.lit(most) * F.col("size")
    totals = sources.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    demand = share * float(totals["size"] or 0)
    level = demand / totals["weight"] if totals["weight"] else 0.0
    closed = -1
    while True:
        capped = full <= F.lit(level) * F.col("weight")
        now = sources.agg(
            F.count_if(capped).alias("closed"),
            F.sum(F.when(capped, full)).alias("taken"),
            F.sum(F.when(~capped, F.col("weight"))).alias("open"),
        ).first()
        if now["closed"] == closed or not now["open"]:
            break
        closed = now["closed"]
        level = (demand - (now["taken"] or 0.0)) / now["open"]
    return sources.withColumn(
        "target", F.when(full <= F.lit(level) * F.col("weight"), full)
        .otherwise(F.lit(level) * F.col("weight")),
    )


def _bucket_digits(rows: int) -> int:
    digits = 0
    while rows > BUCKET_ROWS * 16**digits:
        digits += 1
    return digits


def _bases(buckets: DataFrame, digits: int) -> DataFrame:
    """_source, _bucket and _base, the sizes of all buckets of the source before this one.

    Buckets are summed level by level of ``LEVEL_DIGITS`` digits, so a window holds few of them
    however large the source is.
    """
    out = buckets.select("_source", "_bucket", F.lit(0).cast("long").alias("_base"))
    for begin in range(0, digits, LEVEL_DIGITS):
        end = min(digits, begin + LEVEL_DIGITS)
        prefix = F.substring("_bucket", 1, end)
        before = Window.partitionBy("_source", F.substring("_prefix", 1, begin)).orderBy(
            "_prefix"
        ).rowsBetween(Window.unboundedPreceding, -1)
        level = buckets.groupBy("_source", prefix.alias("_prefix")).agg(
            F.sum("_sum").alias("_sum")
        ).select("_source", "_prefix", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_less"))
        out = out.withColumn("_prefix", prefix).join(level, ["_source", "_prefix"]).select(
            "_source", "_bucket", (F.col("_base") + F.col("_less")).alias("_base")
        )
    return out


def _position(at: Column) -> Column:
    """The time at which a source has supplied the part ``at`` (0 to 1) of its words."""
    return F.element_at(F.transform(F.array(at * F.col("weight")), lambda area: F.element_at(
        F.transform(
            F.filter("segments", lambda s: (s.c0 <= area) | (s.c0 == 0)),
            lambda s: s.t0 + F.coalesce(
                2 * (area - s.c0) / F.nullif(
                    s.w0 + F.sqrt(
                        s.w0 * s.w0 + 2 * ((s.w1 - s.w0) / (s.t1 - s.t0)) * (area - s.c0)
                    ), F.lit(0.0),
                ), F.lit(0.0),
            ),
        ), -1,
    )), 1)


def plan_mix(
    documents: DataFrame, schedule, share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """One row per document: what the mix takes of it, and when.

    ``documents`` has doc_id, text and source; other columns are kept out. ``schedule`` takes the
    table of sources (source, size) and returns it with ``segments`` and ``weight``, one row each.
    The result has doc_id, source, size, source_size, target, taken, copies (pass, words,
    position), and the row key of ``with_row_number``. Every source is read in the order of a digest
    of doc_id as often as its target asks; the copy at the end of the target is cut to the words
    left. A null or empty text has size 0 and no copies; null is a source of its own; equal rows
    are documents of their own. An empty table gives an empty result.
    """
    # The texts are measured before anything is shuffled.
    numbered = with_row_number(documents.select(
        "doc_id", "source", row_hash(documents).alias("_row"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    ))
    # Rows without an id have an order too, by what they hold.
    named = F.coalesce(F.col("doc_id").cast("string"), F.concat_ws("-", F.lit(""), "_row", "_nth"))
    sized = materialise(numbered.withColumns({
        "_order": F.md5(named.cast("binary")), "_source": group_key("source"),
    }), "sized")
    digits = _bucket_digits(sized.count())
    sized = sized.withColumn("_bucket", F.substring("_order", 1, digits) if digits else F.lit(""))

    buckets = sized.groupBy("_source", "_bucket").agg(
        F.first("source").alias("source"), F.sum("size").alias("_sum")
    )
    buckets = materialise(buckets, "buckets")
    sources = buckets.groupBy("_source").agg(
        F.first("source").alias("source"), F.sum("_sum").alias("size")
    )
    targets = materialise(with_targets(
        materialise(schedule(sources), "sources"), share, most
    ), "targets").drop("source").withColumnRenamed("size", "source_size")

    offsets = _bases(buckets, digits).join(targets, "_source")
    inside = Window.partitionBy("_source", "_bucket").orderBy("_order", "_row", "_nth").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = sized.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        offsets, ["_source", "_bucket"]
    )
    begin = F.col("_base") + F.col("_inside")
    passes = F.sequence(F.lit(0), F.lit(int(-(-most // 1)) - 1))

    def copy(n: Column) -> Column:
        start = begin + n * F.col("source_size")
        words = F.greatest(
            F.lit(0), F.least(F.col("size"), F.floor("target") - start)
        ).cast("long")
        at = (start + words / 2) / F.nullif(F.col("target"), F.lit(0.0))
        return F.struct(n.alias("pass"), words.alias("words"), _position(at).alias("position"))

    copies = F.filter(F.transform(passes, copy), lambda c: c.words > 0)
    return placed.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target",
        F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c.words).alias("taken"),
        "copies", "_row", "_nth",
    )


def _numbered(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``with_row_number`` of whole documents; only those that repeat are shuffled for it."""
    repeated = materialise(plan.where("_nth > 1").select("_row").distinct(), "repeated")
    if repeated.isEmpty():
        return rows.withColumn("_nth", F.lit(1))
    single = rows.join(repeated, "_row", "left_anti").withColumn("_nth", F.lit(1))
    return single.unionByName(with_row_number(rows.join(repeated, "_row", "left_semi")))


def mix(documents: DataFrame, schedule, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mixed documents, range-sorted by training position, with the columns of ``documents``.

    A document is repeated as often as the mix takes it. A copy at the end of its source's target
    holds only the words taken, each gap as one space, and its n_chars (if there is one) is new.
    """
    whole = materialise(plan_mix(documents, schedule, share, most).select(
        "_row", "_nth", F.col("size").alias("_size"), "copies"
    ), "plan")
    plan = whole.select("_row", "_nth", "_size", F.explode("copies").alias("_copy"))
    # The document travels as one column, so no name of its columns can clash.
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_doc"),
        row_hash(documents).alias("_row"), "doc_id",
    )
    keyed = _numbered(rows, whole).drop("doc_id")
    taken = keyed.join(plan, ["_row", "_nth"])
    cut = F.col("_copy.words") < F.col("_size")
    words = F.filter(F.split("_doc.text", GAP), lambda w: w != "")
    shown = taken.withColumn("_words", F.when(cut, words)).withColumn("_text", F.when(
        cut, F.array_join(F.expr("slice(_words, 1, int(_copy.words))"), " ")
    ).otherwise(F.col("_doc.text")))
    columns = {"text": F.col("_text")}
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        columns["n_chars"] = F.when(cut, F.length("_text").cast(kind)).otherwise(
            F.col("_doc.n_chars")
        )
    out = F.struct(*[
        columns.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in documents.columns
    ])
    shown = shown.select(F.col("_copy.position").alias("_position"), "_row", out.alias("_doc"))
    return shown.repartitionByRange("_position", "_row").sortWithinPartitions(
        "_position", "_row"
    ).select("_doc.*")


def ranked_schedule(weights=(5, 2, 1), slopes=(-0.5, 0.0, 0.5)):
    """A schedule by the rank of a source's name in code point order, null last.

    Ranks repeat through ``weights``. A slope of -0.5 starts at 1.5 times the weight and falls to
    0.5 times, so heavy sources come early and light ones late. The table of sources has one row
    per source; it is ranked in one task.
    """

    def apply(sources: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
        place = (rank % len(weights)).alias("_place")
        ranked = sources.select("*", place)
        weight, slope = (
            F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("_place") + 1)
            for values in (weights, slopes)
        )
        knots = F.array(
            F.struct(F.lit(0.0).alias("t"), (weight * (1 - slope)).alias("w")),
            F.struct(F.lit(1.0).alias("t"), (weight * (1 + slope)).alias("w")),
        )
        return with_schedule(ranked, knots).drop("_place")

    return apply
