"""Quality rules with robust multivariate outliers, with SQL functions only.

Per language and source, the minimum covariance determinant is estimated by concentration steps:
keep the three quarters of rows nearest to the centre, estimate centre and covariance from them,
measure again. Several fixed starts are taken; the one that leads to the least determinant goes on
until the determinant falls no more. A row is rejected by its Mahalanobis distance from the last
estimate. Estimates lean on those of the level above (a source's on its language's, a language's on
all documents') as if that had so many rows of its own, so small groups are judged too, and a group
is judged no differently because it has one row more. The vectors are whole numbers (thousandths),
so every sum is exact and reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearstop.llm.common import GAP, group_key
from nearstop.scratch import materialise

SYMBOLS = "#*$%&|<>"
WINDOW = 8
SCALE = 1000
FEATURES = ("_f0", "_f1", "_f2", "_f3")
#: Share of a group's rows that the estimate rests on.
SUPPORT = 0.75
#: Steps from every start, and at most from the best one; it has ended long before in practice.
FIRST_STEPS, MOST_STEPS = 2, 20
#: Rows that the estimate of the level above counts for.
PRIOR = 100
#: The starts: no correlation, and that of three transforms of the scaled vectors.
STARTS = ("none", "tanh", "sign", "log")
#: Standard deviations (thousandths) added to each axis, so that a constant statistic has a scale.
FLOORS = (250, 40, 300, 100)
#: Rejected beyond this quantile of the chi-squared distribution. The tails of texts are heavier
#: than normal ones, so it is far out.
QUANTILE = 1 - 1e-12


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated_words(words: Column) -> Column:
    """Words covered by windows of eight words that occur twice or more in the text."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(h) - WINDOW),
            lambda i: F.struct(
                F.xxhash64(*[F.get(h, i + n) for n in range(WINDOW)]).alias("h"), i.alias("i")
            ),
        )

    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda p, n: F.least(
            F.lit(WINDOW), F.coalesce(F.get(places, n + 1) - p, F.lit(WINDOW))
        ))
        return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

    def repeated(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda s, n: (
            (F.get(ordered, n + 1).h == s.h)
            | F.when(n > 0, F.get(ordered, n - 1).h == s.h).otherwise(False)
        ))
        return _let(F.sort_array(F.transform(twice, lambda s: s.i)), covered)

    def counted(found: Column) -> Column:
        distinct = F.size(F.array_distinct(F.transform(found, lambda s: s.h)))
        return F.when(distinct == F.size(found), F.lit(0)).otherwise(
            _let(F.sort_array(found), repeated)
        )

    return _let(hashes, lambda h: F.when(F.size(h) < WINDOW, F.lit(0)).otherwise(
        _let(windows(h), counted)
    ))


def _repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.ltrim(line, F.lit(" \t\r\x0b\x0c")) != "")
    return _let(lines, lambda kept: F.size(kept) - F.size(F.array_distinct(kept)))


def text_statistics(documents: DataFrame) -> DataFrame:
    """doc_id, lang, source and the base statistics of each whole text; null counts as empty."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split("_text", GAP), lambda w: w != "")
    rows = documents.select("doc_id", "lang", "source", text.alias("_text"))
    rows = rows.select(
        "doc_id", "lang", "source",
        F.length(F.regexp_replace("_text", GAP, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long")
        .alias("n_symbols"),
        _repeated_lines(F.col("_text")).cast("long").alias("n_dup_lines"),
        _let(words, lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            _repeated_words(w).cast("long").alias("n_repeat_words"),
        )).alias("_words"),
    )
    return rows.select("*", "_words.*").drop("_words")


def _thousandths(value: Column) -> Column:
    return F.round(value * SCALE).cast("long")


def with_vector(rows: DataFrame) -> DataFrame:
    """The transformed vector: logs of length, word length, symbols a word, uses of a word."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return rows.withColumns({
        "_f0": _thousandths(F.log(n.cast("double"))),
        "_f1": _thousandths(F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n)),
        "_f2": _thousandths(F.log1p(100 * F.col("n_symbols") / n)),
        "_f3": _thousandths(F.log(n / F.greatest(F.col("n_distinct"), F.lit(1)))),
    })


def _at_share(counts: DataFrame, keys: list[str], value: str, share: float, name: str) -> DataFrame:
    """Per key the least value at or below which ``share`` of the counted rows lie."""
    running = Window.partitionBy(*keys).orderBy(value)
    total = Window.partitionBy(*keys)
    return (
        counts.withColumn("_run", F.sum("count").over(running))
        .withColumn("_all", F.sum("count").over(total))
        .where(F.col("_run") >= F.lit(share) * F.col("_all"))
        .groupBy(*keys).agg(F.min(value).alias(name))
    )


def _medians(rows: DataFrame, values: list[Column]) -> DataFrame:
    """Per group the medians of the values, from counts by value, as columns _m0, _m1 and so on."""
    long = rows.select("_group", F.posexplode(F.array(*values)).alias("_axis", "_value"))
    counts = long.groupBy("_group", "_axis", "_value").count()
    found = _at_share(counts, ["_group", "_axis"], "_value", 0.5, "_mid")
    return found.groupBy("_group").agg(*[
        F.max(F.when(F.col("_axis") == n, F.col("_mid"))).alias(f"_m{n}")
        for n in range(len(values))
    ])


def _consistency(share: float) -> float:
    """Brings the covariance of the kept share to that of all rows, for normal data on 4 axes."""
    cut = chi_squared_4(share)
    return share / (1 - math.exp(-cut / 2) * (1 + cut / 2 + cut * cut / 8))


def chi_squared_4(share: float) -> float:
    """The quantile of the chi-squared distribution with four degrees of freedom."""
    low, high = 0.0, 200.0
    for _ in range(200):
        middle = (low + high) / 2
        tail = math.exp(-middle / 2) * (1 + middle / 2)
        low, high = (middle, high) if tail > 1 - share else (low, middle)
    return low


SIZE = len(FEATURES)
PAIRS = [(i, j) for i in range(SIZE) for j in range(i + 1)]


def _factored(frame: DataFrame) -> DataFrame:
    """Add the Cholesky factor _l* of the matrix _v* and the logarithm of its determinant."""
    for i, j in PAIRS:
        rest = F.col(f"_v{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}")
        frame = frame.withColumn(
            f"_l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1.0))) if i == j else rest / F.col(f"_l{j}{j}")
        )
    sides = [F.log(f"_l{i}{i}") for i in range(SIZE)]
    return frame.withColumn("_logdet", 2 * (sides[0] + sides[1] + sides[2] + sides[3]))


def _starts(vectors: DataFrame) -> DataFrame:
    """_group, _start, centre and factor of each start: medians, and scales from median deviations."""
    middle = materialise(_medians(vectors, [F.col(f) for f in FEATURES]), "medians")
    spread = materialise(_medians(
        vectors.join(middle, "_group"),
        [F.abs(F.col(f) - F.col(f"_m{i}")) for i, f in enumerate(FEATURES)],
    ).toDF("_group", *[f"_d{i}" for i in range(SIZE)]), "spreads")
    frame = middle.join(spread, "_group").select("_group", *[
        F.col(f"_m{i}").cast("double").alias(f"_c{i}") for i in range(SIZE)
    ], *[
        F.sqrt((1.4826 * F.col(f"_d{i}")) ** 2 + FLOORS[i] ** 2).alias(f"_s{i}") for i in range(SIZE)
    ])
    frame = materialise(frame, "scales")
    scaled = vectors.join(frame, "_group").select("_group", *[
        ((F.col(f) - F.col(f"_c{i}")) / F.col(f"_s{i}")).alias(f"_z{i}")
        for i, f in enumerate(FEATURES)
    ])
    z = [F.col(f"_z{i}") for i in range(SIZE)]
    norm = F.sqrt(z[0] * z[0] + z[1] * z[1] + z[2] * z[2] + z[3] * z[3])
    transforms = {
        "tanh": [F.tanh(x) for x in z],
        "sign": [F.when(norm > 0, x / norm).otherwise(0.0) for x in z],
        "log": [F.signum(x) * F.log1p(F.abs(x)) for x in z],
    }
    # Thousandths again, for sums that do not depend on the order.
    whole = scaled.select("_group", *[
        _thousandths(x).alias(f"_{name}{i}")
        for name, values in transforms.items() for i, x in enumerate(values)
    ])
    sums = whole.groupBy("_group").agg(*[
        F.sum(F.col(f"_{name}{i}").cast("decimal(19,0)") * F.col(f"_{name}{j}")).cast("double")
        .alias(f"_{name}{i}{j}") for name in transforms for i, j in PAIRS
    ])

    def scatter(name: str) -> list[Column]:
        def entry(i: int, j: int) -> Column:
            scale = F.col(f"_s{i}") * F.col(f"_s{j}")
            if i == j:
                return scale
            if name == "none":
                return F.lit(0.0)
            power = F.sqrt(F.col(f"_{name}{i}{i}") * F.col(f"_{name}{j}{j}"))
            # Less than full correlation, so that the matrix has a factor.
            return F.when(power > 0, 0.99 * F.col(f"_{name}{i}{j}") / power).otherwise(0.0) * scale

        return [entry(i, j).alias(f"v{i}{j}") for i, j in PAIRS]

    rows = frame.join(sums, "_group").select("_group", *[f"_c{i}" for i in range(SIZE)], F.explode(
        F.array(*[
            F.struct(F.lit(n).alias("start"), *scatter(name)) for n, name in enumerate(STARTS)
        ])
    ).alias("_m"))
    # Stored, so that Spark knows how small it is and does not deal all vectors by group to join it.
    return materialise(_factored(rows.select(
        "_group", F.col("_m.start").alias("_start"), *[f"_c{i}" for i in range(SIZE)],
        *[F.col(f"_m.v{i}{j}").alias(f"_v{i}{j}") for i, j in PAIRS],
    )), "starts")


def _moments(kept: DataFrame) -> DataFrame:
    """Per group and start the number _n, centre _c* and covariance _v* of its kept rows."""
    sums = kept.groupBy("_group", "_start").agg(
        F.count(F.lit(1)).cast("double").alias("_n"),
        *[F.sum(f).cast("double").alias(f"_s{i}") for i, f in enumerate(FEATURES)],
        *[
            F.sum(F.col(FEATURES[i]).cast("decimal(19,0)") * F.col(FEATURES[j])).cast("double")
            .alias(f"_s{i}{j}") for i, j in PAIRS
        ],
    )
    return sums.select("_group", "_start", "_n", *[
        (F.col(f"_s{i}") / F.col("_n")).alias(f"_c{i}") for i in range(SIZE)
    ], *[
        (F.lit(_consistency(SUPPORT)) * (
            F.col(f"_s{i}{j}") / F.col("_n")
            - F.col(f"_s{i}") / F.col("_n") * (F.col(f"_s{j}") / F.col("_n"))
        ) + F.lit(float(FLOORS[i] ** 2 if i == j else 0))).alias(f"_v{i}{j}") for i, j in PAIRS
    ])


NUMBERS = [*[f"_c{i}" for i in range(SIZE)], *[f"_v{i}{j}" for i, j in PAIRS]]


def _shrunk(moments: DataFrame, above: DataFrame | None) -> DataFrame:
    """The moments with those of the level above (_group, _a*) as ``PRIOR`` further rows."""
    if above is None:
        return moments
    share = F.lit(float(PRIOR)) / (F.col("_n") + PRIOR)
    return moments.join(above, "_group").select("_group", "_start", "_n", *[
        ((1 - share) * F.col(c) + share * F.col(f"_a{c}")).alias(c) for c in NUMBERS
    ])


def _with_distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Add ``_start`` and ``_d2``, the squared Mahalanobis distance; null without an estimate."""
    columns = [*[f"_c{i}" for i in range(SIZE)], *[f"_l{i}{j}" for i, j in PAIRS]]
    joined = rows.join(estimates.select("_group", "_start", *columns), "_group", "left")
    total = None
    for i, feature in enumerate(FEATURES):
        rest = F.col(feature) - F.col(f"_c{i}")
        for k in range(i):
            rest = rest - F.col(f"_l{i}{k}") * F.col(f"_y{k}")
        joined = joined.withColumn(f"_y{i}", rest / F.col(f"_l{i}{i}"))
        square = F.col(f"_y{i}") * F.col(f"_y{i}")
        total = square if total is None else total + square
    return joined.withColumn("_d2", total).select(
        *[f"`{c}`" for c in rows.columns], "_start", "_d2"
    )


def _nearest_share(measured: DataFrame) -> DataFrame:
    """The rows of each group and start in its nearest ``SUPPORT``, whole steps of distance."""
    step = F.when(F.col("_d2") <= 0, F.lit(-500)).otherwise(
        F.greatest(F.lit(-500), F.floor(F.log("_d2") * 32))
    ).cast("int")
    binned = measured.withColumn("_bin", step)
    counts = binned.groupBy("_group", "_start", "_bin").count()
    edge = materialise(
        _at_share(counts, ["_group", "_start"], "_bin", SUPPORT, "_edge"), "edges"
    )
    return binned.join(edge, ["_group", "_start"]).where(F.col("_bin") <= F.col("_edge"))


def estimate_groups(vectors: DataFrame, above: DataFrame | None = None) -> DataFrame:
    """Per ``_group`` of ``vectors`` the centre _c*, covariance _v* and its factor _l*.

    Two concentration steps from every start; the start with the least determinant goes on until it
    falls no more. ``above`` has the estimate of the level above, as _a_c* and _a_v*.
    """
    def stepped(estimates: DataFrame) -> DataFrame:
        near = _nearest_share(_with_distance(vectors, estimates))
        return _factored(_shrunk(_moments(near), above))

    tried = _starts(vectors)
    for step in range(FIRST_STEPS):
        tried = materialise(stepped(tried), f"step{step}")
    names = ["_start", "_n", *NUMBERS, *[f"_l{i}{j}" for i, j in PAIRS]]
    least = F.min(F.struct("_logdet", *names)).alias("_least")
    best = tried.groupBy("_group").agg(least).select("_group", "_least.*")
    for step in range(MOST_STEPS):
        fresh = materialise(stepped(best).withColumn("_fresh", F.lit(True)), "fresh")
        was = best.select("_group", F.col("_logdet").alias("_was"))
        lower = materialise(
            fresh.join(was, "_group").where(F.col("_logdet") < F.col("_was") - 1e-9)
            .select("_group", "_logdet", *names), "lower",
        )
        if lower.isEmpty():
            break
        best = materialise(
            best.join(lower.select("_group"), "_group", "left_anti").select(lower.columns)
            .unionByName(lower), "best",
        )
    return best


def robust_outliers(statistics: DataFrame) -> DataFrame:
    """Add base_failed, distance (squared) and kept.

    Input is the output of ``text_statistics``. Documents that fail the base rules (under 20
    words, or over 30 % of them repeated) take no part in the estimates. Every document is measured
    by the estimate of its language and source; one that fails the base rules, in a language or with
    a source where all do, by that of the level above. The distance is null only if no document
    passes the base rules. Null languages and sources are groups of their own. An empty table gives
    an empty result.
    """
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = materialise(with_vector(statistics).withColumns({
        "base_failed": failed,
        "_pair": F.concat(F.lit("2"), group_key("lang", "source")),
        "_lang": F.concat(F.lit("1"), group_key("lang")), "_every": F.lit("0"),
    }), "statistics")
    passed = rows.where(~F.col("base_failed"))
    known, above, estimates = None, None, []
    for level, over in (("_every", None), ("_lang", "_every"), ("_pair", "_lang")):
        vectors = passed.select(F.col(level).alias("_group"), *FEATURES)
        if over is not None:
            kin = passed.select(F.col(level).alias("_group"), F.col(over).alias("_over")).distinct()
            given = known.select(F.col("_group").alias("_over"), *[
                F.col(c).alias(f"_a{c}") for c in NUMBERS
            ])
            above = materialise(kin.join(given, "_over").drop("_over"), "above")
        known = estimate_groups(vectors, above)
        estimates.append(known)
    found = materialise(
        estimates[0].unionByName(estimates[1]).unionByName(estimates[2]), "estimates"
    )
    levels = {
        name: found.select(F.col("_group").alias(name), F.lit(True).alias(f"_has{name}"))
        for name in ("_pair", "_lang")
    }
    chosen = rows.join(levels["_pair"], "_pair", "left").join(levels["_lang"], "_lang", "left")
    chosen = chosen.withColumn("_group", F.when(F.col("_has_pair"), F.col("_pair")).when(
        F.col("_has_lang"), F.col("_lang")
    ).otherwise(F.col("_every")))
    measured = _with_distance(chosen, found)
    near = F.coalesce(F.col("_d2") <= chi_squared_4(QUANTILE), F.lit(True))
    return measured.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "n_distinct", "base_failed", F.col("_d2").alias("distance"),
        (~F.col("base_failed") & near).alias("kept"),
    )
