"""Secret scans: candidates by pattern, false positives removed by a random forest.

Everything runs in SQL functions and the forest of Spark's ML library. The forest sees the length
of a candidate, its character transitions, how much of it the corpus's own words cover, the path
and the neighbouring words. It is trained from labelled findings.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearstop.llm.common import WEIGHT, sample_by_label
from nearstop.scratch import materialise

#: Characters of keys and digests; "=" only pads their end.
RUN = r"[A-Za-z0-9+/_-]"
LONG = rf"(?=[+/_-]*+[A-Za-z0-9]){RUN}{{16,}}+(?:={{1,2}}(?![A-Za-z0-9+/_=-]))?"
SECRET_NAME = (
    r"(?i:token|secret|(?:api|access|private)[_-]?key|passw(?:or)?d|pwd|auth(?!or(?!i[sz]))|credential"
    r"|bearer)"
)
SCHEME = r"(?:(?i:bearer|basic)[ \t]+)?+"
#: A name of secrets up to the value that is assigned to it on the same line.
LEAD = (
    rf"{RUN}*{SECRET_NAME}[\w-]*+[\"'`\])]*+[ \t]*+(?::=|={{1,3}}>?|:)[ \t]*+[\"'`]?+{SCHEME}"
)
#: What ends no value: a mark after it belongs to the text around.
MARKS = r",;.:!?)\]}\"'`"
#: A quoted value ends with its quote, another one at a space, the next parameter or a tag. All
#: repetitions are possessive, so neither the length of a value nor its escapes are bounded.
VALUE = "(?:" + "|".join(
    rf"(?<={q})[^{q}\\\r\n]*+(?:\\.[^{q}\\\r\n]*+)*+(?<!{q})" for q in "\"'`"
) + (
    rf"|(?<![\"'`])(?=[^\s&<=\"'`])(?:[{MARKS}]*+"
    rf"(?:[^\s&<{MARKS}]++|&(?![\w.%-]+=)|<(?!/?[A-Za-z][\w-]*[\s/>])))++)"
)
#: Any value assigned to a name of secrets, else a run of 16 or more characters.
CANDIDATE = rf"(?<!{RUN})(?:{LEAD}{VALUE}|{LONG})"
#: Characters of context kept on each side of a candidate.
CONTEXT = 80
#: Bound on the labelled findings that the forest is trained on, chosen by a hash.
TRAINING_ROWS = 20_000
TREES, DEPTH, SEED = 20, 6, 17
#: A word of the corpus counts as known from this many uses on.
KNOWN_USES = 5
LEAST_RUN = 3
THRESHOLD = 0.5
MASK = "[SECRET]"
#: From this length on a secret is no part of ordinary words.
LEAST_EVERYWHERE = 16

#: Letters, then one place for all digits and one for anything else.
ALPHABET = "abcdefghijklmnopqrstuvwxyz"
PLACES = len(ALPHABET) + 2

NAMED = SECRET_NAME + r"[\p{L}\p{N}_-]*[^\p{L}\p{N}_]*(?:(?i:basic)\s+)?$"
ASSIGNED = r"[:=]>?\s*[\"'`]?(?:(?i:bearer|basic)\s+)?$"
#: Words that mark a value as made up; parts of host names and addresses do not count.
PLACEHOLDER = r"(?i)(?<![\w.@-])(?:example|sample|dummy|placeholder|test|fake|your|xxx+)(?![\w.@-])"
#: The same within a value, where anything but letters parts words; test keys of services are keys.
PLACEHOLDER_TOKEN = (
    r"(?i)(?<![a-z])(?<![sp]k_)(?:example|sample|dummy|placeholder|test|fake|your|changeme|xxx+)"
    r"(?![a-z])"
)

FEATURES = [
    "_length", "_changes", "_surprise", "_covered", "_digits", "_distinct", "_path", "_path_example",
    "_named", "_assigned", "_placeholder", "_placeholder_token", "_quoted", "_word_before", "_word_after",
]


def find_candidates(documents: DataFrame, path: str) -> DataFrame:
    """One row per candidate: doc_id, path, start, token, before and after (nearby text).

    The text is split at its matches, so the parts between them give places and neighbours. A match
    with a name is its value; a name that may be a key itself, as a padded one, is a candidate too.
    """
    found = documents.select(
        "doc_id", F.col(f"`{path}`").alias("path"), "text",
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("_matches"),
    ).where(F.size("_matches") > 0).withColumn("_between", F.split("text", CANDIDATE))
    rows = found.select(
        "doc_id", "path", "_between", "_matches", F.posexplode("_matches").alias("_n", "_match")
    )
    place = F.aggregate(
        F.concat(F.expr("slice(_between, 1, _n + 1)"), F.expr("slice(_matches, 1, _n)")),
        F.lit(0).cast("long"), lambda a, part: a + F.length(part),
    )
    lead = F.regexp_extract("_match", f"^{LEAD}", 0)
    rows = rows.select(
        "doc_id", "path", place.alias("_place"), "_match",
        # A run whose padding looks like an assignment has nothing after it.
        F.when(F.length(lead) < F.length("_match"), lead).otherwise("").alias("_lead"),
        F.concat_ws("", F.get("_between", F.col("_n") - 1), F.get("_matches", F.col("_n") - 1),
                    F.get("_between", F.col("_n"))).alias("_left"),
        F.concat_ws("", F.get("_between", F.col("_n") + 1), F.get("_matches", F.col("_n") + 1))
        .alias("_right"),
    )
    name = F.when(F.col("_lead") != "", F.regexp_extract("_match", f"^{LONG}", 0)).otherwise("")

    def part(start: Column, token: Column) -> Column:
        return F.struct(start.cast("int").alias("at"), token.alias("token"))

    value = part(F.length("_lead"), F.expr("substring(_match, length(_lead) + 1)"))
    parts = F.filter(F.array(value, part(F.lit(0), name)), lambda p: p.token != "")
    return rows.withColumn("_part", F.explode(parts)).select(
        "doc_id", "path", (F.col("_place") + F.col("_part.at")).alias("start"),
        F.col("_part.token").alias("token"),
        F.expr(f"right(concat(_left, left(_match, _part.at)), {CONTEXT})").alias("before"),
        F.expr(
            f"left(concat(substring(_match, _part.at + length(_part.token) + 1), _right), {CONTEXT})"
        ).alias("after"),
    )


def corpus_words(documents: DataFrame) -> DataFrame:
    """All lower-case runs of two or more letters and digits of all texts with their uses."""
    parts = F.split(F.lower(F.col("text")), "[^a-z0-9]+")
    return documents.select(F.explode(parts).alias("word")).where(
        F.length("word") >= 2
    ).groupBy("word").agg(F.count(F.lit(1)).alias("uses"))


def _place(character: Column) -> Column:
    """The place of a character in the alphabet; digits share one, all others another."""
    letter = F.instr(F.lit(ALPHABET), character) - 1
    return F.when(letter >= 0, letter).when(
        character.between("0", "9"), len(ALPHABET)
    ).otherwise(len(ALPHABET) + 1)


def _pairs(text: Column) -> Column:
    """The transitions of a text as places in a square table."""
    return F.transform(F.sequence(F.lit(1), F.length(text) - 1), lambda i: (
        _place(F.substring(text, i, F.lit(1))) * PLACES
        + _place(F.substring(text, i + 1, F.lit(1)))
    ).cast("int"))


def transition_table(words: DataFrame) -> DataFrame:
    """One row: the surprise (negative log probability) of each transition, learnt from all words.

    The table has ``PLACES`` squared entries, whatever the corpus.
    """
    spark = words.sparkSession
    counts = words.select("uses", F.explode(_pairs(F.col("word"))).alias("_pair")).groupBy(
        "_pair"
    ).agg(F.sum("uses").alias("_uses"))
    every = spark.range(PLACES * PLACES).select(F.col("id").cast("int").alias("_pair"))
    full = every.join(counts, "_pair", "left").select(
        "_pair", F.floor(F.col("_pair") / PLACES).alias("_first"),
        (F.coalesce("_uses", F.lit(0)) + 1).alias("_uses"),
    )
    totals = full.groupBy("_first").agg(F.sum("_uses").alias("_all"))
    return full.join(totals, "_first").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("_pair", (-F.log(F.col("_uses") / F.col("_all"))).alias("s")))),
        lambda e: e.s,
    ).alias("_table"))


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def with_features(findings: DataFrame, words: DataFrame) -> DataFrame:
    """Add the features. ``findings`` needs _nr (unique), token, path, before and after."""
    token = F.col("token")
    runs = findings.select("_nr", F.explode(F.split(F.lower(token), "[^a-z]+")).alias("word")).where(
        F.length("word") >= LEAST_RUN
    )
    known = words.where(F.col("uses") >= KNOWN_USES).select("word")
    covered = runs.join(known, "word").groupBy("_nr").agg(
        F.sum(F.length("word")).alias("_covered_chars")
    )
    table = transition_table(words)
    pairs = F.when(F.length(token) > 1, _pairs(F.lower(token))).otherwise(
        F.array().cast("array<int>")
    )
    length = F.length(token)
    changes = F.regexp_count(token, F.lit("(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]"))
    letters = F.split(token, "")
    word = r"[\p{L}\p{N}_]+"
    before_word = F.element_at(F.regexp_extract_all("before", F.lit(word), F.lit(0)), -1)
    after_word = F.get(F.regexp_extract_all("after", F.lit(word), F.lit(0)), F.lit(0))

    def bucket(value: Column) -> Column:
        return F.pmod(F.xxhash64(F.lower(value)), F.lit(32)).cast("double")

    named = F.when(F.size(F.regexp_extract_all("before", F.lit(word), F.lit(0))) > 0, before_word)
    # The table of transitions is one row of a fixed size.
    rows = findings.join(covered, "_nr", "left").join(F.broadcast(table))
    return rows.select(
        *[F.col(c) for c in findings.columns],
        length.cast("double").alias("_length"),
        (changes / length).alias("_changes"),
        (F.aggregate(pairs, F.lit(0.0), lambda a, p: a + F.get("_table", p)) / length)
        .alias("_surprise"),
        (F.coalesce("_covered_chars", F.lit(0)) / length).alias("_covered"),
        (F.regexp_count(token, F.lit("[0-9]")) / length).alias("_digits"),
        (F.size(F.array_distinct(letters)) / length).alias("_distinct"),
        F.coalesce(bucket(F.col("path")), F.lit(-1.0)).alias("_path"),
        _flag(F.col("path").rlike(PLACEHOLDER)).alias("_path_example"),
        _flag(F.col("before").rlike(NAMED)).alias("_named"),
        _flag(F.col("before").rlike(ASSIGNED)).alias("_assigned"),
        _flag(F.concat_ws(" ", "before", "after").rlike(PLACEHOLDER)).alias("_placeholder"),
        _flag(token.rlike(PLACEHOLDER_TOKEN)).alias("_placeholder_token"),
        _flag(F.col("before").rlike("[\"']$")).alias("_quoted"),
        F.coalesce(bucket(named), F.lit(-1.0)).alias("_word_before"),
        F.coalesce(bucket(after_word), F.lit(-1.0)).alias("_word_after"),
    )


def reviewed(findings: DataFrame) -> DataFrame:
    """Add ``label`` to findings that two independent signs agree on, null for the rest.

    A secret is a token of several kinds of characters that is assigned to a name of secrets,
    without a placeholder near it. A false positive holds a placeholder itself or, unless it is
    assigned to a name of secrets, is a number, has no digit for every eight characters, has a
    placeholder near it or is neither assigned nor named. For use where nobody has labelled
    findings.
    """
    own = (F.col("_named") == 1) & (F.col("_assigned") == 1)
    secret = (
        own & (F.col("_placeholder") == 0) & (F.col("_placeholder_token") == 0)
        & (F.col("_digits") < 0.95) & (F.col("_digits") > 0.1) & (F.col("_covered") < 0.3)
    )
    other = (F.col("_digits") == 1) | (F.col("_digits") < 0.125) | (F.col("_placeholder") == 1) | (
        (F.col("_named") == 0) & (F.col("_assigned") == 0)
    )
    harmless = (F.col("_placeholder_token") == 1) | (~own & other)
    return findings.withColumn("label", F.when(secret, 1.0).when(harmless, 0.0))


def train_forest(labelled: DataFrame, rows: int = TRAINING_ROWS):
    """A forest from findings with features, ``token`` and ``label``; a number if all are alike.

    At most about ``rows`` labelled findings are used, chosen by a hash of the token and its place:
    up to half of them of each label, which weigh as much as all findings with that label.
    """
    known = sample_by_label(
        labelled.where("label IS NOT NULL"), ["label"], rows, ["token", "doc_id", "start"]
    )
    table = materialise(known.select(*FEATURES, "label", WEIGHT).coalesce(4), "findings")
    kinds = [row["label"] for row in table.select("label").distinct().limit(2).collect()]
    if len(kinds) < 2:
        return kinds[0] if kinds else 0.0
    inputs = VectorAssembler(inputCols=FEATURES, outputCol="_in").transform(table)
    return RandomForestClassifier(
        featuresCol="_in", labelCol="label", weightCol=WEIGHT, numTrees=TREES, maxDepth=DEPTH, seed=SEED,
        probabilityCol="_p", rawPredictionCol="_raw", predictionCol="_y",
    ).fit(inputs)


def with_probability(findings: DataFrame, forest) -> DataFrame:
    """Add ``probability`` of being a secret to findings with features."""
    if not isinstance(forest, RandomForestClassificationModel):
        return findings.withColumn("probability", F.lit(float(forest)))
    inputs = VectorAssembler(inputCols=FEATURES, outputCol="_in").transform(findings)
    scored = forest.transform(inputs)
    return scored.withColumn("probability", F.round(vector_to_array("_p")[1], 6)).drop(
        "_in", "_p", "_raw", "_y"
    )


def scan_secrets(
    documents: DataFrame, path: str = "source", labelled: DataFrame | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Candidates of all ``documents`` (doc_id, text and a path column) with the forest's verdict.

    One row per candidate: doc_id, path, start (code points before it), length, token, digest
    (SHA-256), probability, is_secret. ``labelled`` has doc_id, start and label (0 or 1) of
    reviewed findings; without it ``reviewed`` labels them. If all labels agree, that label is the
    verdict; without any, nothing is a secret. Null and empty texts have no candidates, a null path
    is a path of its own; rows that share an id are scanned one by one. An empty table gives an
    empty result. All words of all documents make up the dictionary.
    """
    findings = materialise(find_candidates(documents, path).withColumn(
        "_nr", F.monotonically_increasing_id()
    ), "candidates")
    words = materialise(corpus_words(documents), "words")
    rows = materialise(with_features(findings, words), "features")
    if labelled is None:
        known = reviewed(rows)
    else:
        known = rows.join(labelled.select("doc_id", "start", "label"), ["doc_id", "start"])
    judged = with_probability(rows, train_forest(known))
    return judged.select(
        "doc_id", "path", "start", F.length("token").cast("long").alias("length"), "token",
        F.sha2("token", 256).alias("digest"), "probability",
        (F.col("probability") >= threshold).alias("is_secret"),
    )


def _masked(text: Column, found: Column) -> Column:
    """The text with the found places masked; places that overlap get one mask.

    The pieces between the places are cut out of the text once each.
    """
    def step(seen: Column, place: Column) -> Column:
        end = (place.start + F.length(place.token)).cast("int")
        piece = F.substring(text, seen.end + 1, place.start.cast("int") - seen.end)
        return F.struct(
            F.greatest(seen.end, end).alias("end"),
            F.when(place.start >= seen.end, F.concat(seen.pieces, F.array(piece)))
            .otherwise(seen.pieces).alias("pieces"),
        )

    # Another row of the same id may have another text.
    here = F.filter(found, lambda p: F.substring(
        text, p.start.cast("int") + 1, F.length(p.token)
    ) == p.token)
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("pieces"))
    return F.aggregate(here, start, step, lambda seen: F.array_join(F.concat(
        seen.pieces, F.array(F.substring(text, seen.end + 1, F.length(text)))
    ), MASK))


def redact_secrets(documents: DataFrame, findings: DataFrame) -> DataFrame:
    """The documents with every confirmed secret replaced by a mask; n_chars follows the text.

    A secret of ``LEAST_EVERYWHERE`` characters goes wherever it stands in its document. All columns
    of the documents come back, whatever their names.
    """
    secrets = findings.where("is_secret").groupBy(F.col("doc_id").alias("_id")).agg(
        F.sort_array(F.collect_set(F.struct("start", "token"))).alias("_found")
    )
    secrets = materialise(secrets, "secrets")
    # The document travels as one column, so no name of its columns can clash.
    whole = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_doc"))
    joined = whole.join(secrets, F.col("_doc.doc_id").eqNullSafe(F.col("_id")), "left")
    long = F.array_sort(F.array_distinct(F.filter(
        F.col("_found.token"), lambda t: F.length(t) >= LEAST_EVERYWHERE
    )), lambda a, b: F.length(b) - F.length(a))
    # A text is only written anew for secrets that it still holds.
    clean = F.aggregate(long, _masked(F.col("_doc.text"), F.col("_found")), lambda text, token: (
        F.when(F.contains(text, token), F.replace(text, token, F.lit(MASK))).otherwise(text)
    ))
    rows = joined.withColumn(
        "_text", F.when(F.col("_found").isNull(), F.col("_doc.text")).otherwise(clean)
    )
    changed = {"text": F.col("_text")}
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        changed["n_chars"] = F.when(
            F.col("_found").isNull(), F.col("_doc.n_chars")
        ).otherwise(F.length("_text").cast(kind))
    return rows.select(*[
        changed.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in documents.columns
    ])
