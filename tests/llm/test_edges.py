"""Nulls, empty texts, ties, repeated rows, clashing columns and empty tables."""

import hashlib
import zlib
from base64 import b32encode

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from nearstop.llm import (
    chat,
    fingerprints,
    jaccard,
    licences,
    mixing,
    outliers,
    packing,
    secrets,
    toxicity,
    warc,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _row string, size int"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
KEY = "0123456789abcdef0123456789abcdef01234567"
TEXTS = [
    "One two three four five six seven eight nine ten.", None, "", " \n\t",
    f'then token = "{KEY}" follows', "Released under the MIT License.", "word " * 9000,
    "ü" * 50, "One two three four five six seven eight nine ten.",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (n, text, None if n == 1 else "en", None if n == 2 else f"s{n % 3}", len(text or ""), "x", n)
        for n, text in enumerate(TEXTS)
    ]
    return spark.createDataFrame([*rows, rows[0], (None, "a null id", None, "s0", 9, None, 1)], DOCS)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def test_mixing(docs, none):
    plan = mixing.plan_mix(docs, mixing.ranked_schedule()).toPandas()
    assert len(plan) == docs.count() and (plan.taken <= 2 * plan["size"]).all()
    by_source = plan.groupby("source", dropna=False).agg({"taken": "sum", "target": "first"})
    assert (by_source.taken == by_source.target.apply(np.floor)).all()
    mixed = mixing.mix(docs, mixing.ranked_schedule())
    assert mixed.columns == docs.columns
    words = mixed.selectExpr("sum(size(filter(split(text, '[ \\n\\t]+'), w -> w <> '')))").first()[0]
    assert words == plan.taken.sum()
    assert mixing.plan_mix(none, mixing.ranked_schedule()).count() == 0
    assert mixing.mix(none, mixing.ranked_schedule()).count() == 0


def test_positions_follow_the_integral(spark):
    rows = [(n, "w " * 10, "a") for n in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.plan_mix(df, mixing.ranked_schedule(), share=1.0).select(
        F.explode("copies.position")
    ).toPandas()["col"].sort_values().to_numpy()
    # Weight 1.5 - t has the integral 1.5 t - t * t / 2.
    assert np.allclose(1.5 * plan - plan**2 / 2, (np.arange(200) + 0.5) / 200)


def test_fingerprints(docs, none):
    rows = fingerprints.fingerprint_documents(docs).toPandas()
    assert len(rows) == docs.count()
    whole = sorted(((n, t or "") for n, t in enumerate(TEXTS)), reverse=True)
    for at, (n, text) in enumerate(whole[:-2]):
        following, half = whole[at + 1][1], len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        row = rows[rows.doc_id == n].iloc[0]
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.n_chars == len(text)
    assert fingerprints.fingerprint_documents(none).count() == 0


def test_chunks_resist_a_shift():
    text = " ".join(f"word{n * n}" for n in range(3000))
    ours, moved = fingerprints.chunk_set(text), fingerprints.chunk_set("shift " + text)
    assert fingerprints.containment(ours, moved) > 0.98
    assert fingerprints.containment(ours, ours) == 1
    assert "".join(text[a:b] for a, b in zip(
        [0, *fingerprints.boundaries(text.encode())], fingerprints.boundaries(text.encode())
    )) == text


def test_archive(spark):
    pages = spark.createDataFrame(
        [(1, "u\r\n", "same"), (3, "u", "same"), (2, None, "same"), (4, "v", None), (5, "v", ""),
         (6, "w", "a\r\n\r\nWARC/1.1\r\n\r\nü"), (None, "x", "same"), (6, "w", "other")],
        "page_id long, url string, html string",
    ).withColumn("digest", F.lit("clash"))
    rows = warc.archive_pages(pages).collect()
    found = {(r.page_id, r.payload_bytes): r for r in rows}
    assert len(rows) == 8
    assert [found[i, 4].refers_to for i in (1, 2, None)] == [3, 3, 3]
    assert (found[3, 4].record_type, found[1, 4].record_type) == ("response", "revisit")
    assert (found[4, 0].refers_to, found[5, 0].record_type) == (5, "response")
    text = "a\r\n\r\nWARC/1.1\r\n\r\nü".encode()
    assert found[6, len(text)].payload_digest == b32encode(hashlib.sha1(text).digest()).decode()
    assert warc.archive_pages(pages.where("false")).count() == 0


def test_jaccard(docs, none):
    rows = {r.doc_id: r for r in jaccard.similar_components(docs).collect()}
    assert [rows[n].n_shingles for n in (0, 1, 2, 3, 7)] == [6, 0, 0, 0, 1]
    assert [rows[n].component_id for n in (0, 8, 1, 2, 3)] == [0, 0, 1, 2, 3]
    assert jaccard.similar_components(none).count() == 0


@pytest.mark.parametrize("size", [1, 2, 5, 9, 14, 40, 150, 700])
def test_linked_sets_share_a_signature(size):
    rng = np.random.default_rng(size)
    for _ in range(60):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        drop = rng.integers(0, size // 5 + 1)
        add = rng.integers(0, size // 4 + 1)
        b = np.unique(np.concatenate([
            rng.permutation(a)[drop:], rng.integers(0, 2**63, add).astype(np.uint64)
        ]))
        shared = len(np.intersect1d(a, b))
        differ = len(a) + len(b) - 2 * shared
        sketches = [jaccard.parity_sketch(x) for x in (a, b)]
        assert jaccard.sketch_distance(*sketches) <= differ
        if 100 * shared >= 80 * (len(a) + len(b) - shared) and differ:
            assert len(np.intersect1d(jaccard.signatures(a), jaccard.signatures(b)))


def test_star_rows_do_not_grow_with_the_parts(spark):
    rng = np.random.default_rng(11)
    texts = []
    for group in range(6):
        words = [f"w{group}x{n}" for n in range(400)]
        for _ in range(5):
            copy = list(words)
            for n in rng.integers(0, len(copy), 4):
                copy[n] = f"y{rng.integers(10**9)}"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    runs = [
        [(r[0], r[1]) for r in jaccard.candidate_stars(docs, n * jaccard.SIGNATURES).collect()]
        for n in (1, 40)
    ]
    found = [jaccard.signatures(jaccard.shingle_set(text)) for text in texts]
    matched = sum(map(len, found)) - len(np.unique(np.concatenate(found)))
    assert len(runs[0]) == len(runs[1]) == matched > 5000
    assert sorted(runs[0]) == sorted(runs[1])


def test_test_within_the_join_turns_no_link_down(spark):
    rng = np.random.default_rng(5)
    rows = []
    for size in (1, 3, 8, 40, 150, 600, 2500, 8000, 9500):
        for part in (0, 0.05, 0.1, 0.12, 0.2, 0.6):
            a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            cut = int(part * size)
            b = np.unique(np.r_[a[cut:], rng.integers(0, 2**63, cut).astype(np.uint64)])
            wide = [jaccard.parity_sketch(x) for x in (a, b)]
            near = jaccard.may_link(len(a), len(b), jaccard.sketch_distance(*wide))
            exact = max(len(w) for w in wide) <= 8 * jaccard.WIDTH
            small = [jaccard.small_sketch(w) for w in wide]
            assert max(len(s) for s in small) <= jaccard.WIDTH
            rows.append((len(rows), near, exact, (len(a), small[0]), (len(b), small[1])))
    kind = "struct<size: long, small: array<bigint>>"
    found = spark.createDataFrame(
        rows, f"n int, near boolean, exact boolean, a {kind}, b {kind}"
    ).select("near", "exact", F.expr(jaccard.SMALL_TEST).alias("kept")).collect()
    assert {r.near for r in found} == {r.exact for r in found} == {True, False}
    assert all(r.kept for r in found if r.near)
    assert all(r.kept == r.near for r in found if r.exact)


def test_every_pair_with_a_shared_signature_is_met(spark):
    rng = np.random.default_rng(3)
    rows = [
        (n, sorted({int(v) for v in rng.integers(-60, 60, rng.integers(1, 60))}))
        for n in range(40)
    ]
    sets = spark.createDataFrame(rows, "key long, found array<bigint>").selectExpr(
        "key", f"slice(found, 1, {jaccard.LEAST}) AS low", "explode(found) AS signature"
    )
    met = sets.alias("a").join(sets.alias("b"), F.expr(
        f"a.signature = b.signature AND a.key < b.key AND {jaccard.FIRST_SHARED}"
    )).selectExpr("a.key AS x", "b.key AS y").groupBy("x", "y").count().collect()
    shared = {
        (x, y): bool(set(f[:jaccard.LEAST]) & set(g[:jaccard.LEAST]))
        for x, f in rows for y, g in rows if x < y and set(f) & set(g)
    }
    assert {(r["x"], r["y"]) for r in met} == set(shared)
    assert all(r["count"] == 1 for r in met if shared[r["x"], r["y"]])


def test_toxicity(spark):
    rows = [(n, f"some plain text number {n}" + " awful" * (n % 3 == 0)) for n in range(150)]
    df = spark.createDataFrame([*rows, (None, None), (900, "")], "doc_id long, text string")
    labels = df.selectExpr("doc_id", "doc_id % 2 AS odd", "int(doc_id % 3 = 0) AS toxic").where(
        "doc_id < 100"
    )
    found = toxicity.toxic_documents(df, labels, ["odd", "toxic"])
    assert {r.doc_id for r in found.where("toxic").collect()} == set(range(0, 150, 3))
    unlabelled = toxicity.toxic_documents(df, labels.where("false"), ["odd", "toxic"])
    assert unlabelled.where("toxic").count() == 0 and unlabelled.count() == 152


def test_licences(spark, docs, none):
    known = licences.known_licences(spark)
    rows = licences.scan_licences(docs, known)
    assert [r.doc_id for r in rows.where("licence = 'MIT'").collect()] == [5]
    assert rows.count() == docs.count()
    changed = spark.createDataFrame(
        [(1, "Copyright (c) 2020 Somebody\n\nreleased UNDER the MIT   licence"),
         (2, "Some words.\nLicensed under CC BY-NC 4.0.\nMore.")], "doc_id long, text string",
    )
    found = {r.doc_id: (r.licence, r.line_licences) for r in
             licences.scan_licences(changed, known).collect()}
    assert found == {1: ("MIT", "MIT"), 2: (None, "CC-BY-NC-4.0")}
    assert licences.scan_licences(none, known).count() == 0


def test_outliers(docs, none):
    rows = outliers.robust_outliers(outliers.text_statistics(docs))
    by_id = {r.doc_id: r for r in rows.collect()}
    assert rows.count() == docs.count()
    assert (by_id[1].n_words, by_id[6].n_repeat_words, by_id[6].kept) == (0, 9000, False)
    assert outliers.robust_outliers(outliers.text_statistics(none)).count() == 0


def test_secrets(docs, none):
    found = secrets.scan_secrets(docs)
    assert [(r.doc_id, r.start, r.length) for r in found.collect()] == [(4, 14, 40)]
    kept = found.withColumn("is_secret", F.lit(True))
    clean = secrets.redact_secrets(docs, kept)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert clean.where("doc_id = 4").first().text == 'then token = "[SECRET]" follows'
    assert secrets.scan_secrets(none).count() == 0


def test_packing(docs, none):
    rows = packing.pack_documents(docs, TOKENIZER, length=256, keep_ids=True).toPandas()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    for n, text in enumerate(TEXTS):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        own = rows[rows.doc_id == n].sort_values("piece").drop_duplicates("piece")
        assert [i for part in own.ids for i in part] == ids
        first = np.array(ids[:256], dtype="<u4").tobytes()
        assert own.ids_crc32.iloc[0] == zlib.crc32(first)
    placed = rows.sort_values(["sequence_id", "offset"])
    ends = placed.groupby("sequence_id").length.cumsum()
    assert (ends - placed.length == placed.offset).all() and ends.max() <= 256
    assert packing.pack_documents(none, TOKENIZER).count() == 0


def test_local_search_empties_bins():
    sizes = np.array([6, 6, 4, 4, 5, 5])
    bins = packing.local_search(sizes, np.arange(6), 10)
    assert len(set(bins)) == 3
    assert np.bincount(bins, weights=sizes).max() <= 10


def test_chats(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"),
         (2, 0, "assistant", "d"), (2, 1, None, None), (None, 0, "system", "e")],
        "conv_id long, turn long, role string, text string",
    ).withColumn("place", F.lit("clash"))
    rows = chat.repair_chats(turns).orderBy("conv_id", "place").collect()
    text = {}
    for r in rows:
        text[r.conv_id] = text.get(r.conv_id, "") + r.rendered
    assert text[1] == "<|user|>\na\nb<|end|>\n<|assistant|>\nc<|end|>\n"
    assert text[None] == (
        "<|system|>\ne<|end|>\n<|user|>\n<|end|>\n<|assistant|>\n<|end|>\n"
    )
    assert len(rows) == 6 and chat.repair_chats(turns.where("false")).count() == 0


def test_long_chat_is_cut_without_loss(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(7, n, str(r), "t") for n, r in enumerate(rng.choice(["user", "assistant"], 300))]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole, total = chat._path([r[2] for r in rows], chat.START, None)
    monkeypatch.setattr(chat, "STRETCH", 16)
    found = chat.repair_chats(turns).orderBy("place").collect()
    assert [r.place for r in found] == list(range(300))
    assert {r.total_cost for r in found} == {total} and len(whole) == 300


def test_toxicity_leaves_columns_alone(spark):
    rows = [(n, f"plain text {n}" + " awful" * (n % 3 == 0), n, "w", "t", 0.5) for n in range(120)]
    df = spark.createDataFrame(
        rows, "doc_id long, text string, _x long, _words string, toxic string, p_toxic double"
    ).withColumn("_doc", F.lit(7))
    labels = df.selectExpr("doc_id", "doc_id % 2 AS odd", "int(doc_id % 3 = 0) AS toxic")
    found = toxicity.toxic_documents(df, labels, ["odd", "toxic"])
    assert found.columns == [
        "doc_id", "text", "_x", "_words", "given_toxic", "given_p_toxic", "_doc", "p_odd", "p_toxic",
        "toxic",
    ]
    kept = found.where("toxic").collect()
    assert {r.doc_id for r in kept} == set(range(0, 120, 3))
    assert {(r._words, r.given_toxic, r.given_p_toxic, r._doc) for r in kept} == {("w", "t", 0.5, 7)}
    assert all(r._x == r.doc_id for r in kept)


@pytest.mark.parametrize("bound", [1, 4000, 1 << 20])
def test_archive_files_are_bounded_by_bytes(spark, tmp_path, bound):
    import gzip

    pages = spark.createDataFrame(
        [(n, f"u{n}", "é\r\n\r\n" * (n % 40 * 30)) for n in range(200)] + [(500, "u", "x" * 90_000)],
        "page_id long, url string, html string",
    ).coalesce(2)
    records = warc.page_records(pages)
    warc.write_warc(records, str(tmp_path / "w"), bound)
    sizes = [len(gzip.open(f).read()) for f in (tmp_path / "w").glob("*.gz")]
    largest = max(len(r.header) + len(r.body) for r in records.collect()) + 4
    assert max(sizes) <= max(bound + 4, largest) and len(sizes) >= sum(sizes) // max(bound, largest)
    back = warc.read_warc(spark, str(tmp_path / "w")).select("header").collect()
    assert sorted(r.header for r in back) == sorted(r.header for r in records.collect())
    assert warc.archive_pages(pages).count() == 201


def test_buckets_on_several_levels_change_nothing(spark, monkeypatch):
    rows = [(n if n % 5 else None, "w " * (n % 17), f"s{n % 3}") for n in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")

    def plan():
        found = mixing.plan_mix(df, mixing.ranked_schedule())
        return sorted(map(str, found.select("doc_id", "size", "target", "taken", "copies").collect()))

    wanted = plan()
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 2)
    for digits in (1, 2):
        monkeypatch.setattr(mixing, "LEVEL_DIGITS", digits)
        assert plan() == wanted
