"""Each stage of the pipeline against plain Python, and held-out accuracy of the classifiers."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from nearstop.llm import mixing, queries, toxicity
from tests.compare import FOLDER

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEY = "4f9d8a7b6c5d4e3f2a1b"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """240 documents: every fifth toxic, some near copies, some with a secret."""
    chance, folder = random.Random(9), str(tmp_path_factory.mktemp("sf"))
    vocabulary = ["".join(chance.choices("abcdefgh", k=5)) for _ in range(300)]
    rows, labels = [], []
    for n in range(240):
        words = chance.choices(vocabulary, k=chance.randrange(30, 120))
        if n % 5 == 0:
            words = [w for word in words for w in (word, chance.choice(["awful", "hateful"]))]
        if n % 16 == 7:
            words = rows[n - 3][1].split()[:-2] + ["other"]
        if n % 12 == 1:
            words += ["password", "=", f'"{KEY}{n:04}"']
        rows.append((n, " ".join(words), "en", chance.choice(["a", "b", None]), 0))
        labels.append((n, 1, int(n % 5 == 0)))
    rows = [(*r[:4], len(r[1])) for r in rows] + [(500, None, None, None, 0), (501, "", "en", "b", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels[:160], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.fixture(scope="module")
def stages(spark, folder):
    """What goes into each stage and what comes out, as lists of rows."""
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{folder}/stage{n}"
        stage(spark, docs, folder).write.parquet(path)
        out = spark.read.parquet(path)
        found.append((name, docs.collect(), out.collect(), out.columns))
        docs = out
    return found


def test_columns(stages):
    assert all(columns == COLUMNS for _, _, _, columns in stages[:-1])


def test_toxic_documents_go(stages):
    _, before, after, _ = stages[0]
    toxic = {r.doc_id for r in before if re.search("awful|hateful", r.text or "")}
    assert {r.doc_id for r in after} == {r.doc_id for r in before} - toxic
    assert sorted(map(str, after)) == sorted(str(r) for r in before if r.doc_id not in toxic)


def test_one_of_each_group_stays(stages):
    _, before, after, _ = stages[1]
    sets = {}
    for r in before:
        words = [w.lower() for w in WORD.findall(r.text or "")]
        size = min(5, len(words))
        sets[r.doc_id] = {tuple(words[n:n + size]) for n in range(len(words) - size + 1)} if words else set()
    root = {n: n for n in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {n: new if r == old else r for n, r in root.items()}
    assert len(set(root.values())) < len(root)
    assert sorted(map(str, after)) == sorted(str(r) for r in before if root[r.doc_id] == r.doc_id)


def test_secrets_are_masked(stages):
    _, before, after, _ = stages[2]
    wanted = {
        r.doc_id: r.text and re.sub(rf"{KEY}[0-9]{{4}}", "[SECRET]", r.text) for r in before
    }
    assert any(t and "[SECRET]" in t for t in wanted.values())
    assert {r.doc_id: r.text for r in after} == wanted
    assert all(r.n_chars == len(r.text or "") for r in after) and len(after) == len(before)


def targets(sizes):
    """The target of each source, by raising the common level until no further source is full."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(names)}
    demand, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = demand - sum(2 * sizes[s] for s in full)
        level = rest / max(1, sum(weight[s] for s in names if s not in full))
        more = {s for s in names if s not in full and level * weight[s] >= 2 * sizes[s]}
        if not more:
            return {s: 2.0 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= more


def test_the_mix_meets_its_targets(spark, stages):
    _, before, after, _ = stages[3]
    sizes, taken, copies = {}, {}, {}
    size = {r.doc_id: len(WORD.findall(r.text or "")) for r in before}
    for r in before:
        sizes[r.source] = sizes.get(r.source, 0) + size[r.doc_id]
    text = {r.doc_id: r.text for r in before}
    for r in after:
        words = WORD.findall(r.text)
        taken[r.source] = taken.get(r.source, 0) + len(words)
        copies.setdefault(r.doc_id, []).append(len(words))
        assert r.text == text[r.doc_id] or words == WORD.findall(text[r.doc_id])[:len(words)]
        assert r.n_chars == len(r.text)
    wanted = targets(sizes)
    assert {s: int(t) for s, t in wanted.items() if int(t)} == taken
    assert all(len(c) <= 2 and sum(c) <= 2 * size[n] for n, c in copies.items())
    # Each source but the cut copies takes whole documents, as often as its target asks.
    assert sum(sum(x < size[n] for x in c) for n, c in copies.items()) <= len(wanted)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_equal_plain_python(spark, seed):
    chance = random.Random(seed)
    names = [f"s{n:02}" for n in range(24)] + [None, "", "Z", "ü"]
    rows = [
        (n, "w " * int(2 ** chance.uniform(0, 10)), chance.choice(names)) for n in range(300)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    wanted = targets(sizes)
    found = mixing.plan_mix(df, mixing.ranked_schedule()).select(
        "source", "target", "source_size", "taken"
    ).collect()
    taken = {}
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(wanted[r.source], rel=1e-12)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - wanted[s]) < 1 for s in taken)


def test_pieces_are_packed(stages):
    _, before, after, _ = stages[4]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = sorted(
        (r.doc_id, n // 4096, n, min(4096, len(ids) - n),
         zlib.crc32(np.array(ids[n:n + 4096], dtype="<u4").tobytes()))
        for r in before
        for ids in [tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]]
        for n in range(0, len(ids), 4096)
    )
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in after) == wanted
    sequences = {}
    for r in after:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        ends = np.cumsum([length for _, length in sorted(parts)])
        assert [offset for offset, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 4096
    assert len(sequences) == -(-sum(r.length for r in after) // 4096)


def test_run_is_the_stages_in_order(spark, folder, stages):
    found = corpus_pipeline.run(spark, folder)
    ids = sorted((r.doc_id, r.piece, r.ids_crc32) for r in found.collect())
    assert ids == sorted((r.doc_id, r.piece, r.ids_crc32) for r in stages[4][2])


def test_held_out_accuracy_of_the_chain(spark):
    sf = str(FOLDER / "sf0.1")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = queries.toxicity_labels(spark, sf).withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2)))
    said = toxicity.toxic_documents(
        docs, labels.where("half = 0").drop("half"), queries.CATEGORIES
    ).select("doc_id", F.col("toxic").alias("said"))
    found = said.join(labels.where("half = 1"), "doc_id").groupBy("toxic", "said").count().collect()
    n = {(r.toxic, r.said): r["count"] for r in found}
    assert n[1, True] >= 4 * n.get((1, False), 0) and n.get((0, True), 0) <= 0.01 * n[0, False]
