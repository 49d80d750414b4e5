"""Distances and verdicts against numpy, base statistics against plain Python."""

import math
import random
import re

import numpy as np
import pytest

from nearstop.llm import outliers as o

SCHEMA = "doc_id long, text string, lang string, source string"


def statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    places = {}
    for n in range(len(words) - 7):
        places.setdefault(tuple(words[n:n + 8]), []).append(n)
    covered = {n + m for found in places.values() if len(found) > 1 for n in found for m in range(8)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered),
        len(set(words)),
    )


def thousandths(value):
    # Half up, as Spark rounds.
    return math.floor(abs(value) * 1000 + 0.5) * (1 if value >= 0 else -1)


def vector(found):
    words, chars, symbols, _, _, distinct = found
    n = max(words, 1)
    return [thousandths(v) for v in (
        math.log(n), math.log(max(chars, 1) / n), math.log1p(100 * symbols / n),
        math.log(n / max(distinct, 1)),
    )]


def lower_median(values):
    return sorted(values)[math.ceil(len(values) / 2) - 1]


def distances(x, centre, matrix):
    y = np.linalg.solve(np.linalg.cholesky(matrix), (x - centre).T)
    return (y * y).sum(axis=0)


def estimate(x, above):
    """Centre, covariance and determinant of a group, with the estimate of the level above."""
    floors = np.array(o.FLOORS, dtype=float)
    centre = np.array([lower_median(c) for c in x.T], dtype=float)
    mad = np.array([lower_median(np.abs(c - m)) for c, m in zip(x.T, centre, strict=True)])
    scale = np.sqrt((1.4826 * mad) ** 2 + floors ** 2)
    z = (x - centre) / scale
    norm = np.sqrt((z * z).sum(axis=1, keepdims=True))
    transforms = [np.tanh(z), np.divide(z, norm, out=np.zeros_like(z), where=norm > 0),
                  np.sign(z) * np.log1p(np.abs(z))]
    starts = [np.diag(scale ** 2)]
    for t in transforms:
        t = np.array([[thousandths(v) for v in row] for row in t], dtype=float)
        sums = t.T @ t
        power = np.sqrt(np.outer(np.diag(sums), np.diag(sums)))
        part = np.divide(0.99 * sums, power, out=np.zeros_like(sums), where=power > 0)
        np.fill_diagonal(part, 1.0)
        starts.append(part * np.outer(scale, scale))

    def step(centre, matrix):
        d2 = distances(x, centre, matrix)
        bins = np.array([-500 if d <= 0 else max(-500, math.floor(math.log(d) * 32)) for d in d2])
        edge = sorted(bins)[math.ceil(o.SUPPORT * len(bins)) - 1]
        kept = x[bins <= edge]
        centre = kept.mean(axis=0)
        matrix = o._consistency(o.SUPPORT) * np.cov(kept.T, bias=True).reshape(4, 4)
        matrix = matrix + np.diag(floors ** 2)
        if above is not None:
            share = o.PRIOR / (len(kept) + o.PRIOR)
            centre = (1 - share) * centre + share * above[0]
            matrix = (1 - share) * matrix + share * above[1]
        return centre, matrix, np.linalg.slogdet(matrix)[1]

    tried = []
    for start in starts:
        found = (centre, start, 0)
        for _ in range(o.FIRST_STEPS):
            found = step(*found[:2])
        tried.append(found)
    best = min(tried, key=lambda t: t[2])
    while True:
        fresh = step(*best[:2])
        if fresh[2] >= best[2] - 1e-9:
            return best
        best = fresh


def expected(rows):
    found = [statistics(text) for _, text, _, _ in rows]
    passed = [n for n, f in enumerate(found) if f[0] >= 20 and 100 * f[4] <= 30 * f[0]]
    x = np.array([vector(f) for f in found], dtype=float)
    known = {}
    for size in (0, 1, 2):
        groups = {}
        for n in passed:
            groups.setdefault(rows[n][2:2 + size], []).append(n)
        for key, members in groups.items():
            known[key] = estimate(x[members], known.get(key[:-1]) if key else None)
    out = {}
    for n, (doc_id, _, lang, source) in enumerate(rows):
        key = next((k for k in ((lang, source), (lang,), ()) if k in known), None)
        d2 = None if key is None else float(distances(x[n:n + 1], *known[key][:2])[0])
        out[doc_id] = (found[n], n not in passed, d2)
    return out


def prose(chance, words, junk=0.0, letters="aeinrst"):
    vocabulary = ["".join(chance.choices(letters, k=chance.randrange(2, 9))) for _ in range(900)]
    out = [
        chance.choice(vocabulary) + ("#" if chance.random() < junk else "") for _ in range(words)
    ]
    return "".join(w + chance.choice("  \n \t") for w in out)


def corpus(seed, count, lang="en"):
    chance = random.Random(seed)
    rows = []
    for n in range(count):
        source = chance.choice(["a", "a", "b", None])
        text = prose(chance, int(chance.lognormvariate(5, 0.6)) + 20, chance.choice([0, 0, 0.01]))
        rows.append((n, text, lang, source))
    return rows


@pytest.fixture(scope="module")
def rows():
    chance = random.Random(5)
    out = corpus(1, 260) + [(1000 + n, t, "de", s) for n, t, _, s in corpus(2, 40)]
    out += [(2000, prose(chance, 60), "fr", "z"), (2001, prose(chance, 40), None, None)]
    out += [(3000, "#|% " * 900, "en", "a"), (3001, "", "xx", "a"), (3002, None, "de", "q"),
            (3003, "one two three four five six seven eight " * 9, "en", "a"),
            (3004, " ".join(f"w{n}" + "x" * 80 + "###$$$" for n in range(400)), "de", "b"),
            (3005, "same line here\n" * 2 + "\x0b\n\n" + prose(chance, 50), "en", "b")]
    return out


def test_equals_numpy(spark, rows):
    found = o.robust_outliers(o.text_statistics(spark.createDataFrame(rows, SCHEMA))).collect()
    wanted = expected(rows)
    assert len(found) == len(rows)
    cut = o.chi_squared_4(o.QUANTILE)
    for r in found:
        stats, failed, d2 = wanted[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.n_distinct) == stats
        assert r.base_failed == failed and r.distance == pytest.approx(d2, rel=1e-6, abs=1e-9)
        assert r.kept == (not failed and d2 <= cut)
    kept = {r.doc_id: r.kept for r in found}
    assert not kept[3004] and kept[2000] and kept[2001] and sum(kept.values()) > 290


@pytest.mark.parametrize("count", [98, 99, 100, 101])
def test_one_row_more_changes_no_verdict(spark, count):
    odd = " ".join(f"w{n}" + "x" * 200 + "###$$$" for n in range(5000))
    rows = [(n, t, "es", s) for n, t, _, s in corpus(3, count - 1)] + [(9999, odd, "es", "a")]
    found = o.robust_outliers(o.text_statistics(spark.createDataFrame(rows, SCHEMA)))
    assert [r.doc_id for r in found.where("NOT kept").collect()] == [9999]
    assert found.where("distance IS NULL").count() == 0


def test_no_document_passes(spark):
    rows = [(1, "too short", "en", "a"), (2, None, None, None)]
    found = o.robust_outliers(o.text_statistics(spark.createDataFrame(rows, SCHEMA))).collect()
    assert [(r.kept, r.distance) for r in found] == [(False, None)] * 2
    none = spark.createDataFrame([], SCHEMA)
    assert o.robust_outliers(o.text_statistics(none)).count() == 0
