"""The most similar text against a comparison of all pairs."""

import random

import pytest

from nearstop.operators.geocode import coordinates_of
from nearstop.operators.spelling import best_spellings

SCHEMA = "g string, t string, gram int"


def distance(a, b):
    row = list(range(len(b) + 1))
    for n, x in enumerate(a, 1):
        row, above = [n], row
        for m, y in enumerate(b, 1):
            row.append(min(above[m] + 1, row[-1] + 1, above[m - 1] + (x != y)))
    return row[-1]


def brute(asked, known, slips):
    out = set()
    for g, t in {r[:2] for r in asked}:
        near = [
            (distance(t, m), m.encode()) for h, m in {r[:2] for r in known}
            if None not in (g, t, h, m) and h == g
        ]
        if near and min(near)[0] <= slips:
            out.add((g, t, min(near)[1].decode(), min(near)[0]))
    return sorted(out)


def slipped(chance, text):
    for _ in range(chance.choice([0, 1, 2, 3])):
        n = chance.randrange(len(text) + 1)
        text = text[:n] + chance.choice(["", "x", "ü", "ab"]) + text[n + chance.choice([0, 1]):]
    return text


@pytest.mark.parametrize("slips", [1, 2, 3])
def test_equals_all_pairs(spark, slips):
    chance = random.Random(slips)
    letters = "abü "
    long = ["".join(chance.choices(letters, k=chance.randrange(25))) for _ in range(120)]
    short = ["".join(chance.choices("ab", k=chance.randrange(7))) for _ in range(40)]
    same = ["aaaaaaaaaaaa" + "b" * n for n in range(9)]
    known = [(chance.choice("xyy"), t, 1) for t in [*long, *short, *same, *short]]
    asked = [(g, slipped(chance, t), 2) for g, t, _ in known]
    odd = [(None, "aa", 1), ("x", None, 1), ("x", "", 1), ("z", "alone", 1)]
    found = best_spellings(
        spark.createDataFrame(asked + odd, SCHEMA), spark.createDataFrame(known + odd, SCHEMA),
        "g", "t", slips,
    ).select("g", "t", "match", "distance")
    assert sorted(tuple(r) for r in found.collect()) == brute(asked + odd, known + odd, slips)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([("x", "text", 1)], SCHEMA)
    assert best_spellings(none, some, "g", "t").count() == 0
    assert best_spellings(some, none, "g", "t").count() == 0


def test_a_misspelt_address_gets_its_place(spark):
    def at(street):
        return f"{street}, 01099, Dresden, Sachsen"

    offers = spark.createDataFrame([
        (1, at("Hauptstr 5"), "01099"), (2, at("Haupstr 5"), "01099"), (3, at("Ring 9"), "01099"),
        (4, None, "01099"), (5, at("Ring 9"), "99999"), (6, "no address", "01099"),
        (7, at("Haupstr 5"), "01099"), (8, at("Lost 1"), "99999"),
    ], "scoutId int, address_string string, geo_plz string")
    register = spark.createDataFrame([
        (at("Hauptstr 5"), 51.0, 13.0), (at("Hauptstr 6"), 51.5, 13.5), (at("Lost 1"), None, 13.0),
    ], "address_string string, lat double, lng double")
    centres = spark.createDataFrame([("01099", 50.0, 12.0)], "PLZ string, lat double, lng double")
    tiers = {
        slips: {r.scoutId: (r.tier, r.coords and r.coords.Lat) for r in coordinates_of(
            offers, register, centres, slips=slips
        ).collect()} for slips in (0, 2)
    }
    assert tiers[0] == {
        1: (1, 51.0), 2: (2, 50.0), 3: (2, 50.0), 4: (2, 50.0), 5: (None, None), 6: (2, 50.0),
        7: (2, 50.0), 8: (None, None),
    }
    assert tiers[2] == tiers[0] | {2: (3, 51.0), 7: (3, 51.0)}
