"""The nearest stations brought up to date against a full run."""

import random

import pytest
from pyspark.sql import functions as F

from nearstop.operators import match

OFFER = "scoutId int, zip_group string, lat double, lng double"
STATION = (
    "DHID string, Parent string, Name string, Latitude double, Longitude double,"
    " ZIP_Group_Station string, extra int"
)


def stations(chance, count, first=0):
    return [
        (f"s{first + n:03}", "p", chance.choice(["a", "b"]), chance.randrange(12) / 2,
         chance.randrange(12) / 2, chance.choice(["g", "g", "h"]), 1)
        for n in range(count)
    ]


@pytest.mark.parametrize(("k", "seed"), [(3, 1), (10, 2), (3, 3)])
def test_equals_a_full_run(spark, monkeypatch, k, seed):
    chance = random.Random(seed)
    offers = [
        (n, chance.choice(["g", "h", "none", None]), chance.randrange(12) / 2, chance.randrange(12) / 2)
        for n in range(80)
    ]
    offers[5:7] = [(5, "g", None, 1.0), (6, "h", float("nan"), 1.0)]
    before = stations(chance, 40) + [("x", "p", None, 1.0, 1.0, "g", 1)]
    moved = [(s[0], s[1], s[2], s[3] + 0.5, *s[4:]) for s in before[:3]]
    after = moved + before[6:] + stations(chance, 4, 100) + [("n", "p", "a", 1.0, 1.0, "none", 1)]
    new = [(200, "g", 1.0, 1.0), (201, "h", 2.0, 2.5)]
    shifted = [(o[0], o[1], 3.0, 3.0) if o[0] == 9 else o for o in offers]
    old, now = spark.createDataFrame(offers, OFFER), spark.createDataFrame(shifted + new, OFFER)
    a, b = spark.createDataFrame(before, STATION), spark.createDataFrame(after, STATION)
    previous = match.nearest_stations(old, a, k)
    added, removed = match.station_changes(a, b)

    met = []
    full = match.nearest_stations

    def noted(some, among, k=10, limits=match.Limits()):
        met.append({r.scoutId for r in some.select("scoutId").collect()})
        return full(some, among, k, limits)

    monkeypatch.setattr(match, "nearest_stations", noted)
    found = match.refresh_nearest(previous, now, b, added, removed, k)
    wanted = full(now, b, k)
    assert found.columns == wanted.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    # Only offers that lost a station, are new, have moved or had no stations meet all of them.
    gone = {s[0] for s in before[:6]}
    held = {}
    for r in previous.collect():
        held.setdefault(r.scoutId, set()).add(r.DHID)
    assert met[0] == {n for n, *_ in shifted + new if n not in held or n == 9 or held[n] & gone}
    assert 9 in met[0] and 200 in met[0] and len(met[0]) < 82


def test_nothing_changed(spark):
    chance = random.Random(4)
    offers = spark.createDataFrame([(n, "g", n / 4, 1.0) for n in range(20)], OFFER)
    some = spark.createDataFrame(stations(chance, 30), STATION)
    added, removed = match.station_changes(some, some.withColumn("extra", F.lit(2)))
    assert added.count() == removed.count() == 0
    previous = match.nearest_stations(offers, some, 5)
    found = match.refresh_nearest(previous, offers, some, added, removed, 5)
    assert sorted(map(str, found.collect())) == sorted(map(str, previous.collect()))


def test_the_stored_result_follows_the_stations(spark, tmp_path):
    from nearstop.plans import enrich
    from nearstop.plans import match as plans
    from nearstop.sinks.tables import write_table
    from nearstop.sources.tables import read_table

    root, chance = str(tmp_path), random.Random(6)
    write_table(spark.createDataFrame(
        [(n, "01099", n / 4, 1.0) for n in range(30)],
        "scoutId int, geo_plz string, lat double, lng double",
    ), enrich.COORDS, root)
    for first in (0, 20):
        some = spark.createDataFrame(stations(chance, 30, first), STATION).withColumns(
            {"ZIP_Group_Rental": F.lit("010"), "ZIP_Group_Station": F.lit("010")}
        )
        write_table(some, "table_stations_grouped", root, partition_by="ZIP_Group_Rental")
        plans.update_nearest_stations(spark, root, 4)
        found = read_table(spark, "table_nearest_4", root)
        wanted = plans.all_nearest_stations(spark, root, 4).select(found.columns)
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
