import pandas as pd
import pytest
from pyspark.sql import functions as F

from nearstop.operators import geocode, match, quality, split, stations
from nearstop.operators.lookup import call_lookup, lookup_join, one_per_key
from nearstop.operators.nearest import Limits

STATION = "SeqNo int, Type string, DHID string, Parent string, Name string, Latitude float, " \
          "Longitude float, MunicipalityCode string, Municipality string"
WITH_ZIP = STATION + ", MunicipalityCode_ZIP string, name_ZIP string, PLZ string"
CENTRE = "PLZ string, lat double, lng double"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_lookup_join_keeps_rows_without_key(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "z"), (4, None)], "n int, k string")
    right = spark.createDataFrame([("a", 10), (None, 99)], "rk string, v int")
    joined = lookup_join(left, right, {"k": "rk"}, "n")
    assert rows(joined, "n", "v") == [(1, 10), (2, None), (3, None), (4, None)]
    assert joined.columns == ["n", "k", "rk", "v"]


def test_lookup_join_spreads_rows_without_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        left = spark.range(1000).withColumn("k", F.lit(None).cast("string"))
        right = spark.createDataFrame([("a", 1)], "rk string, v int")
        joined = lookup_join(left, right, {"k": "rk"}, "id")
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert max(row["count"] for row in sizes) < 600
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_one_per_key(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "z"), (1, 1, "a"), (2, 5, None)], "k int, o int, v string")
    assert rows(one_per_key(df, ["k"], ["o"]), "k", "o", "v") == [(1, 1, "a"), (2, 5, None)]


def test_mapping_listed_twice_doubles_stations(spark):
    station = spark.createDataFrame(
        [(1, "S", "d", "d", "n", 1.0, 1.0, "01", "m"), (2, "Q", "e", "d", "n", 1.0, 1.0, None, "m")],
        STATION,
    )
    mapping = spark.createDataFrame(
        [("01", "x", "10115"), ("01", "y", "10117")], "MunicipalityCode string, Name string, PLZ string"
    )
    joined = stations.with_municipal_zip(station, mapping)
    assert rows(joined, "SeqNo", "name_ZIP", "PLZ") \
        == [(1, "x", "10115"), (1, "y", "10117"), (2, None, None)]
    assert joined.columns[-3:] == ["MunicipalityCode_ZIP", "name_ZIP", "PLZ"]
    assert rows(quality.duplicate_keys(mapping, ["MunicipalityCode"]), "MunicipalityCode", "n") \
        == [("01", 2)]


def test_children_inherit(spark):
    df = spark.createDataFrame(
        [
            (1, "S", "p", "p", "Parent", 1.0, 1.0, "01", "Town", "01", "town", "10115"),
            (2, "Q", "c", "p", "Child", 2.0, 2.0, "00000000", None, None, None, None),
            (3, "Q", "d", "?", "Orphan", 3.0, 3.0, "00000000", None, None, None, None),
            (4, "Q", "e", None, "No code", 4.0, 4.0, None, None, None, None, None),
            (5, "S", "p", "p", "Twin", 5.0, 5.0, "02", "Village", "02", "village", "20115"),
        ],
        WITH_ZIP,
    )
    found = stations.inherit_from_parent(df)
    assert rows(found, "SeqNo", "DHID", "Name", "MunicipalityCode", "Municipality", "PLZ", "ZIP_Group_Station") == [
        (1, "p", "Parent", "01", "Town", "10115", "101"),
        (2, "c", "Child", "01", "Town", "10115", "101"),
        (3, "d", "Orphan", None, None, None, None),
        (4, "e", "No code", None, None, None, None),
        (5, "p", "Twin", "02", "Village", "20115", "201"),
    ]
    quality.require_same_count(df, found)
    with pytest.raises(quality.RowCountChanged):
        quality.require_same_count(df, found.limit(1))


def test_resolved_zip_fills_gaps_only(spark):
    df = spark.createDataFrame([(1, "x", "a"), (2, "y", ""), (3, "z", None)], "SeqNo int, DHID string, PLZ string")
    found = spark.createDataFrame([(1, "x"), (2, "bcde"), ], "SeqNo int, Q_PLZ string")
    assert rows(stations.with_resolved_zip(df, found), "SeqNo", "PLZ", "ZIP_Group_Station") \
        == [(1, "a", "a"), (2, "bcde", "bcd"), (3, None, None)]


def test_missing_zip(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 1.0, ""), (2, 2.0, 2.0, None), (3, 3.0, 3.0, "1")],
        "SeqNo int, Latitude double, Longitude double, PLZ string",
    )
    assert rows(stations.missing_zip(df), "SeqNo") == [(1,), (2,)]


def test_group_without_stations_stays(spark):
    groups = spark.createDataFrame([("101",), ("999",), (None,)], "ZIP_Group_Rental string")
    df = spark.createDataFrame(
        [(1, "101"), (2, "101"), (3, "555"), (4, None)], "SeqNo int, ZIP_Group_Station string"
    )
    assert rows(match.group_stations(groups, df), "ZIP_Group_Rental", "SeqNo") \
        == [("101", 1), ("101", 2), ("999", None), (None, None)]
    assert tuple(quality.zip_group_stats(groups, df).first()) == (2, 1)


CANDIDATES = [
    ("101", 51.0, 9.0, "p", "b", "B"), ("101", 51.0, 9.0, "p", "a", "A"),
    ("101", 51.2, 9.0, "p", "c", "C"), ("101", 51.2, 9.0, "p", "c", "C"),
    ("101", None, 9.0, "p", "d", "D"), ("101", 51.0, 9.0, None, "e", "E"),
    ("555", None, 9.0, "p", "f", "F"),
]
CANDIDATE = "ZIP_Group_Station string, Latitude float, Longitude float, Parent string, " \
            "DHID string, Name string"
OFFER = "scoutId int, zip_group string, lat double, lng double"


def test_nearest_stations(spark):
    near = spark.createDataFrame(CANDIDATES, CANDIDATE)
    offers = spark.createDataFrame(
        [(1, "101", 51.0, 9.0), (2, "999", 51.0, 9.0), (3, "101", None, 9.0), (4, "555", 51.0, 9.0),
         (5, "101", 51.0, 9.0), (5, "101", 51.0, 9.0), (6, None, 51.0, 9.0)],
        OFFER,
    )
    expected = [(1, 1, "a"), (1, 2, "b"), (1, 3, "c")]
    found = match.nearest_stations(offers, near)
    assert rows(found.where("scoutId < 5"), "scoutId", "rank", "DHID") == expected
    assert rows(match.nearest_for(offers, near, 1), "scoutId", "rank", "DHID") == expected
    assert rows(match.nearest_for(offers, near, 1, k=1), "scoutId", "rank", "DHID") == expected[:1]
    for without in (2, 3, 4, 6):
        assert match.nearest_for(offers, near, without).isEmpty()
    for wrong in (5, 77):
        with pytest.raises(LookupError):
            match.nearest_for(offers, near, wrong)
    missed = match.rentals_without_station(offers, near)
    assert rows(missed, "scoutId") == [(2,), (3,), (4,), (6,)]
    keys = match.rental_station_keys(offers.where("scoutId < 5"), near)
    assert rows(keys, "scoutId", "stations") == [(1, 6), (3, 6), (4, 1)]


def test_coordinates_by_tier(spark):
    offers = spark.createDataFrame(
        [(1, "A 1", "10115"), (2, "B 2", "10115"), (3, None, "10115"), (4, None, "99999"), (5, "B 2", None)],
        "scoutId int, address_string string, geo_plz string",
    )
    register = spark.createDataFrame(
        [("A 1", 2.0, 2.0), ("A 1", 1.0, 9.0), (None, 5.0, 5.0), ("B 2", None, 1.0)],
        "address_string string, lat double, lng double",
    )
    centres = spark.createDataFrame([("10115", 50.0, 8.0), (None, 1.0, 1.0)], CENTRE)
    found = geocode.coordinates_of(offers, register, centres)
    assert rows(found, "scoutId", "tier", "coords.Lat", "coords.Lng") == [
        (1, 1, 1.0, 9.0), (2, 2, 50.0, 8.0), (3, 2, 50.0, 8.0), (4, None, None, None),
        (5, None, None, None),
    ]


def far_and_near(spark):
    df = spark.createDataFrame(
        [(n, 47 + (n * 7919 % 8000) / 1000, 6 + (n * 104729 % 9000) / 1000) for n in range(300)]
        + [(900, None, 1.0), (901, 80.0, -170.0)],
        "SeqNo int, Latitude double, Longitude double",
    )
    centres = spark.createDataFrame(
        [(f"{n:05}", 47 + (n * 1777 % 8000) / 1000, 6 + (n * 2311 % 9000) / 1000) for n in range(200)]
        + [("99999", None, 1.0), (None, 50.0, 9.0)],
        CENTRE,
    )
    return df, centres


def test_widening_search_equals_nearest(spark):
    df, centres = far_and_near(spark)
    direct = rows(geocode.nearest_zip(df, centres), "SeqNo", "Q_PLZ")
    assert len(direct) == 301
    split_up = Limits(group=20, settled=10)
    assert rows(geocode.nearest_zip(df, centres, split_up), "SeqNo", "Q_PLZ") == direct
    found = geocode.resolve_zips(df, centres)
    assert rows(found, "SeqNo", "Q_PLZ") == direct
    assert {r.attempt for r in found.collect()} == {1, 2, 3, 4}
    assert rows(geocode.resolve_zips(df, centres, radii=()), "SeqNo", "Q_PLZ") == direct


def test_attempts_do_not_depend_on_the_number_of_centres(spark):
    crowd = [(f"{n:05}", 50 + n % 60 / 1000, 9 + n // 60 / 1000) for n in range(3000)]
    centres = spark.createDataFrame(crowd, "PLZ string, lat double, lng double")
    df = spark.createDataFrame(
        [(1, 50.0, 9.0), (2, 49.8, 9.0), (3, 49.6, 9.0), (4, 45.0, 9.0)],
        "SeqNo int, Latitude double, Longitude double",
    )
    found = geocode.resolve_zips(df, centres)
    assert rows(found, "SeqNo", "Q_PLZ", "attempt") == [
        (1, "00000", 1), (2, "00000", 2), (3, "00000", 3), (4, "00000", 4),
    ]


def test_parent_listed_twice_gives_its_zip(spark):
    df = spark.createDataFrame(
        [(1, "p", None, "01001000", None), (2, "p", None, "01001000", "10115"),
         (3, "c", "p", "00000000", None)],
        "SeqNo int, DHID string, Parent string, MunicipalityCode string, PLZ string",
    )
    child = stations.inherit_from_parent(df).where("SeqNo = 3").first()
    assert child.PLZ == "10115"


def test_retry_takes_first_answer_and_stops_early(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "SeqNo int")
    calls = []

    def attempt(number, answers):
        def run(residual):
            calls.append((number, sorted(r.SeqNo for r in residual.collect())))
            pairs = F.create_map(*[F.lit(x) for pair in answers.items() for x in pair])
            return residual.withColumn("Q_PLZ", pairs[F.col("SeqNo")])
        return run

    attempts = [
        attempt(1, {1: "a", 2: "", 9: "z"}), attempt(2, {2: "b", 3: "", 9: "z"}),
        attempt(3, {3: "c", 9: "z"}), attempt(4, {9: "z"}),
    ]
    found = geocode.resolve_residual(df, ["SeqNo"], "Q_PLZ", attempts)
    assert rows(found, "SeqNo", "Q_PLZ", "attempt") == [(1, "a", 1), (2, "b", 2), (3, "c", 3)]
    assert calls == [(1, [1, 2, 3]), (2, [2, 3]), (3, [3])]


def test_unresolved_rows_are_left_out(spark):
    df = spark.createDataFrame([(1,), (2,)], "SeqNo int")
    once = lambda residual: residual.withColumn("Q_PLZ", F.when(F.col("SeqNo") == 1, "a"))
    found = geocode.resolve_residual(df, ["SeqNo"], "Q_PLZ", [once, once])
    assert rows(found, "SeqNo", "Q_PLZ") == [(1, "a")]


def test_lookup_service(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "bb"), (4, None)], "n int, k string")

    def service(keys):
        assert keys["k"].is_unique
        return pd.DataFrame({"size": keys["k"].str.len()})

    found = call_lookup(df, ["k"], service, "size long", "n", parallelism=2)
    assert rows(found, "n", "k", "size") == [(1, "a", 1), (2, "a", 1), (3, "bb", 2), (4, None, None)]

    def broken(keys):
        raise OSError("no answer")

    assert rows(call_lookup(df, ["k"], broken, "size long", "n"), "n", "size") \
        == [(1, None), (2, None), (3, None), (4, None)]
    with pytest.raises(Exception, match="0 answers for"):
        call_lookup(df, ["k"], lambda keys: pd.DataFrame({"size": []}), "size long", "n").collect()


def test_failing_key_does_not_spoil_its_batch(spark):
    df = spark.range(1000).selectExpr("id AS n", "cast(id AS string) AS k")

    def service(keys):
        if (keys["k"] == "7").any():
            raise OSError("no answer")
        return pd.DataFrame({"size": keys["k"].str.len()})

    found = call_lookup(df, ["k"], service, "size long", "n", error="why")
    failed = found.where("size IS NULL").collect()
    assert [(r.n, r.why) for r in failed] == [(7, "OSError: no answer")]
    assert found.where("why IS NULL").count() == 999


def test_split_and_reunite(spark):
    df = spark.createDataFrame([(n,) for n in range(10)] + [(None,)], "n int")
    low, high = split.split_at_quantile(df, "n")
    assert rows(low, "n") == [(n,) for n in range(5)] and high.count() == 5
    assert split.reunite(low, high).count() == 10
