"""Lookup services: how often they are asked, by how many tasks, and what is kept."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from nearstop.operators.geocode import resolve_residual
from nearstop.operators.lookup import ERROR, ask, call_lookup, stored_answers, stored_lookup
from nearstop.plans import enrich
from nearstop.sinks.tables import write_table
from nearstop.sources.tables import read_table


def recorder(folder, fails=()):
    """A service that notes each call in a file of its own, and raises for some keys."""
    def service(keys):
        from uuid import uuid4
        (folder / uuid4().hex).write_text("\n".join(keys["k"]))
        if keys["k"].isin(list(fails)).any():
            raise OSError("no answer")
        return pd.DataFrame({"size": keys["k"].str.len()})

    return service


def asked(folder):
    return [sorted(path.read_text().split("\n")) for path in folder.iterdir()]


def fresh(tmp_path, name):
    (tmp_path / name).mkdir()
    return tmp_path / name


def test_keys_are_dealt_over_tasks(spark):
    df = spark.range(2000).selectExpr("id AS n", "cast(id % 500 AS string) AS k")
    for tasks, expected in ((3, 3), (None, spark.sparkContext.defaultParallelism)):
        found = ask(df, ["k"], lambda keys: pd.DataFrame({"size": keys["k"].str.len()}), "size long",
                    tasks)
        parts = found.groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) == expected and sum(p["count"] for p in parts) == 500


def test_failing_keys_cost_few_calls(spark, tmp_path):
    folder = fresh(tmp_path, "calls")
    df = spark.range(600).selectExpr("id AS n", "cast(id AS string) AS k").coalesce(1)
    bad = {str(n) for n in range(0, 600, 3)}
    found = ask(df, ["k"], recorder(folder, bad), "size long", 1).collect()
    assert {r.k for r in found if r[ERROR]} == bad and len(found) == 600
    assert len(asked(folder)) <= 600 + 10 + 1


def test_a_service_can_tell_errors_by_row(spark):
    def service(keys):
        return pd.DataFrame({"size": [1, None], ERROR: [None, "gone"]})

    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, k string")
    found = call_lookup(df, ["k"], service, "size double", "n", parallelism=1, error="why")
    assert sorted(r.why or "" for r in found.collect()) == ["", "gone"]


@pytest.mark.parametrize("pieces", [1, 3])
def test_only_new_and_failed_keys_are_asked_again(spark, tmp_path, pieces):
    root = str(fresh(tmp_path, "tables"))
    first, second, third = (fresh(tmp_path, name) for name in ("a", "b", "c"))
    few = spark.createDataFrame([(1, "a"), (2, "bb"), (3, "a"), (4, None)], "n int, k string")
    more = few.unionByName(spark.createDataFrame([(5, "ccc")], "n int, k string"))

    def run(df, service):
        found = stored_lookup(
            df, ["k"], service, "size long", "n", root, "answers", 1, "why", pieces
        )
        return sorted((r.n, r["size"]) for r in found.collect())

    assert run(few, recorder(first, ["bb"])) == [(1, 1), (2, None), (3, 1), (4, None)]
    assert run(more, recorder(second)) == [(1, 1), (2, 2), (3, 1), (4, None), (5, 3)]
    assert sorted(k for call in asked(second) for k in call) == ["bb", "ccc"]
    assert run(few, recorder(third)) == [(1, 1), (2, 2), (3, 1), (4, None)]
    assert asked(third) == []


def test_nothing_to_ask(spark, tmp_path):
    none = spark.createDataFrame([], "n int, k string")
    found = stored_answers(
        none, ["k"], recorder(tmp_path), "size long", str(tmp_path / "t"), "answers"
    )
    assert found.columns == ["k", "size", ERROR] and found.count() == 0


def test_pieces_that_were_stored_stay(spark, tmp_path):
    root, calls = str(fresh(tmp_path, "tables")), fresh(tmp_path, "calls")
    df = spark.createDataFrame([(n, str(n)) for n in range(40)], "n int, k string")
    kept = fresh(tmp_path, "kept")

    def ends(keys):
        import pandas as pd
        if len(list(kept.iterdir())) >= 1:
            return pd.DataFrame({"size": []})  # a mistake ends the run in its second piece
        (kept / "one").write_text("")
        return pd.DataFrame({"size": keys["k"].str.len()})

    with pytest.raises(Exception, match="0 answers for"):
        stored_answers(df, ["k"], ends, "size long", root, "answers", 1, 2).collect()
    done = read_table(spark, "answers", root).count()
    assert 0 < done < 40
    stored_answers(df, ["k"], recorder(calls), "size long", root, "answers", 1, 2)
    assert sum(len(call) for call in asked(calls)) == 40 - done


def test_attempts_go_on_where_they_ended(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0)], "SeqNo int, Latitude double")
    state, tried = (str(tmp_path), "attempt"), []

    def first(rows):
        tried.append("first")
        return rows.withColumn("Q_PLZ", F.when(F.col("SeqNo") == 1, "one"))

    def lost(rows):
        raise RuntimeError("the driver is lost")

    def second(rows):
        tried.append("second")
        return rows.withColumn("Q_PLZ", F.lit("two"))

    with pytest.raises(RuntimeError):
        resolve_residual(df, ["SeqNo"], "Q_PLZ", [first, lost], state)
    found = resolve_residual(df, ["SeqNo"], "Q_PLZ", [first, second], state)
    assert sorted(tuple(r) for r in found.collect()) == [(1, "one", 1), (2, "two", 2)]
    resolve_residual(df, ["SeqNo"], "Q_PLZ", [first, second], state)
    assert tried == ["first", "second"]


def test_stages_take_a_service(spark, tmp_path):
    root, calls = str(fresh(tmp_path, "tables")), fresh(tmp_path, "calls")
    write_table(spark.createDataFrame(
        [(1, "Haupt", "1", "01099", "Dresden", "Sachsen"), (2, "Ring", "2", "01099", "Dresden", "Sachsen"),
         (3, "Weg", "3", "01099", "Dresden", "Sachsen")],
        "scoutId int, streetPlain string, houseNumber string, geo_plz string, geo_krs string,"
        " geo_bln string",
    ), "table_rental_location", root)
    write_table(spark.createDataFrame(
        [("01099", 50.0, 12.0)], "PLZ string, lat double, lng double"
    ), "table_mapping_zip_to_coor", root)
    register = spark.createDataFrame(
        [("Haupt 1, 01099, Dresden, Sachsen", 51.0, 13.0)], "address_string string, lat double, lng double"
    )

    def addresses(keys):
        from uuid import uuid4

        import pandas as pd
        (calls / uuid4().hex).write_text("\n".join(keys["address_string"]))
        known = keys["address_string"].str.startswith("Ring")
        return pd.DataFrame({"lat": known.map({True: 52.0}), "lng": known.map({True: 14.0})})

    for _ in range(2):
        enrich.geocode_rentals(spark, root, register, service=addresses, parallelism=1)
        found = read_table(spark, enrich.COORDS, root).select("scoutId", "lat").collect()
        assert sorted(tuple(r) for r in found) == [(1, 51.0), (2, 52.0), (3, 50.0)]
    assert sorted(k[:4] for call in asked(calls) for k in call) == ["Ring", "Weg "]
