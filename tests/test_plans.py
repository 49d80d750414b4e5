"""The stages from files to nearest stations."""

from pathlib import Path

import pytest

from checks import views
from nearstop.operators.quality import RowCountChanged
from nearstop.plans import enrich, ingest, match
from nearstop.scratch import materialise, scratch_run, stage
from nearstop.sinks.tables import write_table
from nearstop.sources.tables import read_table
from tests.compare import FOLDER

SF = str(FOLDER / "sf0.001")


def test_from_files_to_nearest_stations(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "out")

    def deliver(df, name, **options):
        df.write.options(header=True, **options).csv(f"{folder}/{name}")
        return f"{folder}/{name}"

    ingest.ingest_rentals(spark, deliver(views.rental_file(spark, SF), "r", escape='"'), root)
    ingest.ingest_stations(spark, deliver(views.station_file(spark, SF), "s", sep=";"), root)
    ingest.ingest_mappings(
        spark, deliver(views.mapping(spark, SF), "m"), deliver(views.centres(spark, SF), "z"), root
    )
    location = read_table(spark, "table_rental_location", root)
    assert location.count() == 150 and len(location.columns) == 11
    assert len(read_table(spark, "table_rental_price_and_cost", root).columns) == 11
    assert len(read_table(spark, "table_rental_feature", root).columns) == 28
    assert len(read_table(spark, "table_stations", root).columns) == 9

    register = enrich.with_address(location).selectExpr(
        "address_string", "47.0D + scoutId % 8 AS lat", "6.0D + scoutId % 9 AS lng"
    )
    enrich.geocode_rentals(spark, root, register)
    enrich.add_zipcode_to_stations(spark, root)
    enrich.group_stations_by_zipcode(spark, root)
    final = read_table(spark, "table_stations_with_zip_final", root)
    assert final.count() == 200
    assert final.where("PLZ IS NULL AND Latitude IS NOT NULL").isEmpty()

    everyone = match.all_nearest_stations(spark, root).collect()
    assert everyone
    by_offer = {}
    for row in everyone:
        by_offer.setdefault(row.scoutId, []).append((row["rank"], row.DHID))
    offer = sorted(by_offer)[0]
    one = match.query_nearest_stations(spark, root, offer).collect()
    assert sorted((r["rank"], r.DHID) for r in one) == sorted(by_offer[offer])
    markers = match.show_nearest_stations(spark, root, offer).collect()
    assert sorted(r.role for r in markers) == ["rental"] + ["station"] * len(one)
    with pytest.raises(LookupError):
        match.query_nearest_stations(spark, root, -1)

    # Running a stage again replaces its tables.
    enrich.add_zipcode_to_stations(spark, root)
    assert read_table(spark, "table_stations_with_zip_final", root).count() == 200


def test_offers_from_several_parts(spark, tmp_path):
    root = str(tmp_path)
    columns = "scoutId int, geo_plz string"
    for name, row in (("a", (1, "10115")), ("b", (2, "04229"))):
        spark.createDataFrame([row], columns).write.parquet(f"{root}/{name}.parquet")
    both = enrich.load_rental_coordinates(spark, root, ("a", "b"))
    assert sorted((r.scoutId, r.zip_group) for r in both.collect()) == [(1, "101"), (2, "042")]


def _station_tables(spark, root, mapping):
    write_table(spark.createDataFrame(
        [(n, "S", f"d{n}", "d", "n", 1.0, float(n), f"0{n % 2}", "m") for n in range(10)],
        "SeqNo int, Type string, DHID string, Parent string, Name string, Latitude double,"
        " Longitude double, MunicipalityCode string, Municipality string",
    ), "table_stations", root)
    write_table(spark.createDataFrame(
        mapping, "MunicipalityCode string, Name string, PLZ string"
    ), "table_mapping_municipal_to_zip", root)
    write_table(spark.createDataFrame(
        [("02000", 1.0, 1.0)], "PLZ string, lat double, lng double"
    ), "table_mapping_zip_to_coor", root)


def test_a_stage_raises_if_it_doubles_stations(spark, tmp_path):
    root = str(tmp_path)
    _station_tables(spark, root, [("00", "a", "01000"), ("00", "b", "01001")])
    with pytest.raises(RowCountChanged, match="10 rows before, 15 after"):
        enrich.add_zipcode_to_stations(spark, root)


def test_rows_are_counted_without_a_query_of_their_own(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    _station_tables(spark, root, [("00", "a", "01000")])

    def jobs(group):
        spark.sparkContext.setJobGroup(group, group)
        enrich.add_zipcode_to_stations(spark, root)
        spark.sparkContext.setJobGroup("", "")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    jobs("first")
    counting = jobs("counting")
    monkeypatch.setattr(enrich, "counted", lambda df: (df, None))
    monkeypatch.setattr(enrich, "require_same_rows", lambda *_: None)
    assert counting == jobs("plain")
    assert read_table(spark, "table_stations_with_zip_final", root).count() == 10


def test_intermediate_tables_go_with_the_stage(spark, tmp_path):
    seen = []

    @stage
    def some(spark, n):
        table = materialise(spark.range(n), "numbers")
        seen.extend(table.inputFiles())
        with scratch_run(spark):
            inner = materialise(spark.range(3), "inner").inputFiles()
        assert not Path(inner[0].removeprefix("file:").replace("//", "/")).exists()
        return table.count()

    assert some(spark, 7) == 7
    assert seen and not any(Path(f.removeprefix("file:").replace("//", "/")).exists() for f in seen)
    kept = materialise(spark.range(2), "kept")
    assert "run-" not in kept.inputFiles()[0] and kept.count() == 2
