import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from nearstop import scratch
from nearstop.schemas import SchemaMismatch, require_columns, require_same_columns, schema
from nearstop.sinks.features import map_features
from nearstop.sinks.tables import append_run, extract_table, write_table
from nearstop.sources import files
from nearstop.sources.tables import read_table, spread, table_path

RENTAL_CELLS = {
    "scoutId": "7", "geo_plz": "04229", "newlyConst": "TRUE", "balcony": "FALSE",
    "serviceCharge": "245.5", "picturecount": "x", "livingSpace": "86", "heatingCosts": "NA",
    "description": '"Erste Zeile, ""schön""\nzweite Zeile"', "facilities": "",
}


def rental_csv(folder, cells, drop=()):
    names = [*schema("RENTAL").names, "description", "facilities"]
    names = [name for name in names if name not in drop]
    row = [cells.get(name, "NA") for name in names]
    (folder / "rentals.csv").write_text(",".join(names) + "\n" + ",".join(row) + "\n")
    return str(folder)


def test_rentals_are_typed_and_cleaned(spark, tmp_path):
    rows = files.read_rentals(spark, rental_csv(tmp_path, RENTAL_CELLS)).collect()
    assert len(rows) == 1 and len(rows[0]) == 47
    row = rows[0]
    assert (row.scoutId, row.geo_plz, row.newlyConst, row.balcony) == (7, "04229", True, False)
    assert (row.serviceCharge, row.picturecount, row.livingSpace) == (245.5, None, "86")
    assert row.heatingCosts is None and row.street is None


def test_rentals_with_other_columns_are_refused(spark, tmp_path):
    with pytest.raises(SchemaMismatch, match="geo_plz"):
        files.read_rentals(spark, rental_csv(tmp_path, RENTAL_CELLS, drop=["geo_plz"]))


def test_stations(spark, tmp_path):
    names = schema("STATION").names
    first = ['"0"', '"S"', '"de:1"', '"de:1"', '"Wörth; Alte"', '"49,04"', '"8,26"', '"07334501"']
    (tmp_path / "s.csv").write_text(
        ";".join(f'"{n}"' for n in names) + "\n"
        + ";".join(first + ['""'] * (len(names) - len(first))) + "\n"
        + ";".join(['"x"'] + ['"y"'] * (len(names) - 1)) + "\n"
    )
    one, two = files.read_stations(spark, str(tmp_path)).collect()
    assert (one.SeqNo, one.Name, one.Latitude, one.District) == (0, "Wörth; Alte", "49,04", None)
    assert two.SeqNo is None and two.Type == "y"


def test_mappings(spark, tmp_path):
    (tmp_path / "m.csv").write_text("MunicipalityCode,Name,PLZ\n01001000,Flensburg,24937\n")
    (tmp_path / "z.csv").write_text("PLZ,lat,lng\n01067,51.05,13.71\n01069,x,13.7\n")
    municipal = files.read_municipal_zips(spark, str(tmp_path / "m.csv"))
    assert tuple(municipal.first()) == ("01001000", "Flensburg", "24937")
    municipal.write.json(str(tmp_path / "sheet"))
    again = files.read_municipal_zips(spark, str(tmp_path / "sheet"), "json")
    assert again.collect() == municipal.collect()
    centres = files.read_zip_coordinates(spark, str(tmp_path / "z.csv")).collect()
    assert [tuple(r) for r in centres] == [("01067", 51.05, 13.71), ("01069", None, 13.7)]


def test_missing_source(spark, tmp_path):
    nowhere = str(tmp_path / "nowhere")
    assert not files.source_exists(spark, nowhere)
    assert files.source_exists(spark, str(tmp_path))
    for read in (files.read_rentals, files.read_stations, files.read_zip_coordinates):
        with pytest.raises(files.SourceNotFound):
            read(spark, nowhere)
    with pytest.raises(files.SourceNotFound):
        read_table(spark, "nothing", str(tmp_path))


def test_table_names(tmp_path):
    assert {table_path("/r/", n) for n in ("x", "x.parquet", "x.parquet/")} == {"/r/x.parquet"}


def test_extract_drops_duplicates_and_checks_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 0), (1, "a", 1), (2, "b", 2)], "n int, t string, x int")
    extract_table(df, ["n", "t"], "t", str(tmp_path))
    assert sorted(map(tuple, read_table(spark, "t", str(tmp_path)).collect())) == [(1, "a"), (2, "b")]
    with pytest.raises(SchemaMismatch, match="nope"):
        extract_table(df, ["nope"], "u", str(tmp_path))
    assert not files.source_exists(spark, table_path(str(tmp_path), "u"))


def test_small_table_is_one_file(spark, tmp_path):
    write_table(spark.range(1000).repartition(4), "t", str(tmp_path))
    assert len(list((tmp_path / "t.parquet").rglob("*.parquet"))) == 1


def test_partitioned_table_keeps_text_groups(spark, tmp_path):
    df = spark.createDataFrame([("010", 1), ("44X", 2), (None, 3)], "g string, n int")
    write_table(df, "t", str(tmp_path), partition_by="g")
    back = read_table(spark, "t", str(tmp_path), partition_by="g")
    assert sorted(((r.g, r.n) for r in back.collect()), key=lambda r: r[1]) \
        == [("010", 1), ("44X", 2), (None, 3)]
    only = back.where(F.col("g") == "010")
    assert "PartitionFilters: [isnotnull(g" in only._jdf.queryExecution().executedPlan().toString()
    numbers = df.where(F.col("n") == 1)
    write_table(numbers, "digits", str(tmp_path), partition_by="g")
    assert read_table(spark, "digits", str(tmp_path), partition_by="g").first().g == "010"


def test_appending_a_run_again_replaces_it(spark, tmp_path):
    for run, ids in (("1", [1]), ("2", [2, 3]), ("2", [2, 3])):
        append_run(spark.createDataFrame([(i,) for i in ids], "n int"), "t", str(tmp_path), run)
    back = read_table(spark, "t", str(tmp_path))
    assert back.columns == ["n"] and sorted(r.n for r in back.collect()) == [1, 2, 3]


def test_appending_to_a_written_table_keeps_its_rows(spark, tmp_path):
    def numbers(*ids):
        return spark.createDataFrame([(i,) for i in ids], "n int")

    def stored():
        back = read_table(spark, "t", str(tmp_path))
        assert back.columns == ["n"]
        return sorted(r.n for r in back.collect())

    write_table(numbers(1, 2), "t", str(tmp_path))
    assert stored() == [1, 2]
    append_run(numbers(9), "t", str(tmp_path), "2")
    assert stored() == [1, 2, 9]
    write_table(numbers(4), "t", str(tmp_path))
    assert stored() == [4]


def test_reordered_header_raises(spark, tmp_path):
    header = "PLZ,lat,lng\n10115,52.5,13.4\n", "lat,lng,PLZ\n52.5,13.4,10115\n"
    for n, text in enumerate(header):
        (tmp_path / f"{n}.csv").write_text(text)
    with pytest.raises(Exception, match="header"):
        files.read_zip_coordinates(spark, str(tmp_path)).collect()


def test_map_features(spark):
    offers = spark.createDataFrame(
        [(1, 51.0, 9.0, "Weg 1"), (2, None, 9.0, "Weg 2")],
        "scoutId int, lat double, lng double, address_string string",
    )
    near = spark.createDataFrame(
        [(1, 1, "Halt", 51.5, 9.5)],
        "scoutId int, rank int, Name string, Latitude double, Longitude double",
    )
    rows = map_features(offers, near).orderBy("rank").collect()
    assert [(r.scoutId, r.role, r.color, r.label) for r in rows] \
        == [(1, "rental", "red", "Weg 1"), (1, "station", "blue", "Halt")]
    feature = json.loads(rows[1].feature)
    assert feature["geometry"] == {"type": "Point", "coordinates": [9.5, 51.5]}
    assert feature["properties"]["label"] == "Halt" and feature["type"] == "Feature"


def test_schemas(spark):
    assert [len(schema(n)) for n in ("rental", "Station", "MAPPING_MUNICIPAL_ZIP")] == [47, 18, 3]
    with pytest.raises(ValueError, match="nothing"):
        schema("nothing")
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    require_columns(df, ["a"])
    with pytest.raises(SchemaMismatch, match="c"):
        require_columns(df, ["a", "c"])
    with pytest.raises(SchemaMismatch, match=r"\['PLZ', 'a', 'b', 'lat', 'lng'\]"):
        require_same_columns(df, schema("mapping_zip_coor"))


def test_scratch_tables(spark):
    df = scratch.materialise(spark.range(3).withColumn("t", F.lit("x")), "test")
    assert df.count() == 3 and df.columns == ["id", "t"]
    assert scratch.scratch_path(spark, "a") != scratch.scratch_path(spark, "a")


def test_scratch_folder_is_the_one_the_session_names():
    def session(folder):
        context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
        conf = SimpleNamespace(get=lambda key, default: folder or default)
        return SimpleNamespace(conf=conf, sparkContext=context)

    assert scratch.scratch_path(session("s3a://b/c/"), "a").startswith("s3a://b/c/nearstop/a-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(session(None))


def test_spread(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert spread(table).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(spark.range(100, numPartitions=9)).rdd.getNumPartitions() == 9
