"""The registered queries: each runs operators of the package over whole test tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks import views
from nearstop.functions.text import zip_group
from nearstop.operators import geocode, match, quality, rentals, split, stations
from nearstop.operators.lookup import ERROR, call_lookup, stored_lookup
from nearstop.operators.spelling import SLIPS
from nearstop.schemas import (
    RENTAL_FEATURE,
    RENTAL_LOCATION,
    RENTAL_PRICE_AND_COST,
    SchemaMismatch,
    require_columns,
    require_same_columns,
    schema,
)
from nearstop.scratch import materialise, scratch_path
from nearstop.sinks.features import map_features
from nearstop.sinks.tables import append_run, extract_table, write_table
from nearstop.sources import files
from nearstop.sources.tables import read_table, table_path
from nearstop.streaming.offers import stream_nearest_stations

ONE_OFFER = 100


def _stations(spark: SparkSession, sf: str, heavy: bool = False) -> DataFrame:
    return stations.with_coordinates(views.stations(spark, sf, heavy))


def _stations_with_zip(spark: SparkSession, sf: str, heavy: bool = False) -> DataFrame:
    mapping = views.mapping(spark, sf)
    return stations.with_municipal_zip(_stations(spark, sf, heavy), mapping)


def _stations_final(spark: SparkSession, sf: str) -> DataFrame:
    with_zip = _stations_with_zip(spark, sf, heavy=True)
    found = geocode.resolve_zips(stations.missing_zip(with_zip), views.centres(spark, sf))
    return stations.with_resolved_zip(with_zip, found)


def _rentals(spark: SparkSession, sf: str, heavy: bool = False) -> DataFrame:
    return rentals.with_zip_group(rentals.with_repaired_zip(views.rentals(spark, sf, heavy)))


def _nearest(spark: SparkSession, sf: str) -> DataFrame:
    return match.nearest_stations(_rentals(spark, sf, heavy=True), _stations_final(spark, sf))


def _addresses(spark: SparkSession, sf: str) -> DataFrame:
    return rentals.with_address(_rentals(spark, sf))


def knn_stations(spark, sf):
    return _nearest(spark, sf).select("scoutId", "rank", "DHID", "Parent", "Name")


def knn_refresh(spark, sf):
    """The last result brought up to date: some stations are new since, and some have moved."""
    after = materialise(_stations_final(spark, sf), "stations")
    size = F.pmod(F.xxhash64("DHID"), F.lit(50))
    before = after.where(size >= 4).withColumn(
        "Latitude", F.when(size > 46, F.col("Latitude") + F.lit(0.25).cast("float"))
        .otherwise(F.col("Latitude"))
    )
    offers = materialise(_rentals(spark, sf, heavy=True), "offers")
    previous = materialise(match.nearest_stations(offers, before), "previous")
    added, removed = match.station_changes(before, after)
    found = match.refresh_nearest(
        previous, offers, after, materialise(added, "added"), materialise(removed, "removed")
    )
    return found.select("scoutId", "rank", "DHID", "Parent", "Name")


def knn_stream(spark, sf):
    """The nearest stations of offers that come as a stream of files, one batch for each."""
    offers, root = scratch_path(spark, "offers"), scratch_path(spark, "tables")
    rows = _rentals(spark, sf).select(
        F.col("scoutId").cast("int").alias("scoutId"), "zip_group", "lat", "lng"
    )
    rows.repartition(2).write.parquet(offers)
    stations_ = materialise(_stations_final(spark, sf), "stations")
    query = stream_nearest_stations(
        spark, offers, stations_, root, scratch_path(spark, "progress"), files_per_batch=1
    )
    query.awaitTermination()
    return read_table(spark, "table_nearest_stream", root).select(
        "scoutId", "rank", "DHID", "Parent", "Name"
    )


def knn_stations_dense(spark, sf):
    """Groups beyond the size up to which candidates travel as one row: the grid answers."""
    found = match.nearest_stations(views.dense_rentals(spark, sf), views.dense_stations(spark, sf))
    return found.select("scoutId", "rank", "DHID")


def geocode_reverse_dense(spark, sf):
    places = views.dense_rentals(spark, sf).selectExpr(
        "scoutId AS SeqNo", "lat AS Latitude", "lng AS Longitude"
    )
    found = geocode.nearest_zip(places, views.dense_centres(spark, sf))
    return found.select("SeqNo", "Q_PLZ")


def nearest_for_one(spark, sf):
    found = match.nearest_for(_rentals(spark, sf), _stations_final(spark, sf), ONE_OFFER)
    return found.select("scoutId", "rank", "DHID")


def rental_station_keys(spark, sf):
    return match.rental_station_keys(_rentals(spark, sf), _stations_final(spark, sf))


def zip_repair(spark, sf):
    return rentals.with_repaired_zip(views.rentals(spark, sf)).select("scoutId", "geo_plz")


def bad_zip_report(spark, sf):
    return rentals.short_zips(views.rentals(spark, sf))


def rental_address(spark, sf):
    return _addresses(spark, sf).select(
        "scoutId", "streetPlain", "houseNumber", "geo_plz", "geo_krs", "geo_bln", "address_string"
    )


def rental_zip_groups(spark, sf):
    return rentals.zip_groups(rentals.with_repaired_zip(views.rentals(spark, sf)))


def station_coords(spark, sf):
    return _stations(spark, sf).select(
        "SeqNo", F.col("Latitude").cast("double"), F.col("Longitude").cast("double")
    )


def stations_with_zip(spark, sf):
    return _stations_with_zip(spark, sf).select(
        "SeqNo", "DHID", "MunicipalityCode", "MunicipalityCode_ZIP", "name_ZIP", "PLZ"
    )


def stations_missing_zip(spark, sf):
    missing = stations.missing_zip(_stations_with_zip(spark, sf))
    return missing.select(
        "SeqNo", F.col("Latitude").cast("double"), F.col("Longitude").cast("double")
    )


def inherit_from_parent(spark, sf):
    return stations.inherit_from_parent(_stations_with_zip(spark, sf)).select(
        "SeqNo", "DHID", "Parent", "MunicipalityCode", "Municipality", "name_ZIP", "PLZ",
        "ZIP_Group_Station",
    )


def geocode_reverse(spark, sf):
    found = geocode.nearest_zip(_stations(spark, sf, heavy=True), views.centres(spark, sf))
    return found.select("SeqNo", "Q_PLZ")


def geocode_forward(spark, sf):
    register = rentals.with_address(
        rentals.with_repaired_zip(views.known_places(spark, sf))
    ).select("address_string", "lat", "lng")
    centres = views.centres(spark, sf).withColumn("PLZ", zip_group(F.col("PLZ")))
    offers = _addresses(spark, sf).drop("lat", "lng")
    return geocode.coordinates_of(offers, register, centres, "zip_group").select(
        "scoutId", "tier", F.col("coords.Lat").alias("lat"), F.col("coords.Lng").alias("lng")
    )


def geocode_fuzzy(spark, sf):
    """Addresses with slips in them, and the most similar ones of the register."""
    written = materialise(_addresses(spark, sf).select("scoutId", "address_string"), "addresses")
    offers = written.where("address_string IS NOT NULL").selectExpr(
        "scoutId", f"{views.SLIPPED_ADDRESS} AS address_string"
    )
    register = rentals.with_address(
        rentals.with_repaired_zip(views.known_places(spark, sf))
    ).select("address_string")
    found = geocode.nearest_addresses(offers, register, SLIPS)
    return offers.join(found, "address_string").select(
        "scoutId", "address_string", "match", "distance"
    )


def resolve_residual(spark, sf):
    return geocode.resolve_zips(_stations(spark, sf, heavy=True), views.centres(spark, sf))


def stations_zip_final(spark, sf):
    return _stations_final(spark, sf).select("SeqNo", "DHID", "PLZ", "ZIP_Group_Station")


def station_candidates(spark, sf):
    found = match.station_candidates(_stations(spark, sf))
    return found.withColumns({
        "Latitude": F.col("Latitude").cast("double"),
        "Longitude": F.col("Longitude").cast("double"),
    })


def stations_grouped(spark, sf):
    final = materialise(_stations_final(spark, sf), "stations")
    return match.group_stations(rental_zip_groups(spark, sf), final).select(
        "ZIP_Group_Rental", "SeqNo", "DHID", "PLZ", "ZIP_Group_Station"
    )


def quality_counts(spark, sf):
    return quality.zip_counts(_stations_with_zip(spark, sf), _stations_final(spark, sf))


def zip_group_stats(spark, sf):
    return quality.zip_group_stats(rental_zip_groups(spark, sf), _stations_final(spark, sf))


def duplicate_keys(spark, sf):
    return quality.duplicate_keys(views.stations(spark, sf), ["MunicipalityCode"])


def rentals_without_station(spark, sf):
    # Zip codes of municipalities only: groups without one have no stations yet.
    known = stations.inherit_from_parent(_stations_with_zip(spark, sf))
    missed = match.rentals_without_station(_rentals(spark, sf), known)
    return missed.select("scoutId", "zip_group")


def quantile_split(spark, sf):
    customers = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_acctbal")
    low, high = split.split_at_quantile(customers, "c_custkey")
    return split.reunite(
        low.withColumn("part", F.lit("A")), high.withColumn("part", F.lit("B"))
    )


def quantile_merged(spark, sf):
    """Quantiles of a table that grew by runs, from sketches of the runs, and whether they are close."""
    root, shares = scratch_path(spark, "tables"), [0.1, 0.25, 0.5, 0.9]
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderstatus", "o_totalprice")
    for status in ("O", "F", "P"):
        run = orders.where(F.col("o_orderstatus") == status)
        split.append_with_sketch(run, "orders", root, status, ["o_totalprice"])
    found = split.stored_quantiles(spark, "orders", root, "o_totalprice", shares).collect()
    below = orders.agg(F.count("*").alias("n"), *[
        F.count_if(F.col("o_totalprice") <= row["value"]).alias(f"n{i}")
        for i, row in enumerate(found)
    ])
    return below.select(F.inline(F.array(*[F.struct(
        F.lit(row["quantile"]).alias("quantile"), F.lit(row["n_rows"]).alias("n_rows"),
        (F.abs(F.col(f"n{i}") / F.col("n") - row["quantile"]) <= split.SKETCH_ERROR).alias("is_close"),
    ) for i, row in enumerate(found)])))


def surrogate_id(spark, sf):
    """One row: the rows that got an id, and the distinct ids."""
    customers = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey")
    return split.with_row_id(customers).agg(
        F.count("*").alias("n_rows"), F.countDistinct("_id").alias("n_ids")
    )


def _raises(error: type[Exception], check, *given) -> bool:
    try:
        check(*given)
    except error:
        return True
    return False


def source_exists(spark, sf):
    """One row: a table before and after it is written, and its rows."""
    root = scratch_path(spark, "tables")
    path = table_path(root, "table_stations")
    before = files.source_exists(spark, path)
    write_table(views.stations(spark, sf), "table_stations", root)
    after = files.source_exists(spark, path)
    return read_table(spark, "table_stations", root).agg(
        F.count("*").alias("n_rows"), F.lit(before).alias("before"), F.lit(after).alias("after")
    )


def _column_checks(table: DataFrame, expected: StructType, left_out: str) -> DataFrame:
    """One row: which checks raise on a table, with all its columns and without one."""
    short = table.drop(left_out)
    raised = {
        "whole_misses": _raises(SchemaMismatch, require_columns, table, expected.names),
        "short_misses": _raises(SchemaMismatch, require_columns, short, expected.names),
        "whole_differs": _raises(SchemaMismatch, require_same_columns, table, expected),
        "short_differs": _raises(SchemaMismatch, require_same_columns, short, expected),
    }
    return table.agg(
        F.count("*").alias("n_rows"), *[F.lit(v).alias(name) for name, v in raised.items()]
    )


def column_checks(spark, sf):
    return _column_checks(views.centres(spark, sf), schema("MAPPING_ZIP_COOR"), "lng")


def station_column_checks(spark, sf):
    return _column_checks(views.station_file(spark, sf), schema("STATION"), "TariffName")


def row_count_kept(spark, sf):
    """One row: whether the count check raises for a step that keeps rows, and for one that drops."""
    before, after = views.stations(spark, sf), _stations(spark, sf)
    kept = _raises(quality.RowCountChanged, quality.require_same_count, before, after)
    fewer = after.where("Latitude IS NOT NULL")
    dropped = _raises(quality.RowCountChanged, quality.require_same_count, before, fewer)
    return after.agg(
        F.count("*").alias("n_rows"), F.count("Latitude").alias("n_located"),
        F.lit(kept).alias("whole_differs"), F.lit(dropped).alias("located_differ"),
    )


def map_markers(spark, sf):
    return map_features(_addresses(spark, sf), _nearest(spark, sf)).drop("feature")


def _all_features(spark, sf):
    nearest = materialise(_nearest(spark, sf), "nearest")
    addresses = _addresses(spark, sf).select("scoutId", "address_string")
    offers = _rentals(spark, sf, heavy=True).select("scoutId", "lat", "lng").join(
        nearest.select("scoutId"), "scoutId", "left_semi"
    ).join(addresses, "scoutId", "left")
    return map_features(offers, nearest)


def map_all_features(spark, sf):
    """The features, read back from their JSON, of all offers with stations, address or not."""
    kind = (
        "type string, geometry struct<type: string, coordinates: array<double>>, properties "
        "struct<scoutId: int, role: string, rank: int, label: string, color: string>"
    )
    return _all_features(spark, sf).select(F.from_json("feature", kind).alias("f")).selectExpr(
        "f.type AS type", "f.geometry.type AS shape", "f.geometry.coordinates[1] AS lat",
        "f.geometry.coordinates[0] AS lng", "f.properties.*",
    )


def _write_csv(df: DataFrame, label: str, **options: str) -> str:
    path = scratch_path(df.sparkSession, label)
    df.write.options(header=True, **options).csv(path)
    return path


def _read_rental_file(spark: SparkSession, sf: str) -> DataFrame:
    path = _write_csv(views.rental_file(spark, sf), "rentals", escape='"')
    return files.read_rentals(spark, path)


def scan_rental_csv(spark, sf):
    return _read_rental_file(spark, sf)


def scan_station_csv(spark, sf):
    path = _write_csv(views.station_file(spark, sf), "stations", sep=";")
    return files.read_stations(spark, path)


def scan_mapping(spark, sf):
    return files.read_municipal_zips(spark, _write_csv(views.mapping(spark, sf), "mapping"))


def scan_zip_coord(spark, sf):
    return files.read_zip_coordinates(spark, _write_csv(views.centres(spark, sf), "centres"))


def table_roundtrip(spark, sf):
    root = scratch_path(spark, "tables")
    write_table(views.stations(spark, sf), "table_stations", root)
    return read_table(spark, "table_stations.parquet/", root)


def partitioned_roundtrip(spark, sf):
    root = scratch_path(spark, "tables")
    final = stations_zip_final(spark, sf)
    write_table(final, "table_stations_with_zip_final", root, partition_by="ZIP_Group_Station")
    return read_table(
        spark, "table_stations_with_zip_final", root, partition_by="ZIP_Group_Station"
    )


def append_roundtrip(spark, sf):
    root = scratch_path(spark, "tables")
    everything = views.stations(spark, sf)
    parents = everything.where(F.col("Type") == "S")
    others = everything.where(F.col("Type") != "S")
    write_table(parents, "table_stations", root)
    for run, rows in (("2", others), ("2", others)):
        append_run(rows, "table_stations", root, run)
    return read_table(spark, "table_stations", root)


def _extract(spark: SparkSession, sf: str, columns: list[str]) -> DataFrame:
    root = scratch_path(spark, "tables")
    offers = _read_rental_file(spark, sf)
    extract_table(offers.unionByName(offers), columns, "extract", root)
    return read_table(spark, "extract", root)


def extract_location(spark, sf):
    return _extract(spark, sf, RENTAL_LOCATION)


def extract_price_cost(spark, sf):
    return _extract(spark, sf, RENTAL_PRICE_AND_COST)


def extract_feature(spark, sf):
    return _extract(spark, sf, RENTAL_FEATURE)


def lookup_hook_forward(spark, sf):
    """A stand-in service that answers with the length and the spaces of an address."""

    def service(keys: pd.DataFrame) -> pd.DataFrame:
        texts = keys["address_string"]
        return pd.DataFrame({
            "lat": texts.str.len().astype(float), "lng": texts.str.count(" ").astype(float),
        })

    offers = _addresses(spark, sf).select("scoutId", "address_string")
    return call_lookup(offers, ["address_string"], service, "lat double, lng double", "scoutId")


def lookup_hook_reverse(spark, sf):
    """A stand-in service that answers with the whole degrees of a coordinate."""

    def service(keys: pd.DataFrame) -> pd.DataFrame:
        whole = keys["Latitude"].astype(int) * 1000 + keys["Longitude"].astype(int)
        return pd.DataFrame({"Q_PLZ": whole.astype(str)})

    located = _stations(spark, sf).select("SeqNo", "Latitude", "Longitude")
    found = call_lookup(located, ["Latitude", "Longitude"], service, "Q_PLZ string", "SeqNo")
    return found.select("SeqNo", "Q_PLZ")


def lookup_retry(spark, sf):
    """Open rows go to a second service; the first fails for some keys and lacks others."""

    def whole(keys: pd.DataFrame) -> pd.Series:
        return keys["Latitude"].astype(int) * 1000 + keys["Longitude"].astype(int)

    def first(keys: pd.DataFrame) -> pd.DataFrame:
        number = whole(keys)
        if (number % 3 == 0).any():
            raise OSError("no answer")
        return pd.DataFrame({"Q_PLZ": number.astype(str).where(number % 2 == 0, None)})

    def second(keys: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"Q_PLZ": whole(keys).astype(str)})

    located = _stations(spark, sf).select("SeqNo", "Latitude", "Longitude").where(
        "Latitude IS NOT NULL AND Longitude IS NOT NULL"
    )
    keys = ["Latitude", "Longitude"]
    return geocode.resolve_residual(located, ["SeqNo"], "Q_PLZ", [
        lambda rows: call_lookup(rows, keys, first, "Q_PLZ string", "SeqNo"),
        lambda rows: call_lookup(rows, keys, second, "Q_PLZ string", "SeqNo"),
    ])


def lookup_stored(spark, sf):
    """Two runs share their answers: the second one asks for the keys that failed in the first."""
    def whole(keys: pd.DataFrame) -> pd.Series:
        return keys["Latitude"].astype(int) * 1000 + keys["Longitude"].astype(int)

    def first(keys: pd.DataFrame) -> pd.DataFrame:
        number = whole(keys)
        fails = number % 3 == 0
        return pd.DataFrame({
            "Q_PLZ": number.astype(str).where(~fails, None),
            ERROR: fails.map({True: "no answer", False: None}),
        })

    def second(keys: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"Q_PLZ": "later " + whole(keys).astype(str)})

    located = _stations(spark, sf).select("SeqNo", "Latitude", "Longitude")
    keys, root = ["Latitude", "Longitude"], scratch_path(spark, "answers")
    for service in (first, second):
        found = stored_lookup(
            located, keys, service, "Q_PLZ string", "SeqNo", root, "answers", pieces=2
        )
    return found.select("SeqNo", "Q_PLZ")


QUERIES = {
    "knn_stations": knn_stations,
    "knn_refresh": knn_refresh,
    "knn_stream": knn_stream,
    "knn_stations_dense": knn_stations_dense,
    "geocode_reverse_dense": geocode_reverse_dense,
    "nearest_for_one": nearest_for_one,
    "rental_station_keys": rental_station_keys,
    "zip_repair": zip_repair,
    "bad_zip_report": bad_zip_report,
    "rental_address": rental_address,
    "rental_zip_groups": rental_zip_groups,
    "station_coords": station_coords,
    "stations_with_zip": stations_with_zip,
    "stations_missing_zip": stations_missing_zip,
    "inherit_from_parent": inherit_from_parent,
    "geocode_reverse": geocode_reverse,
    "geocode_forward": geocode_forward,
    "geocode_fuzzy": geocode_fuzzy,
    "resolve_residual": resolve_residual,
    "stations_zip_final": stations_zip_final,
    "station_candidates": station_candidates,
    "stations_grouped": stations_grouped,
    "quality_counts": quality_counts,
    "zip_group_stats": zip_group_stats,
    "duplicate_keys": duplicate_keys,
    "rentals_without_station": rentals_without_station,
    "quantile_split": quantile_split,
    "quantile_merged": quantile_merged,
    "surrogate_id": surrogate_id,
    "source_exists": source_exists,
    "column_checks": column_checks,
    "station_column_checks": station_column_checks,
    "row_count_kept": row_count_kept,
    "map_features": map_markers,
    "map_all_features": map_all_features,
    "scan_rental_csv": scan_rental_csv,
    "scan_station_csv": scan_station_csv,
    "scan_mapping": scan_mapping,
    "scan_zip_coord": scan_zip_coord,
    "table_roundtrip": table_roundtrip,
    "partitioned_roundtrip": partitioned_roundtrip,
    "append_roundtrip": append_roundtrip,
    "extract_location": extract_location,
    "extract_price_cost": extract_price_cost,
    "extract_feature": extract_feature,
    "lookup_hook_forward": lookup_hook_forward,
    "lookup_hook_reverse": lookup_hook_reverse,
    "lookup_retry": lookup_retry,
    "lookup_stored": lookup_stored,
}
