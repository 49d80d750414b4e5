"""DuckDB SQL that answers the registered queries from the same test tables."""

from __future__ import annotations

from checks import views
from checks.queries import ONE_OFFER

# Fixed values, written out here so that the SQL does not take them from what it checks.
LEADING_ZERO_DISTRICTS = ["Bautzen_Kreis", "Vogtlandkreis", "Zwickau"]
PADDED_STATES = ["Niedersachsen", "Nordrhein_Westfalen", "Baden_Württemberg"]
PADDED_DISTRICTS = ["Plauen", "Dortmund"]
UNKNOWN_STREET_MARKS = ["None", "NULL", "no_information"]
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
]

# The columns of the rental file by the type they are read as, and those of the stored extracts.
INTEGERS = [
    "picturecount", "scoutId", "baseRentRange", "noRoomsRange", "livingSpaceRange",
]
DOUBLES = [
    "serviceCharge", "pricetrend", "totalRent", "yearConstructed", "yearConstructedRange", "baseRent",
    "numberOfFloors", "heatingCosts", "lastRefurbish", "electricityBasePrice", "electricityKwhPrice",
]
BOOLEANS = ["newlyConst", "balcony", "hasKitchen", "cellar", "lift", "garden"]
TEXTS = [
    "regio1", "heatingType", "telekomTvOffer", "telekomHybridUploadSpeed", "telekomUploadSpeed",
    "noParkSpaces", "firingTypes", "geo_bln", "houseNumber", "livingSpace", "geo_krs", "condition",
    "interiorQual", "petsAllowed", "street", "streetPlain", "typeOfFlat", "geo_plz", "noRooms",
    "thermalChar", "floor", "regio2", "regio3", "energyEfficiencyClass", "date",
]
LOCATION = [
    "scoutId", "date", "regio1", "regio2", "regio3", "geo_bln", "geo_krs", "geo_plz", "street",
    "streetPlain", "houseNumber",
]
PRICE_AND_COST = [
    "scoutId", "date", "serviceCharge", "newlyConst", "pricetrend", "totalRent", "baseRent",
    "baseRentRange", "heatingCosts", "electricityBasePrice", "electricityKwhPrice",
]
FEATURE = [
    "scoutId", "date", "heatingType", "telekomTvOffer", "telekomHybridUploadSpeed",
    "telekomUploadSpeed", "balcony", "yearConstructed", "yearConstructedRange", "noParkSpaces",
    "firingTypes", "hasKitchen", "cellar", "livingSpace", "condition", "interiorQual", "petsAllowed",
    "lift", "typeOfFlat", "noRooms", "thermalChar", "floor", "numberOfFloors", "noRoomsRange",
    "garden", "livingSpaceRange", "energyEfficiencyClass", "lastRefurbish",
]
STATION_TEXTS = [
    "Type", "DHID", "Parent", "Name", "Latitude", "Longitude", "MunicipalityCode", "Municipality",
    "DistrictCode", "District", "Condition", "State", "Description", "Authority", "DelfiName",
    "TariffDHID", "TariffName",
]


def _select(columns: dict[str, str], table: str) -> str:
    return f"SELECT {', '.join(views.select_list(columns))} FROM {table}"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _hits(column: str, words: list[str]) -> str:
    return " + ".join(
        f"CASE WHEN contains({column}, {_text(word)}) THEN 1 ELSE 0 END" for word in words
    )


IS_SHORT = "NOT regexp_matches(geo_plz, '^[0-9]{5}')"
REPAIRED = (
    f"CASE WHEN {IS_SHORT} THEN repeat('0', {_hits('geo_krs', LEADING_ZERO_DISTRICTS)}) || geo_plz"
    f" || repeat('X', {_hits('geo_bln', PADDED_STATES)} + {_hits('geo_krs', PADDED_DISTRICTS)})"
    " ELSE geo_plz END"
)
UNKNOWN = " OR ".join(f"contains(streetPlain, {_text(w)})" for w in UNKNOWN_STREET_MARKS)
KNOWN_STREET = (
    f"streetPlain IS NOT NULL AND streetPlain <> '' AND lower(streetPlain) <> 'nan' "
    f"AND NOT ({UNKNOWN})"
)
CLEANED = """
    replace(streetPlain, '_', ' ') AS streetPlain,
    regexp_replace(houseNumber, '[^0-9]', ' ', 'g') AS houseNumber, geo_plz,
    replace(replace(geo_krs, '_Kreis', ''), '_', ' ') AS geo_krs,
    replace(geo_bln, '_', ' ') AS geo_bln
"""
ADDRESS = (
    "streetPlain || ' ' || houseNumber || ', ' || geo_plz || ', ' || geo_krs || ', ' || geo_bln"
)
DEGREES = "CAST(TRY_CAST(replace({0}, ',', '.') AS FLOAT) AS DOUBLE)"
STATION_COLUMNS = {
    **views.STATION,
    "Latitude": DEGREES.format(f"({views.STATION['Latitude']})"),
    "Longitude": DEGREES.format(f"({views.STATION['Longitude']})"),
}
AWAY = "({a} - {c}) * ({a} - {c}) + ({b} - {d}) * ({b} - {d})"
TO_CENTRE = AWAY.format(a="s.Latitude", b="s.Longitude", c="c.lat", d="c.lng")
TO_STATION = AWAY.format(a="r.lat", b="r.lng", c="s.Latitude", d="s.Longitude")

# Each table is a common table expression and may read those before it.
TABLES = {
    "mapping": _select(views.MAPPING, "nation"),
    "centre": _select(views.CENTRE, "nation"),
    "raw_rental": _select(views.RENTAL, "customer"),
    "rental": f"SELECT * REPLACE ({REPAIRED} AS geo_plz), substr({REPAIRED}, 1, 3) AS zip_group "
              "FROM raw_rental",
    "cleaned": f"SELECT scoutId, lat, lng, zip_group, {CLEANED} FROM rental WHERE {KNOWN_STREET}",
    "address": f"SELECT *, {ADDRESS} AS address_string FROM cleaned",
    "station": _select(STATION_COLUMNS, "part"),
    "with_zip": "SELECT s.*, m.MunicipalityCode AS MunicipalityCode_ZIP, m.Name AS name_ZIP, m.PLZ "
                "FROM station s LEFT JOIN mapping m ON s.MunicipalityCode = m.MunicipalityCode",
    "inherited": """
        SELECT *, substr(PLZ, 1, 3) AS ZIP_Group_Station
        FROM with_zip WHERE MunicipalityCode <> '00000000'
        UNION ALL BY NAME
        SELECT c.* EXCLUDE (MunicipalityCode, Municipality, MunicipalityCode_ZIP, name_ZIP, PLZ),
               p.MunicipalityCode, p.Municipality, p.MunicipalityCode_ZIP, p.name_ZIP, p.PLZ,
               substr(p.PLZ, 1, 3) AS ZIP_Group_Station
        FROM with_zip c LEFT JOIN with_zip p
            ON c.Parent = p.DHID AND p.MunicipalityCode <> '00000000'
        WHERE c.MunicipalityCode = '00000000' OR c.MunicipalityCode IS NULL""",
    "dense_rental": _select(views.DENSE_RENTAL, "customer"),
    "dense_station": _select(views.DENSE_STATION, "orders"),
    "dense_centre": _select(views.DENSE_CENTRE, "orders"),
    "near_zip": f"""
        SELECT SeqNo, Q_PLZ, d FROM (
            SELECT s.SeqNo, c.PLZ AS Q_PLZ, {TO_CENTRE} AS d,
                   row_number() OVER (PARTITION BY s.SeqNo ORDER BY {TO_CENTRE}, c.PLZ) AS n
            FROM station s, centre c WHERE s.Latitude IS NOT NULL AND s.Longitude IS NOT NULL
        ) WHERE n = 1""",
    "final": "SELECT w.* REPLACE (coalesce(w.PLZ, z.Q_PLZ) AS PLZ), "
             "substr(coalesce(w.PLZ, z.Q_PLZ), 1, 3) AS ZIP_Group_Station "
             "FROM with_zip w LEFT JOIN near_zip z ON w.SeqNo = z.SeqNo",
    "candidate": "SELECT DISTINCT Latitude, Longitude, Parent, DHID, Name, ZIP_Group_Station "
                 "FROM final WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL "
                 "AND Parent IS NOT NULL AND DHID IS NOT NULL AND Name IS NOT NULL",
    "nearest": f"""
        SELECT * FROM (
            SELECT r.scoutId, s.*,
                   row_number() OVER (PARTITION BY r.scoutId ORDER BY {TO_STATION}, s.DHID) AS rank
            FROM rental r JOIN candidate s ON r.zip_group = s.ZIP_Group_Station
        ) WHERE rank <= 10""",
    "rental_groups": "SELECT DISTINCT zip_group AS ZIP_Group_Rental FROM rental",
    "register": (
        "SELECT address_string, lat, lng FROM (SELECT *, row_number() OVER "
        "(PARTITION BY address_string ORDER BY lat, lng) AS n FROM address "
        f"WHERE scoutId IN (SELECT c_custkey FROM customer WHERE {views.KNOWN_PLACE}) "
        "AND address_string IS NOT NULL) WHERE n = 1"
    ),
    "rental_file": _select(views.RENTAL_FILE, "customer"),
    "station_file": _select(views.STATION_FILE, "part"),
}
# The common table expressions each of them reads.
USES = {
    "rental": ["raw_rental"],
    "cleaned": ["rental"],
    "address": ["cleaned"],
    "with_zip": ["station", "mapping"],
    "inherited": ["with_zip"],
    "near_zip": ["station", "centre"],
    "final": ["with_zip", "near_zip"],
    "candidate": ["final"],
    "nearest": ["rental", "candidate"],
    "rental_groups": ["rental"],
    "register": ["address"],
}


# What some queries read twice.
STORED = {"nearest"}


def _with(tables: list[str], query: str) -> str:
    wanted: list[str] = []

    def want(name: str) -> None:
        for used in USES.get(name, []):
            want(used)
        if name not in wanted:
            wanted.append(name)

    for name in tables:
        want(name)
    parts = [
        f"{name} AS {'MATERIALIZED ' if name in STORED else ''}({TABLES[name]})" for name in wanted
    ]
    return f"WITH {', '.join(parts)} {query}"


def _typed(columns: list[str]) -> str:
    tokens = ", ".join(map(_text, NULL_TOKENS))
    kinds = {name: kind for kind, names in (
        ("VARCHAR", TEXTS), ("INTEGER", INTEGERS), ("DOUBLE", DOUBLES), ("BOOLEAN", BOOLEANS),
    ) for name in names}
    return ", ".join(
        f"TRY_CAST(CASE WHEN {name} IN ({tokens}) THEN NULL ELSE {name} END AS {kinds[name]}) "
        f"AS {name}" for name in columns
    )


def _extract(columns: list[str]) -> str:
    return _with(["rental_file"], f"SELECT DISTINCT {_typed(columns)} FROM rental_file")


_STATION_CELLS = ", ".join([
    "CAST(SeqNo AS INTEGER) AS SeqNo", *[f"nullif({name}, '') AS {name}" for name in STATION_TEXTS]
])

ORACLE = {
    "knn_stations": _with(["nearest"], "SELECT scoutId, rank, DHID, Parent, Name FROM nearest"),
    "knn_refresh": _with(["nearest"], "SELECT scoutId, rank, DHID, Parent, Name FROM nearest"),
    "knn_stream": _with(["nearest"], "SELECT scoutId, rank, DHID, Parent, Name FROM nearest"),
    "knn_stations_dense": _with(
        ["dense_rental", "dense_station"],
        f"""
        SELECT scoutId, rank, DHID FROM (
            SELECT r.scoutId, s.DHID,
                   row_number() OVER (PARTITION BY r.scoutId ORDER BY {TO_STATION}, s.DHID) AS rank
            FROM dense_rental r JOIN dense_station s ON r.zip_group = s.ZIP_Group_Station
        ) WHERE rank <= 10
        """,
    ),
    "geocode_reverse_dense": _with(
        ["dense_rental", "dense_centre"],
        f"""
        SELECT SeqNo, least.p AS Q_PLZ FROM (
            SELECT r.scoutId AS SeqNo, min({{'d': {AWAY.format(a="r.lat", b="r.lng", c="c.lat", d="c.lng")},
                                             'p': c.PLZ}}) AS least
            FROM dense_rental r, dense_centre c GROUP BY r.scoutId
        )
        """,
    ),
    "nearest_for_one": _with(
        ["nearest"], f"SELECT scoutId, rank, DHID FROM nearest WHERE scoutId = {ONE_OFFER}"
    ),
    "rental_station_keys": _with(
        ["rental", "final"],
        "SELECT r.scoutId, r.zip_group, count(*) AS stations FROM rental r "
        "JOIN final s ON r.zip_group = s.ZIP_Group_Station GROUP BY ALL",
    ),
    "zip_repair": _with(["rental"], "SELECT scoutId, geo_plz FROM rental"),
    "bad_zip_report": _with(
        ["raw_rental"], f"SELECT scoutId, geo_plz, geo_krs, geo_bln FROM raw_rental WHERE {IS_SHORT}"
    ),
    "rental_address": _with(
        ["address"],
        "SELECT scoutId, streetPlain, houseNumber, geo_plz, geo_krs, geo_bln, address_string "
        "FROM address",
    ),
    "rental_zip_groups": _with(["rental_groups"], "SELECT * FROM rental_groups"),
    "station_coords": _with(["station"], "SELECT SeqNo, Latitude, Longitude FROM station"),
    "stations_with_zip": _with(
        ["with_zip"],
        "SELECT SeqNo, DHID, MunicipalityCode, MunicipalityCode_ZIP, name_ZIP, PLZ FROM with_zip",
    ),
    "stations_missing_zip": _with(
        ["with_zip"], "SELECT SeqNo, Latitude, Longitude FROM with_zip WHERE PLZ IS NULL"
    ),
    "inherit_from_parent": _with(
        ["inherited"],
        "SELECT SeqNo, DHID, Parent, MunicipalityCode, Municipality, name_ZIP, PLZ, "
        "ZIP_Group_Station FROM inherited",
    ),
    "geocode_reverse": _with(["near_zip"], "SELECT SeqNo, Q_PLZ FROM near_zip"),
    "geocode_forward": _with(
        ["address", "register", "centre"],
        """
        SELECT a.scoutId,
               CASE WHEN g.lat IS NOT NULL THEN 1 WHEN c.lat IS NOT NULL THEN 2 END AS tier,
               coalesce(g.lat, c.lat) AS lat, coalesce(g.lng, c.lng) AS lng
        FROM address a LEFT JOIN register g ON a.address_string = g.address_string
        LEFT JOIN centre c ON a.zip_group = substr(c.PLZ, 1, 3)
        """,
    ),
    "geocode_fuzzy": _with(
        ["address", "register"],
        f"""
        SELECT scoutId, address_string, match, distance FROM (
            SELECT o.scoutId, o.address_string, g.address_string AS match,
                   CAST(levenshtein(o.address_string, g.address_string) AS INTEGER) AS distance,
                   row_number() OVER (PARTITION BY o.scoutId ORDER BY distance, match) AS n
            FROM (SELECT scoutId, zip_group, {views.SLIPPED_ADDRESS} AS address_string FROM address
                  WHERE address_string IS NOT NULL) AS o
            JOIN (SELECT DISTINCT address_string, zip_group FROM address
                  JOIN register USING (address_string)) AS g ON o.zip_group = g.zip_group
        ) WHERE n = 1 AND distance <= 2
        """,
    ),
    "resolve_residual": _with(
        ["near_zip"],
        """
        SELECT SeqNo, Q_PLZ, CASE WHEN d <= 0.125 * 0.125 THEN 1 WHEN d <= 0.25 * 0.25 THEN 2
               WHEN d <= 0.5 * 0.5 THEN 3 ELSE 4 END AS attempt
        FROM near_zip
        """,
    ),
    "stations_zip_final": _with(
        ["final"], "SELECT SeqNo, DHID, PLZ, ZIP_Group_Station FROM final"
    ),
    "station_candidates": _with(
        ["candidate"], "SELECT DISTINCT Latitude, Longitude, Parent, DHID, Name FROM candidate"
    ),
    "stations_grouped": _with(
        ["rental_groups", "final"],
        "SELECT r.ZIP_Group_Rental, s.SeqNo, s.DHID, s.PLZ, s.ZIP_Group_Station "
        "FROM rental_groups r LEFT JOIN final s ON r.ZIP_Group_Rental = s.ZIP_Group_Station",
    ),
    "quality_counts": _with(
        ["with_zip", "final"],
        """
        SELECT (SELECT count(*) FROM with_zip) AS rows_before,
               count(*) AS rows_after,
               (SELECT count(*) FROM with_zip WHERE PLZ IS NULL) AS zip_null_before,
               count(*) FILTER (WHERE PLZ IS NULL) AS zip_null_after,
               count(PLZ) AS zip_known_after,
               count(*) FILTER (WHERE PLZ = '') AS zip_blank_after,
               count(Latitude) AS latitudes_after,
               count(Longitude) AS longitudes_after
        FROM final
        """,
    ),
    "zip_group_stats": _with(
        ["rental_groups", "final"],
        "SELECT count(DISTINCT r.ZIP_Group_Rental) AS rental_groups, "
        "count(DISTINCT s.ZIP_Group_Station) AS matched_station_groups "
        "FROM rental_groups r LEFT JOIN final s ON r.ZIP_Group_Rental = s.ZIP_Group_Station",
    ),
    "duplicate_keys": _with(
        ["station"],
        "SELECT MunicipalityCode, count(*) AS n FROM station GROUP BY 1 HAVING count(*) > 1",
    ),
    "rentals_without_station": _with(
        ["rental", "inherited"],
        "SELECT scoutId, zip_group FROM rental r WHERE lat IS NULL OR lng IS NULL OR NOT EXISTS "
        "(SELECT 1 FROM inherited s WHERE s.ZIP_Group_Station = r.zip_group "
        "AND s.Latitude IS NOT NULL AND s.Longitude IS NOT NULL)",
    ),
    "quantile_split": (
        "SELECT c_custkey, c_acctbal, CASE WHEN c_custkey <= "
        "(SELECT quantile_disc(c_custkey, 0.5) FROM customer) THEN 'A' ELSE 'B' END AS part "
        "FROM customer"
    ),
    "quantile_merged": (
        "SELECT CAST(quantile AS DOUBLE) AS quantile, n_rows, true AS is_close "
        "FROM unnest([0.1, 0.25, 0.5, 0.9]) AS q(quantile), (SELECT count(*) AS n_rows FROM orders)"
    ),
    "surrogate_id": "SELECT count(*) AS n_rows, count(*) AS n_ids FROM customer",
    "source_exists": "SELECT count(*) AS n_rows, false AS before, true AS after FROM part",
    "column_checks": (
        "SELECT count(*) AS n_rows, false AS whole_misses, true AS short_misses, "
        "false AS whole_differs, true AS short_differs FROM nation"
    ),
    "station_column_checks": (
        "SELECT count(*) AS n_rows, false AS whole_misses, true AS short_misses, "
        "false AS whole_differs, true AS short_differs FROM part"
    ),
    "row_count_kept": _with(
        ["station"],
        "SELECT count(*) AS n_rows, count(Latitude) AS n_located, false AS whole_differs, "
        "count(*) <> count(Latitude) AS located_differ FROM station",
    ),
    "map_features": _with(
        ["address", "nearest"],
        "SELECT scoutId, 'rental' AS role, 0 AS rank, lat, lng, address_string AS label, "
        "'red' AS color FROM address WHERE lat IS NOT NULL AND lng IS NOT NULL UNION ALL "
        "SELECT scoutId, 'station', CAST(rank AS INTEGER), Latitude, Longitude, Name, 'blue' "
        "FROM nearest",
    ),
    "map_all_features": _with(
        ["rental", "address", "nearest"],
        "SELECT 'Feature' AS type, 'Point' AS shape, scoutId, 'rental' AS role, 0 AS rank, "
        "r.lat, r.lng, address_string AS label, 'red' AS color "
        "FROM rental r LEFT JOIN (SELECT scoutId, address_string FROM address) USING (scoutId) "
        "WHERE scoutId IN (SELECT scoutId FROM nearest) UNION ALL "
        "SELECT 'Feature', 'Point', scoutId, 'station', CAST(rank AS INTEGER), Latitude, "
        "Longitude, Name, 'blue' FROM nearest",
    ),
    "scan_rental_csv": _with(
        ["rental_file"], f"SELECT {_typed([*TEXTS, *INTEGERS, *DOUBLES, *BOOLEANS])} FROM rental_file"
    ),
    "scan_station_csv": _with(["station_file"], f"SELECT {_STATION_CELLS} FROM station_file"),
    "scan_mapping": _with(["mapping"], "SELECT * FROM mapping"),
    "scan_zip_coord": _with(["centre"], "SELECT * FROM centre"),
    "table_roundtrip": _select(views.STATION, "part"),
    "partitioned_roundtrip": _with(
        ["final"], "SELECT SeqNo, DHID, PLZ, ZIP_Group_Station FROM final"
    ),
    "append_roundtrip": _select(views.STATION, "part"),
    "extract_location": _extract(LOCATION),
    "extract_price_cost": _extract(PRICE_AND_COST),
    "extract_feature": _extract(FEATURE),
    "lookup_hook_forward": _with(
        ["address"],
        "SELECT scoutId, address_string, CAST(length(address_string) AS DOUBLE) AS lat, CAST("
        "length(address_string) - length(replace(address_string, ' ', '')) AS DOUBLE) AS lng "
        "FROM address",
    ),
    "lookup_hook_reverse": _with(
        ["station"],
        "SELECT SeqNo, CAST(CAST(floor(Latitude) AS INTEGER) * 1000 + "
        "CAST(floor(Longitude) AS INTEGER) AS VARCHAR) AS Q_PLZ FROM station",
    ),
    "lookup_retry": _with(
        ["station"],
        """
        SELECT SeqNo, CAST(n AS VARCHAR) AS Q_PLZ,
               CASE WHEN n % 3 <> 0 AND n % 2 = 0 THEN 1 ELSE 2 END AS attempt
        FROM (SELECT SeqNo, CAST(floor(Latitude) AS INTEGER) * 1000
                     + CAST(floor(Longitude) AS INTEGER) AS n FROM station)
        WHERE n IS NOT NULL
        """,
    ),
    "lookup_stored": _with(
        ["station"],
        """
        SELECT SeqNo, CASE WHEN n % 3 = 0 THEN 'later ' ELSE '' END || CAST(n AS VARCHAR) AS Q_PLZ
        FROM (SELECT SeqNo, CAST(floor(Latitude) AS INTEGER) * 1000
                     + CAST(floor(Longitude) AS INTEGER) AS n FROM station)
        """,
    ),
}
