"""The same queries as SQL over the raw test tables.

Bounds, labels and the year are written out here once more, so that a wrong one in the package
shows.
"""

from __future__ import annotations

POSITION = """
    CASE WHEN l_partkey % 50 = 0 THEN 0.0::DOUBLE
         ELSE 33.5::DOUBLE + (l_partkey % 40) / 50.0::DOUBLE END AS "LAT",
    CASE WHEN l_partkey % 50 = 0 THEN 0.0::DOUBLE
         ELSE -118.8::DOUBLE + (l_suppkey % 30) / 50.0::DOUBLE END AS "LON"
"""

INCIDENTS = f"""
incidents AS (
    SELECT l_orderkey AS "DR_NO",
           strftime(l_shipdate, '%m/%d/%Y %I:%M:%S %p') AS "DATE OCC",
           ((l_orderkey * 7 + l_linenumber * 131) % 2400)::VARCHAR AS "TIME OCC",
           (l_suppkey % 25)::INTEGER AS "AREA",
           CASE WHEN l_returnflag = 'R' THEN 'STREET' ELSE 'OTHER' END AS "Premis Desc",
           CASE WHEN l_linenumber <> 7
                THEN substring('HBWOACDFGIJKLPSUVXZ-', (1 + l_orderkey % 20)::INTEGER, 1) END AS "Vict Descent",
           (l_quantity * 10)::INTEGER AS "Weapon Used Cd",
           {POSITION}
    FROM lineitem
)
"""

ORDER_INCIDENTS = """
order_incidents AS (
    SELECT strftime(o_orderdate, '%m/%d/%Y %I:%M:%S %p') AS "DATE OCC" FROM orders
)
"""

GEOCODE = f"""
geocode AS (
    SELECT DISTINCT {POSITION},
           (90000 + (l_partkey % 40 * 7 + l_suppkey % 30 * 3 + l_orderkey % 3) % 25)::VARCHAR
           || CASE l_orderkey % 3 WHEN 0 THEN '; 90050' WHEN 1 THEN '-3018' ELSE '' END
           AS "ZIPcode"
    FROM lineitem
),
lookup AS (
    SELECT "LAT", "LON", min(regexp_split_to_array("ZIPcode", '[;:-]')[1]) AS zip_code
    FROM geocode GROUP BY "LAT", "LON"
)
"""

INCOMES = """
incomes AS (
    SELECT (90000 + c_nationkey)::BIGINT AS zip, round(avg(c_acctbal)) AS income
    FROM customer GROUP BY c_nationkey
)
"""

STATIONS = """
stations AS (
    SELECT n_nationkey + 1 AS "OBJECTID", n_name AS "DIVISION", n_nationkey AS "PREC",
           -118.6::DOUBLE + 0.02::DOUBLE * n_nationkey AS x,
           33.6::DOUBLE + 0.03::DOUBLE * n_nationkey AS y
    FROM nation
)
"""

BRANCHES = """
    WHEN hhmm BETWEEN 500 AND 1159 THEN 'Morning'
    WHEN hhmm BETWEEN 1200 AND 1659 THEN 'Afternoon'
    WHEN hhmm BETWEEN 1700 AND 2059 THEN 'Evening'
"""
NIGHT = "hhmm >= 2100 OR hhmm <= 459"
BOUNDED_NIGHT = "hhmm BETWEEN 2100 AND 2359 OR hhmm BETWEEN 0 AND 499"

# Descent codes and their labels.
LABEL = """CASE "Vict Descent"
    WHEN 'A' THEN 'Other Asian' WHEN 'B' THEN 'Black' WHEN 'C' THEN 'Chinese'
    WHEN 'D' THEN 'Cambodian' WHEN 'F' THEN 'Filipino' WHEN 'G' THEN 'Guamanian'
    WHEN 'H' THEN 'Hispanic/Latin/Mexican' WHEN 'I' THEN 'American Indian/Alaskan Native'
    WHEN 'J' THEN 'Japanese' WHEN 'K' THEN 'Korean' WHEN 'L' THEN 'Laotian' WHEN 'O' THEN 'Other'
    WHEN 'P' THEN 'Pacific Islander' WHEN 'S' THEN 'Samoan' WHEN 'U' THEN 'Hawaiian'
    WHEN 'V' THEN 'Vietnamese' WHEN 'W' THEN 'White' WHEN 'X' THEN 'Unknown'
    WHEN 'Z' THEN 'Asian Indian' END"""

DISTANCE = """
2 * 6371 * asin(sqrt(
    sin(radians(y - "LAT") / 2) ** 2
    + cos(radians("LAT")) * cos(radians(y)) * sin(radians(x - "LON") / 2) ** 2))
"""

IN_TEST_YEAR = """substring("DATE OCC", 7, 4) = '1999'"""

ALL_ORDERS = "SELECT * FROM orders"


def _top_months(rank: str, year: str, month: str) -> str:
    return f"""
        WITH {ORDER_INCIDENTS}, monthly AS (
            SELECT substring("DATE OCC", 7, 4) AS y, substring("DATE OCC", 1, 2) AS m,
                   count(*) AS crime_total
            FROM order_incidents GROUP BY 1, 2
        ), ranked AS (
            SELECT *, rank() OVER (PARTITION BY y ORDER BY crime_total DESC) AS r FROM monthly
        )
        SELECT y AS "{year}", m AS "{month}", crime_total, r::INTEGER AS "{rank}"
        FROM ranked WHERE r <= 3
    """


def _segments(night: str, limit: str = "") -> str:
    return f"""
        WITH {INCIDENTS}, street AS (
            SELECT TRY_CAST("TIME OCC" AS BIGINT) AS hhmm FROM incidents
            WHERE "Premis Desc" = 'STREET'
        )
        SELECT count(*) AS incidents,
               CASE {BRANCHES} WHEN {night} THEN 'Night' ELSE 'NA' END AS time_segment
        FROM street GROUP BY 2 ORDER BY 1 DESC, 2 {limit}
    """


def _victims(direction: str) -> str:
    return f"""
        WITH {INCIDENTS}, {GEOCODE}, {INCOMES}, located AS (
            SELECT {LABEL} AS victim_descent, zip_code::BIGINT AS zip
            FROM incidents JOIN lookup USING ("LAT", "LON")
            WHERE {IN_TEST_YEAR} AND "Vict Descent" IS NOT NULL
        ), picked AS (
            SELECT zip FROM incomes WHERE zip IN (SELECT zip FROM located)
            ORDER BY income {direction}, zip LIMIT 3
        )
        SELECT victim_descent, count(*) AS victims FROM located
        WHERE zip IN (SELECT zip FROM picked) GROUP BY 1
    """


def _joined(columns: str) -> str:
    return f"""
        WITH {INCIDENTS}, {STATIONS}
        SELECT {columns} FROM incidents JOIN stations ON "AREA" = "PREC"
    """


def _top_incomes(direction: str) -> str:
    return f"WITH {INCOMES} SELECT zip, income FROM incomes ORDER BY income {direction}, zip LIMIT 3"


_COUNTS = f"""
    SELECT '{{}}' AS variant, "DIVISION", count(*) AS incidents
    FROM incidents JOIN stations ON "AREA" = "PREC" WHERE {IN_TEST_YEAR} GROUP BY "DIVISION"
"""

_DIGESTS = f"""
    WITH {INCIDENTS}, {STATIONS}
    SELECT variant, "AREA" AS key, count(*) AS expected_rows, count(*) AS found_rows, true AS matches
    FROM incidents JOIN stations ON "AREA" = "PREC",
         (VALUES ('broadcast'), ('repartition'), ('copartitioned'), ('bucketed')) AS variants(variant)
    GROUP BY variant, "AREA"
"""

PROFILED = ("whole", "price", "mixed", "date", "jumble", "text", "nothing")

PROFILE = """
    WITH texts AS (
        SELECT o_orderkey::VARCHAR AS whole,
               CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' WHEN o_orderkey % 13 = 0 THEN NULL
                    ELSE (o_orderkey * 3) || '.25' END AS price,
               CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey * 3) || '.25' ELSE o_orderkey::VARCHAR END AS mixed,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS date,
               CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
                    WHEN 1 THEN o_custkey::VARCHAR ELSE '' END AS jumble,
               o_orderpriority AS text, NULL::VARCHAR AS nothing
        FROM orders
    ), listed AS ({listed}), typed AS (
        SELECT "column", value, CASE WHEN value SIMILAR TO '[0-9]+' THEN value::BIGINT END AS l,
               CASE WHEN value SIMILAR TO '[0-9]+([.][0-9]+)?' THEN value::DOUBLE END AS d,
               TRY_CAST(CASE WHEN value LIKE '____-__-__ %' THEN value END AS TIMESTAMP) AS t
        FROM listed
    ), counted AS (
        SELECT "column", count(*) AS rows, count(*) - count(value) AS nulls, count(l) AS longs, count(d) AS doubles,
               count(t) AS timestamps, min(l) AS least_long, min(d) AS least_double, min(t) AS first,
               min(length(value))::INTEGER AS shortest, max(l) AS most_long, max(d) AS most_double, max(t) AS last,
               max(length(value))::INTEGER AS longest, count(value) AS n, greatest(count(d), count(t)) AS most
        FROM typed GROUP BY "column"
    )
    SELECT * EXCLUDE (n, most),
           CASE WHEN n = 0 THEN 'string' WHEN longs = n THEN 'bigint' WHEN doubles = n THEN 'double'
                WHEN timestamps = n THEN 'timestamp_ntz' ELSE 'string' END AS type,
           CASE WHEN 2 * most <= n THEN 'string' WHEN longs = most THEN 'bigint' WHEN doubles = most THEN 'double'
                ELSE 'timestamp_ntz' END AS likely,
           CASE WHEN 2 * most <= n THEN 0 ELSE n - most END AS misfits
    FROM counted
""".format(listed=" UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value FROM texts" for c in PROFILED))

_LOWEST, _HIGHEST = _victims("ASC"), _victims("DESC")

SQL = {
    "etl_union_renamed": ALL_ORDERS,
    "etl_csv_to_parquet": ALL_ORDERS,
    "csv_roundtrip": ALL_ORDERS,
    "parquet_roundtrip": ALL_ORDERS,
    "csv_untyped_scan": """
        SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_brand, p_type, p_size::VARCHAR AS p_size,
               p_retailprice::VARCHAR AS p_retailprice
        FROM part
    """,
    "csv_lossless": """
        WITH odd AS (
            SELECT p_partkey, CASE p_partkey % 8
                WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' || p_name || chr(9) || ' '
                WHEN 3 THEN '"' || p_name || '", "' WHEN 4 THEN p_name || chr(10) || 'next' || chr(92)
                WHEN 5 THEN chr(92) || '"' || p_name || chr(92) WHEN 6 THEN ' ' ELSE p_name END AS odd
            FROM part
        )
        SELECT p_partkey, odd, reverse(odd) AS turned FROM odd
    """,
    "etl_rejects": """
        WITH typed AS (
            SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS o_custkey,
                   CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 THEN o_totalprice END AS o_totalprice,
                   o_custkey AS raw
            FROM orders
        )
        SELECT o_orderkey, o_custkey, o_totalprice, 'o_custkey' AS rejected_column, 'A' || raw AS rejected_text
        FROM typed WHERE o_orderkey % 7 = 0
        UNION ALL
        SELECT o_orderkey, o_custkey, o_totalprice, 'o_totalprice',
               CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' ELSE '' END
        FROM typed WHERE o_orderkey % 11 = 0 OR o_orderkey % 13 = 0
    """,
    "etl_malformed": """
        WITH lines AS (
            SELECT o_orderkey, o_custkey, o_orderkey || ',' || o_custkey AS start,
                   'day ' || (o_orderkey % 5) || ', sent' AS note,
                   CASE WHEN o_orderkey % 17 = 0 THEN 'short' WHEN o_orderkey % 19 = 0 THEN 'long'
                        WHEN o_orderkey % 23 = 0 THEN 'open' END AS fault
            FROM orders
        )
        SELECT o_orderkey, o_custkey, note, NULL::VARCHAR AS reason, NULL::VARCHAR AS line
        FROM lines WHERE fault IS NULL
        UNION ALL
        SELECT NULL, NULL, NULL, CASE fault WHEN 'open' THEN 'odd number of quotes' ELSE 'not 3 fields' END,
               start || CASE fault WHEN 'short' THEN '' WHEN 'long' THEN ',"' || note || '", more ' ELSE ',"open' END
        FROM lines WHERE fault IS NOT NULL
    """,
    "etl_verify": f"""
        WITH {INCIDENTS}
        SELECT substring("DATE OCC", 7, 4)::INTEGER AS occ_year, count(*) AS parquet_rows,
               count(*) AS csv_rows, true AS matches
        FROM incidents GROUP BY 1
    """,
    "etl_incremental": """
        WITH reports AS (
            SELECT o_orderkey AS "DR_NO", o_custkey AS area, o_orderdate < '1999-01-01' AS old,
                   strftime(o_orderdate, '%m/%d/%Y %I:%M:%S %p') AS date
            FROM orders
        ), merged AS (
            SELECT "DR_NO", CASE WHEN old AND "DR_NO" % 100 = 0 THEN '12/31/1998 12:00:00 AM' ELSE date END AS "DATE OCC",
                   (CASE WHEN old AND "DR_NO" % 50 = 0 THEN area + 1 ELSE area END)::INTEGER AS "AREA",
                   CASE WHEN old AND "DR_NO" % 50 = 0 THEN 3 ELSE 1 END AS version
            FROM reports
        )
        SELECT *, substring("DATE OCC", 7, 4)::INTEGER AS occ_year FROM merged
    """,
    "etl_schema_drift": """
        SELECT 'old' AS origin, o_orderkey, o_totalprice, o_custkey::VARCHAR AS o_custkey, o_orderstatus,
               NULL::VARCHAR AS o_orderpriority
        FROM orders WHERE o_orderkey % 2 = 0
        UNION ALL
        SELECT 'new', o_orderkey, round(o_totalprice), o_custkey::VARCHAR, NULL, o_orderpriority
        FROM orders WHERE o_orderkey % 2 <> 0
    """,
    "csv_type_profile": PROFILE,
    "months_incremental": _top_months("rank", "Year", "Month"),
    "lookup_incremental": f'WITH {GEOCODE} SELECT "LAT" AS lat, "LON" AS lon, zip_code FROM lookup',
    "date_parts_text": f"""
        WITH {ORDER_INCIDENTS}
        SELECT "DATE OCC" AS date_text, substring("DATE OCC", 7, 4) AS year,
               substring("DATE OCC", 1, 2) AS month
        FROM order_incidents
    """,
    "first_token": f"""
        WITH {GEOCODE}
        SELECT "ZIPcode" AS written, regexp_split_to_array("ZIPcode", '[;:-]')[1] AS zip_code
        FROM geocode
    """,
    "parse_money": """
        SELECT c_custkey, '$' || format('{:,}', round(c_acctbal)::BIGINT) AS written,
               round(c_acctbal)::BIGINT AS amount
        FROM customer
    """,
    "decode_codes": f"""
        WITH {INCIDENTS}
        SELECT "DR_NO" AS dr_no, "Vict Descent" AS code, {LABEL} AS victim_descent FROM incidents
    """,
    "haversine_km": f"""
        WITH {INCIDENTS}, {STATIONS}
        SELECT "DR_NO" AS dr_no, round({DISTANCE}, 6) AS distance_km
        FROM incidents JOIN stations ON "AREA" = "PREC"
    """,
    "time_segments": f"""
        WITH {INCIDENTS}, times AS (SELECT TRY_CAST("TIME OCC" AS BIGINT) AS hhmm FROM incidents)
        SELECT hhmm, CASE {BRANCHES} WHEN {NIGHT} THEN 'Night' ELSE 'NA' END AS unbounded,
               CASE {BRANCHES} WHEN {BOUNDED_NIGHT} THEN 'Night' ELSE 'NA' END AS bounded
        FROM times
    """,
    "q1_top_months_df": _top_months("rank", "Year", "Month"),
    "q1_top_months_sql": _top_months("ranking", "year", "month"),
    "q1_top_months_df_csv": _top_months("rank", "Year", "Month"),
    "q1_top_months_sql_csv": _top_months("ranking", "year", "month"),
    "q2_segments_sql": _segments(NIGHT),
    "q2_segments_df": _segments(NIGHT),
    "q2_segments_bounded": _segments(BOUNDED_NIGHT),
    "q2_segments_csv": _segments(BOUNDED_NIGHT),
    "q2_top3_segments": _segments(BOUNDED_NIGHT, "LIMIT 3"),
    "q2_top5_segments": _segments(BOUNDED_NIGHT, "LIMIT 5"),
    "lookup_min_per_key": f'WITH {GEOCODE} SELECT "LAT" AS lat, "LON" AS lon, zip_code FROM lookup',
    "semi_join_zip": f"""
        WITH {INCIDENTS}, {GEOCODE}, {INCOMES}
        SELECT zip, income FROM incomes WHERE zip IN (
            SELECT zip_code::BIGINT FROM incidents JOIN lookup USING ("LAT", "LON")
            WHERE {IN_TEST_YEAR} AND "Vict Descent" IS NOT NULL)
    """,
    "topk_low": _top_incomes("ASC"),
    "topk_high": _top_incomes("DESC"),
    "topk_unreadable": f"""
        WITH {INCOMES}
        SELECT zip, CASE WHEN zip % 3 <> 0 THEN income END AS income FROM incomes
        ORDER BY 2 ASC NULLS LAST, zip LIMIT 20
    """,
    "q3_lowest_income": _LOWEST,
    "q3_highest_income": _HIGHEST,
    "q3_lowest_income_stored": _LOWEST,
    "q3_lowest_income_sql": _LOWEST,
    "q3_highest_income_sql": _HIGHEST,
    "q3_sql_hint_broadcast": _LOWEST,
    "q3_sql_hint_merge": _LOWEST,
    "q3_sql_hint_shuffle_hash": _LOWEST,
    "q3_highest_hint_broadcast": _HIGHEST,
    "q3_highest_hint_merge": _HIGHEST,
    "q3_highest_hint_shuffle_hash": _HIGHEST,
    "q3_hint_broadcast": _LOWEST,
    "q3_hint_merge": _LOWEST,
    "q3_hint_shuffle_hash": _LOWEST,
    "q3_hint_replicate_nl": _LOWEST,
    "q4_distance_by_division": f"""
        WITH {INCIDENTS}, {STATIONS}
        SELECT "DIVISION", round(avg({DISTANCE}), 3) AS avg_distance_km,
               count(*) AS "incidents total"
        FROM incidents JOIN stations ON "AREA" = "PREC"
        WHERE "LAT" <> 0 AND "LON" <> 0 AND "Weapon Used Cd" BETWEEN 100 AND 199
        GROUP BY "DIVISION"
    """,
    "q3_merge_prefiltered": _LOWEST,
    "q4_clustered": f"""
        WITH {INCIDENTS}, {STATIONS}
        SELECT "DIVISION", round(avg({DISTANCE}), 3) AS avg_distance_km,
               count(*) AS "incidents total"
        FROM incidents JOIN stations ON "AREA" = "PREC"
        WHERE "LAT" BETWEEN 33.6 AND 33.8 AND "LON" BETWEEN -118.7 AND -118.55 AND "Weapon Used Cd" BETWEEN 100 AND 199
        GROUP BY "DIVISION"
    """,
    "q4_join_broadcast": _joined("*"),
    "q4_join_repartition": _joined('"DR_NO", "DATE OCC", "AREA", "DIVISION", "PREC"'),
    "q4_join_copartitioned": _joined(
        '"AREA" AS key, "DR_NO" AS left_dr_no, "DATE OCC" AS left_date,'
        ' "DIVISION" AS right_division, "PREC" AS right_prec'
    ),
    "q4_join_copartitioned_4": _joined(
        '"AREA" AS key, "DR_NO" AS left_dr_no, "DIVISION" AS right_division'
    ),
    "q4_join_bucketed": _joined('"DR_NO", "DATE OCC", "AREA", "DIVISION", "PREC"'),
    "q4_verify_rows": f"SELECT * EXCLUDE (matches) FROM ({_DIGESTS}) WHERE NOT matches",
    "q4_verify_digests": _DIGESTS,
    "q4_verify_counts": f"WITH {INCIDENTS}, {STATIONS}"
    + " UNION ALL ".join(
        _COUNTS.format(variant)
        for variant in ("plain", "broadcast", "repartition", "copartitioned")
    ),
    "row_merge": """
        SELECT c_custkey, n_nationkey AS nationkey, n_name AS name, c_acctbal,
               n_regionkey AS regionkey
        FROM customer JOIN nation ON c_nationkey = n_nationkey
    """,
}
