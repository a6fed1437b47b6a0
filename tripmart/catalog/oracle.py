"""The registered queries as plain SQL, written independently of the Spark code.

Money and distances are counted in hundredths, so that every rounding is whole-
number arithmetic: `(2*a + b) // (2*b)` rounds a non-negative a/b half up.
"""

from __future__ import annotations

# Supplied tables in the shape of trips and zones.

_RAW = """
joined AS (
    SELECT l.*, o.o_orderkey, o.o_orderdate, c.c_nationkey, s.s_nationkey,
           CAST(round(l_extendedprice * 100) AS BIGINT) AS fare_c,
           CAST(round(l_discount * 100) AS BIGINT) AS discount_c,
           CAST(round(l_tax * 100) AS BIGINT) AS tax_c
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
raw AS (
    SELECT CAST(l_suppkey % 4 AS SMALLINT) AS vendor_id,
           o_orderdate + to_minutes(CAST(o_orderkey * 37 % 1440 AS BIGINT)) AS pickup_datetime,
           l_shipdate + to_minutes(CAST((l_partkey * 53 + l_linenumber * 7) % 1440 AS BIGINT))
               AS dropoff_datetime,
           CAST(l_linenumber AS SMALLINT) AS passenger_count,
           CAST(round((l_quantity - 1) * 100) AS BIGINT) AS dist_c,
           CAST(s_nationkey + 1 AS SMALLINT) AS pu_location_id,
           CAST(c_nationkey + 1 AS SMALLINT) AS do_location_id,
           fare_c,
           (fare_c * discount_c + 50) // 100 AS tip_c,
           (fare_c * (100 + tax_c) + 50) // 100 AS total_c,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS partition_date
    FROM joined
)"""

_STG = (
    _RAW
    + """,
stg AS (
    SELECT *, date_diff('minute', pickup_datetime, dropoff_datetime) AS minutes
    FROM raw
    WHERE dist_c > 0 AND pu_location_id IS NOT NULL AND do_location_id IS NOT NULL
      AND fare_c >= 0 AND total_c >= 0 AND dropoff_datetime > pickup_datetime
)"""
)


def _fixed(cents: str) -> str:
    """Text of an amount with two digits."""
    return f"(({cents}) // 100 || '.' || lpad(CAST(({cents}) % 100 AS VARCHAR), 2, '0'))"


_TRIP_ID = f"""md5(
    coalesce(CAST(vendor_id AS VARCHAR), '_null_') || '|'
    || coalesce(CAST(pickup_datetime AS VARCHAR), '_null_') || '|'
    || coalesce(CAST(dropoff_datetime AS VARCHAR), '_null_') || '|'
    || coalesce(CAST(pu_location_id AS VARCHAR), '_null_') || '|'
    || coalesce(CAST(do_location_id AS VARCHAR), '_null_') || '|'
    || coalesce({_fixed('fare_c')}, '_null_') || '|'
    || CAST(row_number() OVER (
        PARTITION BY vendor_id, pickup_datetime, pu_location_id{{month}}
        ORDER BY dropoff_datetime, fare_c, do_location_id, dist_c, tip_c, total_c,
                 passenger_count, partition_date
    ) AS VARCHAR))"""


def _silver(source: str = "stg", month: str = "") -> str:
    return f"""
silver AS (
    SELECT *,
           {_TRIP_ID.format(month=month)} AS trip_id,
           CASE WHEN dist_c > 0 THEN (200 * fare_c + dist_c) // (2 * dist_c) END AS per_mile_c,
           CASE WHEN total_c > 0 THEN (20000 * tip_c + total_c) // (2 * total_c) ELSE 0 END
               AS tip_pct_c,
           tip_c > 0 AS has_tip
    FROM {source}
)"""


_ZONES = """
zones AS (
    SELECT CAST(n_nationkey + 1 AS SMALLINT) AS location_id, r_name AS borough, n_name AS zone,
           CASE n_nationkey % 4 WHEN 0 THEN 'Yellow Zone' WHEN 1 THEN 'Boro Zone'
                WHEN 2 THEN 'EWR' ELSE 'Airports' END AS service_zone
    FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

_DATE_COLUMNS = """
    rpad(monthname({h}), 9, ' ') AS trip_month_name,
    rpad(dayname({h}), 9, ' ') AS day_of_week,
    CAST(strftime({h}, '%Y%m%d%H') AS BIGINT) AS date_key,
    CAST({h} AS DATE) AS trip_date,
    CAST(year({h}) AS INTEGER) AS trip_year,
    CAST(month({h}) AS INTEGER) AS trip_month_num,
    CAST(day({h}) AS INTEGER) AS trip_day,
    CAST(hour({h}) AS INTEGER) AS trip_hour,
    CAST(dayofweek({h}) AS INTEGER) AS day_of_week_num,
    dayofweek({h}) IN (0, 6) AS is_weekend,
    CASE WHEN hour({h}) BETWEEN 7 AND 9 THEN 'morning_peak'
         WHEN hour({h}) BETWEEN 17 AND 19 THEN 'evening_peak'
         WHEN hour({h}) BETWEEN 0 AND 5 THEN 'overnight'
         ELSE 'off_peak' END AS time_of_day_bucket"""

_DATES = f"""
dates AS (
    SELECT {_DATE_COLUMNS.format(h='h')}
    FROM (SELECT DISTINCT date_trunc('hour', pickup_datetime) AS h FROM stg)
)"""

_VENDORS = """
vendors(vendor_key, vendor_id, vendor_name, vendor_code) AS (
    VALUES (1, '1', 'Creative Mobile Technologies', 'CMT'),
           (2, '2', 'VeriFone Inc.', 'VTS'),
           (0, 'unknown', 'Unknown Vendor', 'UNK')
)"""


def _hash64(text: str) -> str:
    unsigned = f"CAST(CAST('0x' || substr(md5({text}), 1, 16) AS UBIGINT) AS HUGEINT)"
    return (
        f"CAST(CASE WHEN {unsigned} >= 9223372036854775808"
        f" THEN {unsigned} - 18446744073709551616 ELSE {unsigned} END AS BIGINT)"
    )


def _trip_key(passengers: str = "passenger_count") -> str:
    return _hash64(
        "CAST(pickup_datetime AS VARCHAR) || CAST(dropoff_datetime AS VARCHAR)"
        " || CAST(pu_location_id AS VARCHAR) || CAST(do_location_id AS VARCHAR)"
        f" || {_fixed('fare_c')} || {_fixed('tip_c')} || {_fixed('total_c')}"
        f" || CAST({passengers} AS VARCHAR) || CAST(n AS VARCHAR)"
    )


def _keyed(passengers: str = "passenger_count") -> str:
    return f"""
keyed AS (
    SELECT *, row_number() OVER (
        PARTITION BY pickup_datetime, pu_location_id, fare_c, tip_c
        ORDER BY dropoff_datetime, do_location_id, total_c, {passengers} NULLS FIRST, dist_c,
                 vendor_id, partition_date
    ) AS n
    FROM stg
)"""


_FACT = (
    f"{_STG},{_ZONES},{_DATES},{_VENDORS},{_keyed()},"
    f"""
fact AS (
    SELECT strftime(partition_date, '%Y-%m') AS trip_month, dist_c, fare_c, tip_c, total_c,
           passenger_count,
           coalesce(d.date_key, -1) AS date_key,
           CAST(coalesce(pz.location_id, -1) AS INTEGER) AS pickup_zone_key,
           CAST(coalesce(dz.location_id, -1) AS INTEGER) AS dropoff_zone_key,
           coalesce(v.vendor_key, 0) AS vendor_key,
           minutes,
           CASE WHEN dist_c > 0 THEN (200 * fare_c + dist_c) // (2 * dist_c) END AS per_mile_c,
           CASE WHEN fare_c > 0 THEN (20000 * tip_c + fare_c) // (2 * fare_c) ELSE 0 END
               AS tip_pct_c,
           {_trip_key()} AS trip_key
    FROM keyed t
    LEFT JOIN dates d ON CAST(strftime(t.pickup_datetime, '%Y%m%d%H') AS BIGINT) = d.date_key
    LEFT JOIN zones pz ON t.pu_location_id = pz.location_id
    LEFT JOIN zones dz ON t.do_location_id = dz.location_id
    LEFT JOIN vendors v ON CAST(t.vendor_id AS VARCHAR) = v.vendor_id
)"""
)


# March 1996 is delivered again: without dropoff zones over 12, and dearer by five.
_MARCH = "partition_date = DATE '1996-03-01'"
_RELOADED = (
    _STG.replace("stg AS (", "delivered AS (")
    + f""",
stg AS (
    SELECT * REPLACE (total_c + CASE WHEN {_MARCH} THEN 500 ELSE 0 END AS total_c)
    FROM delivered WHERE NOT ({_MARCH} AND do_location_id > 12)
)"""
)
_RELOADED_FACT = _FACT.replace(_STG, _RELOADED)


# Whole loads have all years in one, leave out a month, and name boroughs as the city does.
_SPOILT = "partition_date = DATE '1995-07-01'"
_FLOW_ALL = (
    _RAW.replace("raw AS (", "of_years AS (")
    + """,
delivered AS (
    SELECT * EXCLUDE (k) REPLACE (
        pickup_datetime - to_years(k) AS pickup_datetime,
        dropoff_datetime - to_years(k) AS dropoff_datetime,
        CAST(date_trunc('month', pickup_datetime - to_years(k)) AS DATE) AS partition_date)
    FROM (SELECT *, CAST(year(partition_date) - 1995 AS INTEGER) AS k FROM of_years)
)"""
)
_FLOW_RAW = f"{_FLOW_ALL},\nraw AS (SELECT * FROM delivered WHERE NOT {_SPOILT})"
_FLOW_STG = _STG.replace(_RAW, _FLOW_RAW)
_FLOW_ZONES = _ZONES.replace(
    "r_name AS borough",
    """CASE r_name WHEN 'AFRICA' THEN 'Bronx' WHEN 'AMERICA' THEN 'Brooklyn'
        WHEN 'ASIA' THEN 'Manhattan' WHEN 'EUROPE' THEN 'Queens' ELSE 'EWR' END AS borough""",
)
_FLOW_FACT = _FACT.replace(_STG, _FLOW_STG).replace(_ZONES, _FLOW_ZONES)


def _mean(cents: str, count: str | None = None) -> str:
    """Average of hundredths, rounded to hundredths."""
    n = count or f"count({cents})"
    return f"((2 * sum({cents}) + {n}) // (2 * {n})) / 100.0"


_RAW_COLUMNS = """vendor_id, pickup_datetime, dropoff_datetime, passenger_count,
    dist_c / 100.0 AS trip_distance, pu_location_id, do_location_id, fare_c / 100.0 AS fare_amount,
    tip_c / 100.0 AS tip_amount, total_c / 100.0 AS total_amount, partition_date"""

_STG_COLUMNS = (
    _RAW_COLUMNS
    + """, CAST(minutes AS DOUBLE) AS trip_duration_minutes,
    date_trunc('hour', pickup_datetime) AS pickup_hour,
    CAST(dayofweek(pickup_datetime) AS SMALLINT) AS pickup_day_of_week,
    CAST(hour(pickup_datetime) AS SMALLINT) AS pickup_hour_of_day"""
)

_SILVER_COLUMNS = (
    _STG_COLUMNS
    + """, trip_id, per_mile_c / 100.0 AS fare_per_mile, tip_pct_c / 100.0 AS tip_pct, has_tip"""
)

_AIRPORTS = "(2, 7, 19)"

_BAD = {
    "date_scope": "date_trunc('month', pickup_datetime) <> date_trunc('month', partition_date)",
    "fare_range": "NOT (fare_c > 0 AND fare_c <= 6000000)",
    "distance_range": "NOT (dist_c > 1 AND dist_c <= 4000)",
    "duration_range": "NOT (minutes > 0 AND minutes <= 600000)",
}
_TIMED = (
    _RAW
    + """,
timed AS (
    SELECT *, date_diff('minute', pickup_datetime, dropoff_datetime) AS minutes FROM raw
)"""
)
_ALL_GOOD = " AND ".join(f"NOT ({bad})" for bad in _BAD.values())


def _rules(source: str, rules: list[tuple[str, str, str]], position: bool = False) -> str:
    """One row per month and rule from (name, failures, success)."""
    parts = [
        f"SELECT partition_date, {f'{i} AS position, ' if position else ''}'{name}' AS rule,"
        f" {success} AS success, CAST({failures} AS BIGINT) AS failure_count"
        f" FROM {source} GROUP BY partition_date"
        for i, (name, failures, success) in enumerate(rules)
    ]
    return "\nUNION ALL\n".join(parts)


def _bad(condition: str) -> str:
    return f"count(*) FILTER ({condition})"


def _mostly(condition: str, column: str, percent: int) -> str:
    return f"100 * (count({column}) - {_bad(condition)}) >= {percent} * count({column})"


def _amount_rule(name: str, low: int, high: int, percent: int) -> tuple[str, str, str]:
    amounts = {c: f"{c} < {low} OR {c} > {high}" for c in ("fare_c", "tip_c", "total_c")}
    return (
        name,
        " + ".join(_bad(cond) for cond in amounts.values()),
        " AND ".join(f"({_mostly(cond, c, percent)})" for c, cond in amounts.items()),
    )


def _month_rule(name: str, column: str, percent: int) -> tuple[str, str, str]:
    bad = (
        f"{column} < CAST(partition_date AS TIMESTAMP) OR {column} >"
        " CAST(partition_date + INTERVAL 1 MONTH AS TIMESTAMP) - INTERVAL 1 SECOND"
    )
    return name, _bad(bad), _mostly(bad, column, percent)


def _null_rule(name: str, *columns: str) -> tuple[str, str, str]:
    failures = " + ".join(_bad(f"{c} IS NULL") for c in columns)
    return name, failures, f"({failures}) = 0"


_AMOUNTS = _amount_rule("trips_amounts_non_negative", -50_000, 10_000_000, 99)
_PICKUP_MONTH = _month_rule("trips_pickup_within_partition_month", "pickup_datetime", 98)

_RUN_COLUMNS = """'run-' || user_id AS run_id, event_type AS dag_id, count(*) AS rows_written,
        min(ts) AS started_at, max(ts) AS finished_at, CAST(min(ts) AS DATE) AS partition_date,
        '{"rows_written":' || count(*) || '}' AS metadata"""


def statements() -> dict[str, str]:
    """SQL per registered query."""
    fact = f"""
            SELECT trip_month, dist_c / 100.0 AS trip_distance, fare_c / 100.0 AS fare_amount,
                   tip_c / 100.0 AS tip_amount, total_c / 100.0 AS total_amount, passenger_count,
                   date_key, pickup_zone_key, dropoff_zone_key, vendor_key,
                   CAST(minutes AS DOUBLE) AS trip_duration_min,
                   per_mile_c / 100.0 AS fare_per_mile, tip_pct_c / 100.0 AS tip_pct, trip_key
            FROM fact"""
    hourly = f"""
            SELECT d.date_key, d.trip_date, d.trip_year, d.trip_month_num, d.trip_month_name,
                   d.trip_hour, d.day_of_week, d.is_weekend, d.time_of_day_bucket,
                   z.borough AS pickup_borough, z.service_zone AS pickup_service_zone,
                   count(*) AS trip_count,
                   {_mean('dist_c')} AS avg_distance,
                   {_mean('fare_c')} AS avg_fare_amount,
                   {_mean('tip_c')} AS avg_tip,
                   {_mean('tip_pct_c')} AS avg_tip_pct,
                   sum(total_c) / 100.0 AS total_revenue,
                   {_mean('100 * minutes')} AS avg_duration_min,
                   {_mean('per_mile_c')} AS avg_fare_per_mile
            FROM fact f JOIN dates d ON f.date_key = d.date_key
            JOIN zones z ON f.pickup_zone_key = z.location_id
            GROUP BY ALL"""
    by_zone = f"""
            SELECT f.pickup_zone_key, z.zone AS pickup_zone_name,
                   z.borough AS pickup_borough, z.service_zone, z.borough = 'ASIA' AS is_manhattan,
                   trip_month, count(*) AS trip_count,
                   {_mean('dist_c')} AS avg_distance,
                   {_mean('fare_c')} AS avg_fare,
                   {_mean('tip_pct_c')} AS avg_tip_pct,
                   sum(total_c) / 100.0 AS total_revenue,
                   count(DISTINCT dropoff_zone_key) AS unique_destinations
            FROM fact f JOIN zones z ON f.pickup_zone_key = z.location_id
            GROUP BY ALL"""
    return {
        "bronze_conform": f"WITH {_RAW} SELECT {_RAW_COLUMNS} FROM raw",
        "backfill_outcome": f"""WITH {_RAW}
            SELECT partition_date, count(*) AS rows,
                   count(*) FILTER (month(partition_date) = 5 AND dist_c >= 100) AS unfit,
                   count(*) FILTER (month(partition_date) = 7 AND vendor_id = 1) AS missing
            FROM raw GROUP BY partition_date""",
        "stg_trips": f"WITH {_STG} SELECT {_STG_COLUMNS} FROM stg",
        "stg_zones": f"WITH {_ZONES} SELECT * FROM zones WHERE location_id IS NOT NULL",
        "partition_scan": f"""WITH {_RAW}
            SELECT {_RAW_COLUMNS} FROM raw WHERE partition_date = DATE '1997-03-01'""",
        "replace_partition": f"""WITH {_RAW},
            mixed AS (
                SELECT * REPLACE (fare_c + CASE WHEN partition_date BETWEEN DATE '1996-01-01'
                    AND DATE '1996-06-01' THEN 100 ELSE 0 END AS fare_c) FROM raw
            )
            SELECT {_RAW_COLUMNS} FROM mixed""",
        "surrogate_key": f"""WITH {_RAW}
            SELECT vendor_id, pickup_datetime, md5(
                coalesce(CAST(vendor_id AS VARCHAR), '_null_') || '|'
                || coalesce(CAST(pickup_datetime AS VARCHAR), '_null_') || '|'
                || coalesce(CAST(pu_location_id AS VARCHAR), '_null_') || '|'
                || coalesce(CAST(nullif(passenger_count, 7) AS VARCHAR), '_null_')) AS key
            FROM raw""",
        "silver_trip_id": f"""WITH {_STG},{_silver()}
            SELECT trip_id, vendor_id, pickup_datetime, dropoff_datetime FROM silver""",
        "silver_trip_id_hot": f"""WITH {_STG},
            skewed AS (
                SELECT * REPLACE (
                    CAST(CASE WHEN day(dropoff_datetime) <= 10 THEN 1 ELSE vendor_id END
                        AS SMALLINT) AS vendor_id,
                    CASE WHEN day(dropoff_datetime) <= 10
                        THEN CAST(date_trunc('year', partition_date) AS TIMESTAMP)
                        ELSE pickup_datetime END AS pickup_datetime)
                FROM stg
            ),
            {_silver('skewed')}
            SELECT trip_id, vendor_id, pickup_datetime, dropoff_datetime FROM silver""",
        "silver_enrich": f"""WITH {_STG},{_silver()}
            SELECT vendor_id, pickup_datetime, fare_c / 100.0 AS fare_amount,
                   per_mile_c / 100.0 AS fare_per_mile, tip_pct_c / 100.0 AS tip_pct, has_tip
            FROM silver""",
        "silver_trips": f"WITH {_STG},{_silver()} SELECT {_SILVER_COLUMNS} FROM silver",
        "silver_zones": f"""WITH {_ZONES}
            SELECT *, borough = 'ASIA' AS is_manhattan,
                   coalesce(CASE service_zone WHEN 'Yellow Zone' THEN 'yellow'
                       WHEN 'Boro Zone' THEN 'boro' WHEN 'EWR' THEN 'ewr' END, 'unknown')
                       AS service_zone_code
            FROM zones""",
        "silver_monthly_batches": f"""WITH {_STG},
            delivered AS (
                SELECT * FROM stg
                UNION ALL
                SELECT * REPLACE (CAST(partition_date + INTERVAL 1 MONTH AS DATE)
                    AS partition_date) FROM stg WHERE year(partition_date) = 1997
            ),
            {_silver('delivered', ', partition_date')}
            SELECT trip_id, max(pickup_datetime) AS pickup_datetime,
                   max(partition_date) AS partition_date,
                   arg_max(per_mile_c, partition_date) / 100.0 AS fare_per_mile
            FROM silver GROUP BY trip_id""",
        "incremental_watermark": f"""WITH {_STG}
            SELECT vendor_id, pickup_datetime, dropoff_datetime, partition_date,
                   fare_c / 100.0 AS fare_amount
            FROM stg WHERE partition_date > (SELECT coalesce(max(partition_date),
                DATE '1900-01-01') FROM stg WHERE partition_date <= DATE '1998-06-01')""",
        "merge_upsert": f"""WITH {_STG},{_silver()}
            SELECT trip_id, (tip_c + CASE WHEN year(partition_date) >= 1998 THEN 100 ELSE 0 END)
                / 100.0 AS tip_amount, has_tip, partition_date
            FROM silver""",
        "dim_date": f"""WITH {_STG}
            SELECT {_DATE_COLUMNS.format(h='h')}, CAST(quarter(h) AS INTEGER) AS quarter
            FROM (SELECT DISTINCT date_trunc('hour', pickup_datetime) AS h FROM stg)""",
        "event_hours": f"""
            SELECT * REPLACE (trim(trip_month_name) AS trip_month_name,
                              trim(day_of_week) AS day_of_week)
            FROM (SELECT {_DATE_COLUMNS.format(h='h')}
                  FROM (SELECT DISTINCT date_trunc('hour', ts) AS h FROM events
                        WHERE ts IS NOT NULL))""",
        "dim_zone": f"""WITH {_ZONES}
            SELECT location_id AS zone_key, trim(zone) AS zone_name, trim(borough) AS borough,
                   trim(service_zone) AS service_zone, trim(borough) = 'ASIA' AS is_manhattan,
                   location_id IN {_AIRPORTS} AS is_airport
            FROM zones""",
        "dim_vendor": f"""WITH {_STG},{_VENDORS}
            SELECT vendors.*, (SELECT nullif(count(*), 0) FROM stg
                WHERE CASE WHEN stg.vendor_id IN (1, 2) THEN stg.vendor_id ELSE 0 END
                    = vendors.vendor_key) AS trips
            FROM vendors""",
        "role_playing_join": f"""WITH {_STG},{_ZONES}
            SELECT p.borough AS pickup_borough, d.borough AS dropoff_borough, count(*) AS trips,
                   sum(total_c) / 100.0 AS total_revenue
            FROM stg LEFT JOIN zones p ON pu_location_id = p.location_id
            LEFT JOIN zones d ON do_location_id = d.location_id
            GROUP BY ALL""",
        "fact_trip_key": f"""WITH {_STG},{_keyed('nullif(passenger_count, 7)')}
            SELECT {_trip_key('nullif(passenger_count, 7)')} AS trip_key, pickup_datetime,
                   pu_location_id, nullif(passenger_count, 7) AS passenger_count
            FROM keyed""",
        "fact_trips": f"WITH {_FACT} {fact}",
        "agg_hourly_metrics": f"WITH {_FACT} {hourly}",
        "hourly_metrics_kept_up": f"WITH {_RELOADED_FACT} {hourly}",
        "agg_zone_summary": f"WITH {_FACT} {by_zone}",
        "zone_summary_kept_up": f"WITH {_RELOADED_FACT} {by_zone}",
        "zone_summary_wide": f"""WITH {_STG},
            p AS (
                SELECT pu_location_id AS zone_id, partition_date AS trip_month,
                       count(*) AS total_pickups, {_mean('fare_c')} AS avg_fare,
                       {_mean('dist_c')} AS avg_distance,
                       {_mean(f'''10000 * CAST(pu_location_id IN {_AIRPORTS}
                           OR do_location_id IN {_AIRPORTS} AS BIGINT)''')} AS pct_airport_trips,
                       {_mean('10000 * CAST(tip_c > 0 AS BIGINT)')} AS pct_tipped
                FROM stg GROUP BY ALL
            ),
            d AS (
                SELECT do_location_id AS zone_id, partition_date AS trip_month,
                       count(*) AS total_dropoffs
                FROM stg GROUP BY ALL
            )
            SELECT coalesce(p.zone_id, d.zone_id) AS zone_id,
                   coalesce(p.trip_month, d.trip_month) AS trip_month,
                   coalesce(total_pickups, 0) AS total_pickups,
                   coalesce(total_dropoffs, 0) AS total_dropoffs,
                   avg_fare, avg_distance, pct_airport_trips, pct_tipped
            FROM p FULL JOIN d ON p.zone_id = d.zone_id AND p.trip_month = d.trip_month""",
        "airport_flag": f"""WITH {_STG}
            SELECT partition_date, pu_location_id IN {_AIRPORTS} OR do_location_id IN {_AIRPORTS}
                AS is_airport_trip, count(*) AS trips
            FROM stg GROUP BY ALL""",
        "speed_and_caps": f"""WITH {_STG},{_silver()}
            SELECT pickup_datetime, dropoff_datetime, dist_c / 100.0 AS trip_distance,
                   ((120 * dist_c + minutes) // (2 * minutes)) / 100.0 AS speed_mph,
                   least(tip_pct_c, 500) / 100.0 AS tip_pct_capped
            FROM silver""",
        "dq_not_null": f"""WITH joined AS (
                SELECT o_orderdate, l_orderkey, l_shipdate,
                       CAST(date_trunc('month', o_orderdate) AS DATE) AS partition_date
                FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
            )
            {_rules('joined', [_null_rule('not_null', 'o_orderdate', 'l_orderkey', 'l_shipdate')])}
            """,
        "dq_between": f"""WITH {_RAW}
            {_rules('raw', [_AMOUNTS, _amount_rule('between', 100_000, 10_000_000, 93)])}""",
        "dq_within_month": f"""WITH {_RAW}
            {_rules('raw', [_PICKUP_MONTH, _month_rule('within_month', 'dropoff_datetime', 2)])}
            """,
        "dq_min_value": f"""WITH {_RAW} {_rules('raw', [(
            'between',
            f"{_bad('pu_location_id < 1')} + {_bad('dist_c < 100')}",
            f"{_bad('pu_location_id < 1')} + {_bad('dist_c < 100')} = 0",
        )])}""",
        "dq_row_count": f"""WITH {_RAW} {_rules('raw', [(
            'row_count',
            "CASE WHEN count(*) BETWEEN 700 AND 800 THEN 0 ELSE 1 END",
            "count(*) BETWEEN 700 AND 800",
        )])}""",
        "dq_row_rule": f"""WITH {_RAW} {_rules('raw', [(
            'no_rows',
            _bad('dropoff_datetime <= pickup_datetime'),
            _bad('dropoff_datetime <= pickup_datetime') + ' = 0',
        )])}""",
        "dq_not_after": f"""WITH {_RAW} {_rules('raw', [(
            'not_after',
            _bad("dropoff_datetime > TIMESTAMP '1999-06-15 12:00:00'"),
            _bad("dropoff_datetime > TIMESTAMP '1999-06-15 12:00:00'") + ' = 0',
        )])}""",
        "dq_report": f"""WITH {_RAW} {_rules('raw', [
            _null_rule('trips_critical_columns_not_null', 'pickup_datetime', 'dropoff_datetime',
                       'pu_location_id', 'do_location_id', 'total_c'),
            _AMOUNTS,
            _PICKUP_MONTH,
        ], position=True)}""",
        "dq_unique": f"""WITH {_RAW}
            SELECT vendor_id, pickup_datetime, pu_location_id, count(*) AS n
            FROM raw GROUP BY ALL HAVING count(*) > 1""",
        "dq_accepted_values": """
            SELECT event_type AS value, count(*) AS n FROM events
            WHERE event_type NOT IN ('view', 'click', 'purchase') GROUP BY ALL""",
        "dq_relationships": f"""WITH {_RAW},{_ZONES}
            SELECT do_location_id AS value, count(*) AS n FROM raw
            WHERE do_location_id IS NOT NULL AND NOT EXISTS (
                SELECT 1 FROM zones WHERE location_id = do_location_id
                AND service_zone IN ('Yellow Zone', 'Boro Zone', 'EWR'))
            GROUP BY ALL""",
        "clean_strict": f"WITH {_TIMED} SELECT {_RAW_COLUMNS} FROM timed WHERE {_ALL_GOOD}",
        "drop_reasons": f"""WITH {_TIMED}
            SELECT partition_date, count(*) AS rows_in, {_bad(_ALL_GOOD)} AS rows_kept,
                   {', '.join(f'{_bad(bad)} AS bad_{name}' for name, bad in _BAD.items())}
            FROM timed GROUP BY partition_date""",
        "layer_retention": f"""WITH {_TIMED}
            SELECT partition_date, count(*) AS bronze_rows,
                   {_bad('dist_c > 0 AND minutes > 0')} AS silver_rows,
                   {_bad(_ALL_GOOD)} AS gold_rows,
                   {_mean('10000 * CAST(dist_c > 0 AND minutes > 0 AS BIGINT)')}
                       AS silver_retention_pct
            FROM timed GROUP BY partition_date""",
        "month_profile": f"""WITH {_STG}
            SELECT partition_date, count(*) AS trips, min(pickup_datetime) AS first_pickup,
                   max(pickup_datetime) AS last_pickup
            FROM stg GROUP BY partition_date""",
        "top_pickup_zones": f"""WITH {_STG},{_ZONES}
            SELECT zone AS zone_name, borough, count(*) AS trips
            FROM stg JOIN zones ON pu_location_id = location_id
            GROUP BY ALL ORDER BY trips DESC, zone_name, borough LIMIT 10""",
        "volume_drop": f"""WITH {_STG},
            monthly AS (
                SELECT partition_date, count(*) AS trips,
                       lag(count(*)) OVER (ORDER BY partition_date) AS trips_before
                FROM stg GROUP BY partition_date
            )
            SELECT * FROM monthly WHERE trips * 100 < trips_before * 95""",
        "month_spine": """WITH spine AS (
                SELECT CAST(unnest(generate_series(
                    date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)),
                    INTERVAL 1 MONTH)) AS DATE) AS month
                FROM orders
            )
            SELECT month, count(o_orderkey) AS orders
            FROM spine LEFT JOIN orders ON date_trunc('month', o_orderdate) = month
            GROUP BY month""",
        "runlog_upsert": f"""WITH
            old AS (SELECT {_RUN_COLUMNS} FROM events
                    WHERE ts < TIMESTAMP '2024-01-16' GROUP BY user_id, event_type),
            new AS (SELECT {_RUN_COLUMNS} FROM events
                    WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY user_id, event_type)
            SELECT run_id, dag_id, 'load' AS task_id,
                   CASE WHEN new.rows_written IS NULL THEN 'running' ELSE 'success' END AS status,
                   coalesce(old.partition_date, new.partition_date) AS partition_date,
                   coalesce(new.rows_written, old.rows_written) AS rows_written,
                   CAST(NULL AS DOUBLE) AS duration_seconds,
                   CASE WHEN old.rows_written IS NULL THEN 'second' ELSE 'first' END
                       AS delta_path,
                   CAST(NULL AS VARCHAR) AS error_message,
                   coalesce(old.started_at, new.started_at) AS started_at,
                   coalesce(new.finished_at, old.finished_at) AS finished_at,
                   coalesce(new.metadata, old.metadata) AS metadata
            FROM old FULL JOIN new USING (run_id, dag_id)""",
        "latest_runs": """
            SELECT event_type AS dag_id, event_id AS run_id, 'load' AS task_id,
                   ts AS started_at, CAST(row_number() OVER (
                       PARTITION BY event_type ORDER BY ts DESC, event_id) AS INTEGER) AS nth
            FROM events QUALIFY nth <= 3""",
        "upsert_stored": f"""WITH {_STG},{_silver()}
            SELECT trip_id, (tip_c + CASE WHEN year(partition_date) = 1997 THEN 100 ELSE 0 END)
                       / 100.0 AS tip_amount,
                   has_tip,
                   CAST(CASE WHEN year(partition_date) = 1997
                             THEN partition_date + INTERVAL 2 MONTH ELSE partition_date END AS DATE)
                       AS partition_date
            FROM silver""",
        "key_index_lookup": f"""WITH {_STG},{_silver()}
            SELECT partition_date, count(*) AS trips FROM silver
            WHERE partition_date >= DATE '1997-01-01' AND partition_date < DATE '1997-07-01'
            GROUP BY ALL""",
        "yearly_destinations": f"""WITH {_RELOADED}
            SELECT pu_location_id AS pickup_zone_key, CAST(year(partition_date) AS INTEGER) AS year,
                   count(DISTINCT do_location_id) AS unique_destinations
            FROM stg GROUP BY ALL""",
        "dq_unique_changed": f"""WITH {_STG},{_silver()},
            stored AS (
                SELECT trip_id FROM silver
                UNION ALL SELECT trip_id FROM silver
                WHERE partition_date = DATE '1997-06-01' AND tip_c > 300000
                UNION ALL SELECT trip_id FROM silver WHERE year(partition_date) = 1995 AND has_tip
            )
            SELECT trip_id, count(*) AS n FROM stored GROUP BY ALL HAVING count(*) > 1""",
        "compact_small_files": f"""WITH {_STG},{_silver()}
            SELECT partition_date, count(*) AS trips, sum(tip_c) / 100.0 AS tips, 1 AS files
            FROM silver GROUP BY ALL""",
        "gold_order": f"""WITH {_FACT},
            hourly AS ({hourly}),
            by_zone AS ({by_zone})
            SELECT 'dim_date' AS table, CAST(date_key AS VARCHAR) AS key,
                   CAST(rank() OVER (ORDER BY date_key) AS INTEGER) AS place
            FROM dates
            UNION ALL
            SELECT 'dim_zone', CAST(location_id AS VARCHAR), rank() OVER (ORDER BY location_id)
            FROM zones
            UNION ALL
            SELECT 'agg_hourly_metrics',
                   concat_ws('|', date_key, pickup_borough, pickup_service_zone),
                   rank() OVER (ORDER BY date_key, pickup_borough)
            FROM hourly
            UNION ALL
            SELECT 'agg_zone_summary', concat_ws('|', pickup_zone_key, trip_month),
                   rank() OVER (ORDER BY trip_count DESC)
            FROM by_zone""",
        "curve_order": f"""WITH {_STG},
            pairs AS (
                SELECT pu_location_id, do_location_id, count(*) AS trips FROM stg GROUP BY ALL
            ),
            laid AS (
                SELECT *, CAST(list_sum([
                    ((pu_location_id >> i) & 1) * (1::BIGINT << (2 * i))
                    + ((do_location_id >> i) & 1) * (1::BIGINT << (2 * i + 1))
                    FOR i IN range(0, 16)]) AS BIGINT) AS z
                FROM pairs
            )
            SELECT *, CAST(row_number() OVER (ORDER BY z) AS INTEGER) AS place FROM laid""",
        "equal_depth_splits": f"""WITH {_STG}
            SELECT nullif(fare_c % 10000, 77) AS cents, 1 AS conditions, count(*) AS trips
            FROM stg GROUP BY ALL""",
        "flow_raw_trips": f"WITH {_FLOW_RAW} SELECT {_RAW_COLUMNS} FROM raw",
        "flow_silver_trips": f"WITH {_FLOW_STG},{_silver()} SELECT {_SILVER_COLUMNS} FROM silver",
        "flow_lake_trips": f"""WITH {_FLOW_STG},{_silver()}
            SELECT partition_date, count(*) AS trips, count(DISTINCT trip_id) AS ids,
                   sum(total_c) / 100.0 AS total_amount
            FROM silver GROUP BY ALL""",
        "flow_lake_zones": f"""WITH {_FLOW_ZONES}
            SELECT *, borough = 'Manhattan' AS is_manhattan,
                   CASE service_zone WHEN 'Yellow Zone' THEN 'yellow' WHEN 'Boro Zone' THEN 'boro'
                        WHEN 'EWR' THEN 'ewr' ELSE 'unknown' END AS service_zone_code
            FROM zones""",
        "flow_fact_trips": f"WITH {_FLOW_FACT} {fact}",
        "flow_agg_hourly": f"WITH {_FLOW_FACT} {hourly}",
        "flow_agg_zone": f"WITH {_FLOW_FACT} {by_zone.replace("'ASIA'", "'Manhattan'")}",
        "flow_failed_months": f"""WITH {_FLOW_ALL}
            SELECT partition_date, '0 rows with values that do not fit, ' || count(*)
                || ' with missing values' AS error_message
            FROM delivered WHERE {_SPOILT} AND vendor_id = 3 GROUP BY ALL""",
        "flow_months_loaded": f"""WITH {_FLOW_STG},
            trips AS (SELECT partition_date, count(*) AS trips FROM stg GROUP BY ALL)
            SELECT partition_date, 'success' AS status, trips
            FROM (SELECT DISTINCT partition_date FROM raw)
            LEFT JOIN trips USING (partition_date)""",
        "flow_task_states": f"""WITH {_FLOW_STG},
            n AS (SELECT (SELECT count(*) FROM raw) AS raw, (SELECT count(*) FROM stg) AS stg,
                         (SELECT count(*) FROM nation) AS zones,
                         (SELECT count(DISTINCT partition_date) FROM raw) AS months,
                         (SELECT count(DISTINCT partition_date) FROM delivered
                          WHERE {_SPOILT} AND vendor_id = 3) AS spoilt)
            SELECT * FROM (
                SELECT 'bronze' AS dag_id, 'ingest_trips' AS task_id, 'success' AS status,
                       1::BIGINT AS runs, raw AS rows FROM n
                UNION ALL SELECT 'bronze', 'ingest_zones', 'success', 1, zones FROM n
                UNION ALL SELECT 'bronze', 'validate_trips', 'failed', spoilt, NULL FROM n
                UNION ALL SELECT 'silver', 'silver_zones', 'success', 1, zones FROM n
                UNION ALL SELECT 'silver', 'silver_trips', 'success', 1, stg FROM n
                UNION ALL SELECT 'silver', 'test_silver', 'success', 1, 0 FROM n
                UNION ALL SELECT 'gold', 'build_gold', 'success', 1, NULL FROM n
                UNION ALL SELECT 'gold', 'test_gold', 'success', 1, 0 FROM n
                UNION ALL SELECT 'gold', 'load_fact_trips', 'success', 1, stg FROM n
                UNION ALL SELECT 'gold', 'load_dim_zones', 'success', 1, zones FROM n
                UNION ALL SELECT 'backfill', 'load_month', 'success', months, NULL FROM n)
            WHERE runs > 0""",
        "flow_gate": f"""WITH {_FLOW_RAW}, rules AS (
                SELECT partition_date, 0 AS rule_missing,
                       count(*) FILTER (fare_c < -50000 OR fare_c > 10000000)
                       + count(*) FILTER (tip_c < -50000 OR tip_c > 10000000)
                       + count(*) FILTER (total_c < -50000 OR total_c > 10000000) AS amounts,
                       greatest(count(*) FILTER (fare_c < -50000 OR fare_c > 10000000),
                                count(*) FILTER (tip_c < -50000 OR tip_c > 10000000),
                                count(*) FILTER (total_c < -50000 OR total_c > 10000000)) AS worst,
                       count(*) AS n,
                       count(*) FILTER (dist_c < 100 AND total_c > 5000000) AS own
                FROM raw GROUP BY ALL
            )
            SELECT partition_date, worst * 100 <= n AND own = 0 AS passed,
                   CAST((worst * 100 > n)::INTEGER + (own > 0)::INTEGER AS BIGINT) AS failed_rules,
                   amounts + own AS total_failure_count
            FROM rules""",
    }
