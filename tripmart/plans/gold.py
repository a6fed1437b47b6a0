"""Gold: star schema and aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.functions import calendar, keys, measures
from tripmart.operators.lookup import key_or_default
from tripmart.operators.ranking import numbered

# Airport zones by id (Newark, JFK, LaGuardia).
AIRPORT_ZONES = (1, 132, 138)
# Orders in which tables are shown, and sorted inside their files.
SHOWN_BY = {
    "dim_date": (F.asc, "date_key"),
    "dim_zone": (F.asc, "zone_key"),
    "agg_hourly_metrics": (F.asc, "date_key", "pickup_borough"),
    "agg_zone_summary": (F.desc, "trip_count"),
}
UNKNOWN_KEY = -1
UNKNOWN_VENDOR = 0


def dim_date(trips: DataFrame, padded: bool = True, quarter: bool = False) -> DataFrame:
    """One row per hour with a pickup.

    Distinct hours collapse before the shuffle; names are blank-padded unless
    `padded` is off.
    """
    hours = (
        trips.filter(F.col("pickup_datetime").isNotNull())
        .select(calendar.hour_start(F.col("pickup_datetime")).alias("hour"))
        .distinct()
    )
    hour = F.col("hour")
    day = hour.cast("date")
    weekday = calendar.day_of_week(hour)
    month_name, day_name = F.date_format(day, "MMMM"), F.date_format(day, "EEEE")
    if padded:
        month_name, day_name = calendar.padded(month_name), calendar.padded(day_name)
    extra = [F.quarter(day).alias("quarter")] if quarter else []
    return hours.select(
        month_name.alias("trip_month_name"),
        day_name.alias("day_of_week"),
        calendar.hour_key(hour).alias("date_key"),
        day.alias("trip_date"),
        F.year(day).alias("trip_year"),
        F.month(day).alias("trip_month_num"),
        F.day(day).alias("trip_day"),
        F.hour(hour).alias("trip_hour"),
        weekday.alias("day_of_week_num"),
        calendar.is_weekend(weekday).alias("is_weekend"),
        calendar.time_of_day(F.hour(hour)).alias("time_of_day_bucket"),
        *extra,
    )


def dim_zone(
    seed: DataFrame, central: str = "Manhattan", airports: Sequence[int] | None = None
) -> DataFrame:
    """One row per zone of the seed; with `airports`, flags those ids."""
    borough = F.trim("Borough")
    extra = (
        []
        if airports is None
        else [measures.in_zones(airports, F.col("LocationID")).alias("is_airport")]
    )
    return seed.select(
        F.col("LocationID").alias("zone_key"),
        F.trim("Zone").alias("zone_name"),
        borough.alias("borough"),
        F.trim("service_zone").alias("service_zone"),
        (borough == central).alias("is_manhattan"),
        *extra,
    )


def dim_vendor(spark: SparkSession) -> DataFrame:
    # The vendor dimension.
    return spark.sql(
        """
        SELECT * FROM VALUES
            (1, '1', 'Creative Mobile Technologies', 'CMT'),
            (2, '2', 'VeriFone Inc.', 'VTS'),
            (0, 'unknown', 'Unknown Vendor', 'UNK')
        AS vendors(vendor_key, vendor_id, vendor_name, vendor_code)
        """
    )


def trip_keys(trips: DataFrame, null_safe: bool = False, **ranking) -> DataFrame:
    """Trips with their 64-bit `trip_key`.

    A NULL among the hashed fields makes the key NULL, unless `null_safe`.
    """
    ranked = numbered(
        trips,
        ("pickup_datetime", "pu_location_id", "fare_amount", "tip_amount"),
        (
            "dropoff_datetime",
            "do_location_id",
            "total_amount",
            "passenger_count",
            "trip_distance",
            "vendor_id",
            "partition_date",
        ),
        "copy_number",
        **ranking,
    )
    fields = [
        F.col(c)
        for c in (
            "pickup_datetime",
            "dropoff_datetime",
            "pu_location_id",
            "do_location_id",
            "fare_amount",
            "tip_amount",
            "total_amount",
            "passenger_count",
            "copy_number",
        )
    ]
    text = keys.key_text(*fields) if null_safe else F.concat(*[f.cast("string") for f in fields])
    return ranked.withColumn("trip_key", keys.hash64(text)).drop("copy_number")


_FACT_INPUT = (
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pu_location_id",
    "do_location_id",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "partition_date",
)


def fact_trips(
    trips: DataFrame,
    dates: DataFrame,
    zones: DataFrame,
    vendors: DataFrame,
    null_safe: bool = False,
    *,
    by_time: bool = False,
    **ranking,
) -> DataFrame:
    """One row per silver trip with its key, dimension keys and measures.

    `by_time`, trips of one time and so of one month lie together, to be written as they are.
    """
    keyed = trip_keys(trips.select(*_FACT_INPUT), null_safe, in_ranges=by_time, **ranking)
    return fact_measures(keyed, dates, zones, vendors, "trip_key")


def fact_measures(
    trips: DataFrame, dates: DataFrame, zones: DataFrame, vendors: DataFrame, *also: str
) -> DataFrame:
    """Dimension keys and measures of trips.

    Dimensions carry no hint: Spark knows the size of stored ones and sends small ones to
    the trips.
    """
    zone_keys = zones.select("zone_key")
    date_keys = dates.select("date_key")
    vendor_keys = vendors.select("vendor_key", F.col("vendor_id").alias("vendor_text"))
    fare, tip = F.col("fare_amount"), F.col("tip_amount")
    return (
        trips.withColumn("hour_key", calendar.hour_key(F.col("pickup_datetime")))
        .join(date_keys, F.col("hour_key") == F.col("date_key"), "left")
        .join(
            zone_keys.withColumnRenamed("zone_key", "pickup_zone"),
            F.col("pu_location_id") == F.col("pickup_zone"),
            "left",
        )
        .join(
            zone_keys.withColumnRenamed("zone_key", "dropoff_zone"),
            F.col("do_location_id") == F.col("dropoff_zone"),
            "left",
        )
        .join(vendor_keys, F.col("vendor_id").cast("string") == F.col("vendor_text"), "left")
        .select(
            calendar.month_text(F.col("partition_date")).alias("trip_month"),
            "trip_distance",
            "fare_amount",
            "tip_amount",
            "total_amount",
            "passenger_count",
            key_or_default(F.col("date_key"), UNKNOWN_KEY).alias("date_key"),
            key_or_default(F.col("pickup_zone"), UNKNOWN_KEY).alias("pickup_zone_key"),
            key_or_default(F.col("dropoff_zone"), UNKNOWN_KEY).alias("dropoff_zone_key"),
            key_or_default(F.col("vendor_key"), UNKNOWN_VENDOR).alias("vendor_key"),
            calendar.minutes_between(F.col("pickup_datetime"), F.col("dropoff_datetime")).alias(
                "trip_duration_min"
            ),
            measures.safe_ratio(fare, F.col("trip_distance")).alias("fare_per_mile"),
            measures.safe_pct(tip, fare).alias("tip_pct"),
            *also,
        )
    )


def trip_measures(trips: DataFrame, *also: str) -> DataFrame:
    """What aggregates need of facts, straight from trips and without any join.

    Hours and zones stand for the dimension keys; the aggregates join the dimensions to
    their few groups, where those without a dimension row drop out or become unknown.
    """
    fare, tip = F.col("fare_amount"), F.col("tip_amount")
    start, end = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return trips.select(
        calendar.month_text(F.col("partition_date")).alias("trip_month"),
        "trip_distance",
        "fare_amount",
        "tip_amount",
        "total_amount",
        calendar.hour_key(start).alias("date_key"),
        F.col("pu_location_id").alias("pickup_zone_key"),
        F.col("do_location_id").alias("dropoff_zone_key"),
        calendar.minutes_between(start, end).alias("trip_duration_min"),
        measures.safe_ratio(fare, F.col("trip_distance")).alias("fare_per_mile"),
        measures.safe_pct(tip, fare).alias("tip_pct"),
        *also,
    )


def _summed(*columns: str) -> list[F.Column]:
    """Partial results a mean can be taken from later: sum and non-NULL count."""
    out = []
    for c in columns:
        out += [F.sum(c).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n")]
    return out


def _resummed(*columns: str) -> list[F.Column]:
    out = []
    for c in columns:
        out += [
            F.sum(f"{c}_sum").alias(f"{c}_sum"),
            F.sum(f"{c}_n").alias(f"{c}_n"),
        ]
    return out


def _mean(column: str, scale: int = 2) -> F.Column:
    return measures.rounded_mean(F.col(f"{column}_sum"), F.col(f"{column}_n"), scale)


_HOURLY_MEASURES = (
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "tip_pct",
    "trip_duration_min",
    "fare_per_mile",
)
_HOUR_COLUMNS = (
    "date_key",
    "trip_date",
    "trip_year",
    "trip_month_num",
    "trip_month_name",
    "trip_hour",
    "day_of_week",
    "is_weekend",
    "time_of_day_bucket",
)


def agg_hourly_metrics(fact: DataFrame, dates: DataFrame, zones: DataFrame) -> DataFrame:
    """Metrics per hour, pickup borough and service zone.

    Facts collapse to hours and zones first, so the only large shuffle carries
    partial sums, and the dimension joins see small input that needs no hints.
    Facts with an unknown member find no dimension row and drop out.
    """
    return hourly_metrics(hourly_sums(fact, "date_key"), dates, zones)


def hourly_sums(trips: DataFrame, *by: str) -> DataFrame:
    """Counts and sums per pickup zone and `by`, from which all means can be taken later."""
    return trips.groupBy(*by, "pickup_zone_key").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("total_amount").alias("revenue"),
        *_summed(*_HOURLY_MEASURES),
    )


def hourly_metrics(sums: DataFrame, dates: DataFrame, zones: DataFrame) -> DataFrame:
    """The hourly aggregate from its sums, which may come in any number of parts."""
    where = zones.select(
        F.col("zone_key").alias("pickup_zone_key"),
        F.col("borough").alias("pickup_borough"),
        F.col("service_zone").alias("pickup_service_zone"),
    )
    by_area = (
        sums.join(where, "pickup_zone_key")
        .groupBy("date_key", "pickup_borough", "pickup_service_zone")
        .agg(
            F.sum("trips").alias("trip_count"),
            F.sum("revenue").alias("total_revenue"),
            *_resummed(*_HOURLY_MEASURES),
        )
    )
    return by_area.join(dates.select(*_HOUR_COLUMNS), "date_key").select(
        *_HOUR_COLUMNS,
        "pickup_borough",
        "pickup_service_zone",
        "trip_count",
        _mean("trip_distance").alias("avg_distance"),
        _mean("fare_amount").alias("avg_fare_amount"),
        _mean("tip_amount").alias("avg_tip"),
        _mean("tip_pct").alias("avg_tip_pct"),
        F.round("total_revenue", 2).alias("total_revenue"),
        _mean("trip_duration_min", 16).alias("avg_duration_min"),
        _mean("fare_per_mile").alias("avg_fare_per_mile"),
    )


_ZONE_MEASURES = ("trip_distance", "fare_amount", "tip_pct")


def agg_zone_summary(fact: DataFrame, zones: DataFrame) -> DataFrame:
    """Metrics per pickup zone and month, with the number of distinct destinations.

    Grouping by destination first turns the distinct count into a plain count of
    groups; an unknown destination counts as one.
    """
    per_destination = fact.groupBy(
        "pickup_zone_key",
        F.date_format(F.to_date("trip_month", "yyyy-MM"), "yyyy-MM").alias("trip_month"),
        "dropoff_zone_key",
    ).agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("total_amount").alias("revenue"),
        *_summed(*_ZONE_MEASURES),
    )
    known = zones.select(F.col("zone_key").alias("known"))
    per_known = (
        per_destination.join(known, F.col("dropoff_zone_key") == F.col("known"), "left")
        .groupBy(
            "pickup_zone_key",
            "trip_month",
            key_or_default(F.col("known"), UNKNOWN_KEY).alias("dropoff_zone_key"),
        )
        .agg(
            F.sum("trips").alias("trips"),
            F.sum("revenue").alias("revenue"),
            *_resummed(*_ZONE_MEASURES),
        )
    )
    per_zone = per_known.groupBy("pickup_zone_key", "trip_month").agg(
        F.sum("trips").alias("trip_count"),
        F.sum("revenue").alias("total_revenue"),
        F.count("dropoff_zone_key").alias("unique_destinations"),
        *_resummed(*_ZONE_MEASURES),
    )
    return _zone_columns(per_zone, zones)


def zone_summary(sums: DataFrame, destinations: DataFrame, zones: DataFrame) -> DataFrame:
    """The zone aggregate from sums (see `hourly_sums`) and destinations, per pickup zone and `trip_month`."""
    per_zone = sums.groupBy("pickup_zone_key", "trip_month").agg(
        F.sum("trips").alias("trip_count"),
        F.sum("revenue").alias("total_revenue"),
        *_resummed(*_ZONE_MEASURES),
    )
    return _zone_columns(per_zone.join(destinations, ["pickup_zone_key", "trip_month"]), zones)


def _zone_columns(per_zone: DataFrame, zones: DataFrame) -> DataFrame:
    where = zones.select(
        F.col("zone_key").alias("pickup_zone_key"),
        F.col("zone_name").alias("pickup_zone_name"),
        F.col("borough").alias("pickup_borough"),
        "service_zone",
        "is_manhattan",
    )
    return per_zone.join(where, "pickup_zone_key").select(
        "pickup_zone_key",
        "pickup_zone_name",
        "pickup_borough",
        "service_zone",
        "is_manhattan",
        "trip_month",
        "trip_count",
        _mean("trip_distance").alias("avg_distance"),
        _mean("fare_amount").alias("avg_fare"),
        _mean("tip_pct").alias("avg_tip_pct"),
        F.round("total_revenue", 2).alias("total_revenue"),
        "unique_destinations",
    )


def zone_summary_wide(trips: DataFrame, airports: Sequence[int] = AIRPORT_ZONES) -> DataFrame:
    """Per zone and month: pickups, dropoffs, and airport and tipped shares of pickups.

    One pass over the trips feeds both roles: trips collapse to pairs of zones,
    and each pair is then counted for its pickup and its dropoff zone.
    """
    pairs = trips.groupBy("pu_location_id", "do_location_id", "partition_date").agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if("has_tip").alias("tipped"),
        *_summed("fare_amount", "trip_distance"),
    )
    at_airport = measures.in_zones(airports, F.col("pu_location_id"), F.col("do_location_id"))
    nothing = F.lit(0).cast("bigint")

    def role(zone: str, is_pickup: bool) -> F.Column:
        def own(value: F.Column, kind: str = "bigint") -> F.Column:
            return value if is_pickup else F.lit(0).cast(kind)

        return F.struct(
            F.col(zone).alias("zone_id"),
            own(F.col("trips")).alias("pickups"),
            (nothing if is_pickup else F.col("trips")).alias("dropoffs"),
            own(F.when(at_airport, F.col("trips")).otherwise(nothing)).alias("airport"),
            own(F.col("tipped")).alias("tipped"),
            own(F.col("fare_amount_sum"), "decimal(20,2)").alias("fare_amount_sum"),
            own(F.col("fare_amount_n")).alias("fare_amount_n"),
            own(F.col("trip_distance_sum"), "decimal(18,2)").alias("trip_distance_sum"),
            own(F.col("trip_distance_n")).alias("trip_distance_n"),
        )

    roles = pairs.select(
        "partition_date",
        F.inline(F.array(role("pu_location_id", True), role("do_location_id", False))),
    )
    totals = roles.groupBy("zone_id", F.col("partition_date").alias("trip_month")).agg(
        *[F.sum(c).alias(c) for c in ("pickups", "dropoffs", "airport", "tipped")],
        *_resummed("fare_amount", "trip_distance"),
    )

    def share(column: str) -> F.Column:
        hundred = (F.col(column) * 100).cast("decimal(20,0)")
        return F.when(F.col("pickups") > 0, measures.rounded_mean(hundred, F.col("pickups")))

    def when_picked_up(mean: F.Column) -> F.Column:
        return F.when(F.col("pickups") > 0, mean)

    return totals.select(
        "zone_id",
        "trip_month",
        F.col("pickups").alias("total_pickups"),
        F.col("dropoffs").alias("total_dropoffs"),
        when_picked_up(_mean("fare_amount")).alias("avg_fare"),
        when_picked_up(_mean("trip_distance")).alias("avg_distance"),
        share("airport").alias("pct_airport_trips"),
        share("tipped").alias("pct_tipped"),
    )


def _order(table: str) -> list[F.Column]:
    direction, *columns = SHOWN_BY[table]
    return [direction(c) for c in columns]


def shown(df: DataFrame, table: str) -> DataFrame:
    """A gold table fully sorted for display."""
    return df.orderBy(*_order(table))


def laid_out(df: DataFrame, table: str) -> DataFrame:
    """A gold table sorted within each file, so that min/max statistics prune well."""
    return df.sortWithinPartitions(*_order(table))


def published(silver: DataFrame) -> DataFrame:
    """Silver trips as they go into the lake table."""
    return silver.select(*schemas.LAKE_TRIPS.schema.names)
