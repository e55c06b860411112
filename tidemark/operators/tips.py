"""Tipping analytics over clean trips.

The tables share one building block, :func:`tip_totals`: sums and counts per group. Totals add up, so
a coarser table is a second, small aggregation over a finer one instead of another scan of the trips,
and because the first step combines map-side, a zone with a third of all trips costs no more than
any other. Averages are means of per-trip percentages, not ratios of sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.measures import HIGH_TIP_PCT, count_if, tip_pct
from tidemark.operators.ids import assign_ids

_TOTALS = ("trips_count", "tips_known", "tip_sum", "pct_sum", "zero_tips", "high_tips")


def pickup_hour() -> Column:
    return F.hour("tpep_pickup_datetime").alias("pickup_hour")


def trip_date() -> Column:
    return F.to_date("tpep_pickup_datetime").alias("trip_date")


def tip_totals(trips: DataFrame, *dims: str | Column) -> DataFrame:
    """Trips, tip and tip-percentage sums, zero and high tips per group, over trips with a positive fare."""
    pct = tip_pct(F.col("tip_amount"), F.col("fare_amount"))
    return trips.filter(F.col("fare_amount") > 0).groupBy(*dims).agg(
        F.count(F.lit(1)).alias("trips_count"),
        F.count("tip_amount").alias("tips_known"),
        F.sum("tip_amount").alias("tip_sum"),
        F.sum(pct).alias("pct_sum"),
        count_if(F.coalesce(F.col("tip_amount"), F.lit(0)) == 0).alias("zero_tips"),
        count_if(pct > HIGH_TIP_PCT).alias("high_tips"))


def roll_up(totals: DataFrame, *dims: str) -> DataFrame:
    """Totals of a coarser grouping."""
    return totals.groupBy(*dims).agg(*[F.sum(name).alias(name) for name in _TOTALS])


def daily_totals(trips: DataFrame) -> DataFrame:
    """Totals fine enough for every table below: day, zone, hour and payment type."""
    return tip_totals(trips, trip_date(), "PULocationID", pickup_hour(), "payment_type")


def _mean(total: str) -> Column:
    """Mean over the trips whose tip is known; NULL when none is."""
    return F.col(total) / F.nullif(F.col("tips_known"), F.lit(0))


def _mean_pct() -> Column:
    return _mean("pct_sum")


def behavior_from_totals(by_payment: DataFrame) -> DataFrame:
    """Zone-by-hour behaviour from totals by zone, hour and payment type."""
    # Most frequent payment type among high tips; a tie goes to the smaller one, NULL counts as smallest.
    rank = F.when(F.col("high_tips") > 0, F.struct((-F.col("high_tips")).alias("n"), "payment_type"))
    grouped = by_payment.groupBy("PULocationID", "pickup_hour").agg(
        *[F.sum(name).alias(name) for name in _TOTALS],
        F.min(rank).alias("_mode"))
    return grouped.select(
        "PULocationID", "pickup_hour",
        _mean("tip_sum").alias("avg_tip_amount"),
        _mean_pct().alias("avg_tip_percentage"),
        (F.lit(100.0) * F.col("zero_tips") / F.col("trips_count")).alias("pct_zero_tip"),
        (F.lit(100.0) * F.col("high_tips") / F.col("trips_count")).alias("pct_high_tip"),
        F.col("_mode.payment_type").alias("high_tip_common_payment_type"),
        "trips_count")


def tip_behavior(trips: DataFrame) -> DataFrame:
    """Per zone and pickup hour: average tip, average percentage, shares, commonest payment of high tips."""
    return behavior_from_totals(tip_totals(trips, "PULocationID", pickup_hour(), "payment_type"))


def mode_per_group(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Most frequent value per group; ties go to the smaller value, and NULL is a value, the smallest."""
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = counted.groupBy(*keys).agg(F.min(F.struct((-F.col("_n")).alias("n"), value)).alias("_best"))
    return best.select(*keys, F.col(f"_best.{value}").alias(value), (-F.col("_best.n")).alias("frequency"))


def high_tip_mode(trips: DataFrame) -> DataFrame:
    """Commonest payment type among high tips per zone and hour."""
    pct = tip_pct(F.col("tip_amount"), F.col("fare_amount"))
    high = trips.filter(F.col("fare_amount") > 0).filter(pct > HIGH_TIP_PCT)
    return mode_per_group(high.select("PULocationID", pickup_hour(), "payment_type"),
                          ["PULocationID", "pickup_hour"], "payment_type")


def _first_n(rows: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    ranked = rows.withColumn("_rn", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.filter(F.col("_rn") <= n).drop("_rn")


def rankings_from_totals(totals: DataFrame, n: int = 10, both: bool = False) -> DataFrame:
    """Daily rankings from totals by day, zone, hour and possibly more."""
    zone_day = roll_up(totals, "trip_date", "PULocationID").select(
        "trip_date", "PULocationID", _mean_pct().alias("avg_tip_pct"))
    hour_day = roll_up(totals, "trip_date", "pickup_hour").select(
        "trip_date", "pickup_hour", _mean_pct().alias("pct"))
    # Each side is a plain "rank <= n", which Spark cuts to n rows per day before the shuffle.
    top = _first_n(zone_day, "trip_date", [F.desc("avg_tip_pct"), F.asc("PULocationID")], n)
    bottom = _first_n(zone_day, "trip_date", [F.asc("avg_tip_pct"), F.asc("PULocationID")], n)
    labelled = (top.withColumn("ranking_bucket", F.lit(f"top{n}"))
                .unionByName(bottom.withColumn("ranking_bucket", F.lit(f"bottom{n}"))))
    if not both:
        # A zone in both halves, on a day with few zones, is listed once, as top.
        # Sums of doubles depend on the order of addition, so the average is no part of the key.
        labelled = labelled.groupBy("trip_date", "PULocationID").agg(
            F.max("avg_tip_pct").alias("avg_tip_pct"), F.max("ranking_bucket").alias("ranking_bucket"))
    best = hour_day.groupBy("trip_date").agg(
        F.max(F.struct("pct", (-F.col("pickup_hour")).alias("h"))).alias("_best"))
    best = best.select("trip_date", (-F.col("_best.h")).alias("best_hour_global"),
                       F.col("_best.pct").alias("best_hour_avg_tip_pct"))
    return labelled.join(best, "trip_date").select(
        "trip_date", "ranking_bucket", "PULocationID", "avg_tip_pct",
        "best_hour_global", "best_hour_avg_tip_pct")


def tip_rankings(trips: DataFrame, n: int = 10, both: bool = False) -> DataFrame:
    """Per day the n zones with the best and the worst tips, next to the day's best hour.

    Trips are scanned once; zones and hours are both rolled up from day x zone x hour. With ``both``
    a zone in both halves appears twice.
    """
    return rankings_from_totals(tip_totals(trips, trip_date(), "PULocationID", pickup_hour()), n, both)


def zone_hour_tips(trips: DataFrame) -> DataFrame:
    return tip_totals(trips, "PULocationID", pickup_hour()).select(
        "PULocationID", "pickup_hour", _mean_pct().alias("avg_tip_pct"))


def top_zone_hours(trips: DataFrame, n: int) -> DataFrame:
    """The n best zone and hour pairs."""
    return zone_hour_tips(trips).orderBy(F.desc("avg_tip_pct"), "PULocationID", "pickup_hour").limit(n)


def best_zone_hour(trips: DataFrame) -> DataFrame:
    return top_zone_hours(trips, 1)


def top_behavior(trips: DataFrame, n: int = 20) -> DataFrame:
    """The n zone and hour pairs with the highest average percentage, with all their measures."""
    return tip_behavior(trips).orderBy(F.desc("avg_tip_percentage"), "PULocationID", "pickup_hour").limit(n)


def best_hour(trips: DataFrame) -> DataFrame:
    """The hour with the best tips over the whole period."""
    hours = tip_totals(trips, pickup_hour()).select("pickup_hour", _mean_pct().alias("avg_tip_pct"))
    return hours.orderBy(F.desc("avg_tip_pct"), "pickup_hour").limit(1)


def driver_tip_report(trips: DataFrame, drivers: DataFrame, mode: str = "id") -> DataFrame:
    """Average tip per driver, trips being dealt out to drivers by ``trip_id`` modulo their number.

    ``id``     trips of bucket b belong to the driver with id b + 1; buckets without such a driver drop out.
    ``dense``  trips of bucket b belong to the driver on place b in id order; every trip is kept.

    Trips are reduced to one row per bucket first and only then meet the drivers, so the join is no
    larger than the driver table. The driver count is a scalar subquery.
    """
    drivers = drivers.select("id", "rating")
    count = drivers.agg(F.count(F.lit(1)).alias("n")).scalar()
    bucket = F.pmod(F.col("trip_id"), F.nullif(count, F.lit(0))).alias("_bucket")
    per_bucket = tip_totals(trips, bucket)
    if mode == "id":
        dealt = drivers.withColumn("_bucket", F.col("id").cast("bigint") - 1)
    elif mode == "dense":
        dealt = assign_ids(drivers, "dense", ["id"], "_bucket")
    else:
        raise ValueError("mode must be 'id' or 'dense'")
    return per_bucket.join(dealt, "_bucket").select(
        F.col("id").alias("driver_id"),
        F.col("rating").alias("driver_rating"),
        _mean("tip_sum").alias("avg_tip_amount"),
        _mean_pct().alias("avg_tip_pct"),
        "trips_count")


def top_drivers(report: DataFrame, n: int = 20) -> DataFrame:
    """The n drivers with the best rating, equal ratings by average percentage."""
    return report.orderBy(F.desc("driver_rating"), F.desc("avg_tip_pct"), "driver_id").limit(n)


def driver_tip_by_key(trips: DataFrame, drivers: DataFrame) -> DataFrame:
    """Average percentage per driver for trips that do carry a ``driver_id``; drivers have id and rating."""
    averaged = trips.groupBy("driver_id").agg(
        F.avg(tip_pct(F.col("tip_amount"), F.col("fare_amount"))).alias("avg_tip_pct"))
    known = drivers.select(F.col("id").alias("driver_id"), "rating")
    return averaged.join(known, "driver_id").select("driver_id", "rating", "avg_tip_pct")


def rating_vs_tip(report: DataFrame) -> DataFrame:
    """Mean of the drivers' average percentages per rating."""
    return report.groupBy("driver_rating").agg(
        F.avg("avg_tip_pct").alias("mean_tip_pct"), F.count(F.lit(1)).alias("drivers"))


def rating_tip_correlation(report: DataFrame) -> DataFrame:
    """Correlation of rating and average percentage; NULL when either does not vary."""
    varies = (F.var_pop("driver_rating") > 0) & (F.var_pop("avg_tip_pct") > 0)
    n = F.count(F.lit(1))
    covariance = F.covar_pop("driver_rating", "avg_tip_pct")
    spread = F.stddev_pop("driver_rating") * F.stddev_pop("avg_tip_pct")
    return report.filter(F.col("driver_rating").isNotNull()).agg(
        F.when(varies, covariance / spread).alias("correlation"), n.alias("drivers"))
