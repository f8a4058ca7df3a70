"""A listings table derived from the shared order tables, in Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgecurve.operators.scale import join_measured, materialise
from lodgecurve.schemas import SEGMENT_COLS

LISTING_COLS = [
    "listing_key", *SEGMENT_COLS, "room_type", "listing_price", "person_capacity", "bedrooms", "cleanliness_rating",
    "guest_satisfaction_overall", "city_center_dist", "metro_dist", "host_is_superhost", "multi", "biz", "n_bookings",
    "occupancy_rate", "days_in_period", "days_booked",
]
OF_PARTS = ["listing_key", "room_type", "bedrooms", "city_center_dist", "metro_dist"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Deal rows to all cores when the files give fewer splits than there are cores, as small files do."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def _sent_to_all(df: DataFrame) -> bool:
    """Whether a join would broadcast this table whole."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def _as_often_as_met(lines: DataFrame, parts: DataFrame) -> DataFrame:
    """The inner join of ``lines`` with ``parts`` without columns of parts: each line as often as its key occurs there.

    Lines stay where they are. Their distinct keys, combined map-side, meet the counts of parts, and lines then meet those
    keys that occur never or repeatedly. The check runs while the plan is built.
    """
    counts = parts.groupBy(F.col("p_partkey").alias("__key")).agg(F.count(F.lit(1)).alias("__times"))
    keys = lines.select("l_partkey").where(F.col("l_partkey").isNotNull()).distinct()
    times = keys.join(counts, F.col("l_partkey") == F.col("__key"), "left").select("l_partkey", F.coalesce("__times", F.lit(0)).alias("__times"))
    odd = materialise(times.where(F.col("__times") != 1))
    known = lines.where(F.col("l_partkey").isNotNull())
    if odd.isEmpty():
        return known
    repeated = F.array_repeat(F.lit(1), F.coalesce("__times", F.lit(1)).cast("int"))
    return join_measured(known, odd, ["l_partkey"], "left", stored=True).withColumn("__times", F.explode(repeated)).drop("__times")


def listings(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One listing per order line, with all columns or at least those named. Join strategies are left to table sizes.

    Orders too large to broadcast meet customers and nations first, so that the lines, several to an order, are not
    shuffled by customer. Smaller ones stay in the order of the SQL, which moves no lines and keeps theirs. What depends
    on nations or orders alone is worked out there, before lines, several to an order, repeat it. Parts too large to
    broadcast meet keys of lines only, where no column named comes from parts.
    """
    unseen = bool(columns) and not set(columns) & set(OF_PARTS)
    lines = _spread(table(spark, sf_dir, "lineitem"), "l_orderkey")
    month = F.month("o_orderdate")
    season = F.when(month.isin(6, 7, 8), "high").when(month.isin(4, 5, 9, 10), "shoulder").otherwise("low")
    weekend = (F.weekday("o_orderdate") >= 4).cast("int")
    dated = table(spark, sf_dir, "orders")
    large = not _sent_to_all(dated)
    orders = dated.withColumns({"season": season, "weekend": weekend})
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation").withColumn("city", F.lower("n_name"))
    parts = table(spark, sf_dir, "part")
    counted = unseen and not _sent_to_all(parts.select("p_partkey"))
    lines = _as_often_as_met(lines, parts) if counted else lines
    of_customer, of_nation = orders.o_custkey == customers.c_custkey, customers.c_nationkey == nations.n_nationkey
    if not large:
        placed = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(customers, of_customer).join(nations, of_nation)
    else:
        orders = orders.join(customers, of_customer).join(nations, of_nation)
        placed = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    joined = placed if counted else placed.join(parts, lines.l_partkey == parts.p_partkey)
    season, weekend = F.col("season"), F.col("weekend")
    price = F.col("l_extendedprice") / F.lit(100.0)
    size = F.col("p_size")
    occupancy = F.lit(0.95) - F.lit(0.00045) * price + (F.col("l_quantity") - F.lit(25.0)) / F.lit(250.0)
    days = (
        F.when(season == "high", F.when(weekend == 1, 36.0).otherwise(87.0))
        .when(season == "shoulder", F.when(weekend == 1, 44.0).otherwise(108.0))
        .otherwise(F.when(weekend == 1, 24.0).otherwise(66.0))
    )
    of_parts = [] if counted else [
        F.concat_ws(
            "-",
            F.col("l_orderkey").cast("string"),
            F.col("l_linenumber").cast("string"),
            F.round(F.col("l_extendedprice") * F.lit(100.0)).cast("bigint").cast("string"),
            "p_type",
        ).alias("listing_key"),
        F.col("p_type").alias("room_type"),
        F.pmod(size, F.lit(6)).cast("double").alias("bedrooms"),
        (size / F.lit(4.0)).alias("city_center_dist"),
        (F.pmod(F.col("p_partkey"), F.lit(100)) / F.lit(20.0)).alias("metro_dist"),
    ]
    out = joined.select(
        *SEGMENT_COLS,
        *of_parts,
        price.alias("listing_price"),
        F.col("l_linenumber").cast("double").alias("person_capacity"),
        (F.col("l_tax") * F.lit(125.0)).alias("cleanliness_rating"),
        (F.lit(100.0) - F.col("l_discount") * F.lit(500.0)).alias("guest_satisfaction_overall"),
        (F.col("l_returnflag") == "R").cast("int").alias("host_is_superhost"),
        (F.col("l_linestatus") == "O").cast("int").alias("multi"),
        (F.col("o_orderstatus") == "P").cast("int").alias("biz"),
        F.col("l_quantity").alias("n_bookings"),
        F.least(F.greatest(occupancy, F.lit(0.05)), F.lit(1.0)).alias("occupancy_rate"),
        days.alias("days_in_period"),
    )
    booked = F.floor(F.col("occupancy_rate") * F.col("days_in_period")).cast("double")
    ordered = [c for c in LISTING_COLS if c in [*out.columns, "days_booked"]]
    return out.withColumn("days_booked", booked).select(ordered)


LISTINGS_SQL = """
joined AS (
  SELECT *,
    CASE WHEN month(o_orderdate) IN (6, 7, 8) THEN 'high'
         WHEN month(o_orderdate) IN (4, 5, 9, 10) THEN 'shoulder' ELSE 'low' END AS season,
    CASE WHEN isodow(o_orderdate) >= 5 THEN 1 ELSE 0 END AS weekend,
    l_extendedprice / 1e2 AS price
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey),
listed AS (
  SELECT
    concat_ws('-', l_orderkey, l_linenumber, cast(round(l_extendedprice * 1e2) AS BIGINT), p_type) AS listing_key,
    lower(n_name) AS city, season, weekend, p_type AS room_type, price AS listing_price,
    cast(l_linenumber AS DOUBLE) AS person_capacity,
    cast(p_size % 6 AS DOUBLE) AS bedrooms,
    l_tax * 125e0 AS cleanliness_rating,
    1e2 - l_discount * 5e2 AS guest_satisfaction_overall,
    p_size / 4e0 AS city_center_dist,
    (p_partkey % 100) / 20e0 AS metro_dist,
    cast(l_returnflag = 'R' AS INT) AS host_is_superhost,
    cast(l_linestatus = 'O' AS INT) AS multi,
    cast(o_orderstatus = 'P' AS INT) AS biz,
    l_quantity AS n_bookings,
    least(greatest(0.95e0 - 0.00045e0 * price + (l_quantity - 25e0) / 250e0, 0.05e0), 1e0) AS occupancy_rate,
    cast(CASE season WHEN 'high' THEN CASE weekend WHEN 1 THEN 36 ELSE 87 END
                     WHEN 'shoulder' THEN CASE weekend WHEN 1 THEN 44 ELSE 108 END
                     ELSE CASE weekend WHEN 1 THEN 24 ELSE 66 END END AS DOUBLE) AS days_in_period
  FROM joined),
listings AS (SELECT *, floor(occupancy_rate * days_in_period) AS days_booked FROM listed)
"""

# Listings with the price brought into its range: the only column the ranges change here.
CLIPPED_SQL = """
clipped AS (
  SELECT * REPLACE (CASE WHEN listing_price < 10 THEN 1e1 WHEN listing_price > 10000 THEN 1e4
                         ELSE listing_price END AS listing_price)
  FROM listings)
"""

FEATURES_SQL = """
features AS (
  SELECT *,
    ln(1e0 + listing_price) AS log_price,
    listing_price / greatest(person_capacity, 1e0) AS price_per_person,
    listing_price / greatest(bedrooms, 1e0) AS price_per_bedroom,
    CASE WHEN person_capacity <= 1 THEN '1' WHEN person_capacity = 2 THEN '2' WHEN person_capacity = 3 THEN '3'
         WHEN person_capacity = 4 THEN '4' ELSE '5+' END AS capacity_bin,
    least(1e2, greatest(0e0, guest_satisfaction_overall * 0.5e0 + cleanliness_rating * 0.3e0
          + greatest(0e0, 5e0 - city_center_dist) * 4e0)) AS quality_score,
    listing_price * guest_satisfaction_overall / 1e2 AS price_x_satisfaction,
    listing_price / (city_center_dist + 0.1e0) AS price_per_dist_km,
    ln(1e0 + metro_dist) AS log_metro_dist,
    ln(1e0 + n_bookings) AS log_bookings,
    weekend AS is_weekend
  FROM clipped)
"""

STATS_SQL = """
stats AS (
  SELECT city, season, weekend, count(*) AS segment_listing_count,
    avg(listing_price) AS segment_avg_price, stddev_samp(listing_price) AS segment_price_std,
    quantile_disc(listing_price, 0.5) AS segment_median_price,
    quantile_disc(listing_price, 0.9) AS segment_p90_price,
    quantile_disc(listing_price, 0.1) AS segment_p10_price,
    quantile_disc(listing_price, 0.9) - quantile_disc(listing_price, 0.1) AS segment_price_spread,
    avg(days_in_period) AS avg_days_in_period
  FROM features GROUP BY ALL)
"""
