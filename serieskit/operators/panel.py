"""Daily panel: one row per commodity, series and day."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from serieskit.config import PLACE_KEYS, SERIES_KEYS
from serieskit.operators.ordered import exact_quantiles
from serieskit.operators.skew import HOT_ROWS, split_hot
from serieskit.session import lay_out

# Records whose copies one task removes.
TASK_ROWS = 500_000
DAY = ["commodity", *SERIES_KEYS, "date"]
PLACE = ["commodity", *PLACE_KEYS]


def _middle(values: Column) -> Column:
    """Median of an array without NULLs; NULL when it is empty."""
    ordered, n = F.sort_array(values), F.size(values)
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    return (low + F.get(ordered, F.floor(n / 2).cast("int"))) / 2


def _tasks_for(records: DataFrame) -> int:
    return max(records.sparkSession.sparkContext.defaultParallelism, ceil(records.count() / TASK_ROWS))


def daily_medians(records: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Median price and spread, reports and distinct prices per series and day.

    ``records`` may hold copies, is counted and read twice, so it should be a stored table. Rows are dealt by day once; copies are removed and a day's
    prices are listed where they are then, without a further exchange. The split bounds the lists: days beyond its bound are ordered over
    many tasks instead. The number of tasks follows the rows, so that one holds the distinct rows of its days without sorting them first.
    """
    ordinary, hot = split_hot(records, DAY, hot_rows)
    distinct = ordinary.repartition(_tasks_for(records), *DAY).dropDuplicates()
    # Rows are put in order of their day to be listed; a number in front settles nearly all of that, where the texts begin alike.
    lists = distinct.groupBy(F.xxhash64(*DAY).alias("_day"), *DAY).agg(F.collect_list("price").alias("prices"), F.collect_list("relative_spread").alias("spreads"))
    small = lists.select(
        *DAY,
        _middle(F.col("prices")).alias("price"),
        _middle(F.col("spreads")).alias("relative_spread"),
        F.size("prices").cast("bigint").alias("daily_reports"),
        F.size(F.array_distinct("prices")).cast("bigint").alias("distinct_reported_prices"),
    )
    return small if hot is None else small.unionByName(_large_days(hot.dropDuplicates()))


def _large_days(distinct: DataFrame) -> DataFrame:
    per_price = distinct.groupBy(*DAY, "price").agg(F.count("*").alias("n"))
    counts = per_price.groupBy(*DAY).agg(F.sum("n").alias("daily_reports"), F.count("*").alias("distinct_reported_prices"))
    return (
        exact_quantiles(distinct, DAY, "price", {"price": 0.5})
        .join(exact_quantiles(distinct, DAY, "relative_spread", {"relative_spread": 0.5}), DAY, "left")
        .join(counts, DAY)
    )


def dominant_varieties(days: DataFrame) -> DataFrame:
    """Yearly most frequent variety per place (ties: first by name), and how many differ.

    Counts distinct records through ``daily_reports``, so the records are not read again.
    """
    counts = days.groupBy(*PLACE, F.year("date").alias("year"), "variety").agg(F.sum("daily_reports").alias("rows"))
    yearly = counts.groupBy(*PLACE, "year").agg(F.min(F.struct((-F.col("rows")).alias("o"), "variety"))["variety"].alias("variety"))
    return yearly.groupBy(*PLACE).agg(F.count_distinct("variety").alias("annual_dominant_varieties")).withColumn(
        "dominant_variety_switch", F.col("annual_dominant_varieties") > 1
    )


def stored_days(records: DataFrame, hot_rows: int = HOT_ROWS, buckets: int | None = None) -> DataFrame:
    """The daily medians as a table in folders by year and buckets by place, each bucket in the order of its series.

    What follows (dominance, returns, runs, profiles) groups by the place or by more, so it needs no exchange.
    """
    days = daily_medians(records, hot_rows).withColumn("year", F.year("date"))
    return lay_out(days, PLACE, [*PLACE, *[k for k in SERIES_KEYS if k not in PLACE], "date"], ["year"], buckets)


def in_years(days: DataFrame, first: int, last: int) -> DataFrame:
    """The days of some years; only their folders are read."""
    return days.where(F.col("year").between(first, last))


def with_dominance(days: DataFrame) -> DataFrame:
    return days.drop("year").join(dominant_varieties(days), PLACE, "left")


def daily_panel(records: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    return with_dominance(stored_days(records, hot_rows))


def panel_audit(records: DataFrame, days: DataFrame) -> DataFrame:
    """One row: copies removed, distinct records, panel rows, days with conflicting prices."""
    read = records.agg(F.count("*").alias("sound"))
    counted = days.agg(
        F.coalesce(F.sum("daily_reports"), F.lit(0)).alias("retained_unique_raw_rows"),
        F.count("*").alias("unique_daily_profiles"),
        F.coalesce(F.sum((F.col("distinct_reported_prices") > 1).cast("bigint")), F.lit(0)).alias("days_with_conflicting_reported_prices"),
    )
    removed = (read.scalar() - F.col("retained_unique_raw_rows")).alias("duplicate_rows_removed")
    return counted.select(removed, "*")
