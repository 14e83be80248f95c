"""Regular time grids and windows over them.

A series without a key would put every window into one task. Here the dense grid is cut
into chunks of slots; each chunk also receives the rows its windows reach into, and keeps
only its own. The result equals one window over the whole series. Of many series, short ones are one chunk each, and
long ones are cut.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from serieskit.config import DEMAND_OPTIONAL, DemandConfig
from serieskit.functions import scalars as S
from serieskit.session import materialize
from serieskit.sources.columns import dtype_of

CHUNK = 4096
WEATHER = ("temperature", "humidity", *DEMAND_OPTIONAL)


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session zone."""
    return F.timestamp_diff("MICROSECOND", _epoch(), ts)


def slot_of(ts: Column, step_seconds: int) -> Column:
    width = step_seconds * 1_000_000
    return ((micros(ts) - F.pmod(micros(ts), F.lit(width))) / width).cast("bigint")


def time_of(slot: Column, step_seconds: int) -> Column:
    return _epoch() + F.make_dt_interval(secs=(slot * step_seconds).cast("decimal(18,6)"))


def read_demand(resolved: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Resolved raw readings -> typed columns; nothing is removed yet."""
    columns = [S.parse_timestamp(F.col("timestamp"), cfg.local_zone, dtype_of(resolved, "timestamp")).alias("timestamp")]
    for name in resolved.columns:
        if name != "timestamp":
            columns.append(S.as_number(F.col(name), dtype_of(resolved, name)).alias(name))
    return resolved.select(*columns)


def is_invalid() -> Column:
    return F.col("timestamp").isNull() | F.col("demand").isNull() | (F.col("demand") <= 0)


def off_grid(cfg: DemandConfig) -> Column:
    return F.pmod(micros(F.col("timestamp")), F.lit(cfg.step_seconds * 1_000_000)) != 0


def readings_summary(typed: DataFrame, cfg: DemandConfig) -> DataFrame:
    """One row of counters over the raw readings; copies of a timestamp are combined before counting."""
    bad = is_invalid()
    per_time = typed.groupBy(F.when(~bad, F.col("timestamp")).alias("timestamp")).agg(F.count("*").alias("rows"))
    fine = F.col("timestamp").isNotNull()

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    return per_time.agg(
        total(F.col("rows")).alias("raw_rows"),
        total(F.when(~fine, F.col("rows"))).alias("invalid_demand_or_timestamp"),
        total(F.when(fine, F.col("rows") - 1)).alias("duplicate_timestamp_rows"),
        total(F.when(fine & off_grid(cfg), F.col("rows"))).alias("off_grid_timestamp_rows"),
    )


def regular_grid(readings: DataFrame, cfg: DemandConfig, values: list[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One row per slot from the first to the last reading, of each series ``by``; equal slots averaged, gaps NULL."""
    values = values or [c for c in readings.columns if c not in ("timestamp", "slot", *by)]
    if "slot" not in readings.columns:
        readings = readings.withColumn("slot", slot_of(F.col("timestamp"), cfg.step_seconds))
    # Stored, since its ends are looked for before the slots meet it: the readings are then aggregated once.
    by_slot = materialize(readings.groupBy(*by, "slot").agg(*[F.avg(v).alias(v) for v in values]))
    slots = _all_slots(by_slot, by)
    if not by:
        return slots.join(by_slot, "slot", "left")
    same = reduce(lambda a, b: a & b, [F.col(f"s.{k}").eqNullSafe(F.col(f"r.{k}")) for k in by], F.col("s.slot") == F.col("r.slot"))
    return slots.alias("s").join(by_slot.alias("r"), same, "left").select("s.*", *[F.col(f"r.{v}") for v in values])


def _all_slots(by_slot: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every slot between the ends, made in parallel chunk by chunk."""
    ends = by_slot.groupBy(*by).agg(F.min("slot").alias("_first"), F.max("slot").alias("_last")).where(F.col("_first").isNotNull())
    chunk = F.explode(F.sequence(F.floor(F.col("_first") / CHUNK), F.floor(F.col("_last") / CHUNK))).alias("_chunk")
    chunks = ends.select(*by, "_first", "_last", chunk).repartition(*by, "_chunk")
    start = F.greatest(F.col("_first"), F.col("_chunk") * CHUNK)
    stop = F.least(F.col("_last"), F.col("_chunk") * CHUNK + (CHUNK - 1))
    return chunks.select(*by, F.explode(F.sequence(start, stop)).alias("slot"))


def _chunked_series(grid: DataFrame, back: int, ahead: int, build: Callable[[DataFrame, W], DataFrame], size: int, by: Sequence[str]) -> DataFrame:
    """``chunked`` for many series. A short series is one chunk and copies nothing; a long one is cut at chunks of its own.

    ``grid`` is read twice. Series meet their ends by a join, which Spark broadcasts while it is small and can split where a series is large.
    """
    by = list(by)
    ends = grid.groupBy(*by).agg(F.min("slot").alias("_first"), F.max("slot").alias("_last"))
    same = reduce(lambda a, b: a & b, [F.col(f"g.{k}").eqNullSafe(F.col(f"e.{k}")) for k in by])
    placed = grid.alias("g").join(ends.alias("e"), same).select("g.*", "_first", "_last")
    place, most = F.col("slot") - F.col("_first"), F.floor((F.col("_last") - F.col("_first")) / size)
    spread = F.sequence(F.greatest(F.lit(0), F.floor((place - ahead) / size)), F.least(most, F.floor((place + back) / size)))
    copies = placed.withColumn("_own", F.floor(place / size)).withColumn("_chunk", F.explode(spread)).drop("_first", "_last")
    built = build(copies, W.partitionBy(*by, "_chunk").orderBy("slot"))
    return built.where(F.col("_chunk") == F.col("_own")).drop("_chunk", "_own")


def chunked(grid: DataFrame, back: int, ahead: int, build: Callable[[DataFrame, W], DataFrame], size: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Apply ``build(frame, window)`` with windows reaching ``back`` and ``ahead`` slots on a dense grid, of each series ``by``."""
    size = size or max(CHUNK, 8 * (back + ahead))
    if by:
        return _chunked_series(grid, back, ahead, build, size, by)
    slot = F.col("slot")
    spread = F.sequence(F.floor((slot - ahead) / size), F.floor((slot + back) / size))
    copies = grid.withColumn("_chunk", F.explode(spread))
    built = build(copies, W.partitionBy("_chunk").orderBy("slot"))
    return built.where(F.col("_chunk") == F.floor(slot / size)).drop("_chunk")


def _full(window, start: int, end: int, fn: Callable, c: Column) -> Column:
    """Window aggregate that is NULL unless every slot of the frame has a value."""
    frame = window.rowsBetween(start, end)
    return F.when(F.count(c).over(frame) == end - start + 1, fn(c).over(frame))


def add_lags(frame: DataFrame, window, cfg: DemandConfig) -> DataFrame:
    d = F.col("demand_now")
    lags = {f"lag_{m}min": F.lag(d, cfg.steps(m)).over(window) for m in cfg.lag_minutes}
    change = d - F.lag(d, cfg.steps(cfg.change_minutes)).over(window)
    return frame.withColumns({**lags, f"change_{cfg.change_minutes}min": change})


def add_rolling(frame: DataFrame, window, cfg: DemandConfig) -> DataFrame:
    d, out = F.col("demand_now"), {}
    for m in cfg.rolling_minutes:
        start = 1 - cfg.steps(m)
        out[f"mean_{m}min"] = _full(window, start, 0, F.avg, d)
        out[f"std_{m}min"] = _full(window, start, 0, F.stddev_samp, d)
    return frame.withColumns(out)


def add_lookahead(frame: DataFrame, window, cfg: DemandConfig) -> DataFrame:
    """Highest demand of the coming slots (the current one is out), and the same a day and a week ago."""
    ahead = frame.withColumn("future_hour_max", _full(window, 1, cfg.horizon_steps, F.max, F.col("demand_now")))
    return ahead.withColumns({
        "yesterday_hour_max": F.lag("future_hour_max", cfg.steps(cfg.day_minutes)).over(window),
        "last_week_hour_max": F.lag("future_hour_max", cfg.steps(cfg.week_minutes)).over(window),
    })


def demand_windows(grid: DataFrame, cfg: DemandConfig, size: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    reach = [*cfg.lag_minutes, *cfg.rolling_minutes, cfg.change_minutes, cfg.day_minutes, cfg.week_minutes]
    back = max(cfg.steps(m) for m in reach)

    def build(frame, window):
        for step in (add_lags, add_rolling, add_lookahead):
            frame = step(frame, window, cfg)
        return frame

    return chunked(grid.withColumnRenamed("demand", "demand_now"), back, cfg.horizon_steps, build, size, by)


def relative_change(grid: DataFrame, cfg: DemandConfig, by: Sequence[str] = ()) -> DataFrame:
    """Absolute one-step change relative to the slot before; NULL if either is missing."""
    def build(frame, window):
        return frame.withColumn("absolute_change_fraction", F.abs(S.ratio(F.col("demand"), F.lag("demand", 1).over(window)) - 1))

    return chunked(grid, 1, 0, build, by=by)


def holiday_flags(frame: DataFrame, holidays: DataFrame, when: str = "timestamp") -> DataFrame:
    """1 where the date is in the calendar table (column ``date``), else 0."""
    days = holidays.select(F.col("date").cast("date").alias("_day")).dropDuplicates().withColumn("_hit", F.lit(1))
    marked = frame.withColumn("_day", F.to_date(when)).join(days, "_day", "left")
    return marked.withColumn("india_holiday", F.coalesce("_hit", F.lit(0))).drop("_day", "_hit")


def holiday_table(spark: SparkSession, years: list[int], country: str = "IN") -> DataFrame:
    """Calendar from the optional ``holidays`` package; supply your own table where it is absent."""
    try:
        import holidays
    except ImportError as missing:
        raise ValueError("no holiday calendar: pass a table with a date column") from missing
    days = sorted(holidays.country_holidays(country, years=years))
    return spark.createDataFrame([(d,) for d in days], "date date")


def add_calendar(frame: DataFrame, cfg: DemandConfig) -> DataFrame:
    timed = frame.withColumn("timestamp", time_of(F.col("slot"), cfg.step_seconds))
    ts = F.col("timestamp")
    hour = F.hour(ts) + F.minute(ts) / F.lit(60.0)
    parts = [*S.cyclic(hour, 24, "hour"), *S.cyclic(S.weekday(ts), 7, "weekday"), *S.cyclic(F.month(ts), 12, "month")]
    return timed.select("*", *parts, F.when(S.weekday(ts) >= 5, 1).otherwise(0).alias("weekend"))


def base_features(cfg: DemandConfig) -> list[str]:
    rolling = [f"{kind}_{m}min" for m in cfg.rolling_minutes for kind in ("mean", "std")]
    cycles = [f"{name}_{fn}" for name in ("hour", "weekday", "month") for fn in ("sin", "cos")]
    return ["demand_now", *[f"lag_{m}min" for m in cfg.lag_minutes], *rolling, f"change_{cfg.change_minutes}min", *cycles, "weekend", "india_holiday"]


def weather_features(columns: list[str]) -> list[str]:
    return [w for w in WEATHER if w in columns] + ["temperature_x_humidity"]


LOOKAHEAD = ["future_hour_max", "yesterday_hour_max", "last_week_hour_max"]


def demand_features(grid: DataFrame, cfg: DemandConfig, holidays: DataFrame) -> DataFrame:
    """All predictors and look-ahead columns per slot; only complete examples, weather may be missing."""
    frame = holiday_flags(add_calendar(demand_windows(grid, cfg), cfg), holidays)
    frame = frame.withColumn("temperature_x_humidity", F.col("temperature") * F.col("humidity") / 100)
    return complete_examples(frame, cfg)


def complete_examples(frame: DataFrame, cfg: DemandConfig) -> DataFrame:
    needed = [c for c in base_features(cfg) if c in frame.columns] + LOOKAHEAD
    return frame.dropna(subset=needed)


def grid_summary(grid: DataFrame, frame: DataFrame, cfg: DemandConfig) -> DataFrame:
    """One row: slots, missing slots, ends, usable and removed examples."""
    usable = frame.agg(F.count("*")).scalar()
    return grid.agg(
        F.count("*").alias("grid_intervals"),
        F.count(F.when(F.col("demand").isNull(), 1)).alias("missing_demand_intervals"),
        time_of(F.min("slot"), cfg.step_seconds).cast("string").alias("start"),
        time_of(F.max("slot"), cfg.step_seconds).cast("string").alias("end"),
    ).withColumn("usable_examples", usable).withColumn("removed_incomplete_examples", F.col("grid_intervals") - F.col("usable_examples"))


def daily_max(grid: DataFrame, cfg: DemandConfig) -> DataFrame:
    return grid.groupBy(F.to_date(time_of(F.col("slot"), cfg.step_seconds)).alias("date")).agg(F.max("demand").alias("daily_max"))
