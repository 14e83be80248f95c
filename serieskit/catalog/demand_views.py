"""Regular series derived from the given tables, for Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from serieskit.catalog.registry import load
from serieskit.config import DemandConfig
from serieskit.operators import grid as G, splits
from serieskit.session import materialize

HOURLY = DemandConfig(
    step_seconds=3600, lag_minutes=(60, 180, 360, 1440, 10080), rolling_minutes=(180, 360, 720),
    change_minutes=360, horizon_steps=12, embargo_seconds=12 * 3600,
)
QUARTERLY = DemandConfig(
    step_seconds=900, lag_minutes=(15, 30, 60, 1440, 10080), rolling_minutes=(90, 180, 540),
    change_minutes=90, horizon_steps=12, embargo_seconds=3 * 3600,
)
DAILY = DemandConfig(
    step_seconds=86400, lag_minutes=(1440, 10080), rolling_minutes=(4320, 10080),
    change_minutes=4320, horizon_steps=12, embargo_seconds=12 * 86400,
)


def readings(spark, sf, cfg: DemandConfig) -> DataFrame:
    """Demand per slot of the event stream; temperature is missing where no view happened."""
    kind, value = F.col("event_type"), F.col("value")
    return load(spark, sf, "events").groupBy(G.slot_of(F.col("ts"), cfg.step_seconds).alias("slot")).agg(
        F.round(F.sum("value"), 2).alias("demand"),
        F.round(F.avg(F.when(kind == "view", value)), 4).alias("temperature"),
        F.sum(F.when(kind == "click", 1.0).otherwise(0.0)).alias("humidity"),
    )


def raw_readings(spark, sf) -> DataFrame:
    """Events as raw readings, some of them not positive."""
    return load(spark, sf, "events").select(F.col("ts").alias("timestamp"), (F.col("value") - 10).alias("demand"))


def grid(spark, sf, cfg: DemandConfig) -> DataFrame:
    return G.regular_grid(readings(spark, sf, cfg), cfg)


def sales(spark, sf) -> DataFrame:
    return load(spark, sf, "orders").groupBy(G.slot_of(F.col("o_orderdate"), 86400).alias("slot")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("demand"),
        F.round(F.avg("o_totalprice"), 2).alias("temperature"),
        F.count("*").cast("double").alias("humidity"),
    )


def sales_grid(spark, sf) -> DataFrame:
    return G.regular_grid(sales(spark, sf), DAILY)


def holidays(spark, sf) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    fixed = ("01-26", "08-15", "10-02")
    return load(spark, sf, "orders").select(day.alias("date")).where(F.date_format("date", "MM-dd").isin(*fixed)).dropDuplicates()


def features(spark, sf, cfg: DemandConfig) -> DataFrame:
    source = sales_grid(spark, sf) if cfg is DAILY else grid(spark, sf, cfg)
    return G.demand_features(source, cfg, holidays(spark, sf))


def labelled(spark, sf, cfg: DemandConfig = HOURLY) -> DataFrame:
    stored = materialize(features(spark, sf, cfg))
    return splits.label_target(splits.time_split(stored, cfg), cfg)


def scored(spark, sf) -> DataFrame:
    """Validation and test rows with demand over its train maximum as a score."""
    rows = labelled(spark, sf)
    top = rows.where(F.col("split") == "train").agg(F.max("demand_now")).first()[0]
    held = rows.where(F.col("split").isin("validation", "test"))
    held = held.withColumn("score", F.round(F.col("demand_now") / F.lit(top), 6))
    return held.withColumn("prediction", (F.col("score") >= 0.7).cast("int"))


def _steps(cfg: DemandConfig, minutes: int) -> int:
    return minutes * 60 // cfg.step_seconds


def sql_readings(cfg: DemandConfig) -> str:
    if cfg is DAILY:
        return """
readings as (select epoch_us(o_orderdate) // 86400000000 as slot, round(sum(o_totalprice), 2) as demand,
                    round(avg(o_totalprice), 2) as temperature, count(*)::double as humidity from orders group by 1),
hol as (select distinct cast(o_orderdate as date) as day from orders where strftime(o_orderdate, '%m-%d') in ('01-26', '08-15', '10-02'))"""
    return f"""
readings as (select epoch_us(ts) // ({cfg.step_seconds} * 1000000::bigint) as slot, round(sum(value), 2) as demand,
                    round(avg(case when event_type = 'view' then value end), 4) as temperature,
                    count(*) filter (event_type = 'click')::double as humidity from events group by 1),
hol as (select distinct cast(o_orderdate as date) as day from orders where strftime(o_orderdate, '%m-%d') in ('01-26', '08-15', '10-02'))"""


def sql_grid(cfg: DemandConfig) -> str:
    return sql_readings(cfg) + f""",
grid as (select slot, make_timestamp(slot * {cfg.step_seconds} * 1000000) as timestamp, demand, temperature, humidity
         from (select unnest(range((select min(slot) from readings), (select max(slot) + 1 from readings))) as slot) left join readings using (slot))"""


def sql_windows(cfg: DemandConfig) -> str:
    columns = [f"lag(demand, {_steps(cfg, m)}) over o as lag_{m}min" for m in cfg.lag_minutes]
    for m in cfg.rolling_minutes:
        n = _steps(cfg, m)
        frame = f"(order by slot rows between {n - 1} preceding and current row)"
        columns.append(f"case when count(demand) over {frame} = {n} then avg(demand) over {frame} end as mean_{m}min")
        columns.append(f"case when count(demand) over {frame} = {n} then stddev_samp(demand) over {frame} end as std_{m}min")
    columns.append(f"demand - lag(demand, {_steps(cfg, cfg.change_minutes)}) over o as change_{cfg.change_minutes}min")
    h = cfg.horizon_steps
    ahead = f"(order by slot rows between 1 following and {h} following)"
    return sql_grid(cfg) + f""",
win0 as (select slot, timestamp, demand as demand_now, temperature, humidity, {', '.join(columns)},
                case when count(demand) over {ahead} = {h} then max(demand) over {ahead} end as future_hour_max
         from grid window o as (order by slot)),
win as (select *, lag(future_hour_max, {_steps(cfg, cfg.day_minutes)}) over (order by slot) as yesterday_hour_max,
               lag(future_hour_max, {_steps(cfg, cfg.week_minutes)}) over (order by slot) as last_week_hour_max from win0)"""


def sql_features(cfg: DemandConfig) -> str:
    needed = ["demand_now", *[f"lag_{m}min" for m in cfg.lag_minutes]]
    needed += [f"{k}_{m}min" for m in cfg.rolling_minutes for k in ("mean", "std")]
    needed += [f"change_{cfg.change_minutes}min", "future_hour_max", "yesterday_hour_max", "last_week_hour_max"]
    known = " and ".join(f"{c} is not null" for c in needed)
    return sql_windows(cfg) + f""",
feat as (select *, sin(2 * pi() * (hour(timestamp) + minute(timestamp) / 60.0::double) / 24) as hour_sin,
                cos(2 * pi() * (hour(timestamp) + minute(timestamp) / 60.0::double) / 24) as hour_cos,
                sin(2 * pi() * (isodow(timestamp) - 1) / 7) as weekday_sin, cos(2 * pi() * (isodow(timestamp) - 1) / 7) as weekday_cos,
                sin(2 * pi() * month(timestamp) / 12) as month_sin, cos(2 * pi() * month(timestamp) / 12) as month_cos,
                case when isodow(timestamp) >= 6 then 1 else 0 end as weekend,
                case when cast(timestamp as date) in (select day from hol) then 1 else 0 end as india_holiday,
                temperature * humidity / 100 as temperature_x_humidity from win where {known})"""


def sql_labelled(cfg: DemandConfig) -> str:
    embargo = cfg.embargo_seconds // cfg.step_seconds
    return sql_features(cfg) + f""",
num as (select *, row_number() over (order by slot) - 1 as pos, count(*) over () as n from feat),
cut as (select min(slot) filter (pos = floor(n * 0.7::double)) as vs, min(slot) filter (pos = floor(n * 0.85::double)) as tst from num),
spl as (select num.*, case when slot + {embargo} < vs then 'train' when slot >= vs and slot + {embargo} < tst then 'validation'
                           when slot >= tst then 'test' end as split from num, cut),
lab as (select *, case when future_hour_max >= threshold then 1 else 0 end as target
        from spl, (select quantile_cont(demand_now, 0.9) as threshold from spl where split = 'train'))"""


def sql_scored() -> str:
    return sql_labelled(HOURLY) + """,
scored as (select *, case when score >= 0.7::double then 1 else 0 end as prediction from (
             select *, round(demand_now / (select max(demand_now) from lab where split = 'train'), 6) as score
             from lab where split in ('validation', 'test')))"""


def sql_baseline(cfg: DemandConfig) -> str:
    return sql_labelled(cfg) + """,
base as (select *, case when score >= threshold then 1 else 0 end as prediction from (
           select *, 'Persistence' as model, demand_now as score from lab where split = 'test'
           union all select *, 'Same hour yesterday', yesterday_hour_max from lab where split = 'test'
           union all select *, 'Same hour last week', last_week_hour_max from lab where split = 'test'))"""


SQL_RATES = """
count(*) as rows, round(avg(target), 6) as peak_fraction,
round(avg(case when target = prediction then 1.0::double else 0.0::double end), 6) as accuracy,
round(coalesce(count(*) filter (target = 1 and prediction = 1) / nullif(count(*) filter (prediction = 1), 0)::double, 0), 6) as "precision",
round(count(*) filter (target = 1 and prediction = 1) / nullif(count(*) filter (target = 1), 0)::double, 6) as recall_sensitivity,
round(count(*) filter (target = 0 and prediction = 0) / nullif(count(*) filter (target = 0), 0)::double, 6) as specificity,
round(coalesce(2 * count(*) filter (target = 1 and prediction = 1) / nullif(count(*) filter (target = 1) + count(*) filter (prediction = 1), 0)::double, 0), 6) as f1,
round((count(*) filter (target = 1 and prediction = 1) / nullif(count(*) filter (target = 1), 0)::double
     + count(*) filter (target = 0 and prediction = 0) / nullif(count(*) filter (target = 0), 0)::double) / 2, 6) as balanced_accuracy,
count(*) filter (target = 0 and prediction = 0) as TN, count(*) filter (target = 0 and prediction = 1) as FP,
count(*) filter (target = 1 and prediction = 0) as FN, count(*) filter (target = 1 and prediction = 1) as TP
"""
