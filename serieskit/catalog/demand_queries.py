"""Grid, windows, splits and evaluation over the regular series."""

from __future__ import annotations

from pyspark.sql import functions as F

from serieskit.catalog import demand_views as D
from serieskit.catalog.registry import load, query, rounded
from serieskit.config import POLICY_QUANTILES
from serieskit.operators import grid as G, metrics as M, ordered, splits
from serieskit.session import materialize

HOURLY, QUARTERLY, DAILY = D.HOURLY, D.QUARTERLY, D.DAILY


@query("invalid_demand", """
select event_type, count(*) as raw_rows, count(*) filter (value - 10 <= 0) as invalid from events group by 1""")
def invalid_demand(spark, sf):
    events = load(spark, sf, "events").select("event_type", F.col("ts").alias("timestamp"), (F.col("value") - 10).alias("demand"))
    return events.groupBy("event_type").agg(F.count("*").alias("raw_rows"), F.count(F.when(G.is_invalid(), 1)).alias("invalid"))


@query("off_grid_count", """
select count(*) filter (epoch_us(ts) % 300000000 <> 0) as off_grid_events, count(*) as events,
       (select count(*) filter (epoch_us(o_orderdate) % 300000000 <> 0) from orders) as off_grid_orders from events""")
def off_grid_count(spark, sf):
    five = D.DemandConfig()
    events = load(spark, sf, "events").select(F.col("ts").alias("timestamp"))
    orders = load(spark, sf, "orders").select(F.col("o_orderdate").alias("timestamp"))
    off = F.count(F.when(G.off_grid(five), 1))
    return events.agg(off.alias("off_grid_events"), F.count("*").alias("events")).withColumn("off_grid_orders", orders.agg(off).scalar())


@query("regular_grid", "with " + D.sql_grid(QUARTERLY) + """
select slot, cast(timestamp as varchar) as timestamp, round(demand, 6) as demand, round(temperature, 6) as temperature, humidity from (
  select slot, timestamp, avg(d) as demand, avg(temperature) as temperature, avg(humidity) as humidity from (
    select *, demand as d from grid union all select *, demand + 1 from grid where slot % 2 = 0 and demand is not null) group by all)""")
def regular_grid(spark, sf):
    once = D.readings(spark, sf, QUARTERLY)
    twice = once.unionByName(once.where(F.col("slot") % 2 == 0).withColumn("demand", F.col("demand") + 1))
    out = G.regular_grid(twice, QUARTERLY).withColumn("timestamp", G.time_of(F.col("slot"), 900))
    return rounded(out.select("slot", "timestamp", "demand", "temperature", "humidity"))


@query("grid_lags", "with " + D.sql_windows(QUARTERLY) + """
select slot, round(lag_15min, 4) as lag_15min, round(lag_30min, 4) as lag_30min, round(lag_60min, 4) as lag_60min,
       round(lag_1440min, 4) as lag_1440min, round(lag_10080min, 4) as lag_10080min, round(change_90min, 4) as change_90min from win""")
def grid_lags(spark, sf):
    out = G.demand_windows(D.grid(spark, sf, QUARTERLY), QUARTERLY)
    return rounded(out.select("slot", *[f"lag_{m}min" for m in QUARTERLY.lag_minutes], "change_90min"), 4)


@query("rolling_stats", "with " + D.sql_windows(QUARTERLY) + """
select slot, round(mean_90min, 4) as mean_90min, round(std_90min, 4) as std_90min, round(mean_180min, 4) as mean_180min,
       round(std_180min, 4) as std_180min, round(mean_540min, 4) as mean_540min, round(std_540min, 4) as std_540min from win""")
def rolling_stats(spark, sf):
    out = G.demand_windows(D.grid(spark, sf, QUARTERLY), QUARTERLY)
    return rounded(out.select("slot", *[f"{k}_{m}min" for m in QUARTERLY.rolling_minutes for k in ("mean", "std")]), 4)


SQL_TYPED = """
with readings as (select event_type, epoch_us(ts) // 900000000 as slot, round(sum(value), 2) as demand from events where event_type <> 'view' or user_id % 3 > 0 group by 1, 2),
ends as (select event_type, min(slot) as a, max(slot) as b from readings group by 1),
grid as (select * from (select event_type, unnest(range(a, b + 1)) as slot from ends) left join readings using (event_type, slot))"""


def _typed_windows(spark, sf):
    """Windows over one series for every type of event."""
    events = load(spark, sf, "events").where("event_type <> 'view' or user_id % 3 > 0")
    readings = events.groupBy("event_type", G.slot_of(F.col("ts"), 900).alias("slot")).agg(F.round(F.sum("value"), 2).alias("demand"))
    return G.demand_windows(materialize(G.regular_grid(readings, QUARTERLY, by=["event_type"])), QUARTERLY, by=["event_type"])


@query("grid_lags_by_type", SQL_TYPED + """
select event_type, slot, round(demand, 4) as demand_now, round(lag(demand, 1) over w, 4) as lag_15min, round(lag(demand, 4) over w, 4) as lag_60min,
       round(lag(demand, 672) over w, 4) as lag_10080min, round(demand - lag(demand, 6) over w, 4) as change_90min,
       round(case when count(demand) over a = 12 then max(demand) over a end, 4) as future_hour_max
from grid window w as (partition by event_type order by slot), a as (partition by event_type order by slot rows between 1 following and 12 following)""")
def grid_lags_by_type(spark, sf):
    wanted = ["event_type", "slot", "demand_now", "lag_15min", "lag_60min", "lag_10080min", "change_90min", "future_hour_max"]
    return rounded(_typed_windows(spark, sf).select(*wanted), 4)


@query("rolling_stats_by_type", SQL_TYPED + """
select event_type, slot, round(case when count(demand) over a = 6 then avg(demand) over a end, 4) as mean_90min, round(case when count(demand) over a = 6 then stddev_samp(demand) over a end, 4) as std_90min,
       round(case when count(demand) over b = 36 then avg(demand) over b end, 4) as mean_540min, round(case when count(demand) over b = 36 then stddev_samp(demand) over b end, 4) as std_540min
from grid window a as (partition by event_type order by slot rows between 5 preceding and current row), b as (partition by event_type order by slot rows between 35 preceding and current row)""")
def rolling_stats_by_type(spark, sf):
    return rounded(_typed_windows(spark, sf).select("event_type", "slot", "mean_90min", "std_90min", "mean_540min", "std_540min"), 4)


@query("future_max", "with " + D.sql_windows(QUARTERLY) + "select slot, round(future_hour_max, 4) as future_hour_max from win")
def future_max(spark, sf):
    return rounded(G.demand_windows(D.grid(spark, sf, QUARTERLY), QUARTERLY).select("slot", "future_hour_max"), 4)


@query("future_max_baselines", "with " + D.sql_windows(QUARTERLY) + """
select slot, round(yesterday_hour_max, 4) as yesterday_hour_max, round(last_week_hour_max, 4) as last_week_hour_max from win""")
def future_max_baselines(spark, sf):
    out = G.demand_windows(D.grid(spark, sf, QUARTERLY), QUARTERLY)
    return rounded(out.select("slot", "yesterday_hour_max", "last_week_hour_max"), 4)


@query("complete_examples", "with " + D.sql_features(QUARTERLY) + "select slot, cast(timestamp as varchar) as timestamp from feat")
def complete_examples(spark, sf):
    return rounded(D.features(spark, sf, QUARTERLY).select("slot", "timestamp"))


@query("holiday_flag", "with " + D.sql_grid(DAILY) + """
select slot, cast(timestamp as varchar) as timestamp, case when day is null then 0 else 1 end as india_holiday
from grid left join hol on cast(timestamp as date) = day""")
def holiday_flag(spark, sf):
    timed = D.sales_grid(spark, sf).select("slot", G.time_of(F.col("slot"), 86400).alias("timestamp"))
    return rounded(G.holiday_flags(timed, D.holidays(spark, sf)))


FEATURES = [*G.base_features(HOURLY), "temperature_x_humidity", *G.LOOKAHEAD]


@query("demand_features", "with " + D.sql_features(HOURLY) + "select slot, " + ", ".join(
    c if c in ("weekend", "india_holiday") else f"round({c}, 6) + 0.0::double as {c}" for c in FEATURES) + " from feat")
def demand_features(spark, sf):
    return rounded(D.features(spark, sf, HOURLY).select("slot", *FEATURES))


@query("demand_quality", "with " + D.sql_features(QUARTERLY) + """,
raw as (select ts, value - 10 as demand from events), fine as (select * from raw where demand > 0)
select (select count(*) from raw) as raw_rows, (select count(*) from raw) - (select count(*) from fine) as invalid_demand_or_timestamp,
       (select count(*) - count(distinct ts) from fine) as duplicate_timestamp_rows,
       (select count(*) filter (epoch_us(ts) % 900000000 <> 0) from fine) as off_grid_timestamp_rows,
       count(*) as grid_intervals, count(*) filter (demand is null) as missing_demand_intervals,
       cast(min(timestamp) as varchar) as start, cast(max(timestamp) as varchar) as "end",
       (select count(*) from feat) as usable_examples, count(*) - (select count(*) from feat) as removed_incomplete_examples from grid""")
def demand_quality(spark, sf):
    counted = G.readings_summary(D.raw_readings(spark, sf), QUARTERLY)
    shape = G.grid_summary(D.grid(spark, sf, QUARTERLY), D.features(spark, sf, QUARTERLY), QUARTERLY)
    return counted.withColumn("_k", F.lit(1)).join(shape.withColumn("_k", F.lit(1)), "_k").drop("_k")


@query("daily_max", "with " + D.sql_grid(QUARTERLY) + """
select cast(timestamp as date)::varchar as date, round(max(demand), 4) as daily_max from grid group by 1""")
def daily_max(spark, sf):
    return rounded(G.daily_max(D.grid(spark, sf, QUARTERLY), QUARTERLY), 4)


@query("quantile_table", """
select event_type, round(quantile_cont(value, 0.01), 6) as q01, round(quantile_cont(value, 0.25), 6) as q25, round(quantile_cont(value, 0.5), 6) as q50,
       round(quantile_cont(value, 0.75), 6) as q75, round(quantile_cont(value, 0.9), 6) as q90, round(quantile_cont(value, 0.99), 6) as q99
from events group by 1""")
def quantile_table(spark, sf):
    wanted = {"q01": 0.01, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q90": 0.9, "q99": 0.99}
    return rounded(ordered.exact_quantiles(load(spark, sf, "events"), ["event_type"], "value", wanted))


@query("time_split", "with " + D.sql_labelled(HOURLY) + "select slot, cast(timestamp as varchar) as timestamp, split from lab")
def time_split(spark, sf):
    return rounded(splits.time_split(materialize(D.features(spark, sf, HOURLY)), HOURLY).select("slot", "timestamp", "split"))


@query("label_target", "with " + D.sql_labelled(HOURLY) + "select slot, split, round(threshold, 4) as threshold, target from lab")
def label_target(spark, sf):
    return rounded(D.labelled(spark, sf).select("slot", "split", "threshold", "target"), 4)


@query("split_summary", "with " + D.sql_labelled(HOURLY) + """
select split, count(*) as rows, cast(min(timestamp) as varchar) as start, cast(max(timestamp) as varchar) as "end",
       round(avg(target), 6) as peak_fraction, count(distinct target) as classes from lab where split is not null group by 1""")
def split_summary(spark, sf):
    return rounded(splits.split_summary(D.labelled(spark, sf)))


@query("class_weights", "with " + D.sql_labelled(HOURLY) + """
select target, count(*) as rows, round((select count(*) from lab where split = 'train') / (2.0::double * count(*)), 6) as weight
from lab where split = 'train' group by 1""")
def class_weights(spark, sf):
    return rounded(splits.class_weights(D.labelled(spark, sf).where(F.col("split") == "train")))


@query("backtest_folds", "with " + D.sql_labelled(DAILY) + """,
f as (select *, e - interval 90 day as es, e - interval 120 day as tu from (
        select fold, l - months * interval 1 month as e from (select date_trunc('day', max(timestamp)) as l from lab where split = 'train'),
               (values (0, 12), (1, 6), (2, 0)) v(fold, months))),
p as (select fold, es, e, timestamp, case when timestamp + interval 12 day < tu then 'fit'
             when timestamp >= tu and timestamp + interval 12 day < es then 'tuning'
             when timestamp >= es and timestamp + interval 12 day <= e then 'evaluation' end as part from lab, f where split = 'train')
select fold, part, count(*) as rows, cast(es as date)::varchar as evaluation_start, cast(e as date)::varchar as evaluation_end,
       cast(min(timestamp) as varchar) as start, cast(max(timestamp) as varchar) as "end" from p where part is not null group by all""")
def backtest_folds(spark, sf):
    train = D.labelled(spark, sf, DAILY).where(F.col("split") == "train")
    return rounded(splits.backtest_summary(splits.backtest_parts(train, DAILY)))


SQL_FENCES = """,
q as (select quantile_cont(demand_now, 0.25) as q1, quantile_cont(demand_now, 0.75) as q3 from lab where split = 'train'),
fences as (select q1 - 1.5::double * (q3 - q1) as lo, q3 + 1.5::double * (q3 - q1) as hi from q),
chg as (select slot, demand, abs(demand / lag(demand) over (order by slot) - 1) as ch from grid),
flags as (select slot, demand, ch, coalesce(demand < lo or demand > hi, false) as outside, lo, hi from chg, fences
          where coalesce(demand < lo or demand > hi, false) or coalesce(ch > 0.3::double, false))"""


def _flags(spark, sf):
    fences = splits.outlier_fences(D.labelled(spark, sf))
    return fences, splits.flag_outliers(G.relative_change(D.grid(spark, sf, HOURLY), HOURLY), fences, HOURLY)


@query("outlier_audit", "with " + D.sql_labelled(HOURLY) + SQL_FENCES + """
select round(lo, 4) as "training_IQR_lower", round(hi, 4) as "training_IQR_upper", (select count(*) from flags) as flagged_grid_rows,
       'flag only; retain genuine peaks' as action from fences""")
def outlier_audit(spark, sf):
    fences, flags = _flags(spark, sf)
    return rounded(splits.outlier_audit(flags, fences), 4)


@query("outlier_rows", "with " + D.sql_labelled(HOURLY) + SQL_FENCES + """
select slot, round(demand, 4) as demand, round(ch, 4) as absolute_change_fraction, outside as "outside_training_IQR_fences" from flags""")
def outlier_rows(spark, sf):
    _, flags = _flags(spark, sf)
    return rounded(flags.select("slot", "demand", "absolute_change_fraction", "outside_training_IQR_fences"), 4)


SQL_FLAGS = "flags as (select source, toxic as target, 1 - quality as prediction from labels join documents using (doc_id))"


def _flag_rows(spark, sf):
    both = load(spark, sf, "labels").join(load(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    return both.select("source", F.col("toxic").alias("target"), (1 - F.col("quality")).alias("prediction"))


@query("confusion_counts", "with " + SQL_FLAGS + """
select source, count(*) filter (target = 0 and prediction = 0) as TN, count(*) filter (target = 0 and prediction = 1) as FP,
       count(*) filter (target = 1 and prediction = 0) as FN, count(*) filter (target = 1 and prediction = 1) as TP from flags group by 1""")
def confusion_counts(spark, sf):
    return M.confusion_counts(_flag_rows(spark, sf), ["source"])


@query("binary_metrics", "with " + SQL_FLAGS + f"select source, {D.SQL_RATES} from flags group by 1")
def binary_metrics(spark, sf):
    return rounded(M.binary_metrics(_flag_rows(spark, sf), ["source"]))


@query("roc_auc", "with " + D.sql_scored() + """
select a.split, round(sum(case when a.score > b.score then 1.0::double when a.score = b.score then 0.5::double else 0.0::double end) / count(*), 6) as roc_auc
from scored a join scored b on a.split = b.split and a.target = 1 and b.target = 0 group by 1""")
def roc_auc(spark, sf):
    return rounded(M.ranking_metrics(D.scored(spark, sf), ["split"]).select("split", "roc_auc"))


SQL_CURVE = D.sql_scored() + """,
pts as (select t.split, t.score, count(*) filter (s.target = 1 and s.score >= t.score) as tp, count(*) filter (s.target = 0 and s.score >= t.score) as fp,
               count(*) filter (s.target = 1) as p, count(*) filter (s.target = 0) as n
        from (select distinct split, score from scored) t join scored s on s.split = t.split group by all)"""


@query("average_precision", "with " + SQL_CURVE + """
select split, round(sum((tp - coalesce(prev, 0)) / p::double * tp / (tp + fp)), 6) as average_precision
from (select *, lag(tp) over (partition by split order by score desc) as prev from pts) group by 1""")
def average_precision(spark, sf):
    return rounded(M.ranking_metrics(D.scored(spark, sf), ["split"]).select("split", "average_precision"))


@query("roc_points", "with " + SQL_CURVE + """
select split, round(score, 6) as score, round(fp / n::double, 6) as false_positive_rate, round(tp / p::double, 6) as true_positive_rate from pts""")
def roc_points(spark, sf):
    return rounded(M.roc_points(D.scored(spark, sf), ["split"]))


@query("pr_points", "with " + SQL_CURVE + """
select split, round(score, 6) as score, round(tp / (tp + fp)::double, 6) as "precision", round(tp / p::double, 6) as recall,
       round(p / (p + n)::double, 6) as prevalence from pts""")
def pr_points(spark, sf):
    return rounded(M.pr_points(D.scored(spark, sf), ["split"]))


@query("fit_cutoff", "with " + D.sql_scored() + """,
c as (select 0.05::double + i * ((0.95::double - 0.05::double) / 90) as cutoff from range(0, 91) r(i)),
f as (select split, cutoff, coalesce(2 * count(*) filter (target = 1 and score >= cutoff) /
        nullif(count(*) filter (target = 1) + count(*) filter (score >= cutoff), 0)::double, 0) as f1 from scored, c group by all)
select split, round(cutoff, 6) as cutoff, round(f1, 6) as f1 from (
  select *, row_number() over (partition by split order by f1 desc, cutoff) as place from f) where place = 1""")
def fit_cutoff(spark, sf):
    return rounded(M.fit_cutoff(D.scored(spark, sf), ["split"]))


@query("whatif_cutoffs", "with " + D.sql_scored() + f""",
c as (select s.* replace (case when score >= probability_cutoff then 1 else 0 end as prediction), probability_cutoff
      from scored s, (values (0.2::double), (0.35::double), (0.5::double), (0.8::double)) v(probability_cutoff))
select split, probability_cutoff, {D.SQL_RATES} from c group by split, probability_cutoff""")
def whatif_cutoffs(spark, sf):
    return rounded(M.whatif_cutoffs(D.scored(spark, sf), ["split"]))


@query("whatif_peak_definition", "with " + D.sql_labelled(HOURLY) + """,
t as (select p as train_quantile, quantile_cont(demand_now, 0.85) as a, quantile_cont(demand_now, 0.9) as b, quantile_cont(demand_now, 0.95) as c
      from lab, (values (0.85::double), (0.9::double), (0.95::double)) v(p) where split = 'train' group by 1),
u as (select train_quantile, case train_quantile when 0.85 then a when 0.9 then b else c end as th from t)
select train_quantile, round(th, 4) as demand_threshold_native_units,
       round((select avg(case when future_hour_max >= th then 1.0::double else 0.0::double end) from lab where split = 'test'), 6) as test_future_peak_fraction,
       false as model_retrained from u""")
def whatif_peak_definition(spark, sf):
    return rounded(M.whatif_peak_definition(D.labelled(spark, sf), POLICY_QUANTILES), demand_threshold_native_units=4)


@query("baseline_metrics", "with " + D.sql_baseline(HOURLY) + f""",
auc as (select a.model, sum(case when a.score > b.score then 1.0::double when a.score = b.score then 0.5::double else 0.0::double end) / count(*) as roc_auc
        from base a join base b on a.model = b.model and a.target = 1 and b.target = 0 group by 1)
select model, {D.SQL_RATES}, round(any_value(roc_auc), 6) as roc_auc from base left join auc using (model) group by model""")
def baseline_metrics(spark, sf):
    return rounded(M.full_metrics(M.baseline_predictions(D.labelled(spark, sf)), ["model"]).drop("average_precision"))


@query("baseline_predictions", "with " + D.sql_baseline(HOURLY) + """
select model, slot, round(demand_now, 4) as demand_now, round(future_hour_max, 4) as future_hour_max, target, round(score, 4) as alert_score, prediction from base""")
def baseline_predictions(spark, sf):
    out = M.baseline_predictions(D.labelled(spark, sf)).withColumnRenamed("score", "alert_score")
    return rounded(out.select("model", "slot", "demand_now", "future_hour_max", "target", "alert_score", "prediction"), 4)


@query("metrics_advance_warning", "with " + D.sql_baseline(HOURLY) + f"select model, {D.SQL_RATES} from base where demand_now < threshold group by model")
def metrics_advance_warning(spark, sf):
    below = M.baseline_predictions(D.labelled(spark, sf)).where(F.col("demand_now") < F.col("threshold"))
    return rounded(M.binary_metrics(below, ["model"]))


@query("metrics_quarterly", "with " + D.sql_baseline(DAILY) + f"""
select year(timestamp)::varchar || 'Q' || quarter(timestamp)::varchar as period, model, {D.SQL_RATES} from base group by 1, 2""")
def metrics_quarterly(spark, sf):
    return rounded(M.binary_metrics(splits.quarters(M.baseline_predictions(D.labelled(spark, sf, DAILY))), ["period", "model"]))


@query("practical_error_rates", "with " + D.sql_baseline(HOURLY) + """
select model, count(*) as rows, count(*) filter (target = 0 and prediction = 1) as FP, count(*) filter (target = 1 and prediction = 0) as FN,
       round(1000.0::double * count(*) filter (target = 0 and prediction = 1) / count(*), 6) as false_alarms_per_1000_checks,
       round(1000.0::double * count(*) filter (target = 1 and prediction = 0) / count(*), 6) as missed_peak_checks_per_1000_checks from base group by 1""")
def practical_error_rates(spark, sf):
    counts = M.confusion_counts(M.baseline_predictions(D.labelled(spark, sf)), ["model"])
    return rounded(M.practical_error_rates(counts, ["model"]))


@query("example_predictions", "with " + D.sql_scored() + """
select * from (select case when target = 1 and prediction = 1 then 'correct warning' when target = 0 and prediction = 0 then 'correct no warning'
                           when target = 0 then 'false alarm' else 'missed peak' end as outcome, cast(timestamp as varchar) as timestamp, target, prediction,
                      row_number() over (partition by target, prediction order by timestamp) as position from scored where split = 'test') where position <= 3""")
def example_predictions(spark, sf):
    test = D.scored(spark, sf).where(F.col("split") == "test").select("timestamp", "target", "prediction")
    return rounded(M.example_predictions(test))


@query("anchor_cases", "with " + D.sql_labelled(HOURLY) + """
select 'low demand' as "case", arg_min(slot, (demand_now, slot)) as slot from lab where split = 'test'
union all select 'near peak threshold', arg_min(slot, (abs(demand_now - threshold), slot)) from lab where split = 'test'
union all select 'high demand', arg_min(slot, (-demand_now, slot)) from lab where split = 'test'""")
def anchor_cases(spark, sf):
    return M.anchor_cases(D.labelled(spark, sf))


@query("day_block_bootstrap", "with " + D.sql_scored() + """,
days as (select row_number() over (order by day) - 1 as i, count(*) over () as nd, * from (
           select cast(timestamp as date) as day, count(*) filter (target = 0 and prediction = 0) as tn, count(*) filter (target = 0 and prediction = 1) as fp,
                  count(*) filter (target = 1 and prediction = 0) as fn, count(*) filter (target = 1 and prediction = 1) as tp from scored group by 1)),
draws as (select r, floor(cast('0x' || substr(md5('42:' || r::varchar || ':' || i::varchar), 1, 8) as bigint) * nd / 4294967296.0::double)::bigint as pick
          from days, range(0, 100) x(r)),
sums as (select r, sum(tn) as tn, sum(fp) as fp, sum(fn) as fn, sum(tp) as tp from draws join days on pick = i group by 1),
v as (select 'f1' as metric, 2 * tp / nullif(2 * tp + fp + fn, 0)::double as x from sums union all
      select 'recall_sensitivity', tp / nullif(tp + fn, 0)::double from sums union all select 'specificity', tn / nullif(tn + fp, 0)::double from sums)
select metric, round(quantile_cont(x, 0.025), 6) as lower_95, round(quantile_cont(x, 0.975), 6) as upper_95, 'calendar day' as resampling_unit from v group by 1""")
def day_block_bootstrap(spark, sf):
    return rounded(M.day_block_bootstrap(D.scored(spark, sf), 100))
