"""Scans, cleaning, panel and profiles over the price records."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from serieskit.catalog import views as V
from serieskit.catalog.registry import load, query, rounded
from serieskit.config import PRICE_ALIASES, PRICE_OPTIONAL, PriceConfig
from serieskit.functions import scalars as S
from serieskit.operators import clean, panel, profiles
from serieskit.session import shared_folder
from serieskit.sources.columns import resolve
from serieskit.sources.discovery import CSV
from serieskit.sources.readers import scan_csv_text, union_sources
from serieskit.sources.sinks import key_values, write_json

DAY = "commodity, state, district, market, variety, grade, cast(date as varchar) as date"
TEXT_CFG = PriceConfig(commodities=("Economy", "Promo", "Small"), start_date="1997-01-01", end_date="1999-12-31")
ALL_CFG = PriceConfig(commodities=V.KINDS, start_date="1900-01-01", end_date="2099-12-31")


@query("scan_project_parquet", """
select l_returnflag, cast(l_shipdate as date)::varchar as day, count(*) as n, round(sum(l_quantity), 4) as quantity from lineitem group by all""")
def scan_project_parquet(spark, sf):
    day = F.col("l_shipdate").cast("date").cast("string").alias("day")
    return load(spark, sf, "lineitem").groupBy("l_returnflag", day).agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 4).alias("quantity"))


@query("resolve_aliases", "with " + V.SQL_TEXT + """
select l_orderkey, l_linenumber, commodity_name as commodity, state, district_name as district, market, variety,
       arrival_date as date, modal_price as price, round(min_price, 6) as minimum from txt""")
def resolve_aliases(spark, sf):
    bound = resolve(V.obs_price_text(spark, sf), PRICE_ALIASES, PRICE_OPTIONAL, keep=["l_orderkey", "l_linenumber"])
    return bound.withColumn("minimum", F.round(S.parse_number(F.col("minimum")), 6))


@query("union_aliased_sources", "with " + V.SQL_OBS + """
select origin, commodity, count(*) as n, count(minimum) as known_minimum, round(sum(price), 2) as price from (
  select 'a' as origin, commodity, price, minimum from obs where source_id = 0
  union all select 'b', commodity, price, null from obs where source_id = 1
  union all select 'c', commodity, price, minimum from obs where source_id = 2) group by all""")
def union_aliased_sources(spark, sf):
    obs = V.obs_price(spark, sf)
    shapes = {
        "a": {"commodity": "Commodity", "price": "Modal Price", "minimum": "Min_Price"},
        "b": {"commodity": "commodity_name", "price": "MODALPRICE"},
        "c": {"commodity": "Commodity Name", "price": "modal-price", "minimum": "Minimum Price"},
    }
    wanted = {k: PRICE_ALIASES[k] for k in ("commodity", "price", "minimum")}
    parts = []
    for i, (origin, headers) in enumerate(shapes.items()):
        raw = obs.where(F.col("source_id") == i).select(*[F.col(k).alias(h) for k, h in headers.items()], F.lit(origin).alias("origin"))
        parts.append(resolve(raw, wanted, ("minimum",), keep=["origin"]))
    return union_sources(parts).groupBy("origin", "commodity").agg(
        F.count("*").alias("n"), F.count("minimum").alias("known_minimum"), F.round(F.sum("price"), 2).alias("price")
    )


def _judged_dup(spark, sf):
    obs = V.obs_price_dup(spark, sf)
    return clean.judge(clean.standardize(obs, V.PRICES, keep=["source_id"]), V.PRICES)


@query("scan_manifest", "with " + V.SQL_TEXT + """,
r as (select * from txt union all select * from txt where l_linenumber = 1),
j as (select l_orderkey % 3 as source_id, lower(trim(commodity_name)) as kind, lower(trim(state)) as state, district_name, market, variety,
        case when l_orderkey % 90 = 7 then null else coalesce(try_strptime(arrival_date, '%d/%m/%Y'), try_strptime(arrival_date, '%Y-%m-%d')) end as day,
        try_cast(replace(modal_price, ',', '') as double) as price, min_price, case when l_linenumber = 2 then 1.0 else 1e7 end::double as maximum from r),
s as (select *, (maximum - min_price) / price as spread, case when kind not in ('economy', 'promo', 'small') then 'other' when day is null then 'unreadable'
        when day not between timestamp '1997-01-01' and timestamp '1999-12-31' then 'outside' when price is null or price <= 0 or state = '' then 'invalid'
        when min_price <= 0 or maximum < min_price or price < min_price or price > maximum then 'broken' else 'kept' end as step from j),
u as (select source_id, count(*) as valid_rows from (select distinct source_id, kind, state, district_name, market, variety, day, price, spread from s where step = 'kept') group by 1)
select source_id, count(*) as raw_rows_scanned, count(*) filter (step <> 'other') as commodity_rows, count(*) filter (step = 'unreadable') as unreadable_date_rows,
       count(*) filter (step in ('invalid', 'broken', 'kept')) as window_rows, count(*) filter (step = 'invalid') as invalid_rows,
       count(*) filter (step = 'broken') as inconsistent_price_rows, count(*) filter (step = 'kept') - any_value(valid_rows) as exact_duplicate_rows,
       any_value(valid_rows) as valid_rows
from s join u using (source_id) group by 1""")
def scan_manifest(spark, sf):
    text = V.obs_price_text(spark, sf)
    raw = text.unionByName(text.where("l_linenumber = 1")).withColumns({
        "source_id": F.col("l_orderkey") % 3,
        "Arrival_Date": F.when(F.col("l_orderkey") % 90 == 7, F.lit("soon")).otherwise(F.col("Arrival_Date")),
        "Max Price": F.when(F.col("l_linenumber") == 2, F.lit("1")).otherwise(F.lit("10,000,000")),
    })
    bound = resolve(raw, PRICE_ALIASES, PRICE_OPTIONAL, keep=["source_id"])
    judged = clean.judge(clean.standardize(bound, TEXT_CFG, ["source_id"]), TEXT_CFG)
    return clean.manifest(clean.store_judged(judged, ["source_id"]), "source_id")


@query("quality_kv", "with " + V.SQL_DUP + """,
t as (select count(*) as raw, count(*) filter (minimum <= 0 or maximum < minimum or price < minimum or price > maximum) as broken,
             count(distinct source_id) as sources from dup)
select 'raw_rows_scanned' as "check", raw::varchar as value from t union all
select 'inconsistent_price_rows_removed', broken::varchar from t union all select 'sources', sources::varchar from t""")
def quality_kv(spark, sf):
    counted = clean.manifest(clean.store_judged(_judged_dup(spark, sf), ["source_id"]), "source_id")
    row = counted.agg(
        F.sum("raw_rows_scanned").alias("raw_rows_scanned"),
        F.sum("inconsistent_price_rows").alias("inconsistent_price_rows_removed"),
        F.count("*").alias("sources"),
    )
    return key_values(row)


@query("csv_scan_typed", """
select l_returnflag as variety, count(*) as n, count(*) filter (l_linenumber <> 2) as known, round(sum(l_extendedprice), 2) as price,
       cast(max(l_shipdate) as date)::varchar as last_date from lineitem group by 1""")
def csv_scan_typed(spark, sf):
    """Lines written as CSV text with awkward cells, read back as text by their header and typed."""
    lines = load(spark, sf, "lineitem")
    missing = F.when(F.col("l_linenumber") == 2, F.lit("N/A")).otherwise(F.col("l_tax").cast("string"))
    text = lines.select(
        F.col("l_returnflag").alias("Variety"), F.format_number("l_extendedprice", 2).alias("Modal Price"), missing.alias("Min Price"),
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("Arrival_Date"), F.lit('a "quoted", cell').alias("Remark"),
    )
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    text.write.options(**CSV).csv(path)
    wanted = ("variety", "price", "minimum", "date")
    found = resolve(scan_csv_text(spark, [path], text.columns), {k: PRICE_ALIASES[k] for k in wanted})
    return found.groupBy("variety").agg(
        F.count("*").alias("n"), F.count("minimum").alias("known"), F.round(F.sum(S.parse_number(F.col("price"))), 2).alias("price"),
        F.max(S.parse_date(F.col("date"))).cast("string").alias("last_date"),
    )


@query("metrics_json", """
select l_returnflag, l_linestatus, count(*) as n, round(avg(l_discount), 6) as mean_discount,
       case when l_returnflag <> 'N' then round(sum(l_quantity), 2) end as quantity, cast(max(l_shipdate) as date)::varchar as last_date from lineitem group by 1, 2""")
def metrics_json(spark, sf):
    """Metrics written as JSON lines and read back: what is not finite comes back as missing, dates as text."""
    made = load(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.round(F.avg("l_discount"), 6).alias("mean_discount"),
        F.when(F.col("l_returnflag") == "N", F.lit(float("nan"))).otherwise(F.round(F.sum("l_quantity"), 2)).alias("quantity"),
        F.max("l_shipdate").cast("date").alias("last_date"),
    )
    path = f"{shared_folder(spark)}/json-{uuid.uuid4().hex}"
    write_json(made, path)
    schema = "l_returnflag string, l_linestatus string, n bigint, mean_discount double, quantity double, last_date string"
    return spark.read.schema(schema).json(path)


@query("parse_numbers", "with " + V.SQL_TEXT + """
select l_orderkey, l_linenumber, round(try_cast(replace(modal_price, ',', '') as double), 4) as number from txt""")
def parse_numbers(spark, sf):
    return V.obs_price_text(spark, sf).select("l_orderkey", "l_linenumber", F.round(S.parse_number(F.col("Modal_Price")), 4).alias("number"))


@query("clean_keys", "with " + V.SQL_TEXT + """
select lower(trim(state)) as state, lower(trim(district_name)) as district, coalesce(nullif(lower(trim(variety)), ''), 'unspecified') as variety,
       'unspecified' as grade, count(*) as n from txt group by all""")
def clean_keys(spark, sf):
    raw = V.obs_price_text(spark, sf)
    return raw.groupBy(
        S.clean_key(F.col("STATE")).alias("state"),
        S.clean_key(F.col("District Name")).alias("district"),
        S.clean_or_default(F.col("Variety")).alias("variety"),
        S.clean_or_default(F.lit(None)).alias("grade"),
    ).agg(F.count("*").alias("n"))


@query("map_category", "with " + V.SQL_TEXT + """
select case lower(trim(commodity_name)) when 'economy' then 'Economy' when 'promo' then 'Promo' when 'small' then 'Small' end as commodity,
       count(*) as n from txt group by 1""")
def map_category(spark, sf):
    spelled = S.spelling(F.col("Commodity Name"), TEXT_CFG.commodities).alias("commodity")
    return V.obs_price_text(spark, sf).groupBy(spelled).agg(F.count("*").alias("n"))


@query("parse_dates", """
select l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') as date from lineitem""")
def parse_dates(spark, sf):
    key = F.col("l_orderkey")
    text = F.lit(None).cast("string")
    layouts = ["yyyy-MM-dd", "dd/MM/yyyy", "dd-MM-yyyy", "d MMM yyyy", "yyyy/MM/dd", "dd/MM/yyyy HH:mm", "d MMMM yyyy", "dd/MM/yy", "d-MMM-yy", "MMMM d, yyyy", "dd.MM.yyyy hh:mm a"]
    for i, layout in enumerate(layouts):
        text = F.when(key % len(layouts) == i, F.date_format("l_shipdate", layout)).otherwise(text)
    return load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", S.parse_date(text).cast("string").alias("date"))


@query("parse_timestamps", """
select event_id, case when event_id % 9 <> 4 then strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') end as ts from events""")
def parse_timestamps(spark, sf):
    key = F.col("event_id") % 9
    text = (
        F.when(key == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(key == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(key == 2, F.date_format("ts", "MM/dd/yyyy HH:mm:ss"))
        .when(key == 3, F.date_format("ts", "yyyy/MM/dd HH:mm:ss"))
        .when(key == 4, F.concat(F.lit("about "), F.date_format("ts", "HH:mm")))
        .when(key == 5, F.date_format("ts", "M/d/yyyy h:mm:ss a"))
        .when(key == 6, F.date_format("ts", "MM/dd/yy HH:mm:ss"))
        .when(key == 7, F.date_format("ts", "d MMMM yyyy HH:mm:ss"))
        .otherwise(F.date_format("ts", "MMM d, yyyy hh:mm:ss a"))
    )
    return load(spark, sf, "events").select("event_id", S.parse_timestamp(text, "Asia/Kolkata").cast("string").alias("ts"))


@query("local_time", """
select event_id, strftime(ts + interval 5 hour + interval 30 minute, '%Y-%m-%d %H:%M:%S') as local_time from events""")
def local_time(spark, sf):
    zoned = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("Z"))
    return load(spark, sf, "events").select("event_id", S.parse_timestamp(zoned, "Asia/Kolkata").cast("string").alias("local_time"))


@query("calendar_parts", """
select event_id, hour(ts) as hour, minute(ts) as minute, second(ts) as second, isodow(ts) - 1 as weekday, month(ts) as month,
       year(ts) as year, strftime(ts, '%Y-%m-01') as month_start, year(ts)::varchar || 'Q' || quarter(ts)::varchar as quarter,
       strftime(ts, '%Y-%m-%d') as midnight, case when isodow(ts) >= 6 then 1 else 0 end as weekend from events""")
def calendar_parts(spark, sf):
    ts = F.col("ts")
    parts = load(spark, sf, "events").select(
        "event_id", F.hour(ts).alias("hour"), F.minute(ts).alias("minute"), F.second(ts).alias("second"),
        S.weekday(ts).alias("weekday"), F.month(ts).alias("month"), F.year(ts).alias("year"),
        F.trunc(ts, "MM").alias("month_start"), S.quarter_label(ts).alias("quarter"),
        F.to_date(ts).alias("midnight"), F.when(S.weekday(ts) >= 5, 1).otherwise(0).alias("weekend"),
    )
    return rounded(parts)


@query("cyclic_time", """
select event_id, round(sin(2 * pi() * h / 24), 6) + 0 as hour_sin, round(cos(2 * pi() * h / 24), 6) + 0 as hour_cos,
       round(sin(2 * pi() * d / 7), 6) + 0 as weekday_sin, round(cos(2 * pi() * d / 7), 6) + 0 as weekday_cos,
       round(sin(2 * pi() * m / 12), 6) + 0 as month_sin, round(cos(2 * pi() * m / 12), 6) + 0 as month_cos
from (select event_id, hour(ts) + minute(ts) / 60.0::double as h, isodow(ts) - 1 as d, month(ts) as m from events)""")
def cyclic_time(spark, sf):
    ts = F.col("ts")
    hour = F.hour(ts) + F.minute(ts) / F.lit(60.0)
    return rounded(load(spark, sf, "events").select(
        "event_id", *S.cyclic(hour, 24, "hour"), *S.cyclic(S.weekday(ts), 7, "weekday"), *S.cyclic(F.month(ts), 12, "month")
    ))


@query("derived_ratios", "with " + V.SQL_OBS + """
select commodity, state, count(*) as n, round(avg((maximum - minimum) / price), 6) as spread,
       round(avg(price * minimum / 100), 4) as product from obs group by all""")
def derived_ratios(spark, sf):
    spread = S.ratio(F.col("maximum") - F.col("minimum"), F.col("price"))
    return V.obs_price(spark, sf).groupBy("commodity", "state").agg(
        F.count("*").alias("n"), F.round(F.avg(spread), 6).alias("spread"),
        F.round(F.avg(F.col("price") * F.col("minimum") / 100), 4).alias("product"),
    )


def _judged_text(spark, sf):
    bound = resolve(V.obs_price_text(spark, sf), PRICE_ALIASES, PRICE_OPTIONAL)
    return clean.judge(clean.standardize(bound.drop("minimum"), TEXT_CFG), TEXT_CFG)


@query("filter_category_window", "with " + V.SQL_TEXT + """,
d as (select lower(trim(commodity_name)) as c,
             case when l_orderkey % 2 = 0 then strptime(arrival_date, '%d/%m/%Y') else strptime(arrival_date, '%Y-%m-%d') end::date as day from txt)
select upper(c[1]) || c[2:] as commodity, strftime(day, '%Y-%m-%d') as date, count(*) as n from d
where c in ('economy', 'promo', 'small') and day between date '1997-01-01' and date '1999-12-31' group by all""")
def filter_category_window(spark, sf):
    inside = ~F.col("state_of_row").isin("other commodity", "unreadable date", "outside window")
    return _judged_text(spark, sf).where(inside).groupBy("commodity", F.col("date").cast("string").alias("date")).agg(F.count("*").alias("n"))


@query("invalid_rows", "with " + V.SQL_TEXT + """
select upper(trim(commodity_name)[1]) || lower(trim(commodity_name)[2:]) as commodity,
       case when modal_price = 'n/a' or trim(state) = '' then 'invalid' else 'kept' end as state_of_row, count(*) as n from txt group by all""")
def invalid_rows(spark, sf):
    bound = resolve(V.obs_price_text(spark, sf), PRICE_ALIASES, PRICE_OPTIONAL)
    return clean.judge(clean.standardize(bound, ALL_CFG), ALL_CFG).groupBy("commodity", "state_of_row").agg(F.count("*").alias("n"))


@query("price_consistency", "with " + V.SQL_UNKNOWN + """
select lower(state) as state, lower(market) as market,
       count(*) filter (maximum < minimum or price < minimum or price > maximum or minimum <= 0) as inconsistent,
       count(*) filter (minimum is null) as unknown_range, count(*) as n,
       round(avg(case when minimum > 0 and maximum >= minimum and price >= minimum and price <= maximum then (maximum - minimum) / price end), 6) as mean_spread
from unknown group by all""")
def price_consistency(spark, sf):
    judged = clean.judge(clean.standardize(V.obs_price_unknown(spark, sf), V.PRICES), V.PRICES)
    return judged.groupBy("state", "market").agg(
        F.count(F.when(F.col("state_of_row") == "inconsistent", 1)).alias("inconsistent"),
        F.count(F.when(F.col("minimum").isNull(), 1)).alias("unknown_range"),
        F.count("*").alias("n"),
        F.round(F.avg(F.when(F.col("state_of_row") == "kept", F.col("relative_spread"))), 6).alias("mean_spread"),
    )


@query("dedupe_records", "with " + V.SQL_DUP + V.sql_records("dup") + f"""
select {DAY}, round(price, 6) as price, round(relative_spread, 6) as relative_spread from rec""")
def dedupe_records(spark, sf):
    return rounded(clean.distinct_records(clean.store_judged(_judged_dup(spark, sf))))


@query("panel_audit", "with " + V.SQL_DUP + V.sql_panel("dup") + """
select (select count(*) from dup where not (minimum <= 0 or maximum < minimum or price < minimum or price > maximum)) - (select count(*) from rec) as duplicate_rows_removed,
       (select count(*) from rec) as retained_unique_raw_rows, count(*) as unique_daily_profiles,
       count(*) filter (distinct_reported_prices > 1) as days_with_conflicting_reported_prices from panel""")
def panel_audit(spark, sf):
    records = clean.sound_records(clean.store_judged(_judged_dup(spark, sf)))
    return panel.panel_audit(records, panel.daily_medians(records))


@query("daily_median_panel", "with " + V.SQL_OBS + V.sql_panel("obs") + f"""
select {DAY}, round(price, 6) as price, round(relative_spread, 6) as relative_spread, daily_reports, distinct_reported_prices,
       annual_dominant_varieties, dominant_variety_switch from panel""")
def daily_median_panel(spark, sf):
    return rounded(panel.daily_panel(V.stored_records(V.obs_price(spark, sf))))


@query("dominant_category", "with " + V.SQL_SKEW + V.sql_panel("skew") + """
select commodity, state, district, market, annual_dominant_varieties, annual_dominant_varieties > 1 as dominant_variety_switch from dominance""")
def dominant_category(spark, sf):
    return panel.dominant_varieties(panel.daily_medians(V.stored_records(V.obs_price_skew(spark, sf))))


@query("consecutive_returns", "with " + V.PLACE_PANEL_SQL + """
select commodity, state, market, cast(date as varchar) as date, gap as day_gap, round(case when gap = 1 then price / before - 1 end, 6) as daily_return
from (select *, date - lag(date) over w as gap, lag(price) over w as before from panel window w as (partition by commodity, state, market order by date))""")
def consecutive_returns(spark, sf):
    out = profiles.consecutive_returns(V.place_panel(spark, sf))
    return rounded(out.select("commodity", "state", "market", "date", F.col("day_gap").cast("bigint").alias("day_gap"), "daily_return"))


@query("stale_runs", "with " + V.PLACE_PANEL_SQL + """,
banded as (select commodity, state, market, date, floor(price / 1000) * 1000 + 1000 as price from panel),
islands as (select *, date - (row_number() over (partition by commodity, state, market, price order by date))::int as island from banded),
spots as (select *, row_number() over (partition by commodity, state, market, price, island order by date) as run_position from islands)
select commodity, state, market, cast(date as varchar) as date, price, run_position, run_position >= 3 as is_stale from spots""")
def stale_runs(spark, sf):
    banded = V.place_panel(spark, sf).withColumn("price", F.floor(F.col("price") / 1000) * 1000.0 + 1000.0)
    out = profiles.stale_runs(banded)
    return rounded(out.select("commodity", "state", "market", "date", "price", "run_position", "is_stale"))


@query("stale_share", "with " + V.PLACE_PANEL_SQL + """,
banded as (select commodity, state, market, date, floor(price / 1000) * 1000 + 1000 as price from panel),
islands as (select *, date - (row_number() over (partition by commodity, state, market, price order by date))::int as island from banded),
spots as (select *, row_number() over (partition by commodity, state, market, price, island order by date) as run_position from islands)
select commodity, state, market, round(avg(case when run_position >= 3 then 1.0::double else 0.0::double end), 6) as stale_price_fraction from spots group by all""")
def stale_share(spark, sf):
    banded = V.place_panel(spark, sf).withColumn("price", F.floor(F.col("price") / 1000) * 1000.0 + 1000.0)
    out = profiles.profile_features(banded, V.PROFILES)
    return rounded(out.select("commodity", "state", "market", "stale_price_fraction"))


SQL_PROFILE = V.PLACE_PANEL_SQL + """,
steps as (select *, date - lag(date) over w as gap, lag(price) over w as before from panel window w as (partition by commodity, state, market order by date)),
rets as (select *, case when gap = 1 then price / before - 1 end as ret from steps),
months as (select commodity, state, market, stddev_pop(m) / avg(m) as monthly_variation_cv, count(*) as months_observed
           from (select commodity, state, market, date_trunc('month', date) as mo, avg(price) as m from panel group by all) group by all),
years as (select commodity, state, market, min(n) as min_year_observations
          from (select s.commodity, s.state, s.market, y, count(p.date) as n
                from (select distinct commodity, state, market from panel) s cross join range(1995, 2002) r(y)
                left join panel p on p.commodity = s.commodity and p.state = s.state and p.market = s.market and year(p.date) = y group by all) group by all),
feats as (
  select commodity, state, district, market, variety, grade, count(*) as observations,
         count(*) / (date '2001-12-31' - date '1995-01-01' + 1)::double as calendar_coverage,
         any_value(months_observed) as months_observed, any_value(min_year_observations) as min_year_observations,
         count(ret) as valid_daily_returns, count(*) filter (abs(ret) > 1) / greatest(count(ret), 1)::double as large_daily_change_fraction,
         bool_or(dominant_variety_switch) as dominant_variety_switch, avg(price) as mean_price, ln(1 + avg(price)) as log_mean_price,
         stddev_samp(price) / avg(price) as price_cv, stddev_samp(ret) as return_volatility,
         avg(case when ret is null then null when ret <= -0.1::double then 1.0::double else 0.0::double end) as sharp_drop_fraction,
         any_value(monthly_variation_cv) as monthly_variation_cv, median(relative_spread) as median_relative_spread
  from rets join months using (commodity, state, market) join years using (commodity, state, market)
  group by commodity, state, district, market, variety, grade),
reasoned as (
  select *, coalesce(nullif(concat_ws('; ', case when observations < 650 then 'few observations' end,
       case when calendar_coverage < 0.25 then 'low calendar coverage' end, case when months_observed < 82 then 'few represented months' end,
       case when min_year_observations < 75 then 'uneven year coverage' end,
       case when valid_daily_returns < 170 then 'few consecutive-day changes' end), ''), 'eligible') as eligibility_reason from feats)
"""


def place_profiles(spark, sf, panel_frame=None):
    frame = profiles.profile_features(panel_frame or V.place_panel(spark, sf), V.PROFILES)
    return profiles.with_eligibility(frame, V.PROFILES)


@query("profile_coverage", "with " + SQL_PROFILE + """
select commodity, state, market, observations, round(calendar_coverage, 6) as calendar_coverage, months_observed, min_year_observations from feats""")
def profile_coverage(spark, sf):
    return rounded(place_profiles(spark, sf).select(
        "commodity", "state", "market", "observations", "calendar_coverage", "months_observed", "min_year_observations"))


@query("profile_features", "with " + SQL_PROFILE + """
select commodity, state, district, market, variety, grade, valid_daily_returns, round(large_daily_change_fraction, 6) as large_daily_change_fraction,
       dominant_variety_switch, round(mean_price, 4) as mean_price, round(log_mean_price, 6) as log_mean_price, round(price_cv, 6) as price_cv,
       round(return_volatility, 6) as return_volatility, round(sharp_drop_fraction, 6) as sharp_drop_fraction,
       round(monthly_variation_cv, 6) as monthly_variation_cv, round(median_relative_spread, 6) as median_relative_spread from feats""")
def profile_features(spark, sf):
    left_out = ["observations", "calendar_coverage", "months_observed", "min_year_observations", "stale_price_fraction", "eligibility_reason"]
    return rounded(place_profiles(spark, sf).drop(*left_out), mean_price=4)


@query("monthly_variation", "with " + SQL_PROFILE + """
select commodity, state, market, months_observed, round(monthly_variation_cv, 6) as monthly_variation_cv from months""")
def monthly_variation(spark, sf):
    return rounded(place_profiles(spark, sf).select("commodity", "state", "market", "months_observed", "monthly_variation_cv"))


@query("profile_eligibility", "with " + SQL_PROFILE + """
select commodity, state, market, eligibility_reason, eligibility_reason = 'eligible' as included from reasoned""")
def profile_eligibility(spark, sf):
    eligible, excluded = profiles.make_profiles(V.place_panel(spark, sf), V.PROFILES)
    both = eligible.withColumn("included", F.lit(True)).unionByName(excluded.withColumn("included", F.lit(False)))
    return both.select("commodity", "state", "market", "eligibility_reason", "included")


@query("whatif_daily_drops", "with " + SQL_PROFILE + """
select commodity, label as drop_definition, round(avg(case when ret is null then null when ret <= -d then 1.0::double else 0.0::double end), 6) as event_fraction,
       count(ret) as valid_daily_changes, false as groups_refitted
from rets semi join (select * from reasoned where eligibility_reason = 'eligible') using (commodity, state, market)
cross join (values (0.05::double, '5% consecutive-day decline'), (0.1::double, '10% consecutive-day decline'), (0.15::double, '15% consecutive-day decline')) v(d, label)
group by commodity, label""")
def whatif_daily_drops(spark, sf):
    frame = V.place_panel(spark, sf)
    eligible = place_profiles(spark, sf, frame).where(F.col("eligibility_reason") == "eligible")
    return rounded(profiles.whatif_daily_drops(frame, eligible))


@query("whatif_coverage", "with " + SQL_PROFILE + """
select commodity, c as minimum_calendar_coverage, count(*) filter (calendar_coverage >= c) as currently_eligible_profiles_retained, false as groups_refitted
from reasoned cross join (values (0.25::double), (0.35::double), (0.5::double)) v(c) where eligibility_reason = 'eligible' group by commodity, c""")
def whatif_coverage(spark, sf):
    return profiles.whatif_coverage(place_profiles(spark, sf).where(F.col("eligibility_reason") == "eligible"))


@query("topk_extreme_profiles", "with " + SQL_PROFILE + """
select commodity, state, market, round(return_volatility, 6) as return_volatility, position from (
  select *, row_number() over (partition by commodity order by return_volatility desc, state, district, market) as position from feats where return_volatility is not null)
where position <= 10""")
def topk_extreme_profiles(spark, sf):
    out = profiles.extreme_profiles(place_profiles(spark, sf), 10)
    return rounded(out.select("commodity", "state", "market", "return_volatility", "position"))
