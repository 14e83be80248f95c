"""Record shapes derived from the given tables, once for Spark and once as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from serieskit.catalog.registry import load
from serieskit.config import DemandConfig, PriceConfig
from serieskit.operators.clean import judge, sound_records, standardize, store_judged
from serieskit.operators.panel import daily_panel

KINDS = ("Economy", "Large", "Medium", "Promo", "Small", "Standard")
PRICES = PriceConfig(commodities=KINDS, start_date="1995-01-01", end_date="2001-12-31")
PROFILES = PriceConfig(
    commodities=KINDS, start_date="1995-01-01", end_date="2001-12-31", min_observations=650,
    min_calendar_coverage=0.25, min_months=82, min_year_observations=75, min_daily_returns=170,
)


def joined_lines(spark: SparkSession, sf: str) -> DataFrame:
    part = load(spark, sf, "part")
    supplier = load(spark, sf, "supplier")
    nation = load(spark, sf, "nation")
    region = load(spark, sf, "region")
    return (
        load(spark, sf, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


def obs_price(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return joined_lines(spark, sf).select(
        F.col("p_type").alias("commodity"),
        F.col("r_name").alias("state"),
        F.col("n_name").alias("district"),
        F.col("l_linestatus").alias("market"),
        F.col("l_returnflag").alias("variety"),
        F.lit("faq").alias("grade"),
        F.col("l_shipdate").cast("date").alias("date"),
        price.alias("price"),
        F.col("p_retailprice").alias("minimum"),
        (price * (1 + F.col("l_tax"))).alias("maximum"),
        (F.col("l_orderkey") % 3).alias("source_id"),
        "l_linenumber",
    )


def obs_price_dup(spark, sf) -> DataFrame:
    obs = obs_price(spark, sf)
    return obs.unionByName(obs.where(F.col("l_linenumber") == 1))


def obs_price_skew(spark, sf) -> DataFrame:
    common = F.when(F.col("l_linenumber") <= 3, F.lit("common")).otherwise(F.col("variety"))
    return obs_price(spark, sf).withColumn("variety", common)


def obs_price_unknown(spark, sf) -> DataFrame:
    return obs_price(spark, sf).withColumn("minimum", F.when(F.col("l_linenumber") != 2, F.col("minimum")))


def obs_place(spark, sf) -> DataFrame:
    """Sixty long series: one per kind, region and line status."""
    return obs_price(spark, sf).withColumn("district", F.col("state")).withColumn("variety", F.lit("common"))


def obs_price_text(spark, sf) -> DataFrame:
    """The same records as files deliver them: padded, mixed case, numbers and dates as text."""
    key = F.col("l_orderkey")
    kind = F.when(key % 2 == 0, F.concat(F.lit("  "), F.lower("p_type"), F.lit(" "))).otherwise(F.col("p_type"))
    day = F.when(key % 2 == 0, F.date_format("l_shipdate", "dd/MM/yyyy")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    return joined_lines(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        kind.alias("Commodity Name"),
        F.when(key % 70 == 0, F.lit("")).otherwise(F.concat(F.col("r_name"), F.lit(" "))).alias("STATE"),
        F.col("n_name").alias("District Name"),
        F.col("l_linestatus").alias("Market"),
        F.when(F.col("l_returnflag") == "R", F.lit("")).otherwise(F.col("l_returnflag")).alias("Variety"),
        day.alias("Arrival_Date"),
        F.when(key % 50 == 0, F.lit("n/a")).otherwise(F.format_number("l_extendedprice", 2)).alias("Modal_Price"),
        F.col("p_retailprice").cast("string").alias("Min Price"),
    )


def records(obs: DataFrame, cfg: PriceConfig = PRICES) -> DataFrame:
    return sound_records(judge(standardize(obs, cfg), cfg))


def stored_records(obs: DataFrame, cfg: PriceConfig = PRICES) -> DataFrame:
    return sound_records(store_judged(judge(standardize(obs, cfg), cfg)))


def place_panel(spark, sf) -> DataFrame:
    return daily_panel(stored_records(obs_place(spark, sf)))


# The same shapes as SQL text: comma-separated common table expressions.
SQL_OBS = """
obs as (
  select p_type as commodity, r_name as state, n_name as district, l_linestatus as market,
         l_returnflag as variety, 'faq' as grade, cast(l_shipdate as date) as date,
         l_extendedprice / l_quantity as price, p_retailprice as minimum,
         (l_extendedprice / l_quantity) * (1 + l_tax) as maximum,
         l_orderkey % 3 as source_id, l_linenumber
  from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
  join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
"""
SQL_PLACE = SQL_OBS + """,
place as (select * replace (state as district, 'common' as variety) from obs)
"""
SQL_DUP = SQL_OBS + ", dup as (select * from obs union all select * from obs where l_linenumber = 1)\n"
SQL_SKEW = SQL_OBS + """,
skew as (select * replace (case when l_linenumber <= 3 then 'common' else variety end as variety) from obs)
"""
SQL_UNKNOWN = SQL_OBS + """,
unknown as (select * replace (case when l_linenumber <> 2 then minimum end as minimum) from obs)
"""
SQL_TEXT = """
txt as (
  select l_orderkey, l_linenumber,
         case when l_orderkey % 2 = 0 then '  ' || lower(p_type) || ' ' else p_type end as commodity_name,
         case when l_orderkey % 70 = 0 then '' else r_name || ' ' end as state,
         n_name as district_name, l_linestatus as market,
         case when l_returnflag = 'R' then '' else l_returnflag end as variety,
         case when l_orderkey % 2 = 0 then strftime(l_shipdate, '%d/%m/%Y') else strftime(l_shipdate, '%Y-%m-%d') end as arrival_date,
         case when l_orderkey % 50 = 0 then 'n/a' else format('{:,.2f}', l_extendedprice) end as modal_price,
         p_retailprice as min_price
  from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
  join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
"""


def sql_records(source: str) -> str:
    """Distinct sound records of a view, as one more common table expression ``rec``."""
    return f""",
rec as (
  select distinct upper(commodity[1]) || lower(commodity[2:]) as commodity, lower(state) as state, lower(district) as district,
         lower(market) as market, lower(variety) as variety, grade, date, price,
         case when minimum is not null and maximum is not null then (maximum - minimum) / price end as relative_spread
  from {source}
  where date between date '1995-01-01' and date '2001-12-31' and price > 0
    and (minimum is null or maximum is null
         or not (minimum <= 0 or maximum < minimum or price < minimum or price > maximum)))
"""


def sql_panel(source: str) -> str:
    return sql_records(source) + """,
dominance as (
  select commodity, state, district, market, count(distinct variety) as annual_dominant_varieties
  from (select *, row_number() over (partition by commodity, state, district, market, y order by n desc, variety) as place
        from (select commodity, state, district, market, year(date) as y, variety, count(*) as n from rec group by all))
  where place = 1 group by all),
panel as (
  select commodity, state, district, market, variety, grade, date, median(price) as price,
         median(relative_spread) as relative_spread, count(*) as daily_reports,
         count(distinct price) as distinct_reported_prices,
         any_value(annual_dominant_varieties) as annual_dominant_varieties,
         any_value(annual_dominant_varieties) > 1 as dominant_variety_switch
  from rec join dominance using (commodity, state, district, market)
  group by commodity, state, district, market, variety, grade, date)
"""


PLACE_PANEL_SQL = SQL_PLACE + sql_panel("place")
