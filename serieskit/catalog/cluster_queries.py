"""Feature preparation, sampling, clustering and its quality."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from serieskit.catalog import views as V
from serieskit.catalog.price_queries import SQL_PROFILE, place_profiles
from serieskit.catalog.registry import load, query, rounded
from serieskit.config import PriceConfig
from serieskit.operators import cluster as K, cluster_metrics as Q, prep, profiles as P, sampling
from serieskit.plans import price as R
from serieskit.session import materialize

GROUP, DIMS = ["group"], 64
WIDE = PriceConfig(
    commodities=V.KINDS, start_date="1995-01-01", end_date="2001-12-31", min_observations=100, min_calendar_coverage=0.03,
    min_months=40, min_year_observations=5, min_daily_returns=3,
)


def given(spark, sf):
    """Embeddings with their label as a given clustering."""
    return load(spark, sf, "embeddings").select(
        F.lit("all").alias("group"), "vec_id", F.col("label").cast("int").alias("cluster"), F.col("embedding").cast("array<double>").alias("x")
    )


SQL_EMB = """
emb as (select vec_id, label, embedding::double[] as x from embeddings),
dims as (select vec_id, label, unnest(x) as v, unnest(range(64)) as d from emb),
cen as (select label, d, avg(v) as c, count(*) as n from dims group by all),
own as (select vec_id, label, sum((v - c) ** 2) as d2 from dims join cen using (label, d) group by all)"""
SQL_SIL = """,
pd as (select a.vec_id, a.label, b.label as other, sum(list_distance(a.x, b.x)) as s, count(*) as n
       from emb a join emb b on a.vec_id <> b.vec_id group by all),
sil as (select vec_id, label, (b - a) / greatest(a, b) as silhouette from (
          select vec_id, label, max(case when other = label then s / n end) as a, min(case when other <> label then s / n end) as b from pd group by all))"""


@query("cluster_sizes", "with sizes as (select label, count(*) as n from embeddings group by 1) select i as cluster, coalesce(n, 0) as size from range(0, 12) r(i) left join sizes on label = i")
def cluster_sizes(spark, sf):
    return rounded(Q.cluster_sizes(given(spark, sf), GROUP, 12).drop("group"))


@query("cluster_centers", "with " + SQL_EMB + "select label as cluster, d as feature, round(c, 6) as value from cen")
def cluster_centers(spark, sf):
    return rounded(Q.center_table(given(spark, sf), GROUP, DIMS).drop("group"))


@query("inertia", "with " + SQL_EMB + "select round(sum(d2), 4) as inertia from own")
def inertia(spark, sf):
    return rounded(Q.inertia(given(spark, sf), GROUP, DIMS).drop("group"), 4)


@query("calinski_harabasz", "with " + SQL_EMB + """
select round((select sum(n * (c - m) ** 2) from cen join (select d, avg(v) as m from dims group by 1) using (d)) / (k - 1) / ((select sum(d2) from own) / (n - k)), 6) as calinski_harabasz
from (select count(*) as n, count(distinct label) as k from emb)""")
def calinski_harabasz(spark, sf):
    return rounded(Q.calinski_harabasz(given(spark, sf), GROUP, DIMS).drop("group"))


@query("davies_bouldin", "with " + SQL_EMB + """,
s as (select label, avg(sqrt(d2)) as s from own group by 1),
far as (select a.label as i, b.label as j, sqrt(sum((a.c - b.c) ** 2)) as dist from cen a join cen b on a.d = b.d and a.label <> b.label group by all)
select round(avg(worst), 6) as davies_bouldin from (select i, max((si.s + sj.s) / dist) as worst from far join s si on si.label = i join s sj on sj.label = j group by 1)""")
def davies_bouldin(spark, sf):
    return rounded(Q.davies_bouldin(given(spark, sf), GROUP, DIMS).drop("group"))


@query("silhouette_samples", "with " + SQL_EMB + SQL_SIL + "select vec_id, label::bigint as cluster, round(silhouette, 6) as silhouette, silhouette <= 0 as weak_separation from sil")
def silhouette_samples(spark, sf):
    return rounded(Q.silhouette_samples(given(spark, sf), GROUP, ["vec_id"]).drop("group"))


@query("silhouette_mean", "with " + SQL_EMB + SQL_SIL + "select round(avg(silhouette), 6) as silhouette from sil")
def silhouette_mean(spark, sf):
    return rounded(Q.silhouette_mean(given(spark, sf), GROUP, "vec_id").drop("group"))


@query("silhouette_histogram", "with " + SQL_EMB + SQL_SIL + """
select least(floor((silhouette - lo) * 20 / (hi - lo)), 19)::bigint as bin, count(*) as profiles
from sil, (select min(silhouette) as lo, max(silhouette) as hi from sil) group by 1""")
def silhouette_histogram(spark, sf):
    return Q.silhouette_histogram(Q.silhouette_samples(given(spark, sf), GROUP, ["vec_id"]))


@query("whatif_separation", "with " + SQL_EMB + SQL_SIL + """
select c as silhouette_cutoff, count(*) filter (silhouette <= c) as profiles_below_cutoff, count(silhouette) as profiles_evaluated
from sil, (values (-0.1::double), (0.0::double), (0.1::double)) v(c) group by 1""")
def whatif_separation(spark, sf):
    return Q.whatif_separation(Q.silhouette_samples(given(spark, sf), GROUP, ["vec_id"]))


@query("topk_least_separated", "with " + SQL_EMB + SQL_SIL + """
select vec_id, label::bigint as cluster, round(silhouette, 6) as silhouette, row_number() over (order by silhouette, vec_id) as position
from sil qualify position <= 10""")
def topk_least_separated(spark, sf):
    scored = Q.silhouette_samples(given(spark, sf), GROUP, ["vec_id"])
    return rounded(Q.least_separated(scored, GROUP, ["vec_id"]).select("vec_id", "cluster", "silhouette", "position"))


@query("adjusted_rand", """
with c as (select label as a, vec_id % 3 as b, count(*) as n from embeddings group by all),
s as (select (select sum(n * (n - 1) / 2.0::double) from c) as ab, (select sum(n * (n - 1) / 2.0::double) from (select sum(n) as n from c group by a)) as sa,
             (select sum(n * (n - 1) / 2.0::double) from (select sum(n) as n from c group by b)) as sb, (select sum(n) * (sum(n) - 1) / 2.0::double from c) as t)
select round((ab - sa * sb / t) / ((sa + sb) / 2 - sa * sb / t), 8) as "ARI" from s""")
def adjusted_rand(spark, sf):
    return rounded(Q.adjusted_rand(given(spark, sf).withColumn("other", F.col("vec_id") % 3), "cluster", "other"), 8)


SQL_ASSIGN = SQL_EMB + """,
dist as (select vec_id, cen.label as cluster, sum((v - c) ** 2) as d2 from dims join cen using (d) group by all),
near as (select vec_id, arg_min(cluster, (d2, cluster)) as cluster, min(d2) as d2 from dist group by 1)"""


@query("assign_to_centers", "with " + SQL_ASSIGN + "select vec_id, cluster::bigint as cluster, round(sqrt(d2), 6) as distance from near")
def assign_to_centers(spark, sf):
    rows = given(spark, sf)
    centers = Q.centroids(rows, GROUP, DIMS).drop("size")
    return rounded(K.assign(rows.drop("cluster"), centers, GROUP).select("vec_id", "cluster", "distance"))


@query("representatives", "with " + SQL_ASSIGN + """
select vec_id, cluster::bigint as cluster, round(sqrt(d2), 6) as distance, position from (
  select *, row_number() over (partition by cluster order by d2, vec_id) as position from near) where position <= 3""")
def representatives(spark, sf):
    rows = given(spark, sf)
    assigned = K.assign(rows.drop("cluster"), Q.centroids(rows, GROUP, DIMS).drop("size"), GROUP)
    return rounded(Q.nearest_members(assigned, GROUP, ["vec_id"]).select("vec_id", "cluster", "distance", "position"))


@query("kmeans_lloyd_fixed", "with " + SQL_ASSIGN + """,
cen1 as (select cluster as label, d, avg(v) as c from dims join near using (vec_id) group by all),
dist1 as (select vec_id, cen1.label as cluster, sum((v - c) ** 2) as d2 from dims join cen1 using (d) group by all),
near1 as (select vec_id, arg_min(cluster, (d2, cluster)) as cluster from dist1 group by 1),
cen2 as (select cluster as label, d, avg(v) as c from dims join near1 using (vec_id) group by all)
select label::bigint as cluster, d as feature, round(c, 6) as value from cen2""")
def kmeans_lloyd_fixed(spark, sf):
    rows = given(spark, sf)
    start = {r["cluster"]: r["center"] for r in Q.centroids(rows, GROUP, DIMS).collect()}
    names = sorted(start)
    run = K.Run("all", len(names), centers=np.array([start[n] for n in names]))
    K.lloyd(materialize(K.points_frame(rows, F.col("group"), F.col("vec_id"))), [run], max_iterations=2, tolerance=-1.0)
    out = K.centers_frame(spark, [("all", int(n), [float(v) for v in c]) for n, c in zip(names, run.centers)], "group string")
    return rounded(out.select("cluster", F.posexplode("center").alias("feature", "value")))


@query("rank_groups", "with m as (select label as cluster, median(embedding[1]::double) as median from embeddings group by 1)" + """
select cluster::bigint as cluster, round(median, 6) as median, row_number() over (order by median, cluster) as group_rank,
       'Volatility group ' || row_number() over (order by median, cluster) || '/' || count(*) over () || ' (low to high)' as group_description from m""")
def rank_groups(spark, sf):
    rows = given(spark, sf).withColumn("first", F.col("x")[0])
    return rounded(Q.rank_groups(rows, GROUP, "first").drop("group"))


@query("group_summary", "with " + SQL_PROFILE + """
select market as cluster, count(*) as profile_count, round(avg(mean_price), 4) as mean_price, round(avg(return_volatility), 6) as mean_daily_return_volatility,
       round(avg(calendar_coverage), 6) as mean_calendar_coverage, round(avg(case when price_cv > 0.4 then 1.0::double else 0.0::double end), 6) as clipped_profile_fraction,
       round(avg(price_cv - 0.4), 6) as mean_profile_silhouette, round(avg(case when price_cv - 0.4 <= 0 then 1.0::double else 0.0::double end), 6) as weak_separation_fraction,
       round(median(price_cv), 6) as median_price_cv, round(median(return_volatility), 6) as median_daily_return_volatility,
       round(median(sharp_drop_fraction), 6) as median_sharp_drop_fraction, round(median(monthly_variation_cv), 6) as median_monthly_variation from feats group by 1""")
def group_summary(spark, sf):
    score = F.col("price_cv") - 0.4
    rows = materialize(place_profiles(spark, sf)).withColumns({
        "group": F.lit("all"), "cluster": F.col("market"), "profile_was_clipped": F.col("price_cv") > 0.4, "silhouette": score, "weak_separation": score <= 0})
    return rounded(Q.group_summary(rows, GROUP).drop("group"), mean_price=4)


@query("monthly_index", "with " + V.PLACE_PANEL_SQL + """,
m as (select commodity, state, market, date_trunc('month', date) as month, avg(price) as monthly_mean from panel group by all),
e as (select commodity, state, market, unnest(generate_series(min(month)::timestamp, max(month)::timestamp, interval 1 month))::date as month from m group by commodity, state, market)
select commodity, state, market, cast(month as varchar) as month, round(monthly_mean, 4) as monthly_mean,
       round(monthly_mean / avg(monthly_mean) over (partition by commodity, state, market), 6) as monthly_index
from e left join m using (commodity, state, market, month)""")
def monthly_index(spark, sf):
    out = P.monthly_index(V.place_panel(spark, sf))
    return rounded(out.select("commodity", "state", "market", "month", "monthly_mean", "monthly_index"), monthly_mean=4)


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "tax"]
SQL_LINES = """
lines as (select l_orderkey, l_linenumber, l_returnflag, l_quantity, l_extendedprice, l_discount,
                 case when l_linenumber <> 2 then l_tax end as tax from lineitem)"""


def lines(spark, sf):
    return load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice", "l_discount",
        F.when(F.col("l_linenumber") != 2, F.col("l_tax")).alias("tax"),
    )


SQL_BOUNDS = SQL_LINES + """,
bounds as (select l_returnflag, quantile_cont(l_quantity, 0.01) as q0, quantile_cont(l_quantity, 0.99) as q1,
                  quantile_cont(l_extendedprice, 0.01) as e0, quantile_cont(l_extendedprice, 0.99) as e1,
                  quantile_cont(l_discount, 0.01) as d0, quantile_cont(l_discount, 0.99) as d1,
                  quantile_cont(tax, 0.01) as t0, quantile_cont(tax, 0.99) as t1 from lines group by 1)"""


@query("missing_share", "with " + SQL_LINES + "select l_returnflag, round(avg(case when tax is null then 1.0::double else 0.0::double end), 6) as missing_fraction from lines group by 1")
def missing_share(spark, sf):
    return rounded(prep.missing_share(lines(spark, sf), "tax", ["l_returnflag"]))


@query("clip_bounds", "with " + SQL_BOUNDS + """
select l_returnflag, 'l_quantity' as feature, round(q0, 6) as lower, round(q1, 6) as upper from bounds
union all select l_returnflag, 'l_extendedprice', round(e0, 6), round(e1, 6) from bounds
union all select l_returnflag, 'l_discount', round(d0, 6), round(d1, 6) from bounds
union all select l_returnflag, 'tax', round(t0, 6), round(t1, 6) from bounds""")
def clip_bounds(spark, sf):
    return rounded(prep.clip_bounds(lines(spark, sf), MEASURES, 0.01, ["l_returnflag"]))


@query("clip_features", "with " + SQL_BOUNDS + """
select l_orderkey, l_linenumber, l_returnflag, least(greatest(l_quantity, q0), q1) as l_quantity, round(least(greatest(l_extendedprice, e0), e1), 6) as l_extendedprice,
       least(greatest(l_discount, d0), d1) as l_discount, case when tax is not null then least(greatest(tax, t0), t1) end as tax,
       l_quantity < q0 or l_quantity > q1 or l_extendedprice < e0 or l_extendedprice > e1 or l_discount < d0 or l_discount > d1
         or coalesce(tax < t0 or tax > t1, false) as profile_was_clipped
from lines join bounds using (l_returnflag)""")
def clip_features(spark, sf):
    rows = lines(spark, sf)
    bounds = prep.settled(prep.clip_bounds(rows, MEASURES, 0.01, ["l_returnflag"]))
    return rounded(prep.clip(rows, bounds, MEASURES, ["l_returnflag"]))


@query("impute_median", "with " + SQL_LINES + """
select l_orderkey, l_linenumber, l_returnflag, l_quantity, l_extendedprice, l_discount, coalesce(tax, m) as tax
from lines join (select l_returnflag, median(tax) as m from lines group by 1) using (l_returnflag)""")
def impute_median(spark, sf):
    return rounded(prep.impute_median(lines(spark, sf), MEASURES, ["l_returnflag"]))


@query("standardize", "with " + SQL_LINES + """
select l_orderkey, l_linenumber, l_returnflag, round((l_quantity - avg(l_quantity) over w) / stddev_pop(l_quantity) over w, 6) + 0 as l_quantity,
       round((l_extendedprice - avg(l_extendedprice) over w) / stddev_pop(l_extendedprice) over w, 6) + 0 as l_extendedprice
from lines window w as (partition by l_returnflag)""")
def standardize(spark, sf):
    return rounded(prep.standardize(lines(spark, sf).drop("tax", "l_discount"), MEASURES[:2], ["l_returnflag"]))


@query("bin_features", """
with b as (select event_type, list_sort(list_distinct(list(q))) as borders from (
             select event_type, unnest(quantile_cont(value, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875])) as q from events group by 1) group by 1)
select event_id, event_type, case when event_id % 10 = 0 then 8 else len(list_filter(borders, lambda q: value >= q)) end as bin from events join b using (event_type)""")
def bin_features(spark, sf):
    events = load(spark, sf, "events")
    borders = prep.bin_borders(events, ["value"], 8, ["event_type"]).select("event_type", "borders")
    value = F.when(F.col("event_id") % 10 != 0, F.col("value"))
    # One row per group, so the borders may be sent to all tasks.
    return events.join(F.broadcast(borders), "event_type").select("event_id", "event_type", prep.bin_among(value, F.col("borders")).cast("bigint").alias("bin"))


@query("hash_sample", """
select vec_id, label::bigint as label from (select *, row_number() over (partition by label order by cast('0x' || substr(md5('42:' || vec_id::varchar), 1, 8) as bigint), vec_id) as r,
       count(*) over (partition by label) as n from embeddings) where r <= floor(n * 0.8::double)""")
def hash_sample(spark, sf):
    rows = load(spark, sf, "embeddings").select("vec_id", F.col("label").cast("bigint").alias("label"))
    return sampling.hash_sample(rows, ["label"], "vec_id", lambda n: F.floor(n * F.lit(0.8)))


@query("stratified_sample", """
with d as (select vec_id, label, cast('0x' || substr(md5('42:' || vec_id::varchar), 1, 8) as bigint) as h from embeddings),
p as (select *, row_number() over (partition by label order by h, vec_id) as r from d)
select vec_id, label::bigint as label from (select *, row_number() over (order by case when r <= 2 then 0 else 1 end, h, vec_id) as place from p) where place <= 100""")
def stratified_sample(spark, sf):
    rows = load(spark, sf, "embeddings").select(F.lit("all").alias("group"), "vec_id", F.col("label").cast("bigint").alias("label"))
    return sampling.stratified_sample(rows, GROUP, "label", "vec_id", 100).drop("group")


def wide_panel(spark, sf):
    obs = V.obs_price(spark, sf).withColumn("district", F.col("state"))
    return R.panel_from(obs, WIDE)["panel"]


def wide_matrix(spark, sf):
    eligible, _, _ = R.eligible_profiles(wide_panel(spark, sf), WIDE)
    return eligible, materialize(prep.feature_matrix(eligible, R.BY, WIDE.clip_quantile))


KS, STARTS = range(2, 7), 20


def _wrapped(text: str) -> str:
    """Unsigned arithmetic modulo 2 ** 64."""
    return f"cast(({text}) % 18446744073709551616::uhugeint as ubigint)"


def _times(a: str, b: str) -> str:
    return _wrapped(f"{a}::uhugeint * {b}::uhugeint")


def _kmeans_sql() -> str:
    """Hash of the ids, the race for the starting points (one step for each), and Lloyd rounds of all runs at once until each has settled."""
    # The multipliers of xxHash64 and of the splitmix64 finaliser.
    p1, p2, p3, p4, p5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
    golden, first, second = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
    # End of fixed values.
    hashed = [
        f"select vec_id, embedding::double[] as x, {_times('vec_id::ubigint', str(p2))} as h from embeddings",
        f"select * replace ({_times(_wrapped('h::uhugeint * 2147483648 + (h >> 33)'), str(p1))} as h) from {{0}}",
        f"select * replace (xor(h, {(42 + p5 + 8) % 2**64}::ubigint) as h) from {{0}}",
        f"select * replace ({_wrapped(_times(_wrapped('h::uhugeint * 134217728 + (h >> 37)'), str(p1)) + f'::uhugeint + {p4}')} as h) from {{0}}",
        f"select * replace ({_times('xor(h, h >> 33)', str(p2))} as h) from {{0}}",
        f"select * replace ({_times('xor(h, h >> 29)', str(p3))} as h) from {{0}}",
        "select * replace (xor(h, h >> 32) as h) from {0}",
    ]
    steps = [f"h{i} as ({text.format(f'h{i - 1}')})" for i, text in enumerate(hashed)]
    steps.append(f"points as materialized (select * from h{len(hashed) - 1})")
    for step in range(max(KS)):
        salt = f"((43 * 1000003 + s + 1) * 1000003 + {step} + 1)"
        z = _wrapped(f"h::uhugeint + {_times(salt, str(golden))}")
        source = "points, range(%d) as starts(s)" % STARTS
        if step:
            source = f"near{step - 1} join pick{step - 1} as p using (s)"
            near = "list_distance(near%d.x, p.x) ** 2" % (step - 1)
            near = near if step == 1 else f"least(d2, {near})"
            steps.append(f"near{step} as materialized (select s, near{step - 1}.vec_id, near{step - 1}.x, h, {near} as d2 from {source})")
        else:
            steps.append(f"near0 as materialized (select s, vec_id, x, h, 1.0::double as d2 from {source})")
        steps.append(f"draw{step} as (select s, vec_id, x, d2, {z} as z from near{step})")
        steps.append(f"mix{step} as (select * replace ({_times('xor(z, z >> 30)', str(first))} as z) from draw{step})")
        steps.append(f"mixed{step} as (select * replace ({_times('xor(z, z >> 27)', str(second))} as z) from mix{step})")
        key = "-ln((xor(z, z >> 31)::double + 0.5) / 18446744073709551616.0::double) / d2"
        steps.append(f"pick{step} as materialized (select s, {step} as j, arg_min(x, {key}) as x from mixed{step} where d2 > 1e-12 group by s)")
    picks = " union all ".join(f"select s, j, x from pick{step}" for step in range(max(KS)))
    steps.append(f"init as (select k, s, list(x order by j) as c from ({picks}), range({min(KS)}, {max(KS) + 1}) as ks(k) where j < k group by k, s)")
    steps.append("""rounds as (
  select k, s, 0 as iterations, c, false as converged from init
  union all
  select k, s, iterations + 1, moved, list_sum(list_transform(range(1, k + 1), lambda j: list_distance(moved[j], c[j]) ** 2)) <= 1e-4
  from (
    select k, s, iterations, c, list_transform(range(1, k + 1), lambda j: coalesce(list_extract(list_filter(met, lambda m: m.j = j), 1).center, c[j])) as moved
    from (
      select k, s, any_value(iterations) as iterations, any_value(c) as c, list({'j': j, 'center': center}) as met
      from (
        select k, s, any_value(iterations) as iterations, any_value(c) as c, j, list(m order by d) as center
        from (
          select k, s, any_value(iterations) as iterations, any_value(c) as c, j, d, avg(v) as m
          from (
            select k, s, iterations, c, list_position(dist, list_min(dist)) as j, unnest(x) as v, generate_subscripts(x, 1) as d
            from (select k, s, iterations, c, x, list_transform(c, lambda y: list_distance(y, x)) as dist from rounds, points where not converged and iterations < 300)
          ) group by k, s, j, d
        ) group by k, s, j
      ) group by k, s
    )
  )
)""")
    steps.append("settled as (select k, s, max(iterations) as iterations, arg_max(c, iterations) as c, arg_max(converged, iterations) as converged from rounds group by k, s)")
    steps.append("""ends as (
  select k, s, list_position(dist, list_min(dist)) as j, list_min(dist) ** 2 as d2
  from (select k, s, list_transform(c, lambda y: list_distance(y, x)) as dist from settled, points)
), counted as (select k, s, j, count(*) as n, sum(d2) as d2 from ends group by all)""")
    return "with recursive " + ",\n".join(steps) + """
select k as clusters, s as "start", round(any_value(total), 6) as inertia, any_value(iterations)::bigint as iterations, any_value(converged) as converged,
       string_agg(coalesce(n, 0)::varchar, ',' order by i) as sizes
from (select settled.k, settled.s, iterations, converged, i, n, sum(d2) over (partition by settled.k, settled.s) as total
      from settled join range(1, 7) as r(i) on i <= settled.k left join counted on counted.k = settled.k and counted.s = settled.s and counted.j = i) group by 1, 2"""


@query("kmeans_fit", _kmeans_sql())
def kmeans_fit(spark, sf):
    rows = given(spark, sf)
    points = materialize(K.points_frame(rows, F.col("group"), F.col("vec_id")))
    runs = [K.Run("all", k, (42, s)) for k in KS for s in range(STARTS)]
    K.fit(points, runs)
    table = [(r.k, r.start[1], r.inertia, r.iterations, r.converged, ",".join(str(int(n)) for n in r.sizes)) for r in runs]
    return rounded(spark.createDataFrame(table, "clusters int, start int, inertia double, iterations int, converged boolean, sizes string"))


@query("kmeans_selection")
def kmeans_selection(spark, sf):
    _, matrix = wide_matrix(spark, sf)
    return R.select_clusters(matrix, WIDE)["selection"]


@query("kmeans_stability")
def kmeans_stability(spark, sf):
    _, matrix = wide_matrix(spark, sf)
    picked = R.select_clusters(matrix, WIDE)
    return R.stability(matrix, picked, R.label_profiles(matrix, picked["models"]), WIDE)


@query("clip_sensitivity")
def clip_sensitivity(spark, sf):
    eligible, matrix = wide_matrix(spark, sf)
    picked = R.select_clusters(matrix, WIDE)
    return R.clip_sensitivity(eligible, picked, R.label_profiles(matrix, picked["models"]), WIDE)


@query("price_level_sensitivity")
def price_level_sensitivity(spark, sf):
    _, matrix = wide_matrix(spark, sf)
    picked = R.select_clusters(matrix, WIDE)
    return R.price_level_sensitivity(matrix, picked, R.label_profiles(matrix, picked["models"]), WIDE)


# Repeated squaring of a covariance matrix leaves the projector on its first axis; the second comes after taking that out.
SQL_SQUARE = """
select commodity, c, t + 1, list_transform(b, lambda r: list_transform(r, lambda z: z / (b[1][1] + b[2][2] + b[3][3] + b[4][4] + b[5][5])))
from (select commodity, c, t, list_transform(a, lambda r: list_transform(a, lambda s: list_dot_product(r, s))) as b from {0} where t < 45)"""
SQL_AXIS = """
select commodity, c, list_transform(v, lambda z: z * case when list_aggregate(v, 'max') >= -list_aggregate(v, 'min') then 1 else -1 end) as v
from (select commodity, c, list_transform(row, lambda z: z / sqrt(list_dot_product(row, row))) as v from (
        select commodity, c, a[list_position([a[1][1], a[2][2], a[3][3], a[4][4], a[5][5]], greatest(a[1][1], a[2][2], a[3][3], a[4][4], a[5][5]))] as row from {0} where t = 45))"""
SQL_COVARIANCES = ", ".join("[" + ", ".join(f"covar_pop(x[{i}], x[{j}])" for j in range(1, 6)) + "]" for i in range(1, 6))


@query("pca_projection", f"""
with recursive e as (select label::varchar as commodity, vec_id::varchar as series_id, list_transform(embedding[1:5], lambda v: v::double) as x from embeddings),
m as (select commodity, [{SQL_COVARIANCES}] as c from e group by 1),
s1 as (select commodity, c, 0 as t, c as a from m union all {SQL_SQUARE.format("s1")}),
a1 as ({SQL_AXIS.format("s1")}),
l1 as (select *, list_dot_product(v, list_transform(c, lambda r: list_dot_product(r, v))) as l from a1),
d as (select commodity, list_transform(c, lambda r, i: list_transform(r, lambda z, j: z - l * v[i] * v[j])) as c from l1),
s2 as (select commodity, c, 0 as t, c as a from d union all {SQL_SQUARE.format("s2")}),
a2 as ({SQL_AXIS.format("s2")}),
l2 as (select *, list_dot_product(v, list_transform(c, lambda r: list_dot_product(r, v))) as l from a2)
select commodity, series_id, round(list_dot_product(x, l1.v), 6) as PC1, round(list_dot_product(x, l2.v), 6) as PC2,
       round((l1.l + l2.l) / (l1.c[1][1] + l1.c[2][2] + l1.c[3][3] + l1.c[4][4] + l1.c[5][5]), 6) as explained_share
from e join l1 using (commodity) join l2 using (commodity)""")
def pca_projection(spark, sf):
    """Vectors as profiles, their label as commodity."""
    rows = given(spark, sf).select(F.col("cluster").cast("string").alias("commodity"), F.col("vec_id").cast("string").alias("series_id"), F.slice("x", 1, 5).alias("x"))
    return rounded(R.projection(rows))


@query("representative_history")
def representative_history(spark, sf):
    daily = materialize(wide_panel(spark, sf))
    eligible, _, _ = R.eligible_profiles(daily, WIDE)
    matrix = materialize(prep.feature_matrix(eligible, R.BY, WIDE.clip_quantile))
    labelled = R.label_profiles(matrix, R.select_clusters(matrix, WIDE)["models"])
    return R.representative_history(daily, Q.nearest_members(labelled, R.BY, P.SERIES[1:]))


@query("commodity_overview")
def commodity_overview(spark, sf):
    return R.analyze(materialize(wide_panel(spark, sf)), WIDE)["commodity_overview"]
