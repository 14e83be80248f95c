"""Classifiers on the hourly series; checked by rows only, since fits are numerical."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from serieskit.catalog import demand_views as D
from serieskit.catalog.registry import query, rounded
from serieskit.operators import classify as L, exact_tree, grid as G, metrics as M
from serieskit.plans import demand as R
from serieskit.session import materialize

SMALL = replace(D.HOURLY, max_bins=16, max_interaction_bins=8, additive_iterations=30, min_examples=100)
SMALL_DAILY = replace(D.DAILY, max_bins=16, max_interaction_bins=8, additive_iterations=30, min_examples=100, min_backtest_rows=15)


WITH_WEATHER = G.base_features(D.HOURLY) + G.weather_features(["temperature", "humidity"])


def sql_logistic(cfg, features, steps: int = 12) -> str:
    """Newton steps from zero, each a sum over the train rows and an elimination; ends in ``solved`` with one list, the intercept first."""
    p = len(features) + 1
    lists = ", ".join(f"{f}::double" for f in features)
    medians = ", ".join(f"median({f}::double)" for f in features)
    out = D.sql_labelled(cfg) + f""",
seen as (select slot, target, [{lists}] as f from lab where split = 'train'),
mids as (select [{medians}] as m from lab where split = 'train'),
filled as (select slot, target, list_transform(f, lambda v, i: coalesce(v, m[i], 0.0)) as f from seen, mids),
cells as (select slot, unnest(f) as v, generate_subscripts(f, 1) as i from filled),
moments as (select list(a order by i) as a, list(case when s > n * e * s + (n * a * e) ** 2 then sqrt(s) end order by i) as d
            from (select i, avg(v) as a, var_pop(v) as s, count(*) as n, 2.220446049250313e-16::double as e from cells group by i)),
given as materialized (
  select slot, target, count(*) over () / (2.0::double * count(*) over (partition by target)) as w,
         list_prepend(1.0::double, list_transform(f, lambda v, i: case when d[i] is null then 0.0 else (v - a[i]) / d[i] end)) as x from filled, moments),
b0 as (select list_transform(range({p}), lambda i: 0.0::double) as beta)"""
    for t in range(steps):
        out += f""",
r{t} as materialized (select x, w, target, 1 / (1 + exp(-list_dot_product(x, beta))) as q, beta from given, b{t}),
u{t} as (select i, w * (q - target) * x[i] as g, list_transform(x, lambda v: v * x[i] * w * q * (1 - q)) as h, beta[i] as b from r{t}, range(1, {p + 1}) as t(i)),
g{t} as (select i, sum(g) + case when i > 1 then any_value(b) else 0 end as g from u{t} group by i),
h{t} as (select i, j, sum(h[j]) + case when i = j and i > 1 then 1 else 0 end as h from u{t}, range(1, {p + 1}) as t(j) group by i, j),
a{t} as (select list(list_append(r, g) order by i) as a from (select i, list(h order by j) as r from h{t} group by i) join g{t} using (i)),
e{t} as (select 1 as k, a from a{t} union all
        select k + 1, list_transform(a, lambda r, i: case when i = k then list_transform(r, lambda v: v / a[k][k])
                                                          else list_transform(r, lambda v, c: v - r[k] * a[k][c] / a[k][k]) end) from e{t} where k <= {p}),
b{t + 1} as materialized (select list_transform(beta, lambda v, i: v - a[i][{p + 1}]) as beta from e{t}, b{t} where k = {p + 1})"""
    return "with recursive " + out.strip() + f""",
solved as (select beta from b{steps})"""


def labelled(spark, sf, cfg=SMALL):
    return materialize(D.labelled(spark, sf, cfg if cfg is not SMALL_DAILY else D.DAILY))


def _model(spark, sf, name):
    rows = labelled(spark, sf)
    marked, _ = R.predictions(rows, R.fit_models(rows, SMALL, [name]))
    return M.full_metrics(marked, ["split", "model"])


def sql_model_metrics(name: str) -> str:
    """Metrics of ``held`` (split, target, score) at the cutoff of the validation rows."""
    return f""",
cuts as (select 0.05::double + i * ((0.95::double - 0.05::double) / 90) as cutoff from range(0, 91) t(i)),
tries as (select cutoff, coalesce(2 * count(*) filter (target = 1 and score >= cutoff) /
          nullif(count(*) filter (target = 1) + count(*) filter (score >= cutoff), 0)::double, 0) as f1 from held, cuts where split = 'validation' group by 1),
chosen as (select cutoff from tries order by f1 desc, cutoff limit 1),
marked as (select split, target, score, case when score >= cutoff then 1 else 0 end as prediction from held, chosen),
areas as (select a.split, sum(case when a.score > b.score then 1.0::double when a.score = b.score then 0.5::double else 0.0::double end) / count(*) as roc_auc
          from held a join held b on a.split = b.split and a.target = 1 and b.target = 0 group by 1),
pts as (select t.split, t.score, count(*) filter (s.target = 1 and s.score >= t.score) as tp, count(*) filter (s.target = 0 and s.score >= t.score) as fp,
               count(*) filter (s.target = 1) as p from (select distinct split, score from held) t join held s on s.split = t.split group by all),
means as (select split, sum((tp - coalesce(prev, 0)) / p::double * tp / (tp + fp)) as average_precision
          from (select *, lag(tp) over (partition by split order by score desc) as prev from pts) group by 1)
select split, '{name}' as model, {D.SQL_RATES}, round(any_value(roc_auc), 6) as roc_auc, round(any_value(average_precision), 6) as average_precision
from marked left join areas using (split) left join means using (split) group by split"""


@query("model_logistic", sql_logistic(D.HOURLY, WITH_WEATHER) + f""",
held as (select split, target, 1 / (1 + exp(-list_dot_product(beta, list_prepend(1.0::double,
                list_transform(f, lambda v, i: case when d[i] is null then 0.0 else (coalesce(v, m[i], 0.0) - a[i]) / d[i] end))))) as score
         from (select split, target, [{", ".join(f"{n}::double" for n in WITH_WEATHER)}] as f from lab where split in ('validation', 'test')), mids, moments, solved)"""
+ sql_model_metrics(L.LOGISTIC_WEATHER))
def model_logistic(spark, sf):
    return rounded(_model(spark, sf, L.LOGISTIC_WEATHER))


def sql_tree(cfg, features, depth: int = L.TREE_DEPTH) -> str:
    """Level by level: running sums over the values of every node and feature, the best split of each node, rows sent on. Ends in ``nodes{depth}``."""
    lists = ", ".join(f"{f}::double" for f in features)
    medians = ", ".join(f"median({f}::double)" for f in features)
    out = D.sql_labelled(cfg) + f""",
mids as (select [{medians}] as m from lab where split = 'train'),
filled as (select slot, split, target, list_transform(f, lambda v, i: coalesce(v, m[i], 0.0)) as f from (select slot, split, target, [{lists}] as f from lab where split is not null), mids),
weighed as (select slot, target, f, count(*) over () / (2.0::double * count(*) over (partition by target)) as w, greatest(50, count(*) over () // 1000) as least
            from filled where split = 'train'),
nodes0 as materialized (select slot, split, target, f, 1 as node from filled)"""
    for t in range(depth):
        out += f""",
v{t} as (select node, i, f[i] as v, sum(w * target) as pos, sum(w * (1 - target)) as neg, count(*) as n, any_value(least) as least
         from weighed join (select slot, node from nodes{t} where split = 'train' and node >= {1 << t}) using (slot), range(1, {len(features) + 1}) as r(i) group by all),
c{t} as (select *, sum(pos) over o as lp, sum(neg) over o as ln, sum(n) over o as nl, sum(pos) over a as tp, sum(neg) over a as tn, sum(n) over a as nt, lead(v) over (partition by node, i order by v) as after
         from v{t} window o as (partition by node, i order by v), a as (partition by node, i)),
k{t} as (select node, i, v, after, round((2 * tp * tn / (tp + tn) - 2 * lp * ln / (lp + ln) - coalesce(2 * (tp - lp) * (tn - ln) / nullif((tp - lp) + (tn - ln), 0), 0)) / (tp + tn), 12) as gain
         from c{t} where nl >= least and nt - nl >= least and tp > 0 and tn > 0),
s{t} as materialized (select node, i, (v + after) / 2 as th from (select *, row_number() over (partition by node order by gain desc, i, v) as place from k{t} where gain > 0) where place = 1),
nodes{t + 1} as materialized (select slot, split, target, f, case when i is null then node when f[i] <= th then 2 * node else 2 * node + 1 end as node from nodes{t} left join s{t} using (node))"""
    return "with recursive " + out.strip()


@query("model_tree", sql_tree(D.HOURLY, WITH_WEATHER) + f""",
shares as (select node, sum(w * target) / sum(w) as share from weighed join (select slot, node from nodes{L.TREE_DEPTH} where split = 'train') using (slot) group by 1),
held as (select split, target, share as score from nodes{L.TREE_DEPTH} join shares using (node) where split in ('validation', 'test'))"""
+ sql_model_metrics(L.TREE))
def model_tree(spark, sf):
    return rounded(_model(spark, sf, L.TREE))


@query("tree_splits", sql_tree(D.HOURLY, WITH_WEATHER) + """,
every as (""" + " union all ".join(f"select node, i, th from s{t}" for t in range(L.TREE_DEPTH)) + f""")
select node::bigint as node, [{", ".join(f"'{n}'" for n in WITH_WEATHER)}][i] as feature, round(th, 6) as threshold from every""")
def tree_splits(spark, sf):
    fitted = R.fit_models(labelled(spark, sf), SMALL, [L.TREE])[L.TREE][0]
    return rounded(exact_tree.split_table(fitted.model, fitted.features, spark).where("feature is not null").drop("positive_share"))


@query("model_additive")
def model_additive(spark, sf):
    return _model(spark, sf, L.ADDITIVE)


@query("model_comparison")
def model_comparison(spark, sf):
    rows = labelled(spark, sf)
    marked, _ = R.predictions(rows, R.fit_models(rows, SMALL))
    return M.full_metrics(R.all_test_rows(rows, marked), ["model"])


def _additive(spark, sf):
    rows = labelled(spark, sf)
    return rows, R.fit_models(rows, SMALL, [L.ADDITIVE])[L.ADDITIVE][0]


@query("term_importance")
def term_importance(spark, sf):
    rows, fitted = _additive(spark, sf)
    return L.term_importance(fitted, rows.where(F.col("split") == "train"))


@query("effect_table")
def effect_table(spark, sf):
    rows, fitted = _additive(spark, sf)
    names = ["demand_now", f"change_{SMALL.change_minutes}min", "temperature", "humidity"]
    return L.effect_table(fitted, rows.where(F.col("split") == "train"), names)


@query("lr_coefficients", sql_logistic(D.HOURLY, WITH_WEATHER) + f"""
select unnest([{", ".join(f"'{n}'" for n in WITH_WEATHER)}]) as feature, unnest(list_transform(beta[2:], lambda v: round(v, 6) + 0.0)) as standardized_coefficient from solved""")
def lr_coefficients(spark, sf):
    rows = labelled(spark, sf)
    return rounded(L.coefficient_table(R.fit_models(rows, SMALL, [L.LOGISTIC_WEATHER])[L.LOGISTIC_WEATHER][0], spark))


@query("whatif_temperature")
def whatif_temperature(spark, sf):
    rows, fitted = _additive(spark, sf)
    return L.whatif_temperature(fitted, rows, M.anchor_cases(rows))


@query("backtest_metrics")
def backtest_metrics(spark, sf):
    return R.rolling_backtests(labelled(spark, sf, SMALL_DAILY), SMALL_DAILY)


