"""Quality of a clustering, per group."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from serieskit.config import SEPARATION_CUTOFFS
from serieskit.functions import scalars as S
from serieskit.operators.cluster import squared_distance

# When all points of a group meet each other: rows that a block may always have, numbers of the vectors and sums of a larger one at most,
# and blocks that a group of many rows has at least.
BLOCK_ROWS, BLOCK_NUMBERS, BLOCK_SUMS, LEAST_BLOCKS = 1024, 1 << 21, 1 << 22, 12
# Rows and members whose distances are held at once; numbers of their differences at once.
TILE, PART_NUMBERS = (128, 1024), 1 << 20
# Points of a squared distance below this share of their squared lengths (from the middle of their blocks) are compared by components.
CLOSE = 1e-5


def cluster_sizes(labelled: DataFrame, by: Sequence[str], k: int | None = None) -> DataFrame:
    """Rows per cluster; with ``k`` also the empty ones."""
    counts = labelled.groupBy(*by, "cluster").agg(F.count("*").alias("size"))
    if k is None:
        return counts
    every = counts.select(*by).dropDuplicates().select(*by, F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("cluster"))
    return every.join(counts, [*by, "cluster"], "left").fillna(0, ["size"])


def centroids(labelled: DataFrame, by: Sequence[str], dims: int, x: str = "x") -> DataFrame:
    means = F.array(*[F.avg(F.col(x)[i]) for i in range(dims)])
    return labelled.groupBy(*by, "cluster").agg(means.alias("center"), F.count("*").alias("size"))


def center_table(labelled: DataFrame, by: Sequence[str], dims: int, names: Sequence[str] | None = None) -> DataFrame:
    """Centre per cluster and feature in long form."""
    long = centroids(labelled, by, dims).select(*by, "cluster", F.posexplode("center").alias("feature", "value"))
    if names is None:
        return long
    return long.withColumn("feature", F.array(*[F.lit(n) for n in names])[F.col("feature")])


def _to_own(labelled: DataFrame, by: Sequence[str], dims: int) -> DataFrame:
    own = centroids(labelled, by, dims)
    # One row per cluster: bounded by the number of groups and clusters.
    return labelled.join(F.broadcast(own), [*by, "cluster"]).withColumn("_d2", squared_distance(F.col("x"), F.col("center")))


def inertia(labelled: DataFrame, by: Sequence[str], dims: int) -> DataFrame:
    return _to_own(labelled, by, dims).groupBy(*by).agg(F.sum("_d2").alias("inertia"))


def calinski_harabasz(labelled: DataFrame, by: Sequence[str], dims: int) -> DataFrame:
    """Between over within dispersion, each per degree of freedom."""
    whole = labelled.groupBy(*by).agg(F.array(*[F.avg(F.col("x")[i]) for i in range(dims)]).alias("_mean"))
    parts = centroids(labelled, by, dims).join(whole, list(by))
    between = parts.groupBy(*by).agg(
        F.sum(F.col("size") * squared_distance(F.col("center"), F.col("_mean"))).alias("_between"),
        F.count("*").alias("_k"), F.sum("size").alias("_n"),
    )
    joined = between.join(inertia(labelled, by, dims), list(by))
    value = S.ratio(F.col("_between") * (F.col("_n") - F.col("_k")), F.col("inertia") * (F.col("_k") - 1))
    return joined.select(*by, value.alias("calinski_harabasz"))


def davies_bouldin(labelled: DataFrame, by: Sequence[str], dims: int) -> DataFrame:
    """Mean over clusters of the worst (s_i + s_j) / d_ij; the k centres of a group meet in one array."""
    spread = _to_own(labelled, by, dims).groupBy(*by, "cluster").agg(F.avg(F.sqrt("_d2")).alias("s"), F.first("center").alias("center"))
    lists = spread.groupBy(*by).agg(F.collect_list(F.struct("cluster", "s", "center")).alias("c"))

    def worst(a):
        others = F.filter(F.col("c"), lambda b: b["cluster"] != a["cluster"])
        return F.array_max(F.transform(others, lambda b: S.ratio(a["s"] + b["s"], F.sqrt(squared_distance(a["center"], b["center"])))))

    total = F.aggregate(F.transform("c", worst), F.lit(0.0), lambda t, v: t + v)
    return lists.where(F.size("c") > 1).select(*by, (total / F.size("c")).alias("davies_bouldin"))


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows, missing components as NaN."""
    lists = vectors.combine_chunks()
    widths = np.unique(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    if len(widths) != 1 or lists.null_count:
        raise ValueError("the vectors of a group must all be there and of one length")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), int(widths[0]))


def _products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Squared lengths, and the two factors whose product is the squared distances."""
    n, one = (x * x).sum(1)[:, None], np.ones((len(x), 1))
    return n[:, 0], np.hstack([-2.0 * x, n, one]), np.hstack([x, one, n])


def _set_close(d: np.ndarray, x: np.ndarray, y: np.ndarray, least: np.ndarray) -> None:
    """Squared distances below ``least``, and those that are no numbers, again from the differences themselves."""
    r, c = np.nonzero(~(d >= least))
    step = max(1, PART_NUMBERS // max(1, x.shape[1]))
    for at in range(0, len(r), step):
        i, j = r[at:at + step], c[at:at + step]
        d[i, j] = ((x[i] - y[j]) ** 2).sum(1)


def _pieces(own: np.ndarray, step: int) -> list[tuple]:
    """Runs of ``step`` rows; for each where its clusters start and which they are. ``own`` is sorted."""
    out = []
    for at in range(0, len(own), step):
        starts = np.flatnonzero(np.diff(own[at:at + step], prepend=-1))
        out.append((slice(at, min(at + step, len(own))), starts, own[at:at + step][starts]))
    return out


@np.errstate(invalid="ignore", over="ignore")
def _block_sums(x: np.ndarray, x_own: np.ndarray, y: np.ndarray, y_own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances of each row of one block summed by the ``k`` clusters of the other, both ways. Cluster ``k`` is counted by nobody.

    Squared distances come from one product. Where two points are so close for their lengths that this loses digits, they come from the differences.
    """
    middle = np.concatenate([x, y]).mean(0)
    middle = np.where(np.isfinite(middle), middle, 0.0)
    x, y = x - middle, y - middle
    (x_len, left, _), (y_len, _, right) = _products(x), _products(y)
    to_y, to_x = np.zeros((len(x), k + 1)), np.zeros((len(y), k + 1))
    members = _pieces(y_own, TILE[1])
    for i, i_starts, i_names in _pieces(x_own, TILE[0]):
        for j, j_starts, j_names in members:
            d = left[i] @ right[j].T
            if not d.min() >= CLOSE * (x_len[i].max() + y_len[j].max()):
                _set_close(d, x[i], y[j], CLOSE * (x_len[i, None] + y_len[None, j]))
            np.sqrt(d, out=d)
            to_y[i, j_names] += np.add.reduceat(d, j_starts, axis=1)
            to_x[j, i_names] += np.add.reduceat(d, i_starts, axis=0).T
    return to_y[:, :k], to_x[:, :k]


def _distance_sums(keys: Sequence[str]):
    """Per point of two blocks the sums of its distances to the clusters of the other one, or of the only one."""

    def run(cell: pa.Table) -> pa.Table:
        coded = cell["cluster"].combine_chunks().dictionary_encode()
        names, k = coded.dictionary, len(coded.dictionary)
        own = coded.indices.fill_null(k).to_numpy()
        second = cell["_own"].to_numpy() != cell["_i"][0].as_py()
        x, sides = _matrix(cell["x"]), []
        for side in (second == 0, second):
            at = np.flatnonzero(side)
            at = at[np.argsort(own[at], kind="stable")]
            sides.append((at, x[at], own[at]))
        (a, xa, own_a), (b, xb, own_b) = sides
        if cell["_i"][0] == cell["_j"][0]:
            met = [(a, own_a, _block_sums(xa, own_a, xa, own_a, k)[0])]
        else:
            to_b, to_a = _block_sums(xa, own_a, xb, own_b, k)
            met = [(a, own_b, to_b), (b, own_a, to_a)]
        out = []
        for at, others, totals in met:
            there = np.unique(others[others < k])
            rows = cell.select(list(keys)).take(pa.array(np.repeat(at, len(there))))
            rows = rows.append_column("other", names.take(pa.array(np.tile(there, len(at)))))
            out.append(rows.append_column("total", pa.array(totals[:, there].ravel())))
        return pa.concat_tables(out)

    return run


def _blocks(block_rows: int | None) -> Column:
    """Blocks of a group: of about ``block_rows`` rows, else as few as a task holds and as many as keep tasks busy."""
    if block_rows:
        return F.ceil(F.col("_rows") / block_rows)
    held = F.least(F.lit(BLOCK_NUMBERS) / F.greatest("_width", F.lit(1)), F.lit(BLOCK_SUMS) / F.col("_clusters"), F.col("_rows") / LEAST_BLOCKS)
    return F.ceil(F.col("_rows") / F.greatest(F.lit(BLOCK_ROWS), held))


def silhouette_samples(labelled: DataFrame, by: Sequence[str], ident: Sequence[str], block_rows: int | None = None) -> DataFrame:
    """Exact silhouette per row of every group, whatever its size; ``ident`` names a row within its group.

    A group is cut into blocks of rows and two blocks meet once, in one task, which gives sums per point and cluster
    only, for both. The work is quadratic in a group's rows, as the measure is, but no task holds more
    than two blocks, and a row is sent as often as its group has blocks. Groups of one cluster, or of single points only, have no silhouette.
    """
    by, ident = list(by), list(ident)
    keys = [*by, *ident, "cluster"]
    sizes = labelled.groupBy(*by, "cluster").agg(F.count("*").alias("_n"), F.max(F.size("x")).alias("_width"))
    groups = sizes.groupBy(*by).agg(F.sum("_n").alias("_rows"), F.count("*").alias("_clusters"), F.max("_width").alias("_width"))
    # One row per cluster and group, so the sizes may be sent to all tasks.
    rows = labelled.select(*keys, F.col("x").cast("array<double>").alias("x")).join(F.broadcast(groups), by)
    # Rows are dealt first, since the task that reads them would write all their copies.
    dealt = rows.withColumn("_draw", F.xxhash64(*ident, "x")).repartition("_draw")
    blocks = dealt.withColumn("_blocks", _blocks(block_rows)).withColumn("_own", F.pmod("_draw", "_blocks"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1))
    spread = blocks.select(*keys, "x", "_own", every.alias("_met"))
    cells = spread.select(*keys, "x", "_own", F.least("_own", "_met").alias("_i"), F.greatest("_own", "_met").alias("_j"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in labelled.select(*keys).schema.fields)
    kind = labelled.schema["cluster"].dataType.simpleString()
    sums = cells.groupBy(*by, "_i", "_j").applyInArrow(_distance_sums(keys), f"{fields}, other {kind}, total double")
    whole = sums.groupBy(*keys, "other").agg(F.sum("total").alias("total"))
    facing = whole.join(F.broadcast(sizes.drop("_width").withColumnRenamed("cluster", "other")), [*by, "other"])
    mine = F.col("other") == F.col("cluster")
    near = facing.groupBy(*keys).agg(
        F.max(F.when(mine, S.ratio(F.col("total"), F.col("_n") - 1))).alias("_in"),
        F.min(F.when(~mine, F.col("total") / F.col("_n"))).alias("_out"),
        F.max(F.when(mine, F.col("_n"))).alias("_size"),
    ).join(F.broadcast(groups), by)
    score = F.when(F.col("_size") > 1, F.coalesce(S.ratio(F.col("_out") - F.col("_in"), F.greatest("_in", "_out")), F.lit(0.0))).otherwise(0.0)
    defined = (F.col("_clusters") > 1) & (F.col("_clusters") < F.col("_rows"))
    scored = near.select(*keys, F.when(defined, S.finite(score)).alias("silhouette"))
    return scored.withColumn("weak_separation", F.when(F.col("silhouette").isNotNull(), F.col("silhouette") <= 0))


def silhouette_mean(labelled: DataFrame, by: Sequence[str], ident: str) -> DataFrame:
    """Mean of the exact silhouettes of each group."""
    return silhouette_samples(labelled, by, [ident]).groupBy(*by).agg(F.avg("silhouette").alias("silhouette"))


def adjusted_rand(pairs: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Agreement of two labellings from their contingency table; 1 where it is undefined."""
    def couples(n):
        return n.cast("double") * (n - 1) / 2

    cells = pairs.groupBy(*by, a, b).agg(F.count("*").alias("n"))
    rows = cells.groupBy(*by, a).agg(F.sum("n").alias("n")).groupBy(*by).agg(F.sum(couples(F.col("n"))).alias("_a"))
    cols = cells.groupBy(*by, b).agg(F.sum("n").alias("n")).groupBy(*by).agg(F.sum(couples(F.col("n"))).alias("_b"))
    both = cells.groupBy(*by).agg(F.sum(couples(F.col("n"))).alias("_ab"), F.sum("n").alias("_n"))
    key = list(by) or ["_one"]
    parts = [t if by else t.withColumn("_one", F.lit(1)) for t in (both, rows, cols)]
    joined = parts[0].join(parts[1], key).join(parts[2], key)
    expected = S.ratio(F.col("_a") * F.col("_b"), couples(F.col("_n")))
    value = S.ratio(F.col("_ab") - expected, (F.col("_a") + F.col("_b")) / 2 - expected)
    return joined.select(*by, F.coalesce(value, F.lit(1.0)).alias("ARI"))


def silhouette_histogram(scored: DataFrame, bins: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """Equal bins between the smallest and the largest silhouette; one bin if they are equal."""
    known = scored.where(F.col("silhouette").isNotNull())
    ends = known.groupBy(*by).agg(F.min("silhouette").alias("_lo"), F.max("silhouette").alias("_hi"))
    key = list(by) or ["_one"]
    if not by:
        known, ends = known.withColumn("_one", F.lit(1)), ends.withColumn("_one", F.lit(1))
    place = F.floor(S.ratio((F.col("silhouette") - F.col("_lo")) * bins, F.col("_hi") - F.col("_lo")))
    numbered = known.join(ends, key).withColumn("bin", F.coalesce(F.least(place, F.lit(bins - 1)), F.lit(0)).cast("bigint"))
    return numbered.groupBy(*by, "bin").agg(F.count("*").alias("profiles"))


def whatif_separation(scored: DataFrame, by: Sequence[str] = (), cutoffs: Sequence[float] = SEPARATION_CUTOFFS) -> DataFrame:
    s = F.col("silhouette")
    wide = scored.groupBy(*by).agg(
        F.count(s).alias("profiles_evaluated"),
        *[F.count(F.when(s <= F.lit(float(c)), 1)).alias(f"c{i}") for i, c in enumerate(cutoffs)],
    )
    cells = ", ".join(f"double({c}), c{i}" for i, c in enumerate(cutoffs))
    stacked = F.expr(f"stack({len(cutoffs)}, {cells}) as (silhouette_cutoff, profiles_below_cutoff)")
    return wide.select(*by, stacked, "profiles_evaluated")


def nearest_members(assigned: DataFrame, by: Sequence[str], ident: Sequence[str], n: int = 3) -> DataFrame:
    """The ``n`` members nearest to each centre; cut before the shuffle."""
    order = W.partitionBy(*by, "cluster").orderBy("distance", *ident)
    return assigned.withColumn("position", F.row_number().over(order)).where(F.col("position") <= n)


def least_separated(scored: DataFrame, by: Sequence[str], ident: Sequence[str], n: int = 10) -> DataFrame:
    order = W.partitionBy(*by).orderBy("silhouette", *ident)
    known = scored.where(F.col("silhouette").isNotNull())
    return known.withColumn("position", F.row_number().over(order)).where(F.col("position") <= n)


def rank_groups(labelled: DataFrame, by: Sequence[str], measure: str) -> DataFrame:
    """Clusters ordered by the median of a measure, with the text that names each."""
    from serieskit.operators.ordered import exact_quantiles

    medians = exact_quantiles(labelled, [*by, "cluster"], measure, {"median": 0.5})
    order = W.partitionBy(*by).orderBy("median", "cluster")
    placed = medians.withColumn("group_rank", F.row_number().over(order)).withColumn("_of", F.count("*").over(W.partitionBy(*by)))
    text = F.concat(F.lit("Volatility group "), F.col("group_rank"), F.lit("/"), F.col("_of"), F.lit(" (low to high)"))
    return placed.withColumn("group_description", text).drop("_of")


def group_summary(labelled: DataFrame, by: Sequence[str]) -> DataFrame:
    """Size, means, medians and shares of each cluster."""
    from serieskit.operators.ordered import exact_quantiles
    from serieskit.operators.prep import long_form

    medians = {
        "price_cv": "median_price_cv", "return_volatility": "median_daily_return_volatility",
        "sharp_drop_fraction": "median_sharp_drop_fraction", "monthly_variation_cv": "median_monthly_variation",
    }
    key = [*by, "cluster"]
    middle = exact_quantiles(long_form(labelled, list(medians), key), [*key, "feature"], "value", {"m": 0.5})
    wide = middle.groupBy(*key).agg(*[F.max(F.when(F.col("feature") == f, F.col("m"))).alias(name) for f, name in medians.items()])
    means = labelled.groupBy(*key).agg(
        F.count("*").alias("profile_count"),
        F.avg("mean_price").alias("mean_price"),
        F.avg("return_volatility").alias("mean_daily_return_volatility"),
        F.avg("calendar_coverage").alias("mean_calendar_coverage"),
        F.avg(F.col("profile_was_clipped").cast("double")).alias("clipped_profile_fraction"),
        F.avg("silhouette").alias("mean_profile_silhouette"),
        F.avg(F.col("weak_separation").cast("double")).alias("weak_separation_fraction"),
    )
    return means.join(wide, key, "left")
