"""K-means over many groups, cluster counts, starts and resamples at once.

Points of a checked small size are sent to all tasks, and the runs are dealt to tasks: one job holds all rounds of all runs.
Beyond that size the points are dealt instead. Every pass over them serves all runs then: a task reduces its points to one partial sum
per run and centre, and only those sums are shuffled. Centres (runs x k x features) are
the only thing the driver holds, so an iteration has no lineage beyond the stored points. Both ways draw and round alike.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# Resamples one word of a mask holds.
WORD_BITS = 62
# Bytes of points that are sent to every task, at most.
SENT_BYTES = 32 << 20


@dataclass
class Run:
    """One K-means fit. ``bit`` selects the points whose mask words have that bit; -1 takes all."""

    group: str
    k: int
    start: tuple = (0,)
    bit: int = -1
    centers: np.ndarray | None = None
    inertia: float = float("inf")
    iterations: int = 0
    converged: bool = False
    sizes: np.ndarray | None = field(default=None)


def words_for(repeats: int) -> int:
    return max(1, -(-repeats // WORD_BITS))


def drawn(mask: np.ndarray, bit):
    """The given bit (or bits) of every row's mask words."""
    return (mask[:, bit // WORD_BITS] >> (bit % WORD_BITS)) & 1


def points_frame(df: DataFrame, group: Column, ident: Column, x: str = "x", mask: Column | None = None) -> DataFrame:
    """Columns the fit needs: group, a 64-bit hash of the identity, the words of the resample mask and the vector."""
    mask = F.array(F.lit(0).cast("bigint")) if mask is None else mask
    return df.select(
        group.cast("string").alias("group"), F.xxhash64(ident).alias("h"), mask.cast("array<bigint>").alias("mask"),
        F.col(x).cast("array<double>").alias("x"),
    )


def _uniform(h: np.ndarray, salt: int) -> np.ndarray:
    """Even numbers in (0, 1) from hashes and a salt (splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        z = h.astype(np.int64).view(np.uint64) + np.uint64(salt & (2**64 - 1)) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return (z.astype(np.float64) + 0.5) / 2.0**64


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of n points to c centres."""
    d = (x * x).sum(1)[:, None] - 2.0 * x @ centers.T + (centers * centers).sum(1)[None, :]
    return np.maximum(d, 0.0)


def _groups(batches: Iterator[pd.DataFrame]):
    for pdf in batches:
        for name, part in pdf.groupby("group", sort=False):
            yield name, part["h"].to_numpy(), np.stack(part["mask"].to_numpy()), np.stack(part["x"].to_numpy())


def _salt(start: tuple, step: int) -> int:
    out = 0
    for v in (*start, step):
        out = (out * 1_000_003 + int(v) + 1) % (2**63)
    return out


def seed_centers(points: DataFrame, runs: Sequence[Run]) -> None:
    """Spread-out starting centres: each next one drawn with chance proportional to its squared distance.

    The draw is a race: the point with the smallest -ln(u)/d2 wins, which is one distributed
    minimum. Runs that differ only in k share one sequence of draws.
    """
    series = sorted({(r.group, r.start, r.bit) for r in runs})
    depth = {s: max(r.k for r in runs if (r.group, r.start, r.bit) == s) for s in series}
    chosen: dict[int, list] = {i: [] for i in range(len(series))}
    for step in range(max(depth.values())):
        todo = defaultdict(list)
        for i, s in enumerate(series):
            if step < depth[s]:
                todo[s[0]].append((i, s[2], _salt(s[1], step), np.array(chosen[i])))

        def race(batches, todo=dict(todo)):
            for name, h, mask, x in _groups(batches):
                rows = []
                for i, bit, salt, centers in todo.get(name, ()):
                    key = -np.log(_uniform(h, salt))
                    if len(centers):
                        nearest = _distances(x, centers).min(1)
                        key = np.where(nearest > 1e-12, key / np.maximum(nearest, 1e-300), np.inf)
                    if bit >= 0:
                        key = np.where(drawn(mask, bit) == 1, key, np.inf)
                    best = int(np.argmin(key))
                    if np.isfinite(key[best]):
                        rows.append((i, float(key[best]), x[best].tolist()))
                yield pd.DataFrame(rows, columns=["i", "key", "x"])

        won = points.mapInPandas(race, "i int, key double, x array<double>").groupBy("i").agg(F.min(F.struct("key", "x"))["x"].alias("x"))
        for row in won.collect():
            chosen[row.i].append(row.x)
    place = {s: i for i, s in enumerate(series)}
    for r in runs:
        r.centers = np.array(chosen[place[(r.group, r.start, r.bit)]][: r.k], dtype=float)


def _pass(points: DataFrame, runs: Sequence[Run]) -> dict[int, tuple]:
    """Per run the points, sums and squared distances of each centre, from one job."""
    by_shape = defaultdict(lambda: defaultdict(list))
    for i, r in enumerate(runs):
        by_shape[r.group][len(r.centers)].append((i, r.bit, r.centers))
    plan = {g: {k: ([i for i, _, _ in v], np.array([b for _, b, _ in v]), np.stack([c for _, _, c in v])) for k, v in shapes.items()} for g, shapes in by_shape.items()}
    dims = runs[0].centers.shape[1]
    names = [f"s{d}" for d in range(dims)]

    def partial(batches):
        for name, _, mask, x in _groups(batches):
            for k, (ids, bits, centers) in plan.get(name, {}).items():
                d = _distances(x, centers.reshape(-1, dims)).reshape(len(x), len(ids), k)
                label, nearest = d.argmin(2), d.min(2)
                weight = np.where(bits[None, :] < 0, 1, drawn(mask, np.maximum(bits, 0))).astype(float)
                for j in range(k):
                    member = (label == j) * weight
                    out = pd.DataFrame(member.T @ x, columns=names)
                    out.insert(0, "d2", (member * nearest).sum(0))
                    out.insert(0, "n", member.sum(0).astype(np.int64))
                    out.insert(0, "j", j)
                    out.insert(0, "i", ids)
                    yield out

    schema = "i int, j int, n bigint, d2 double, " + ", ".join(f"{s} double" for s in names)
    sums = points.mapInPandas(partial, schema).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "d2", *names)])
    out = {}
    for i, r in enumerate(runs):
        k = len(r.centers)
        out[i] = (np.zeros(k, dtype=np.int64), np.zeros(k), np.zeros((k, dims)))
    for row in sums.collect():
        n, d2, total = out[row["i"]]
        n[row["j"]], d2[row["j"]], total[row["j"]] = row["n"], row["d2"], [row[s] for s in names]
    return out


def lloyd(points: DataFrame, runs: Sequence[Run], max_iterations: int = 300, tolerance: float = 1e-4) -> None:
    """Advance all runs together until their centres rest; an empty cluster keeps its centre."""
    active = [r for r in runs if len(r.centers)]
    for _ in range(max_iterations):
        if not active:
            break
        for i, (n, _, total) in _pass(points, active).items():
            run = active[i]
            moved = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], run.centers)
            run.iterations += 1
            run.converged = bool(((moved - run.centers) ** 2).sum() <= tolerance)
            run.centers = moved
        active = [r for r in active if not r.converged]
    settled_runs = [r for r in runs if len(r.centers)]
    if settled_runs:
        for i, (n, d2, _) in _pass(points, settled_runs).items():
            settled_runs[i].sizes, settled_runs[i].inertia = n, float(d2.sum())


def fit(points: DataFrame, runs: Sequence[Run], max_iterations: int = 300, tolerance: float = 1e-4) -> None:
    """Seed and settle all runs. ``points`` is a stored table of ``points_frame``."""
    size = points.agg(F.count("*"), F.max(F.size("x") + F.size("mask"))).first()
    if runs and size[0] and size[0] * size[1] * 8 <= SENT_BYTES:
        _fit_by_run(points, runs, max_iterations, tolerance)
    else:
        seed_centers(points, runs)
        lloyd(points, runs, max_iterations, tolerance)


def _drawn_start(h: np.ndarray, x: np.ndarray, start: tuple, k: int) -> np.ndarray:
    """The race of ``seed_centers`` over the points of one run."""
    chosen: list[np.ndarray] = []
    nearest = np.ones(len(x))
    for step in range(k):
        key = -np.log(_uniform(h, _salt(start, step)))
        if chosen:
            nearest = np.minimum(nearest, _distances(x, chosen[-1][None])[:, 0]) if step > 1 else _distances(x, chosen[-1][None])[:, 0]
            key = np.where(nearest > 1e-12, key / np.maximum(nearest, 1e-300), np.inf)
        least = key.min(initial=np.inf)
        if not np.isfinite(least):
            break
        chosen.append(np.array(min(x[key == least].tolist())))
    return np.array(chosen, dtype=float)


def _settled(x: np.ndarray, centers: np.ndarray, max_iterations: int, tolerance: float) -> tuple:
    """The rounds of ``lloyd`` over the points of one run: centres, inertia, iterations, converged, sizes."""

    def moved_to(centers):
        d = _distances(x, centers)
        label, nearest = d.argmin(1), d.min(1)
        member = (label[:, None] == np.arange(len(centers))[None, :]).astype(float)
        return member.sum(0).astype(np.int64), (member * nearest[:, None]).sum(0), member.T @ x

    iterations, converged = 0, False
    while iterations < max_iterations and not converged:
        n, _, total = moved_to(centers)
        moved = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centers)
        iterations += 1
        converged = bool(((moved - centers) ** 2).sum() <= tolerance)
        centers = moved
    n, d2, _ = moved_to(centers)
    return centers, float(d2.sum()), iterations, converged, n


def _fit_by_run(points: DataFrame, runs: Sequence[Run], max_iterations: int, tolerance: float) -> None:
    spark = points.sparkSession
    pdf = points.toPandas().sort_values(["group", "h"], kind="stable")
    held = {name: (part["h"].to_numpy(), np.stack(part["mask"].to_numpy()), np.stack(part["x"].to_numpy())) for name, part in pdf.groupby("group")}
    sent = spark.sparkContext.broadcast(held)
    plan = [(r.group, r.k, r.start, r.bit, r.centers) for r in runs]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in batch["id"]:
                group, k, start, bit, centers = plan[i]
                h, mask, x = sent.value[group]
                if bit >= 0:
                    own = drawn(mask, bit) == 1
                    h, x = h[own], x[own]
                centers = _drawn_start(h, x, start, k) if centers is None else centers
                if len(centers):
                    centers, inertia, iterations, converged, n = _settled(x, centers, max_iterations, tolerance)
                    yield pd.DataFrame({"i": [i], "centers": [centers.tolist()], "inertia": [inertia], "iterations": [iterations], "converged": [converged], "sizes": [n.tolist()]})

    schema = "i long, centers array<array<double>>, inertia double, iterations int, converged boolean, sizes array<long>"
    parts = min(len(runs), 4 * spark.sparkContext.defaultParallelism)
    # Runs of one count follow each other and differ in cost, so they are dealt one by one.
    order = spark.range(len(runs)).repartition(parts, F.col("id") % parts)
    for run in runs:
        run.centers = np.zeros((0, 0)) if run.centers is None else run.centers
    for row in order.mapInPandas(work, schema).collect():
        run = runs[row.i]
        run.centers, run.inertia, run.iterations, run.converged = np.array(row.centers), row.inertia, row.iterations, row.converged
        run.sizes = np.array(row.sizes, dtype=np.int64)
    sent.unpersist()


def best_runs(runs: Sequence[Run], key) -> dict:
    """Lowest inertia per key, the earliest start on ties."""
    best: dict = {}
    for r in sorted(runs, key=lambda r: (round(r.inertia, 9), r.start)):
        best.setdefault(key(r), r)
    return best


def centers_frame(spark, rows: Sequence[tuple], by: str = "by string") -> DataFrame:
    """Rows (by..., cluster, centre) as a table."""
    return spark.createDataFrame(rows, f"{by}, cluster int, center array<double>")


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, v: s + v)


def assign(df: DataFrame, centers: DataFrame, by: Sequence[str], x: str = "x") -> DataFrame:
    """Nearest centre of each row's group, the lowest cluster number on ties.

    The centres of a group are few and travel as one array, so a point stays one row.
    """
    lists = centers.groupBy(*by).agg(F.collect_list(F.struct("cluster", "center")).alias("_centers"))
    nearest = F.array_min(F.transform("_centers", lambda c: F.struct(squared_distance(F.col(x), c["center"]).alias("d2"), c["cluster"].alias("cluster"))))
    joined = df.join(lists, list(by)) if by else df.withColumn("_centers", lists.scalar())
    return joined.withColumn("_near", nearest).withColumn("cluster", F.col("_near.cluster")).withColumn("distance", F.sqrt(F.col("_near.d2"))).drop("_near", "_centers")
