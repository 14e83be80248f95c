"""Order statistics and running sums without a single-task window.

Each group of more rows than a task should order is cut into value ranges at borders from its own quantile sketch, and a range that is
still too large is cut again at its own. So the number of ranges follows the rows of a group, whatever band its values lie in.
The per-range sums are few, so their prefix sums are cheap; the exact order is then settled inside each
range, one task per range. Results do not depend on where the range borders fall. Input without a
known range is stored once, since it is counted, sketched, summed and joined.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from serieskit.session import materialize

# Rows of one range that a task orders.
RANGE_ROWS = 100_000
# Ranges that a too large one is cut into, a power of two, and the size of the sketch that gives their borders.
FAN, SKETCH_SIZE = 256, 1024
# Bits of a draw, whose even spread gives its range directly.
DRAW_BITS = 32
_RANGE = "_range"


def levels_for(rows: int) -> int:
    """Halvings of the range of a draw until a part holds about RANGE_ROWS of ``rows``."""
    return min(DRAW_BITS, max(0, ceil(log2(max(1, rows) / RANGE_ROWS))))


def with_range(df: DataFrame, by: Sequence[str], order: str, range_rows: int | None = None, range_of: Column | None = None) -> DataFrame:
    """Add the number of the value range of ``order`` within the group; ranges are numbered in the order of their values.

    ``range_of`` gives the range directly where an even, order-keeping one is known. Copies of one value stay in one range.
    """
    if range_of is not None:
        return df.withColumn(_RANGE, range_of)
    most = range_rows or RANGE_ROWS
    # Groups of one hash would share borders, which is as good.
    ranged = df.withColumn("_group", F.xxhash64(*by) if by else F.lit(0).cast("bigint")).withColumn(_RANGE, F.lit(0).cast("bigint"))
    value = F.col(order).cast("double")
    ranks = F.array(*[F.lit(i / FAN) for i in range(1, FAN)])
    while True:
        found = ranged.groupBy("_group", _RANGE).agg(F.count("*").alias("n"), F.min(order).alias("low"), F.max(order).alias("high"))
        large = found.where((F.col("n") > most) & (F.col("low") < F.col("high"))).select("_group", _RANGE)
        if large.isEmpty():
            return ranged.drop("_group")
        hot = ranged.join(materialize(large), ["_group", _RANGE], "left_semi").groupBy("_group", _RANGE)
        sketched = hot.agg(F.kll_sketch_agg_double(value, F.lit(SKETCH_SIZE)).alias("s"), F.max(value).alias("most"))
        borders = F.filter(F.kll_sketch_get_quantile_double("s", ranks), lambda b: b < F.col("most"))
        cut = materialize(sketched.select("_group", _RANGE, borders.alias("_borders"), F.col("most").alias("_most")))
        ranged = ranged.join(cut, ["_group", _RANGE], "left").withColumn("_digit", F.lit(0).cast("bigint"))
        for step in [FAN >> i for i in range(1, FAN.bit_length())]:
            above = F.coalesce(F.get("_borders", (F.col("_digit") + (step - 1)).cast("int")) < value, F.lit(False))
            ranged = ranged.withColumn("_digit", F.col("_digit") + F.when(above, step).otherwise(0))
        # Where the largest value fills all of the range but a few rows, its copies go on their own.
        digit = F.when((F.size("_borders") == 0) & (value >= F.col("_most")), 1).otherwise(F.col("_digit"))
        ranged = ranged.withColumn(_RANGE, F.col(_RANGE) * FAN + digit).drop("_digit", "_borders", "_most")


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    sums: Sequence[str],
    ties: Sequence[str] = (),
    only: Callable[[Column, Column, Column], Column] | None = None,
    range_rows: int | None = None,
    range_of: Column | None = None,
) -> DataFrame:
    """Add ``<s>_before`` (sum over the rows ordered earlier) and ``<s>_total`` for each sum.

    ``only`` may drop whole value ranges early; it receives a range's start, its own sum
    and the group total of the first column in ``sums``.
    """
    by = list(by)
    df = materialize(df) if range_of is None else df
    ranged = with_range(df, by, order, range_rows, range_of)
    earlier = W.partitionBy(*by).orderBy(_RANGE).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*by)
    starts = ranged.groupBy(*by, _RANGE).agg(*[F.sum(s).alias(s) for s in sums])
    starts = starts.select(
        *by,
        _RANGE,
        F.col(sums[0]).alias("_own"),
        *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"_{s}_start") for s in sums],
        *[F.sum(s).over(whole).alias(f"{s}_total") for s in sums],
    )
    if only is not None:
        starts = starts.where(only(F.col(f"_{sums[0]}_start"), F.col("_own"), F.col(f"{sums[0]}_total")))
    inside = W.partitionBy(*by, _RANGE).orderBy(order, *ties).rowsBetween(W.unboundedPreceding, -1)
    joined = ranged.join(starts.drop("_own"), [*by, _RANGE])
    return joined.select(
        *df.columns,
        *[(F.col(f"_{s}_start") + F.coalesce(F.sum(s).over(inside), F.lit(0))).alias(f"{s}_before") for s in sums],
        *[f"{s}_total" for s in sums],
    )


def values_at(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    positions: dict[str, Callable[[Column], Column]],
    range_rows: int | None = None,
    range_of: Column | None = None,
) -> DataFrame:
    """Per group the values at given 0-based sorted positions; a position is a function of the count."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))

    def covers(start: Column, own: Column, total: Column) -> dict[str, Column]:
        return {name: (start <= at(total)) & (at(total) < start + own) for name, at in positions.items()}

    def wanted(start: Column, own: Column, total: Column) -> Column:
        hits = list(covers(start, own, total).values())
        out = hits[0]
        for hit in hits[1:]:
            out = out | hit
        return out

    ranked = running_totals(counts, by, value, ["_n"], only=wanted, range_rows=range_rows, range_of=range_of)
    hit = covers(F.col("_n_before"), F.col("_n"), F.col("_n_total"))
    picks = [F.max(F.when(cond, F.col(value))).alias(name) for name, cond in hit.items()]
    return ranked.groupBy(*by).agg(F.max("_n_total").alias("_n_total"), *picks)


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probabilities: dict[str, float], range_rows: int | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation between the two neighbours."""
    positions = {}
    for name, p in probabilities.items():
        positions[f"_lo_{name}"] = lambda n, p=p: F.floor(F.lit(float(p)) * (n - 1))
        positions[f"_hi_{name}"] = lambda n, p=p: F.ceil(F.lit(float(p)) * (n - 1))
    found = values_at(df, by, value, positions, range_rows)
    out = []
    for name, p in probabilities.items():
        place = F.lit(float(p)) * (F.col("_n_total") - 1)
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return found.select(*by, *out)


def ranked(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    ties: Sequence[str],
    below: Callable[[Column], Column] | None = None,
    range_of: Column | None = None,
) -> DataFrame:
    """Add the 0-based ``position`` of each row in its group and the group ``size``.

    With ``below`` (a function of the group size) only rows placed before it are kept, and
    ranges past it are never sorted.
    """
    only = (lambda start, own, total: start < below(total)) if below else None
    out = running_totals(df.withColumn("_one", F.lit(1).cast("bigint")), by, order, ["_one"], ties, only, range_of=range_of)
    out = out.withColumnRenamed("_one_before", "position").withColumnRenamed("_one_total", "size").drop("_one")
    return out.where(F.col("position") < below(F.col("size"))) if below else out
