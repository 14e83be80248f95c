"""Record cleaning. Rows are judged first and counted from the judgement, so one scan serves both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from serieskit.config import PLACE_KEYS, SERIES_KEYS, PriceConfig
from serieskit.functions import scalars as S
from serieskit.session import materialize
from serieskit.sources.columns import dtype_of

RECORD = ["commodity", *SERIES_KEYS, "date", "price", "relative_spread"]


def standardize(raw: DataFrame, cfg: PriceConfig, keep: Sequence[str] = ()) -> DataFrame:
    """Resolved raw records -> typed, cleaned columns; nothing is removed yet."""
    have = set(raw.columns)
    keys = {k: S.clean_key(F.col(k)) if k in have else F.lit("unspecified") for k in PLACE_KEYS}
    for k in SERIES_KEYS[len(PLACE_KEYS):]:
        keys[k] = S.clean_or_default(F.col(k)) if k in have else F.lit("unspecified")
    numbers = {
        n: S.as_number(F.col(n), dtype_of(raw, n)) if n in have else F.lit(None).cast("double")
        for n in ("price", "minimum", "maximum")
    }
    return raw.select(
        S.spelling(F.col("commodity"), cfg.commodities).alias("commodity"),
        *[c.alias(k) for k, c in keys.items()],
        S.parse_date(F.col("date"), dtype_of(raw, "date")).alias("date"),
        *[c.alias(n) for n, c in numbers.items()],
        *keep,
    )


def judge(records: DataFrame, cfg: PriceConfig) -> DataFrame:
    """Add the step at which each record leaves, and the relative spread of sound ranges."""
    between = F.col("date").between(F.lit(cfg.start_date).cast("date"), F.lit(cfg.end_date).cast("date"))
    inside = F.coalesce(between, F.lit(False))
    missing = F.col("price").isNull() | (F.col("price") <= 0)
    for k in PLACE_KEYS:
        missing = missing | F.col(k).isNull() | (F.col(k) == "")
    broken = S.range_violation(F.col("price"), F.col("minimum"), F.col("maximum"))
    state = (
        F.when(F.col("commodity").isNull(), "other commodity")
        .when(F.col("date").isNull(), "unreadable date")
        .when(~inside, "outside window")
        .when(missing, "invalid")
        .when(broken, "inconsistent")
        .otherwise("kept")
    )
    spread = F.when(F.col("price") > 0, (F.col("maximum") - F.col("minimum")) / F.col("price"))
    # The window is left as plain bounds here, so that a stored date column is filtered by the scan.
    sound = F.col("commodity").isNotNull() & between & ~missing & ~broken
    return records.withColumn("state_of_row", state).withColumn("is_sound", sound).withColumn("relative_spread", spread)


def store_judged(judged: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every row's state (and the columns of ``keep``) in one stored table, with the record itself where it is sound.

    The raw data are scanned once for records and counters alike; later reads take the columns they need from here.
    """
    sound = F.col("is_sound")
    return materialize(judged.select(*keep, "state_of_row", "is_sound", *[F.when(sound, F.col(c)).alias(c) for c in RECORD]))


def sound_records(judged: DataFrame) -> DataFrame:
    """Kept rows over the nine clean columns; copies are still in."""
    return judged.where("is_sound").select(*RECORD)


def distinct_records(judged: DataFrame) -> DataFrame:
    """Sound records without copies; NULL equals NULL."""
    return sound_records(judged).dropDuplicates()


def manifest(stored: DataFrame, source: str) -> DataFrame:
    """Counters per source of a table by ``store_judged``. A record is shuffled as 128 bits of hash, copies are counted per
    distinct record first, and no source or group of copies has to fit one task."""
    state = F.col("state_of_row")
    kept = state == "kept"
    # Only the spread may be missing in a sound record, and it comes last, so hashes that skip missing values do not mix columns up.
    name = [F.when(kept, F.xxhash64(F.lit(salt), *RECORD)).alias(f"_name{salt}") for salt in (1, 2)]
    cells = stored.groupBy(source, "state_of_row", *name).agg(F.count("*").alias("rows"))

    def total(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("rows"))), F.lit(0)).cast("bigint")

    return cells.groupBy(source).agg(
        F.sum("rows").cast("bigint").alias("raw_rows_scanned"),
        total(state != "other commodity").alias("commodity_rows"),
        total(state == "unreadable date").alias("unreadable_date_rows"),
        total(~state.isin("other commodity", "unreadable date", "outside window")).alias("window_rows"),
        total(state == "invalid").alias("invalid_rows"),
        total(state == "inconsistent").alias("inconsistent_price_rows"),
        F.sum(F.when(kept, F.col("rows") - 1).otherwise(0)).cast("bigint").alias("exact_duplicate_rows"),
        F.sum(F.when(kept, 1).otherwise(0)).cast("bigint").alias("valid_rows"),
    )
