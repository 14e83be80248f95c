"""What the layout of stored tables and plans promise: one raw scan, no exchange over a laid-out panel, pruned folders."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from serieskit.config import PriceConfig
from serieskit.operators import clean, panel, profiles as P

CFG = PriceConfig(commodities=("Onion", "Potato"), start_date="2021-01-01", end_date="2023-12-31", min_observations=4)


@pytest.fixture(scope="module")
def raw(spark):
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame({
        "commodity": rng.choice(["onion ", "Potato", "salt"], n), "state": rng.choice(["A", "B", ""], n, p=[0.5, 0.45, 0.05]), "district": "D",
        "market": rng.choice([f"M{i}" for i in range(4)], n), "variety": rng.choice(["x", "y"], n), "grade": "g",
        "date": (pd.Timestamp("2020-12-01") + pd.to_timedelta(rng.integers(0, 1200, n), "D")).date, "price": rng.integers(1, 9, n) * 10.0,
        "minimum": 5.0, "maximum": rng.choice([90.0, 20.0], n), "source_file": rng.choice(["a", "b"], n),
    })
    return spark.createDataFrame(pd.concat([pdf, pdf[:200]]))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_manifest_and_records_come_from_one_stored_table(raw):
    judged = clean.judge(clean.standardize(raw, CFG, ["source_file"]), CFG)
    stored = clean.store_judged(judged, ["source_file"])
    assert sorted(map(str, clean.sound_records(stored).collect())) == sorted(map(str, clean.sound_records(judged).collect()))
    found = {r["source_file"]: r for r in clean.manifest(stored, "source_file").collect()}
    rows = judged.toPandas()
    for name, part in rows.groupby("source_file"):
        kept = part[part.state_of_row == "kept"]
        assert found[name]["raw_rows_scanned"] == len(part) and found[name]["invalid_rows"] == (part.state_of_row == "invalid").sum()
        assert found[name]["valid_rows"] == len(kept[clean.RECORD].drop_duplicates())
        assert found[name]["exact_duplicate_rows"] == len(kept) - found[name]["valid_rows"]
    for frame in (clean.manifest(stored, "source_file"), clean.sound_records(stored)):
        plan = plan_of(frame)
        assert plan.count("FileScan parquet") == 1 and "ExistingRDD" not in plan


def test_profiles_over_the_laid_out_panel_need_no_exchange(raw):
    records = clean.sound_records(clean.store_judged(clean.judge(clean.standardize(raw, CFG), CFG)))
    plain = panel.daily_medians(records)
    days = panel.stored_days(records, buckets=6)
    assert sorted(map(str, days.drop("year").collect())) == sorted(map(str, plain.collect()))
    daily = panel.with_dominance(days)
    for frame in (daily, P.profile_features(daily, CFG), P.consecutive_returns(daily), P.stale_runs(daily)):
        assert "Exchange" not in plan_of(frame).replace("BroadcastExchange", "")
    wanted = P.profile_features(plain.join(panel.dominant_varieties(plain), panel.PLACE, "left"), CFG)
    one, two = (sorted(tuple(r) for r in df.collect()) for df in (P.profile_features(daily, CFG), wanted))
    assert len(one) == len(two) > 10
    for a, b in zip(one, two):
        assert a == pytest.approx(b, rel=1e-12, nan_ok=True) if not any(isinstance(v, str) for v in a) else [v for v in a if isinstance(v, str)] == [v for v in b if isinstance(v, str)]


def test_a_year_reads_only_its_folder(raw):
    records = clean.sound_records(clean.store_judged(clean.judge(clean.standardize(raw, CFG), CFG)))
    days = panel.stored_days(records, buckets=3)
    some = panel.in_years(days, 2022, 2022)
    assert "PartitionFilters: [isnotnull(year" in plan_of(some)
    assert {f.rsplit("/", 2)[-2] for f in some.inputFiles()} >= {"year=2022"} and some.agg(F.min("date"), F.max("date")).first()[0].year == 2022
    assert some.count() == days.where(F.year("date") == 2022).count() > 0


def test_an_empty_panel_is_laid_out(raw):
    empty = clean.sound_records(clean.store_judged(clean.judge(clean.standardize(raw.limit(0), CFG), CFG)))
    assert panel.with_dominance(panel.stored_days(empty)).count() == 0
