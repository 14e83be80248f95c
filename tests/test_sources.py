"""File discovery, readers, sinks and the two complete runs."""

import json
from dataclasses import replace
from datetime import datetime, timedelta
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from serieskit.config import DEMAND_ALIASES, DEMAND_OPTIONAL, PRICE_ALIASES, DemandConfig, PriceConfig
from serieskit.operators import cluster as K, grid as G
from serieskit.plans import demand as D, price as R
from serieskit.sources import discovery, readers, sinks
from serieskit.sources.columns import find_column, plain, resolve

COLUMNS = ["State Name", "District", "Market_Name", "Commodity", "Price Date", "Modal Price", "Min Price", "Max Price", "Variety", "Grade"]


def test_header_binding():
    assert plain(" Modal_Price (Rs.) ") == "modalpricers"
    assert find_column(["x", "MODAL PRICE", "modal-price"], ["modal price"]) == "modal-price"
    assert find_column(["x"], ["modal price"], required=False) is None
    with pytest.raises(ValueError):
        find_column(["x"], ["modal price"])


def write_prices(folder: Path):
    one = pd.DataFrame([["A", "D", "M", "Onion", "2022-01-01", "1,000", "900", "1,100", "V", "FAQ"]], columns=COLUMNS)
    one.to_csv(folder / "2022.csv", index=False)
    one.to_parquet(folder / "2022.parquet", index=False)
    one.to_csv(folder / "2019.csv", index=False)
    one.rename(columns={"Modal Price": "modalprice"}).drop(columns=["Variety", "Min Price"]).to_csv(folder / "more.csv", index=False)
    pd.DataFrame({"a": [1]}).to_csv(folder / "other.csv", index=False)
    (folder / "broken.parquet").write_bytes(b"not parquet")


def test_discovery_rules(spark, tmp_path):
    write_prices(tmp_path)
    aliases = PRICE_ALIASES["price"]
    with pytest.warns(UserWarning, match="broken"):
        files = discovery.discover(spark, str(tmp_path), aliases, prefer_parquet=True, years=(2022, 2024))
    assert [f.path.rsplit("/", 1)[-1] for f in files] == ["2022.parquet", "more.csv"]
    assert [f.size for f in files] == [(tmp_path / n).stat().st_size for n in ("2022.parquet", "more.csv")]
    named = discovery.discover(spark, str(tmp_path), aliases, str(tmp_path / "2019.csv"), years=(2022, 2024))
    assert [f.stem for f in named] == ["2019"]
    with pytest.raises(ValueError), pytest.warns(UserWarning):
        discovery.discover(spark, str(tmp_path), aliases, single=True)
    with pytest.raises(FileNotFoundError), pytest.warns(UserWarning):
        discovery.discover(spark, str(tmp_path), DEMAND_ALIASES["demand"])


def test_many_heads_take_one_job(spark, tmp_path):
    """Three hundred files of several headers, with names and contents that need care, one job for all heads and none for footers."""
    for i in range(300):
        head = ["Modal Price,State", "modal_price,\"A, b\",State", "Modal Price,x,x,"][i % 3]
        (tmp_path / (f"a b+{i}%.csv" if i % 7 == 0 else f"{i}.csv")).write_text(head + "\n" + "1,2,3\n" * (20000 if i < 3 else 1))
    (tmp_path / "empty.csv").write_text("")
    pd.DataFrame({"modal price": [1.0], "y": [2]}).to_parquet(tmp_path / "p.parquet", index=False)
    spark.sparkContext.setJobGroup("heads", "heads")
    paths = [p for p, _ in discovery.listing(spark, str(tmp_path))]
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("heads"))
    heads = discovery.csv_heads(spark, [p for p in paths if p.endswith(".csv")])
    middle = len(spark.sparkContext.statusTracker().getJobIdsForGroup("heads"))
    footers = discovery.parquet_heads(spark, [p for p in paths if p.endswith(".parquet")])
    after = len(spark.sparkContext.statusTracker().getJobIdsForGroup("heads"))
    spark.sparkContext.setJobGroup("", "")
    # Spark lists so many paths by a job of its own.
    assert middle - before <= 2 and after == middle and len(heads) == 300 and list(footers.values()) == [("modal price", "y")]
    for path in list(heads)[:40]:
        assert heads[path] == tuple(spark.read.options(**discovery.CSV).csv(path).columns)


def test_mixed_headers_become_one_frame(spark, tmp_path):
    write_prices(tmp_path)
    with pytest.warns(UserWarning):
        files = discovery.discover(spark, str(tmp_path), PRICE_ALIASES["price"], prefer_parquet=True, years=(2022, 2024))
    df = readers.read_aliased(spark, files, PRICE_ALIASES, ("variety", "grade", "minimum", "maximum"))
    rows = sorted((r["source_file"].rsplit("/", 1)[-1], r["price"], r["variety"], r["minimum"]) for r in df.collect())
    assert rows == [("2022.parquet", "1,000", "V", "900"), ("more.csv", "1,000", None, None)]


def test_csv_words_for_missing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Modal Price,State\nNA,x\n12,null\n")
    df = readers.scan_csv_text(spark, [str(tmp_path / "a.csv")], ["Modal Price", "State"])
    assert [tuple(r) for r in df.collect()] == [(None, "x"), ("12", None)]


def test_json_sink(spark, tmp_path):
    df = spark.createDataFrame([(float("nan"), float("inf"), 1.5, datetime(2022, 1, 1))], "a double, b double, c double, t timestamp_ntz")
    sinks.write_json(df, str(tmp_path / "j"))
    text = "".join(f.read_text() for f in (tmp_path / "j").glob("*.json"))
    assert json.loads(text) == {"a": None, "b": None, "c": 1.5, "t": "2022-01-01 00:00:00"}


def test_key_value_table(spark):
    out = sinks.key_values(spark.createDataFrame([(1, "x")], "rows int, name string")).collect()
    assert [tuple(r) for r in out] == [("rows", "1"), ("name", "x")]


def market_history(folder: Path, markets=14, days=240):
    rng = np.random.default_rng(7)
    rows = []
    for c in ("Onion", "Potato"):
        for m in range(markets):
            noise = 0.02 if m % 2 else 0.2
            price = 1000.0
            for d in range(days):
                price = max(200.0, 1000 + (price - 1000) * 0.5 + rng.normal(0, 1000 * noise))
                day = (datetime(2022, 1, 1) + timedelta(days=d)).strftime("%d/%m/%Y")
                rows.append(["A", "D", f"M{m}", c, day, f"{price:,.2f}", f"{price * 0.9:.2f}", f"{price * (1.05 + noise):.2f}", "", "FAQ"])
    frame = pd.DataFrame(rows, columns=COLUMNS)
    frame.iloc[: len(frame) // 2].to_csv(folder / "2022.csv", index=False)
    frame.iloc[len(frame) // 2:].to_parquet(folder / "rest.parquet", index=False)


def test_price_run(spark, tmp_path):
    market_history(tmp_path)
    cfg = {
        "input_root": str(tmp_path), "output_dir": str(tmp_path / "out"), "commodities": ["Onion", "Potato"], "start_date": "2022-01-01",
        "end_date": "2022-12-31", "chunksize": 10, "min_observations": 100, "min_months": 6, "kmeans_starts": 2, "stability_repeats": 2, "max_clusters": 3,
    }
    out = R.run_price(spark, cfg)
    overview = {r["commodity"]: r for r in out["commodity_overview"].collect()}
    assert set(overview) == {"Onion", "Potato"}
    for r in overview.values():
        assert (r["groups"], r["eligible_profiles"], r["retained_daily_records"]) == (2, 14, 14 * 240)
        assert 0 < r["mean_subsampling_ARI"] <= 1 and 0 < r["price_feature_ARI"] <= 1
    groups = {r["group_description"] for r in out["group_summary"].collect()}
    assert groups == {"Volatility group 1/2 (low to high)", "Volatility group 2/2 (low to high)"}
    same = [r for r in out["clipping_sensitivity"].collect() if r["clip_quantile_each_tail"] == 0.01]
    assert all(r["ARI_vs_main"] == pytest.approx(1.0) for r in same)
    checks = {r["check"]: r["value"] for r in out["data_quality"].collect()}
    assert checks["raw_rows_scanned_once"] == str(2 * 14 * 240)
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "group_stability")).count() == 2 * (5 + 2)
    model = R.load_model(spark, str(tmp_path / "out" / "model"))
    given = out["market_profiles"]
    again = R.label_new(given.drop("cluster", "distance", "silhouette", "weak_separation", "group_description", "profile_was_clipped"), model)
    both = again.select("series_id", F.col("cluster").alias("c"), F.col("group_description").alias("g")).join(given, "series_id")
    assert both.where("c = cluster and g = group_description").count() == given.count() == 28
    assert out["profile_projection"].where("explained_share between 0 and 1").groupBy("commodity").count().count() == 2
    parts = [pd.read_csv(f) for f in sorted((tmp_path / "out" / "market_profiles").glob("part-*.csv"))]
    written = pd.concat([f for f in parts if len(f)])[["commodity", "cluster", "series_id"]].to_numpy().tolist()
    assert len(written) == 28 and written == sorted(written)


def test_quoted_cells_and_awkward_names(spark, tmp_path):
    folder = tmp_path / "in put+1"
    folder.mkdir()
    head = ",".join(COLUMNS)
    (folder / "my prices.csv").write_text(f'{head}\nA,"D ""x"", y",M,Onion,02/01/2022 10:00,"1,000",900,"1,100",V,F\nA,D,M,Onion,soon,1,1,1,V,F\n')
    (folder / "plain.csv").write_text(f"{head}\nA,D,M,Onion,3 February 2022,500,400,600,V,F\n")
    cfg = PriceConfig(input_root=str(folder), commodities=("Onion",), start_date="2022-01-01", end_date="2022-12-31")
    built = R.panel_from_files(spark, cfg)
    rows = {r["source_file"].rsplit("/", 1)[-1]: r for r in built["manifest"].collect()}
    assert (rows["my prices.csv"]["raw_rows_scanned"], rows["my prices.csv"]["valid_rows"], rows["my prices.csv"]["unreadable_date_rows"]) == (2, 1, 1)
    assert rows["plain.csv"]["valid_rows"] == 1
    assert {(r["district"], r["price"], str(r["date"])) for r in built["panel"].collect()} == {('d "x", y', 1000.0, "2022-01-02"), ("d", 500.0, "2022-02-03")}


@pytest.mark.parametrize("repeats", [0, 70])
def test_resamples_have_their_exact_size(spark, repeats):
    matrix = spark.range(40).select(F.lit("a").alias("commodity"), F.col("id").cast("string").alias("series_id"), F.array(F.col("id") * 1.0).alias("x"))
    if not repeats:
        assert K.words_for(0) == 1
        return
    mask = R._resample_mask(matrix, {"a": 40}, {"a": 2}, repeats).collect()
    sizes = [sum((r["mask"][i // K.WORD_BITS] >> (i % K.WORD_BITS)) & 1 for r in mask) for i in range(repeats)]
    assert sizes == [32] * repeats


def test_price_run_refuses_missing_commodity(spark, tmp_path):
    market_history(tmp_path, markets=2, days=3)
    cfg = PriceConfig(input_root=str(tmp_path), output_dir=str(tmp_path / "out"), commodities=("Onion", "Garlic"))
    with pytest.raises(ValueError, match="eligible|Garlic"):
        R.run_price(spark, cfg)
    with pytest.raises(ValueError):
        PriceConfig(commodities=("Onion", "onion"))


def test_demand_run(spark, tmp_path):
    i = np.arange(9000)
    rng = np.random.default_rng(8)
    times = [datetime(2022, 1, 1) + timedelta(minutes=5 * int(k)) for k in i]
    load = 3000 + 500 * np.sin(i / 288 * 2 * np.pi) + 200 * np.sin(i / 2016 * 2 * np.pi) + rng.normal(0, 20, len(i))
    temp = 25 + 5 * np.sin(i / 288 * 2 * np.pi)
    frame = pd.DataFrame({"datetime": times, "Power demand": load, "temp": temp, "rhum": 60.0, "dwpt": 10.0})
    frame.loc[::50, "dwpt"] = np.nan
    frame.to_csv(tmp_path / "load.csv", index=False)
    holidays = spark.createDataFrame([(datetime(2022, 1, 26).date(),)], "date date")
    cfg = DemandConfig(input_root=str(tmp_path), output_dir=str(tmp_path / "out"), additive_iterations=20, max_bins=16, min_examples=5000, bootstrap_repeats=20, min_bootstrap_days=3, logistic_iterations=100)
    typed = G.read_demand(resolve(D.read_input(spark, cfg), DEMAND_ALIASES, DEMAND_OPTIONAL), cfg)
    assert str(typed.agg(F.min("timestamp")).first()[0]) == "2022-01-01 00:00:00"
    out = D.run_demand(spark, replace(cfg, rolling_backtests=True), holidays)
    test = {r["model"]: r for r in out["tables"]["model_comparison_test"].collect()}
    assert len(test) == 7
    for name in ("Additive model", "Logistic Regression: weather enhanced", "Shallow Decision Tree"):
        assert test[name]["f1"] > 0.7 and test[name]["roc_auc"] > 0.9
    assert test["Persistence"]["rows"] == out["labelled"].where("split = 'test'").count()
    assert out["tables"]["what_if_temperature"].count() == 9
    assert out["tables"]["day_block_confidence_intervals"].count() == 3
    scores = out["tables"]["test_predictions"].agg(F.min("alert_score"), F.max("alert_score")).first()
    assert 0 <= scores[0] <= scores[1] <= 1
    assert (tmp_path / "out" / "model" / "classifier").exists()


def test_off_grid_readings_are_refused(spark):
    raw = spark.createDataFrame([("2022-01-01 00:00:01", 5.0, 1.0, 1.0)], "datetime string, load double, temp double, rhum double")
    with pytest.raises(ValueError, match="grid"):
        D.prepare(raw, DemandConfig(), spark.createDataFrame([], "date date"))


def test_zoned_readings_move_to_local_time(spark):
    raw = spark.createDataFrame([("2022-01-01 00:00:00Z", "1,200", 1.0, 1.0), ("x", "3", 1.0, 1.0)], "timestamp string, demand string, temperature double, humidity double")
    typed = G.read_demand(raw, DemandConfig()).collect()
    assert (str(typed[0]["timestamp"]), typed[0]["demand"], typed[1]["timestamp"]) == ("2022-01-01 05:30:00", 1200.0, None)
