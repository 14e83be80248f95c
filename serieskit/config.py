"""Run settings. Every threshold an operator uses is a field here, never a literal in its code."""

from __future__ import annotations

from dataclasses import dataclass, fields
from typing import Any

# Logical column -> accepted headers, in order of preference.
PRICE_ALIASES = {
    "state": ["state", "state name"],
    "district": ["district", "district name"],
    "market": ["market", "market name", "mandi"],
    "commodity": ["commodity", "commodity name"],
    "date": ["arrival date", "price date", "date", "reported date"],
    "price": ["modal price", "modalprice"],
    "minimum": ["min price", "minimum price"],
    "maximum": ["max price", "maximum price"],
    "variety": ["variety"],
    "grade": ["grade"],
}
PRICE_OPTIONAL = ("variety", "grade", "minimum", "maximum")
DEMAND_ALIASES = {
    "timestamp": ["datetime", "timestamp", "date time"],
    "demand": ["power demand", "Delhi demand", "demand", "load"],
    "temperature": ["temp", "temperature"],
    "humidity": ["rhum", "humidity", "relative humidity"],
    "dew_point": ["dwpt", "dew point"],
    "wind_speed": ["wspd", "wind speed"],
    "pressure": ["pres", "pressure"],
}
DEMAND_OPTIONAL = ("dew_point", "wind_speed", "pressure")
SERIES_KEYS = ("state", "district", "market", "variety", "grade")
PLACE_KEYS = ("state", "district", "market")
BASE_FEATURES = ("price_cv", "return_volatility", "sharp_drop_fraction", "monthly_variation_cv")
SPREAD_FEATURE = "median_relative_spread"
RESTART_SEEDS = (7, 21, 84, 123, 2026)
SENSITIVITY_CLIPS = (0.0, 0.01, 0.02)
SPREAD_MISSING_LIMIT = 0.20
DROP_DEFINITIONS = (0.05, 0.10, 0.15)
SEPARATION_CUTOFFS = (-0.10, 0.0, 0.10)
COVERAGE_CUTOFFS = (0.25, 0.35, 0.50)
ALERT_CUTOFFS = (0.2, 0.35, 0.5, 0.8)
POLICY_QUANTILES = (0.85, 0.90, 0.95)
TEMPERATURE_SHIFTS = (-3, 0, 3)
# End of fixed values.


class _Settings:
    @classmethod
    def from_dict(cls, values: dict[str, Any]):
        """Build from a plain dict; keys that only tune some other engine are ignored."""
        known = {f.name for f in fields(cls)}
        picked = {k: tuple(v) if isinstance(v, list) else v for k, v in values.items() if k in known}
        if "commodity" in values and "commodities" not in values and "commodities" in known:
            picked["commodities"] = (values["commodity"],)
        return cls(**picked)


@dataclass(frozen=True)
class PriceConfig(_Settings):
    input_root: str = "."
    input_path: str | None = None
    output_dir: str = "price_results"
    commodities: tuple[str, ...] = ("Onion", "Potato", "Tomato")
    start_date: str = "2022-01-01"
    end_date: str = "2024-12-31"
    min_observations: int = 180
    min_calendar_coverage: float = 0.25
    min_months: int = 18
    min_year_observations: int = 60
    min_daily_returns: int = 60
    drop_fraction: float = 0.10
    max_clusters: int = 6
    min_cluster_fraction: float = 0.02
    stability_repeats: int = 10
    clip_quantile: float = 0.01
    kmeans_starts: int = 20
    kmeans_iterations: int = 300
    min_profiles: int = 10

    def __post_init__(self):
        folded = [c.strip().lower() for c in self.commodities]
        if len(set(folded)) != len(folded):
            raise ValueError("commodity names must be unique")


@dataclass(frozen=True)
class DemandConfig(_Settings):
    input_root: str = "."
    input_path: str | None = None
    output_dir: str = "demand_results"
    peak_quantile: float = 0.90
    bootstrap_repeats: int = 100
    rolling_backtests: bool = True
    step_seconds: int = 300
    lag_minutes: tuple[int, ...] = (5, 15, 30, 60, 1440, 10080)
    rolling_minutes: tuple[int, ...] = (30, 60, 180)
    change_minutes: int = 30
    horizon_steps: int = 12
    day_minutes: int = 1440
    week_minutes: int = 10080
    min_examples: int = 5000
    train_fraction: float = 0.70
    validation_fraction: float = 0.85
    embargo_seconds: int = 3600
    min_bootstrap_days: int = 8
    min_backtest_rows: int = 500
    local_zone: str = "Asia/Kolkata"
    max_bins: int = 64
    max_interaction_bins: int = 16
    additive_iterations: int = 100
    logistic_iterations: int = 1500
    jump_fraction: float = 0.30

    def steps(self, minutes: int) -> int:
        return minutes * 60 // self.step_seconds
