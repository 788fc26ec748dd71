"""Typed settings with the reference defaults (the YAML config becomes these)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class CleaningParams:
    iqr_factor: float = 3.0
    outlier_cols: tuple[str, ...] = ("unit_price",)
    rating_min: float = 1.0
    rating_max: float = 5.0
    zscore_col: str = "age"
    zscore_limit: float = 3.0
    # fixed values: the imputed columns, in order
    median_cols: tuple[str, ...] = ("age", "unit_price", "discount", "customer_rating", "shipping_days")
    mode_cols: tuple[str, ...] = ("gender", "payment_method", "region", "city", "state", "loyalty_tier")
    date_format: str = "yyyy-MM-dd"
    # numpy rounding (scale, round half to even, unscale); False = half away from zero
    half_even: bool = True
    # how the deduplicated frame is pinned before the global aggregates
    materialize: str = "checkpoint"


@dataclass(frozen=True)
class AbcParams:
    a_threshold: float = 0.70
    b_threshold: float = 0.90


@dataclass(frozen=True)
class ForecastParams:
    n_estimators: int = 200
    max_depth: int = 10
    min_samples_leaf: int = 5
    test_size: float = 0.20
    cv_folds: int = 5
    forecast_months: int = 3
    random_state: int = 42
    max_bins: int = 32
    max_memory_mb: int = 1024      # node statistics a pass may hold: one pass per tree level
    fit_partitions: int = 8        # of the daily frame (days x series); raise it with the series
    band: float = 0.15
    strict_features: bool = False


@dataclass(frozen=True)
class ReportingParams:
    top_n_products: int = 10
    top_k_summary: int = 5
    sample_rows: int = 800
    normality_sample: int = 500
