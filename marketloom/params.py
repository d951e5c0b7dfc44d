"""Every threshold of the analyses, with its default, in one immutable object."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # None means: the newest completed order day found in the data.
    analysis_date: dt.date | None = None
    # Reference midnight of the 24-hour-period recency (K2, R1); None as above.
    reference_date: dt.date | None = None
    churn_days: int = 90
    volume_high: int = 5000
    volume_medium: int = 1000
    retention_month: int = 3
    score_groups: int = 5
    pair_min_count: int = 5
    pair_limit: int = 50
    # Most products of one order that meet in one task (H5); more are split over tasks.
    pair_block: int = 512
    churned_limit: int = 100
    forest_trees: int = 200
    forest_depth: int = 8
    # Training rows per task; the number of tasks grows with the rows, and the bootstrap depends on it.
    forest_rows_per_part: int = 20_000
    seed: int = 42
    test_share: float = 0.25
    risk_low: float = 0.3
    risk_high: float = 0.6
    anomaly_window: int = 30
    anomaly_min_rows: int = 15
    anomaly_limit: float = 2.5
    holdout_days: int = 60
    horizon_days: int = 90
    band_sigma: float = 1.96
    alpha: float = 0.05
    business_bar_points: float = 1.0
    histogram_bins: int = 50
    histogram_quantile: float = 0.99
    evidence_rows: int = 30
    sample_rows: int = 20
    evidence_budget: int = 120_000


DEFAULTS = Params()
