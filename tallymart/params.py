"""Parameters and label tables of the order analytics."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Labels and texts that appear in results.
COMPLETED = "已完成"
UNKNOWN = "未知"
WEEKEND_LABEL = "周末"
WORKDAY_LABEL = "工作日"
DAY_LABELS = ("周一", "周二", "周三", "周四", "周五", "周六", "周日")
ALL = "all"

SEGMENT_HIGH_VALUE = "高价值客户"
SEGMENT_HIGH_FREQUENCY = "高频客户"
SEGMENT_CHURN_RISK = "流失风险"
SEGMENT_LOW_ACTIVITY = "低活跃客户"
SEGMENT_POTENTIAL = "潜力客户"

INSIGHT_FINDING = "发现"
INSIGHT_ADVICE = "建议"


@dataclass(frozen=True)
class Params:
    """Effective defaults of every operator that can be tuned."""

    completed_status: str = COMPLETED
    unknown_label: str = UNKNOWN

    # Which copy of an order is the first; a load sequence column may be named here.
    duplicate_order: tuple[str, ...] = ("order_date",)
    # Forms of a date besides ISO; the first that fits counts.
    date_forms: tuple[str, ...] = ("yyyy/M/d[ H:mm[:ss]]", "M/d/yyyy[ H:mm[:ss]]", "yyyyMMdd")
    iqr_multiplier: float = 3.0
    max_discount_rate: float = 0.5
    default_quantity: int = 1

    forecast_days: int = 90
    season_length: int = 7
    alphas: tuple[float, ...] = (0.1, 0.2, 0.3, 0.5)
    betas: tuple[float, ...] = (0.01, 0.05, 0.1)
    gammas: tuple[float, ...] = (0.05, 0.1, 0.2, 0.3)

    moving_average_days: tuple[int, ...] = (7, 30)
    score_bins: int = 5
    rfm_weights: tuple[float, float, float] = (0.3, 0.3, 0.4)
    top_n: int = 100
    as_of: dt.date | None = None  # None: the current date

    n_clusters: int = 5
    cluster_restarts: int = 10
    cluster_iterations: int = 300
