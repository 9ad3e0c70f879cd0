"""Parameters of the client-signal job.

Every operator takes its thresholds, windows and weights from these frozen
dataclasses, so a single object decides which rows a feature may see (the
leakage barrier) and the defaults reproduce the published method.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


def _d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


@dataclass(frozen=True)
class WindowSpec:
    """Half-open observation and prediction windows on dates.

    ``obs = [obs_start, obs_end)``, ``pred = [pred_start, pred_end)``; without
    ``obs_start`` or ``pred_end`` a window is open on that side.
    ``late_start`` splits the observation window into an early and a late
    part for the late/early activity ratio; ``*_periods`` are the divisors
    that turn counts into per-period rates.
    """

    obs_end: dt.date
    late_start: dt.date
    pred_start: dt.date
    obs_periods: float
    pred_periods: float
    early_periods: float
    late_periods: float
    obs_start: dt.date | None = None
    pred_end: dt.date | None = None

    @property
    def obs_last_day(self) -> dt.date:
        """Closed end of the observation window (recency reference day)."""
        return self.obs_end - dt.timedelta(days=1)


# Windows for the driver's tables (fixed values, see FIXTURES.md section 2).
ORDERS_WINDOWS = WindowSpec(
    obs_end=_d("2000-01-01"),
    late_start=_d("1998-05-01"),
    pred_start=_d("2000-01-01"),
    obs_periods=60.0,
    pred_periods=20.0,
    early_periods=40.0,
    late_periods=20.0,
)

EVENTS_WINDOWS = WindowSpec(
    obs_end=_d("2024-01-22"),
    late_start=_d("2024-01-15"),
    pred_start=_d("2024-01-22"),
    obs_periods=3.0,
    pred_periods=1.0,
    early_periods=2.0,
    late_periods=1.0,
)


@dataclass(frozen=True)
class LabelRules:
    """Label thresholds: disengaged below ``disengage_ratio`` of the
    observation rate (or silent), growth at ``growth_factor`` times it."""

    disengage_ratio: float = 0.20
    growth_factor: float = 1.5


@dataclass(frozen=True)
class TxMapping:
    """How a source table (``format``: parquet or csv) maps onto (customer_id,
    date, type, amount); the key may be a SQL expression. The types come from
    the data unless ``types`` names them."""

    table: str
    customer_id: str
    date: str
    type: str
    amount: str
    windows: WindowSpec
    types: tuple[str, ...] | None = None
    format: str = "parquet"


ORDERS_MAPPING = TxMapping(
    table="orders",
    customer_id="o_custkey",
    date="o_orderdate",
    type="o_orderstatus",
    amount="o_totalprice",
    windows=ORDERS_WINDOWS,
)

EVENTS_MAPPING = TxMapping(
    table="events",
    customer_id="user_id",
    date="ts",
    type="event_type",
    amount="value",
    windows=EVENTS_WINDOWS,
)


# Ordinal category orders of the reference's encoder.
INCOME_ORDER = ("Low", "Medium", "High", "Very High")

# Own cuts of c_acctbal that stand in for the income bracket.
INCOME_CUTS = (2500.0, 5000.0, 7500.0)


@dataclass(frozen=True)
class FeatureSpec:
    """Customer attribute groups fed to the preprocessor."""

    numeric: tuple[str, ...] = ("c_acctbal", "c_nationkey")
    ordinal: dict = field(default_factory=lambda: {"income_bracket": INCOME_ORDER})
    nominal: tuple[str, ...] = ("c_mktsegment",)

    @property
    def all_columns(self) -> list[str]:
        return list(self.numeric) + list(self.ordinal) + list(self.nominal)


@dataclass(frozen=True)
class CustomerMapping:
    """How a customer table (``format``: parquet or csv) maps onto
    ``customer_id``, attributes and ``sanity_score``. Sources are column names
    or SQL expressions; without ``columns`` all other columns are attributes.
    ``ordinal`` gives the category orders; the other attributes are numeric or
    nominal by type."""

    table: str
    customer_id: str
    columns: dict[str, str] | None = None
    ordinal: dict = field(default_factory=dict)
    sanity: str | None = None
    format: str = "parquet"


# The reference's leakage exclusion list (dropped if present).
LEAKAGE_EXCLUDE = (
    "churn_probability", "customer_lifetime_value", "clv_segment",
    "tx_count", "avg_tx_value", "total_tx_volume",
    "monthly_transaction_count", "average_transaction_value",
    "total_transaction_volume", "transaction_frequency",
    "avg_daily_transactions", "weekend_transaction_ratio",
    "preferred_transaction_type", "first_tx", "last_tx",
    "first_transaction_date", "last_transaction_date",
    "base_satisfaction", "tx_satisfaction", "product_satisfaction",
    "last_survey_date", "app_store_rating", "feature_requests",
    "complaint_topics", "customer_segment",
)

# High-cardinality strings dropped before modelling.
DROP_STRINGS = ("location", "occupation", "education_level", "marital_status")


@dataclass(frozen=True)
class SignalParams:
    """Weights and cut-offs of the signal layer."""

    # engagement = w_freq*freq + w_trend*trend + w_rec*(1-recency) + w_gap*(1-gap)
    w_freq: float = 0.35
    w_trend: float = 0.25
    w_recency: float = 0.20
    w_gap: float = 0.20
    risk_floor: float = 0.01
    upsell_bp: float = 0.6
    upsell_rr: float = 0.3
    retention_rr: float = 0.6
    emerging_bp: float = 0.4
    emerging_rr: float = 0.5
    top_n: int = 100


@dataclass(frozen=True)
class SplitSpec:
    """Seeded hash split: buckets [0, train) train, [train, val) validation."""

    seed: int = 42
    train_pct: int = 60
    val_pct: int = 20


@dataclass(frozen=True)
class ModelParams:
    """Hyper-parameters of the three model families (reference defaults)."""

    lr_c: float = 1.0
    lr_max_iter: int = 1000
    rf_trees: int = 300
    rf_depth: int = 8
    rf_min_leaf: int = 20
    gbt_rounds: int = 300
    gbt_depth: int = 4
    gbt_step: float = 0.05
    gbt_subsample: float = 0.8
    gbt_colsample: float = 0.8
    seed: int = 42


@dataclass(frozen=True)
class Fold:
    fold: int
    obs_end: dt.date
    pred_start: dt.date
    pred_end: dt.date
    obs_periods: float
    pred_periods: float


# Expanding-window folds for the orders mapping (FIXTURES.md section 2); they
# all observe from this day on.
ORDERS_FOLDS_START = _d("1995-01-01")
ORDERS_FOLDS = (
    Fold(1, _d("1998-01-01"), _d("1998-01-01"), _d("1999-01-01"), 36.0, 12.0),
    Fold(2, _d("1998-07-01"), _d("1998-07-01"), _d("1999-07-01"), 42.0, 12.0),
    Fold(3, _d("1999-01-01"), _d("1999-01-01"), _d("2000-01-01"), 48.0, 12.0),
    Fold(4, _d("1999-07-01"), _d("1999-07-01"), _d("2000-07-01"), 54.0, 12.0),
    Fold(5, _d("2000-01-01"), _d("2000-01-01"), _d("2001-01-01"), 60.0, 12.0),
)

STABILITY_STD = 0.03
