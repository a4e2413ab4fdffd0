"""Project parameters, passed explicitly to every model.

The warehouse thresholds and dates are fixed values of the original project
configuration; the review thresholds are the cut points its SQL uses.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # ---- fixed values: warehouse project variables -------------------------
    start_date: dt.date = dt.date(2023, 1, 1)
    end_date: dt.date = dt.date(2023, 12, 31)
    high_value_customer_threshold: float = 1000.0
    medium_value_customer_threshold: float = 500.0
    low_value_customer_threshold: float = 100.0
    excellent_roas_threshold: float = 4.0
    good_roas_threshold: float = 2.0
    breakeven_roas_threshold: float = 1.0
    high_engagement_score: float = 70.0
    medium_engagement_score: float = 40.0
    # ---- fixed value: the source tag written on every ingested review --------
    data_source: str = "kaggle_google_play_store"
    # ---- our choices --------------------------------------------------------
    as_of: dt.date = dt.date(2024, 1, 31)      # replaces CURRENT_DATE
    session_gap_minutes: int = 720             # sessionization gap
    recent_days: int = 30                      # user_engagement_metrics window
    seed: int = 42


DEFAULT = Params()

# Parameters the registered warehouse queries run with: the driver tables put
# orders and shipments in 1995-2001, so the spine covers 1998.
FIXTURE = Params(start_date=dt.date(1998, 1, 1), end_date=dt.date(1998, 12, 31),
                 as_of=dt.date(2024, 1, 31))


@dataclass(frozen=True)
class ReviewParams:
    valid_sentiments: tuple = ("Positive", "Negative", "Neutral")
    min_text_length: int = 3
    outlier_quantile: float = 0.95
    zscore_threshold: float = 2.0
    example_count: int = 3
    preview_rows: int = 10


REVIEWS = ReviewParams()
