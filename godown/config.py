"""Parameters of the analytics build.

Thresholds are arguments, never literals inside a query. The calendar of a build comes from its data
(``Calendar.covering``): a flow on a later date moves the end, and none is left out.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

# ---------------------------------------------------------------------------------------------------
# These must equal the definitions the analyses are specified with.
#   carrying rate            0.24 of stock value a year, charged per day as value * 0.24 / 365
#   ABC class boundaries     A below 0.80 of cumulative value before the item, B below 0.95, else C
#   ABC check bands          A share between 0.79 and 0.81, C share at most 0.06
#   feature caps             cover_days 120, pipeline_cover_days 120, stock_to_reorder_point 10,
#                            days to the next festival 60
#   supplier defaults        on-time rate 0.8 and lead-time sd 2 when no delivery in the last 180 days
#   label horizon            14 days after the snapshot
#   risk bands               High at 0.5 or more, Watch at 0.2 or more, else Low
#   reason codes             drop in risk above 0.02, at most two, largest first
#   reason references        median of labelled history, demand_trend 1.0, days to festival 60
#   model choice             logistic regression unless another model beats its ROC AUC by 0.01 or more
#   OTIF band                Under 70%, 70 to 85%, 85% or more
#   high-risk share band     5% or more at high risk, 2 to 5%, Under 2% (Delivery city without snapshots)
#   road distance            great circle on a 6371 km sphere, times 1.3
#   standard transit         max(1, ceil(km / 450)); quoted lead 5 + floor(max km / 600)
#   festive lift             ramp 1 + (lift - 1) * (1 - d / 30) over the 24 days before, then
#                            1 + (lift - 1) * 0.4 * (1 + d / 7) over the 7 days after
#   pre-build look-ahead     days 0, 3, ..., 21; order-up-to = reorder point + 30 days of demand
# ---------------------------------------------------------------------------------------------------
CARRY_RATE = 0.24
ABC_A, ABC_B = 0.80, 0.95
ABC_A_BAND, ABC_C_MAX = (0.79, 0.81), 0.06
COVER_CAP, PIPELINE_COVER_CAP, STOCK_TO_ROP_CAP, FESTIVAL_CAP = 120, 120, 10, 60
SUPPLIER_ON_TIME_DEFAULT, SUPPLIER_LEAD_SD_DEFAULT = 0.8, 2
TRAILING_DAYS = 180
HORIZON_DAYS = 14
RISK_HIGH, RISK_WATCH = 0.5, 0.2
REASON_MIN_DROP, REASON_MAX = 0.02, 2
MODEL_CHOICE_MARGIN = 0.01
EARTH_KM, ROAD_FACTOR = 6371.0, 1.3
TRANSIT_KM_PER_DAY, QUOTE_KM_PER_DAY, QUOTE_BASE_DAYS = 450.0, 600.0, 5
ORDER_UP_TO_DAYS = 30
PREBUILD_AHEAD_DAYS = tuple(range(0, 22, 3))

# The registered features, in the order of the model's vector: (feature, kind). Encoders, imputation, importance and
# reasons follow from these rows; a build may be given others (``ml.registered`` reads them from a table).
FEATURES = (
    ("cover_days", "numeric"), ("pipeline_cover_days", "numeric"), ("stock_to_reorder_point", "numeric"), ("demand_trend", "numeric"),
    ("demand_cv", "numeric"), ("supplier_on_time_180d", "numeric"), ("supplier_lead_sd_180d", "numeric"), ("days_to_festival", "numeric"),
    ("category", "categorical"), ("abc_class", "categorical"), ("dc_id", "categorical"),
)

# The reason texts are outputs that must match.
# reason label, feature, reference value ("median" = median over labelled history)
REASONS = (
    ("low stock cover", "cover_days", "median"),
    ("little on order", "pipeline_cover_days", "median"),
    ("unreliable supplier", "supplier_on_time_180d", "median"),
    ("erratic supplier lead time", "supplier_lead_sd_180d", "median"),
    ("demand rising", "demand_trend", 1.0),
    ("festive season ahead", "days_to_festival", 60.0),
)


@dataclass(frozen=True)
class Calendar:
    """Time frame of one build. ``end`` is the last day of stock data; it censors the label."""

    start: date = date(1995, 1, 1)
    end: date = date(2001, 8, 31)
    snapshot_from: date = date(1995, 2, 1)
    fiscal_start_month: int = 4
    festival_days: tuple[date, ...] = field(default_factory=lambda: tuple(date(y, 11, 1) for y in range(1995, 2002)))
    train_end: date = date(1999, 6, 30)
    test_start: date = date(2000, 1, 1)
    opening_stock: int = 50

    @classmethod
    def covering(cls, first: date, last: date) -> Calendar:
        """Whole months from the first to the last day of any flow; snapshots from the second month on; a test
        period from the start of the last year but one, and training up to half a year before it."""
        start = first.replace(day=1)
        end = _next_month(last) - timedelta(days=1)
        return cls(start=start, end=end, snapshot_from=_next_month(start),
                   festival_days=tuple(date(y, 11, 1) for y in range(start.year, end.year + 1)),
                   train_end=date(end.year - 2, 6, 30), test_start=date(end.year - 1, 1, 1))


def _next_month(d: date) -> date:
    return date(d.year + d.month // 12, d.month % 12 + 1, 1)


DEFAULT = Calendar()
