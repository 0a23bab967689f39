"""Business rules. Every value here is a parameter; the defaults are fixed values."""

from __future__ import annotations

from dataclasses import dataclass, field

# These must equal the published ones for results to match.

FISCAL_START_MONTH = 4

SEASON_BY_MONTH = {
    1: "Pongal",
    2: "Post-Pongal",
    3: "Lean",
    4: "Wedding",
    5: "Wedding",
    6: "Lean",
    7: "Aadi",
    8: "Aadi",
    9: "Pre-festive",
    10: "Deepavali",
    11: "Deepavali",
    12: "Year-end",
}

PREMIUM_FROM = 6000
MID_FROM = 1500

PHYSICAL_CHANNELS = ("Walk-in", "Exhibition Stall")

SEGMENT_CHAMPIONS = "Champions - protect"
SEGMENT_OVERDUE = "High value, overdue - call them"
SEGMENT_NEW = "New - convert to second purchase"
SEGMENT_SLIPPING = "Loyal but slipping - reactivate"
SEGMENT_DORMANT = "Dormant low value - do not spend"
SEGMENT_BIG_SPENDER = "Big spender, low frequency - upsell events"
SEGMENT_MIDDLE = "Steady middle - hold"

STEP_BUDGET = "Budget revenue"
STEP_PRICE = "Price / discount effect"
STEP_VOLUME = "Volume effect"
STEP_MIX = "Mix effect"
STEP_ACTUAL = "Actual revenue"

VERDICT_MODEL = "model beats seasonal naive"
VERDICT_NAIVE = "seasonal naive is as good or better - prefer it"
STATUS_TOO_SHORT = "insufficient history for an honest backtest"
STATUS_OK = "ok"
STATUS_NO_FORECAST = "a held-out month has no forecast"

SEASON_LENGTH = 12
HORIZON_MONTHS = 6
HOLDOUT_MONTHS = 6
BAND_SIGMAS = 1.28
PLAN_UPLIFT = 1.12
OVERDUE_FROM = 2.0


@dataclass(frozen=True)
class Rules:
    """The rules a warehouse and its views are built under."""

    fiscal_start_month: int = FISCAL_START_MONTH
    seasons: dict[int, str] = field(default_factory=lambda: dict(SEASON_BY_MONTH))
    premium_from: float = PREMIUM_FROM
    mid_from: float = MID_FROM
    physical_channels: tuple[str, ...] = PHYSICAL_CHANNELS
    overdue_from: float = OVERDUE_FROM


DEFAULT_RULES = Rules()
