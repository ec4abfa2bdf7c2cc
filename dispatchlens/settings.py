"""Parameters of the analysis; the defaults are the published ones."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from decimal import Decimal


@dataclass(frozen=True)
class Settings:
    """Analysis window, detection thresholds and ranking limits."""

    # The half-open window of purchase dates under analysis.
    window_start: date = date(2017, 1, 1)
    window_end: date = date(2018, 9, 1)

    # Change of the on-time rate, in percentage points, that
    # makes a month an issue and that makes the issue severe (inclusive).
    issue_change_pp: Decimal = Decimal("-5.00")
    high_change_pp: Decimal = Decimal("-8.00")

    # Eligible orders a group needs in both periods.
    min_region_orders: int = 50
    min_seller_orders: int = 20

    # Rows kept per ranking and per summary table.
    top_contributors: int = 15
    top_brief_rows: int = 5

    def __post_init__(self) -> None:
        if self.window_start >= self.window_end:
            raise ValueError("window_start must lie before window_end")
        if self.min_region_orders < 1 or self.min_seller_orders < 1:
            raise ValueError("minimum group sizes must be at least one")

    @property
    def window_months(self) -> int:
        """Calendar months the window touches.

        There is at most one issue per month, so this bounds every table
        that holds one row per month or per issue.
        """
        last = self.window_end
        months = (last.year - self.window_start.year) * 12
        return months + last.month - self.window_start.month + 1
