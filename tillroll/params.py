"""Parameters of an analysis run; the defaults describe a two-year loyalty-card panel."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Params:
    """Time boundaries are integer day numbers; day 1 falls on ``ref_date``."""

    ref_date: str = "2013-01-01"
    max_day: int = 711
    cal_end_day: int = 365
    churn_window: int = 90
    pre_weeks: int = 8
    half_day: int | None = None
    last_window: int = 28
    min_cohort_size: int = 20
    high_risk: float = 0.70
    margin: float = 0.27
    mailer_cost: dict[str, float] = field(
        default_factory=lambda: {"TypeA": 1.50, "TypeB": 0.80, "TypeC": 0.50}
    )
    rfm_cuts: tuple[int, int, int] = (13, 10, 7)
    exclude_zero_pre: bool = True
    seed: int = 42

    @property
    def churn_cutoff(self) -> int:
        return self.max_day - self.churn_window

    @property
    def half(self) -> int:
        return self.cal_end_day // 2 if self.half_day is None else self.half_day

    def with_(self, **changes) -> "Params":
        return replace(self, **changes)
