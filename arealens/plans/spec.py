"""Declarative indicator specification, validated when it is built."""

from __future__ import annotations

from dataclasses import dataclass, field

from ..functions.dates import time_fix
from ..sources.refdata import EPOP_WEIGHTS, epop_total

MEASURES = ("percent", "crude", "stdrate", "perc_pcf")
GEOGRAPHIES = ("datazone11", "council", "all")
YEAR_TYPES = ("calendar", "financial", "school", "survey")


@dataclass(frozen=True)
class IndicatorSpec:
    """One indicator run (the parameters of both analysis stages).

    ``epop_total`` defaults to the total implied by ``epop_age`` and
    ``sexes``; passing a different value is allowed (some published runs do)
    but is reported by :meth:`epop_warning`.
    """

    ind_id: int
    measure: str
    time_agg: int
    yearstart: int
    yearend: int
    year_type: str
    geography: str = "datazone11"
    epop_age: str | None = None
    epop_total: float | None = None
    sexes: int = 2
    crude_rate: float | None = None
    adp: bool = False
    hscp: bool = False
    legacy_five_year_labels: bool = False
    strict_years: bool = False      # periods of calendar years instead of rows (quirk Q7)
    filters: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.measure not in MEASURES:
            raise ValueError(f"measure must be one of {MEASURES}")
        if self.geography not in GEOGRAPHIES:
            raise ValueError(f"geography must be one of {GEOGRAPHIES}")
        time_fix(self.time_agg)  # rejects 4 and > 5
        if not (self.year_type in YEAR_TYPES or "snapshot" in self.year_type):
            raise ValueError(f"unknown year_type {self.year_type!r}")
        if self.measure == "stdrate":
            if self.epop_age not in EPOP_WEIGHTS:
                raise ValueError("stdrate needs epop_age in " + ", ".join(EPOP_WEIGHTS))
        if self.measure == "crude" and not self.crude_rate:
            raise ValueError("crude needs crude_rate")
        if self.yearend < self.yearstart:
            raise ValueError("yearend before yearstart")

    @property
    def time_fix(self) -> int:
        return time_fix(self.time_agg)

    @property
    def standard_total(self) -> float:
        if self.epop_total is not None:
            return float(self.epop_total)
        return float(epop_total(self.epop_age, self.sexes))

    def epop_warning(self) -> str | None:
        if self.measure != "stdrate" or self.epop_total is None:
            return None
        implied = epop_total(self.epop_age, self.sexes)
        if abs(implied - self.epop_total) > 1e-9:
            return (f"ind {self.ind_id}: epop_total {self.epop_total} differs from the "
                    f"{implied} implied by epop_age={self.epop_age!r}")
        return None
