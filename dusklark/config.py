"""Parameters of the hourly-data operators, with their checked defaults."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, fields
from pathlib import Path


@dataclass(frozen=True)
class Config:
    exclusion_start: str = "2026-04-25"
    exclusion_end: str = "2026-06-03"
    train_start: str = "2025-09-01"
    train_end: str = "2025-12-31"
    calib_start: str = "2026-01-01"
    calib_end: str = "2026-01-31"
    test_start: str = "2026-02-01"
    test_end: str = "2026-02-28"
    max_window_hours: int = 120
    recovery_hours: int = 24
    drop_edge_truncated: bool = True
    rate_window_days: int = 30
    anchor_band: float = 0.025
    tier_step: float = 0.025
    min_feasible_tiers: int = 2
    default_reference: float = 0.30
    # Reference discounts by category.
    reference: dict[str, float] = field(default_factory=lambda: {"RED MEAT": 0.25, "POULTRY": 0.25, "SIDE PLATE": 0.25})
    arm_allocation: float = 0.5
    smoothing_days: int = 7
    max_k: int = 25
    demand_floor: float = 0.01

    def __post_init__(self) -> None:
        for f in fields(self):
            if f.name.endswith(("_start", "_end")):
                iso_date(getattr(self, f.name), f.name)
        for name in ("exclusion", "train", "calib", "test"):
            if getattr(self, f"{name}_start") > getattr(self, f"{name}_end"):
                raise ValueError(f"{name}: the start lies after the end")
        if not 0 < self.tier_step < 1 or not 0 <= self.arm_allocation <= 1 or self.max_window_hours < 1:
            raise ValueError("tier_step, arm_allocation or max_window_hours out of range")


def iso_date(value: str, label: str) -> str:
    """The value if it is an ISO date, so that it may stand in a generated query."""
    if dt.date.fromisoformat(value).isoformat() != value:
        raise ValueError(f"{label}: {value!r} is no ISO date")
    return value


def load_config(path: str | None = None, strict: bool = True) -> Config:
    """Defaults, overridden by a YAML file; unknown keys are refused if ``strict``."""
    if path is None:
        return Config()
    import yaml

    given = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    known = {f.name for f in fields(Config)}
    if strict and (extra := set(given) - known):
        raise ValueError(f"unknown keys: {sorted(extra)}")
    return Config(**{k: str(v) if isinstance(v, dt.date) else v for k, v in given.items() if k in known})
