"""Analysis settings. A frozen value object whose fields become literals in query plans."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Mapping
from dataclasses import asdict, dataclass, fields
from datetime import datetime, time, timedelta

FAMILIES = ("logistic", "forest", "boosted")
REQUIRED = ("county_fips", "start_date", "end_date")


@dataclass(frozen=True)
class Config:
    # What to analyse. All three are required; the window is half-open, in UTC.
    county_fips: tuple[str, ...] = ()
    start_date: str = ""
    end_date: str = ""
    lead_hours: tuple[int, ...] = (24, 30, 36, 42, 48)
    init_hours: tuple[int, ...] = (0,)

    # Weather and outage rules.
    spatial_buffer_m: float = 25000.0
    outage_threshold: float = 0.05
    event_outage_threshold: float = 0.005
    event_gap_minutes: int = 60
    min_samples_per_block: int = 8
    hail_temp_threshold: float = 0.0
    hail_precip_threshold: float = 2.0
    wind_consistency_min: int = 2
    hail_consistency_min: int = 1

    # Models.
    ml_models: tuple[str, ...] = ("regressor", "logistic")
    ml_max_iterations: int = 50
    ml_learn_rate: float = 0.1
    ml_min_tree_child_weight: int = 5
    ml_subsample: float = 0.8
    # Families that `automl` tries; all of them, in this order.
    automl_families: tuple[str, ...] = ("logistic", "forest", "boosted")

    # Geometry of the forecast grid and of the spatial index.
    cell_half_deg: float = 0.125
    tile_deg: float = 0.25

    # Quantile levels of the county thresholds (see operators.thresholds).
    wind_quantile: float = 10 / 11
    updraft_quantile: float = 4 / 5

    # Length of the pieces a county's history is ordered in. It changes how a plan runs, never what it returns.
    event_piece_hours: int = 12

    def __post_init__(self) -> None:
        missing = [name for name in REQUIRED if not getattr(self, name)]
        if missing:
            raise ValueError(f"missing required settings: {', '.join(missing)}")
        if self.start > self.end:
            raise ValueError("start_date must not be after end_date")
        if not self.lead_hours or not self.init_hours:
            raise ValueError("lead_hours and init_hours must not be empty")
        if self.event_piece_hours not in (1, 2, 3, 4, 6, 8, 12, 24):
            raise ValueError("event_piece_hours must divide a day")
        if not self.automl_families or set(self.automl_families) - set(FAMILIES):
            raise ValueError(f"automl_families must name some of {', '.join(FAMILIES)}")

    @property
    def start(self) -> datetime:
        return datetime.fromisoformat(self.start_date)

    @property
    def end(self) -> datetime:
        return datetime.fromisoformat(self.end_date)

    def init_times(self) -> list[datetime]:
        """Every run that can have a configured lead valid inside the window.

        Days run from the start less the longest lead (floored to a day) to the end, inclusive.
        """
        first = (self.start - timedelta(hours=max(self.lead_hours))).date()
        days = (self.end.date() - first).days + 1
        return [
            datetime.combine(first + timedelta(days=d), time(h))
            for d in range(days)
            for h in self.init_hours
        ]

    def fingerprint(self) -> str:
        """Identifies the settings a table was built with; `resume` compares it."""
        body = json.dumps(asdict(self), sort_keys=True, default=list)
        return hashlib.sha256(body.encode()).hexdigest()[:16]

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Config:
        """Read settings from upper-case environment names; lists are comma-separated."""
        env = os.environ if env is None else env
        given = {}
        for f in fields(cls):
            text = env.get(f.name.upper())
            if text is None or text == "":
                continue
            kind = str(f.type)
            if kind.startswith("tuple"):
                items = [part.strip() for part in text.split(",") if part.strip()]
                given[f.name] = tuple(int(i) for i in items) if "int" in kind else tuple(items)
            elif kind == "int":
                given[f.name] = int(text)
            elif kind == "float":
                given[f.name] = float(text)
            else:
                given[f.name] = text
        return cls(**given)
