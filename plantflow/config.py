"""Fixed business values and their parameter types.

The numbers in this file are fixed values: physical limits, shift hours, day
ranges and money assumptions that define the results. Everything that reads
them takes them as an argument, so another plant passes its own.
"""

from __future__ import annotations

from dataclasses import dataclass

# Valid range of every sensor channel, both ends included.
PHYSICAL_BOUNDS = {
    "temperature_k": (250.0, 400.0),
    "process_temperature_k": (250.0, 420.0),
    "vibration_mm_s": (0.0, 30.0),
    "pressure_bar": (0.0, 60.0),
    "torque_nm": (0.0, 150.0),
    "rotational_speed_rpm": (0.0, 5000.0),
    "load_pct": (0.0, 100.0),
}
CHANNELS = list(PHYSICAL_BOUNDS)
OUTLIER_CHANNELS = ["vibration_mm_s", "temperature_k", "pressure_bar"]


@dataclass(frozen=True)
class Shift:
    """A named work shift; `end_hour <= start_hour` means it crosses midnight."""

    name: str
    start_hour: int
    end_hour: int

    @property
    def overnight(self) -> bool:
        return self.end_hour <= self.start_hour


# The three work shifts, in the order in which they happen.
SHIFTS = [Shift("Morning", 6, 14), Shift("Afternoon", 14, 22), Shift("Night", 22, 6)]
SHIFT_HOURS = 8

GAP_READINGS = 4
MAINTENANCE_DAYS = 7
ROLLING_SHIFTS = [3, 9]
SEQUENCE_SHIFTS = 5

HISTORY_COLUMNS = ["quality_score", "production_rate", "downtime_minutes"] + [
    f"{c}_mean" for c in CHANNELS
]

# Inputs of the sequence model, before the one-hot status columns.
SEQUENCE_COLUMNS = [
    "production_rate",
    "quality_score",
    "downtime_minutes",
    *[f"{c}_mean" for c in CHANNELS],
    "downtime_ratio",
    "production_efficiency",
    "days_since_last_maintenance",
    "maintenance_count_past_7d",
    "has_recent_maintenance",
    "failure_occurred_this_shift",
]

ID_COLUMNS = ["machine_id", "date", "shift", "sim_day"]
CATEGORICAL_COLUMNS = ["machine_type", "operating_status"]
TARGET = "failure_next_shift"


@dataclass(frozen=True)
class SplitDays:
    """First day of the record and the inclusive day ranges of each split."""

    start: str = "2026-05-01"
    train: tuple[int, int] = (1, 50)
    validation: tuple[int, int] = (51, 65)
    test: tuple[int, int] = (66, 90)

    def ranges(self) -> dict[str, tuple[int, int]]:
        return {"train": self.train, "validation": self.validation, "test": self.test}


@dataclass(frozen=True)
class Economics:
    """What-if constants: hours, fractions and US dollars (fixed values)."""

    horizon_shifts: int = 6
    shift_hours: float = 8.0
    failure_downtime_hours: float = 8.0
    maintenance_downtime_hours: float = 4.5
    load_reduction: float = 0.20
    unit_margin_usd: float = 12.0
    downtime_cost_per_hour_usd: float = 150.0
    failure_repair_usd: float = 2000.0


WARNING_SIGMA = 2.0
DANGER_SIGMA = 3.5

CHUNK_WORDS = 90
CHUNK_OVERLAP = 20
TOP_K = 4
MIN_SCORE = 0.05
