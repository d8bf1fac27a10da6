"""Thresholds of the curation and insight rules, in one frozen object.

Every operator takes a ``Rules`` instance (default ``RULES``) so another meter
population can be configured without touching code.
"""
from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rules:
    # ---- fixed values: physical sanity limits, closed ranges (0 kept = outage) ----
    energy_range: tuple[float, float] = (0.0, 50.0)
    voltage_range: tuple[float, float] = (0.0, 400.0)
    current_range: tuple[float, float] = (0.0, 200.0)
    frequency_range: tuple[float, float] = (0.0, 70.0)

    # ---- fixed values: bands ----
    over_voltage: float = 240.0          # > : OVER_VOLTAGE / CRITICAL
    normal_voltage_min: float = 220.0    # >= : NORMAL
    low_voltage_min: float = 200.0       # >= : LOW, below: CRITICAL_LOW / WARNING
    high_load_amps: float = 9.0          # > : HIGH_LOAD
    medium_load_amps: float = 3.0        # >= : MEDIUM_LOAD, > 0 : LIGHT_LOAD
    high_power_kw: float = 2.0           # > : HIGH
    medium_power_kw: float = 0.5         # >= : MEDIUM, > 0 : LOW

    # ---- fixed values: health score penalties (start at 100, floor 0) ----
    score_start: float = 100.0
    score_floor: float = 0.0
    penalty_over_voltage: float = 30.0
    penalty_critical_low: float = 25.0
    penalty_low_voltage: float = 10.0
    penalty_over_current: float = 20.0
    penalty_frequency: float = 15.0
    penalty_dead_meter: float = 20.0
    frequency_band: tuple[float, float] = (49.5, 50.5)
    dead_kwh_max: float = 0.0005         # <= : no consumption
    dead_voltage_min: float = 100.0      # > : energised

    # ---- fixed values: reading cadence and raw format ----
    # power_band from the rounded power_kw (batch script) or from unrounded V·I/1000 (SQL job form)
    power_band_on_rounded: bool = True

    interval_minutes: int = 3
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss"
    power_decimals: int = 4

    @property
    def readings_per_hour(self) -> int:
        return 60 // self.interval_minutes

    @property
    def readings_per_day(self) -> int:
        return 24 * self.readings_per_hour

    def ranges(self) -> dict[str, tuple[float, float]]:
        return {
            "energy_kwh": self.energy_range,
            "avg_voltage": self.voltage_range,
            "avg_current": self.current_range,
            "frequency_hz": self.frequency_range,
        }


RULES = Rules()

# Curated column contract (fixed values: names and order of the curated table).
KEY = ("meter_id", "reading_ts")
MEASURES = ("energy_kwh", "avg_voltage", "avg_current", "frequency_hz")
BASE_COLUMNS = ("reading_ts", "energy_kwh", "avg_voltage", "avg_current", "frequency_hz", "meter_id")
DERIVED_COLUMNS = (
    "day", "hour", "day_of_week", "is_weekend", "power_kw", "voltage_band",
    "current_band", "power_band", "health_score", "health_status",
)
PARTITION_COLUMNS = ("year", "month")
CURATED_COLUMNS = BASE_COLUMNS + DERIVED_COLUMNS + PARTITION_COLUMNS

# Health statuses from worst to best, used to break ties between equal scores.
STATUS_SEVERITY = ("CRITICAL", "WARNING", "HIGH_LOAD", "POSSIBLE_METER_ISSUE", "HEALTHY")
