"""Column expressions (JVM-side, codegen-friendly) shared by all operators."""
from .numeric import rnd, safe_div, pct
from .readings import (
    power_kw, voltage_band, current_band, power_band, health_score, health_status,
    time_attributes, town, reading_date, hour_ts, day_of_week_number,
)

__all__ = [
    "rnd", "safe_div", "pct", "power_kw", "voltage_band", "current_band", "power_band",
    "health_score", "health_status", "time_attributes", "town", "reading_date", "hour_ts",
    "day_of_week_number",
]
