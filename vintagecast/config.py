"""Rule parameters.

Every operator takes its thresholds from here (or from an override passed
in), never from literals scattered through the code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: these must equal the source pipeline's rules ----------------
# alert horizon 6 hours; digest horizon 12 hours; cooldown 2 hours
# rain: precipitation_mm > 0 counts as rain
# wind: current max >= 30 km/h and rise vs previous >= 15 km/h
# digest wind line from 25 km/h; digest not before 07 local
# expected snapshots per local day: hours 06 to 19; profile band: hours 6 to 23
# sky: mean cloud <= 20 clear, <= 60 partly cloudy, else cloudy, NULL unknown
# digest day band: local 06:00 to 24:00
# day part sets (first matching band wins):
#   A: morning 6-9, noon 10-14, afternoon 14-18, evening 19-23, else other
#   B: morning 6-9, noon 10-13, afternoon 14-17, evening 18-23, else NULL
#   C: morning 6-11, noon 12-14, afternoon 15-18, evening 19-23, else NULL
# day part order: morning 1, noon 2, afternoon 3, evening 4, else 9
# alert types: rain_next6h, wind_next6h
# messages:
#   "ALERT: Rain expected in next 6 hours."
#   "ALERT: Wind spike expected (max ~{max} km/h in next 6h)."
#   "ALERT: Wind spike expected in next 6 hours."
# envelope defaults: source "open-meteo", endpoint ""
# ---------------------------------------------------------------------------------

DAYPART_SETS: dict[str, tuple[tuple[str, int, int], ...]] = {
    "A": (("morning", 6, 9), ("noon", 10, 14), ("afternoon", 14, 18), ("evening", 19, 23)),
    "B": (("morning", 6, 9), ("noon", 10, 13), ("afternoon", 14, 17), ("evening", 18, 23)),
    "C": (("morning", 6, 11), ("noon", 12, 14), ("afternoon", 15, 18), ("evening", 19, 23)),
}
DAYPART_ELSE: dict[str, str | None] = {"A": "other", "B": None, "C": None}
DAYPART_ORDER: tuple[str, ...] = ("morning", "noon", "afternoon", "evening")
DAYPART_ORDER_ELSE = 9

SKY_BANDS: tuple[tuple[float, str], ...] = ((20.0, "clear"), (60.0, "partly cloudy"))
SKY_ELSE = "cloudy"
SKY_UNKNOWN = "unknown"

RAIN_ALERT_TYPE = "rain_next6h"
WIND_ALERT_TYPE = "wind_next6h"
RAIN_MESSAGE = "ALERT: Rain expected in next 6 hours."
WIND_MESSAGE_FMT = "ALERT: Wind spike expected (max ~%s km/h in next 6h)."
WIND_MESSAGE_PLAIN = "ALERT: Wind spike expected in next 6 hours."

DEFAULT_SOURCE = "open-meteo"
DEFAULT_ENDPOINT = ""
DAYPART_SEPARATOR = " • "
DEGREE_C = "°C"
RAIN_TAG = " (rain)"


@dataclass(frozen=True)
class Rules:
    alert_horizon_hours: int = 6
    digest_horizon_hours: int = 12
    cooldown_hours: int = 2
    rain_threshold_mm: float = 0.0
    wind_min_kmh: float = 30.0
    wind_rise_kmh: float = 15.0
    digest_wind_line_kmh: float = 25.0
    digest_earliest_hour: int = 7
    health_first_hour: int = 6
    health_last_hour: int = 19
    profile_first_hour: int = 6
    profile_last_hour: int = 23
    day_band_start_hour: int = 6
    day_band_end_hour: int = 24
    history_days: int = 4
    quantiles: tuple[float, ...] = field(default=(0.05, 0.5, 0.95))


RULES = Rules()
