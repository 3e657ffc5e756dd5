"""Pipeline parameters.

Every threshold is a field of a frozen dataclass so a caller can run the same
plan with other values (tests do).  The defaults are the values the reference
pipeline uses; they must stay equal for results to match.
"""
from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass


# Fixed values that results depend on (must equal the reference's).
MIN_GAP_S = 60            # seconds, inclusive
MAX_GAP_S = 1500          # seconds, inclusive
MAX_KMPH = 80.0           # inclusive, tested on the rounded speed
MOVING_KMPH = 3.0         # strict '>' on the rounded speed
BUNCH_M = 300.0           # metres, strict '<'
LAT_MIN, LAT_MAX = 28.0, 29.0
LON_MIN, LON_MAX = 76.5, 77.8
EARTH_RADIUS_M = 6371000.0
TIME_ZONE = "Asia/Kolkata"
NEAR_STOP_M = 150.0       # inclusive '<='
OUTLIER_SEC = 10800       # strict '>' on abs(delay)
MIN_MOVING = 3            # sample-size floor of reports, model, lookups
MIN_MOVING_RATE = 10      # floor of the bunching-rate report
PEAK_HOURS = (8, 9, 18, 19, 20)
WEEKEND_DAYS = (1, 7)     # 1 = Sunday, 7 = Saturday
MIN_TRAIN_ROWS = 50
DATE_DIM_START = _dt.date(2026, 1, 1)
DATE_DIM_END = _dt.date(2028, 12, 31)
# day-part buckets of dim_hour: (first hour, last hour, label); other hours -> LATE_EVENING
DAY_PARTS = ((0, 5, "Night"), (6, 10, "Morning peak"), (11, 15, "Midday"), (16, 20, "Evening peak"))
LATE_EVENING = "Late evening"


@dataclass(frozen=True)
class Params:
    min_gap_s: int = MIN_GAP_S
    max_gap_s: int = MAX_GAP_S
    max_kmph: float = MAX_KMPH
    moving_kmph: float = MOVING_KMPH
    bunch_m: float = BUNCH_M
    lat_min: float = LAT_MIN
    lat_max: float = LAT_MAX
    lon_min: float = LON_MIN
    lon_max: float = LON_MAX
    time_zone: str = TIME_ZONE
    near_stop_m: float = NEAR_STOP_M
    outlier_sec: int = OUTLIER_SEC
    min_moving: int = MIN_MOVING
    min_moving_rate: int = MIN_MOVING_RATE
    peak_hours: tuple = PEAK_HOURS
    weekend_days: tuple = WEEKEND_DAYS
    min_train_rows: int = MIN_TRAIN_ROWS
    date_dim_start: _dt.date = DATE_DIM_START
    date_dim_end: _dt.date = DATE_DIM_END
    # Bunching: fine grid cells are small enough that two points in one cell
    # are always closer than bunch_m (see operators/bunching.py); coarse cells
    # bound the probe join.  Sizes are in degrees.
    coarse_cell_deg: float = 0.01
    # A coarse cell of the bunching probe join is dealt over as many salts as
    # it has multiples of this many points.
    salt_rows: int = 2_000_000
    # Nearest-stop tie-break rounds the distance to this many decimals first.
    stop_dist_dp: int = 1
    # Strict bunching also requires the flagged ping itself to be moving.
    strict_bunching: bool = False


DEFAULT = Params()
