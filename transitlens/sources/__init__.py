"""Readers and writers for the feed, the static timetable and derived tables."""
from transitlens.sources.feed import (
    read_snapshots, positions_for_speed, positions_for_delay, read_static, read_csv_bom_safe,
    feed_presence, land_raw,
)
from transitlens.sources.fixtures import Tables, raw_feed, static_timetable, delay_positions

__all__ = [
    "read_snapshots", "positions_for_speed", "positions_for_delay", "read_static",
    "read_csv_bom_safe", "feed_presence", "land_raw", "Tables", "raw_feed",
    "static_timetable", "delay_positions",
]
