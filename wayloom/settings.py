"""All thresholds in one place; every operator takes a Settings."""

from __future__ import annotations

import dataclasses


@dataclasses.dataclass(frozen=True)
class Settings:
    # fixed values: bounds, thresholds and windows of the fleet rules
    lon_min: float = 106.4
    lon_max: float = 107.1
    lat_min: float = 10.3
    lat_max: float = 11.2
    fault_speed_kmh: float = 120.0
    excess_speed_kmh: float = 80.0
    jump_km: float = 0.5
    jump_seconds: int = 30
    idle_kmh: float = 2.0
    restart_kmh: float = 5.0
    stop_seconds: int = 60
    heading_degrees: float = 45.0
    session_gap_seconds: int = 300
    slide_window_seconds: int = 300
    slide_step_seconds: int = 30
    archive_seconds: int = 60
    feature_seconds: int = 3600
    feature_utc_offset_hours: int = 7
    watermark: str = "30 seconds"
    state_ttl_seconds: int = 3600
    route_speed_ttl_seconds: int = 120
    recent_anomalies: int = 500
    cell_degrees: float = 0.005
    trip_min_minutes: float = 5.0
    trip_max_minutes: float = 180.0
    top_trip_routes: int = 15
    event_day: str = "2025-04-30"
    cluster_eps_radians: float = 5e-4
    cluster_min_points: int = 10
    listing_cap: int = 200
    unknown_route: str = "UNKNOWN"
    unknown_route_id: str = "0"


DEFAULTS = Settings()
