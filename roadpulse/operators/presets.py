"""Limits of the published detectors, as data. All numbers are fixed values."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Preset:
    """Limits of one band-rule detector.

    ``None`` for ``accel``/``brake``/``gap_lo``/``gap_hi``/turn limits means
    "learned": the caller supplies a statistics row. ``straight`` is the
    turn below which a speed change counts; ``turn_first`` is the order in
    which the three rules are tried. ``limits`` picks the mileage-limit variant
    and ``limits_read`` the unit it takes the m/s speed columns for: ``kmh``
    keeps the double conversion the taxi numbers were learned with. Pairs are
    ``least_gap`` to 60 whole seconds apart.
    """

    name: str
    accel: float | None
    brake: float | None
    gap_lo: float | None
    gap_hi: float | None
    turn: float | None
    turn_rate: float | None
    turn_speed: float | None
    straight: float | None = None
    turn_first: bool = True
    use_gap: bool = True
    limits: str = "ramp"
    limits_read: str = "ms"
    least_gap: int = 5


PRESETS = {p.name: p for p in (
    Preset("bus_jr_offline", 0.5026947901583626, -0.499124456277012, None, None, 89.30, 14.98, 28.95,
           straight=30.0, limits="truncated"),
    Preset("bus_jr_stat", 0.5026947901583626, -0.499124456277012, None, None, 45.0, 20.486, 20.0,
           limits="truncated"),
    Preset("bus_pd_offline", None, None, None, None, 45.0, 20.486, 20.0,
           limits="truncated"),
    Preset("taxi_dz_offline", None, None, None, None, 1.985, 0.249, 47.422, limits_read="kmh"),
    Preset("bus_detail_stream", 0.503, -0.500, 19.387, 31.020, 89.30, 14.98, 28.95,
           straight=30.0, turn_first=False),
    Preset("bus_event_stream", 0.885, -0.878, 26.256, 41.484, 89.29677, 14.98, 28.95, turn_first=False),
    Preset("taxi_detail_stream", None, None, None, None, None, None, None, straight=30.0, turn_first=False),
    Preset("taxi_detail_bk", 0.414, -0.407, 26.256, 100.0, 45.0, 20.486, 33.79,
           straight=45.0, turn_first=False),
    Preset("taxi_event_bk", 0.414, -0.407, 26.256, 41.484, 45.0, 20.486, 46.62, turn_first=False),
    Preset("bus_event_bk", 0.885, -0.878, 26.256, 41.484, 45.0, 20.486, 33.79,
           turn_first=False, limits="truncated", least_gap=6),
    Preset("quantile_event_bk", 0.2438, -0.2381, None, None, 45.0, 2.1968, 29.843,
           turn_first=False, use_gap=False),
)}

# The simple speed rule.
SIMPLE_ACCEL = 0.763468
SIMPLE_TURN_RATE = 11.5
SIMPLE_SPEED = 20.5
