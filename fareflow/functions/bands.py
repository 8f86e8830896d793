"""Labels: the bands and categories the marts are read by."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Labels, limits and sort orders of the marts.
WINDOWS = ("00-03", "04-07", "08-29", "30+")
WINDOW_NAMES = {
    "00-03": "Last Minute",
    "04-07": "Short Notice",
    "08-29": "Standard Booking",
    "30+": "Advance Booking",
}
FARE_BUCKETS = ("prem_cabin", "full_mid_econ", "deep_disc_econ")
FARE_BUCKET_NAMES = {
    "prem_cabin": "Premium Cabin",
    "full_mid_econ": "Full/Mid Economy",
    "deep_disc_econ": "Deep Discount Economy",
}
SEAT_BANDS = ("sold_out", "scarce", "9plus")
HHI_LEVELS = ((0.8, "High Concentration"), (0.5, "Moderate Concentration"))
CARRIER_HHI_LEVELS = ((0.7, "High Concentration"), (0.4, "Medium Concentration"))
CELL_ALERTS = ((40, "High Alert"), (20, "Medium Alert"), (5, "Low Alert"))
CELL_VOLUMES = (
    (1_000_000, "Very High Volume"),
    (100_000, "High Volume"),
    (10_000, "Medium Volume"),
    (1_000, "Low Volume"),
)
ROUTE_VOLUMES = ((10_000, "High Volume"), (1_000, "Medium Volume"))
ROUTE_ALERTS = ((30, "High Alert"), (15, "Medium Alert"))
HAULS = ((2000, "Long Haul"), (500, "Medium Haul"))
CARRIER_SIZES = ((15, "Major Carrier"), (5, "Mid-tier Carrier"))
VIOLATION_LEVELS = ((25, "High Violation"), (15, "Medium Violation"))


def _cases(arms: Sequence[tuple[Column, object]], otherwise: object = None) -> Column:
    label = F.when(*arms[0])
    for condition, name in arms[1:]:
        label = label.when(condition, name)
    return label if otherwise is None else label.otherwise(otherwise)


def at_least(value: Column, levels: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """The first label whose limit ``value`` reaches; NULL falls to ``otherwise``."""
    return _cases([(value >= limit, name) for limit, name in levels], otherwise)


def named(value: Column, names: dict[str, str]) -> Column:
    """Display name by code; NULL for a code without one."""
    return _cases([(value == code, name) for code, name in names.items()])


def rank_in(value: Column, order: Sequence[str]) -> Column:
    """1-based place of ``value`` in a fixed order; NULL when it is not there."""
    return _cases([(value == code, i) for i, code in enumerate(order, start=1)])


def indicator(condition: Column) -> Column:
    """1 when the condition holds, else 0 (also for NULL)."""
    return F.when(condition, 1).otherwise(0)


def booking_window(days_to_flight: Column) -> Column:
    """Days-to-flight band; NULL and negative days fall to the last one."""
    return (
        F.when(days_to_flight.between(0, 3), WINDOWS[0])
        .when(days_to_flight.between(4, 7), WINDOWS[1])
        .when(days_to_flight.between(8, 29), WINDOWS[2])
        .otherwise(WINDOWS[3])
    )


def seats_band(seats_remaining: Column) -> Column:
    """Seat band; NULL counts as plenty."""
    return (
        F.when(seats_remaining == 0, SEAT_BANDS[0])
        .when(seats_remaining.between(1, 8), SEAT_BANDS[1])
        .otherwise(SEAT_BANDS[2])
    )


def concentration_level(hhi: Column) -> Column:
    return at_least(hhi, HHI_LEVELS, "Low Concentration")
