"""Settings shared by the fare jobs."""

from __future__ import annotations

from dataclasses import dataclass

from fareflow.operators.joins import BROADCAST_BYTES, HOT_ROWS

# Percentiles every price benchmark carries, by output column.
STANDARD_PERCENTILES = {
    "p50_usd_per_mi": 0.50,
    "p90_usd_per_mi": 0.90,
    "p95_usd_per_mi": 0.95,
    "p97_usd_per_mi": 0.97,
}


@dataclass(frozen=True)
class FareParams:
    """Thresholds and sizes; the defaults are the tuned project values."""

    z_threshold: float = 1.5          # rule 1: z-score at or above this is an outlier
    r2_percentile: float = 0.90       # rule 2: scarce seats priced at or above this percentile
    hhi_threshold: float = 0.80       # rule 3: concentration at or above this is a monopoly
    fare_scale: int = 0               # decimals kept when fares and miles are cleaned
    earth_radius_m: float = 6_371_000.0
    routing_pad: float = 1.02         # great-circle miles are padded to resemble flown miles
    min_route_bookings: int = 1000    # smallest route shown on the geographic mart
    sample_rate: float = 0.018
    sample_min: int = 5               # bookings per stratum, at least
    sample_max: int = 100             # bookings per stratum, at most
    sample_seed: str = "fareflow"
    broadcast_bytes: int = BROADCAST_BYTES   # a per-route table up to this stored size is sent to all tasks
    hot_rows: int = HOT_ROWS          # a key with more bookings is spread where such a table is joined

    @property
    def benchmark_percentiles(self) -> dict[str, float]:
        """The standard percentiles plus the one rule 2 asks for, as ``r2_usd_per_mi``."""
        return {**STANDARD_PERCENTILES, "r2_usd_per_mi": self.r2_percentile}
