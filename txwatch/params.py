"""Every tunable number in one immutable object that operators take explicitly."""

from __future__ import annotations

from dataclasses import dataclass, field

# Default share of each rule in the combined score.
DEFAULT_WEIGHTS = {
    "D1_CUSUM": 0.10,
    "D2_EWMA": 0.10,
    "D3_3SIGMA_HORA": 0.08,
    "D4_BENFORD": 0.07,
    "D5_FRACIONAMENTO": 0.20,
    "M1_ISOLATION_FOREST": 0.25,
    "M2_AUTOENCODER": 0.20,
}

# Lower edge of each severity band, highest first.
SEVERITY_BANDS = (
    (0.95, "CRITICA"),
    (0.85, "ALTA"),
    (0.70, "MEDIA"),
    (0.50, "BAIXA"),
)

# Fixed values: (month, day) of the national holidays known to the calendar.
HOLIDAYS = ((1, 1), (4, 21), (5, 1), (9, 7), (10, 12), (11, 2), (11, 15), (12, 25))

# Payment types watched for structuring.
STRUCTURING_TYPES = ("PIX_OUT", "TED")


@dataclass(frozen=True)
class Params:
    cusum_slack: float = 0.5
    cusum_limit: float = 5.0

    ewma_weight: float = 0.2
    ewma_width: float = 3.0
    ewma_min_points: int = 5

    sigma_width: float = 3.0

    benford_min_rows: int = 100
    benford_min_digits: int = 30

    structuring_limit: float = 10_000.0
    structuring_hours: int = 24
    structuring_min_tx: int = 3
    structuring_types: tuple[str, ...] = STRUCTURING_TYPES

    high_value: float = 50_000.0
    authority_value: float = 100_000.0
    opening_hour: int = 6
    closing_hour: int = 22

    severity_bands: tuple[tuple[float, str], ...] = SEVERITY_BANDS
    weights: dict[str, float] = field(default_factory=lambda: dict(DEFAULT_WEIGHTS))

    # Slice of time in which every key's history is cut for running totals. Rows of one instant are
    # combined before, so a task holds at most the instants of one key and slice.
    slice_seconds: int = 3600
