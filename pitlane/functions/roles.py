"""Column roles of a telemetry frame.

The names below are the contract of the input data: which column is a
status, which one is a packed per-wheel vector, which ones are filled
forward and which by the neighbour mean.  They are data, not code, so the
operators take a ``Roles`` value and every list can be replaced.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

# --- fixed values: input column names and codes of the telemetry files ------
WHEELS = ("FL", "FR", "RL", "RR")
SERIES_KEYS = ("raceId", "pilot_index")
ORDER_KEY = "frameIdentifier"
PRESENCE_FLAGS = (("inPitArea", "pitStatus"), ("active", "resultStatus"))
EQUALS_FLAGS = (("pitting", "pitStatus", "pitting"),)
COMPOUND = "actualTyreCompound"
COMPOUND_CODES = (("soft", 0), ("medium", 1), ("hard", 2))
PACKED_DOUBLE = (
    "tyresSurfaceTemperature",
    "tyresInnerTemperature",
    "tyresPressure",
    "tyresWear",
    "tyresDamage",
    "brakesTemperature",
)
PACKED_INT = ("surfaceType",)
PACKED_SEPARATOR = "/"
FORWARD_SCALARS = ("pitLimiterStatus", "actualTyreCompound", "drs", "gear", "ersDeployMode", "fuelMix")
MEAN_SCALARS = (
    "speed",
    "throttle",
    "steer",
    "brake",
    "clutch",
    "engineRPM",
    "engineTemperature",
    "fuelInTank",
    "fuelRemainingLaps",
    "ersStoreEnergy",
    "ersHarvestedThisLapMGUK",
    "ersHarvestedThisLapMGUH",
    "ersDeployedThisLap",
)
CHUNK_SIZE = 200
# ---------------------------------------------------------------------------


def wheel_columns(packed: Iterable[str], wheels: Iterable[str] = WHEELS) -> tuple[str, ...]:
    """``FL_<c>, FR_<c>, RL_<c>, RR_<c>`` for every packed column ``c``."""
    return tuple(f"{w}_{c}" for c in packed for w in wheels)


@dataclass(frozen=True)
class Roles:
    """Which input column plays which part in cleaning and imputation."""

    presence_flags: tuple[tuple[str, str], ...] = PRESENCE_FLAGS
    equals_flags: tuple[tuple[str, str, str], ...] = EQUALS_FLAGS
    compound: str | None = COMPOUND
    compound_codes: tuple[tuple[str, int], ...] = COMPOUND_CODES
    packed_double: tuple[str, ...] = PACKED_DOUBLE
    packed_int: tuple[str, ...] = PACKED_INT
    wheels: tuple[str, ...] = WHEELS
    separator: str = PACKED_SEPARATOR
    forward_scalars: tuple[str, ...] = FORWARD_SCALARS
    mean_scalars: tuple[str, ...] = MEAN_SCALARS
    extra_drop: tuple[str, ...] = field(default=())

    @property
    def status_columns(self) -> tuple[str, ...]:
        seen: dict[str, None] = {}
        for _, src in self.presence_flags:
            seen[src] = None
        for _, src, _ in self.equals_flags:
            seen[src] = None
        return tuple(seen)

    @property
    def consumed(self) -> tuple[str, ...]:
        """Columns that cleaning replaces by derived ones and drops."""
        return self.status_columns + self.packed_double + self.packed_int + self.extra_drop

    @property
    def forward_fill(self) -> tuple[str, ...]:
        """Categorical columns: last non-null value carried forward."""
        return wheel_columns(self.packed_int, self.wheels) + self.forward_scalars

    @property
    def mean_fill(self) -> tuple[str, ...]:
        """Numeric columns: an isolated null becomes the mean of its neighbours."""
        return self.mean_scalars + wheel_columns(self.packed_double, self.wheels)

    def present_in(self, columns: Iterable[str]) -> Roles:
        """The same roles restricted to the raw columns a frame actually has."""
        have = set(columns)
        return replace(
            self,
            presence_flags=tuple(p for p in self.presence_flags if p[1] in have),
            equals_flags=tuple(e for e in self.equals_flags if e[1] in have),
            compound=self.compound if self.compound in have else None,
            packed_double=tuple(c for c in self.packed_double if c in have),
            packed_int=tuple(c for c in self.packed_int if c in have),
            forward_scalars=tuple(c for c in self.forward_scalars if c in have),
            mean_scalars=tuple(c for c in self.mean_scalars if c in have),
        )


DEFAULT_ROLES = Roles()
