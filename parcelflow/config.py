"""Settings of the dispatch jobs."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Depot:
    id: str
    name: str
    lat: float
    lng: float


@dataclass(frozen=True)
class Fleet:
    """How many drivers start where, when they work and what they can carry."""

    drivers: int = 18
    drivers_per_depot: int = 6
    shift_start: str = "09:00"
    shift_end: str = "18:00"
    min_visits: int = 1
    weight: float = 1000.0
    volume: float = 1000.0


@dataclass(frozen=True)
class Visit:
    """Time window and service minutes given to every customer visit."""

    start: str = "09:00"
    end: str = "18:00"
    duration: int = 5


@dataclass(frozen=True)
class Limits:
    """Totals at which a group of orders is full; ``seconds`` is the age of the open group."""

    weight: float = 1000.0
    volume: float = 5000.0
    seconds: float | None = None


# Depots, statuses, id prefixes and solver options that results depend on.
DEPOTS = (
    Depot("depot_1", "San Sebastian de los Reyes", 40.54510, -3.61184),
    Depot("depot_2", "Alcorcón", 40.350370, -3.855863),
    Depot("depot_3", "Vallecas", 40.36977, -3.59670),
)
RECEIVED = "RECEIVED"
IN_PROGRESS = "in_progress"
READY = "READY"
READY_FOR_DELIVERY = "READY_FOR_DELIVERY"
READY_FOR_DISPATCH = "READY_FOR_DISPATCH"
DISPATCHED = "DISPATCHED"
PAID = "PAID"
CUSTOMER_PREFIX = "cus-"
DEPOT_PREFIX = "depot_"
UNKNOWN_HOUR = "UNKNOWN"
PRIORITIES = ("low", "regular", "high")
DRIVER_RULES = {
    "type": ["A", "B"],
    "strict_start": True,
    "breaks": [
        {"id": "lunch", "start": "12:00", "end": "13:00"},
        {"id": "client call", "start": "15:00", "end": "15:30", "in_transit": True},
    ],
}
ROUTING_OPTIONS = {"traffic": "slow", "balance": True, "shortest_distance": True, "polylines": True}

# Thresholds of the packing, flushing and lorry-loading jobs.
PACK_LIMITS = Limits(weight=1000.0, volume=5000.0)
FLUSH_LIMITS = Limits(weight=700.0, volume=500.0, seconds=2700.0)
CUTOFF_LIMITS = Limits(weight=1000.0, volume=5000.0)
CUTOFF_CLOCK = "12:00"
WINDOW_FLOOR = Limits(weight=500.0, volume=1000.0)
LORRY_LIMITS = Limits(weight=5000.0, volume=20000.0)


@dataclass(frozen=True)
class Settings:
    depots: tuple[Depot, ...] = DEPOTS
    fleet: Fleet = field(default_factory=Fleet)
    visit: Visit = field(default_factory=Visit)
    pack: Limits = PACK_LIMITS
    options: dict = field(default_factory=lambda: dict(ROUTING_OPTIONS))
    driver_rules: dict = field(default_factory=dict)  # further settings of every driver, such as DRIVER_RULES


def driver_ids(count: int = Fleet.drivers) -> list[str]:
    return [f"driver_{number}" for number in range(1, count + 1)]
