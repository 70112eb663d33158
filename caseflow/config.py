"""Plain descriptions of what to compute: windows, observations, rules, cohorts."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Callable

from caseflow.functions import timegrid as tg

_UNIT = {"s": tg.SECOND, "min": tg.MINUTE, "h": tg.HOUR, "d": tg.DAY}


@dataclass(frozen=True)
class Window:
    """Half-open time window ``[ObsDT + start, ObsDT + end)`` with its 5-minute grid."""

    name: str
    start: float
    end: float
    unit: str
    first_step: int = 0
    last_step: int = 0

    def __post_init__(self):
        if self.unit not in _UNIT:
            raise ValueError(f"unknown time unit {self.unit!r}")
        if self.lo >= self.hi:
            raise ValueError(f"window {self.name} is empty")

    @property
    def lo(self) -> int:
        """Microseconds from the case time to the first instant inside."""
        return round(self.start * _UNIT[self.unit])

    @property
    def hi(self) -> int:
        """Microseconds from the case time to the first instant past the end."""
        return round(self.end * _UNIT[self.unit])


# The three windows in use and their 5-minute steps.
BF24H = Window("Bf24H", -24, 1e-06, "h", -288, 0)
AF2H = Window("Af2H", 1, 121, "min", 1, 24)
AF2TO8H = Window("Af2to8H", 121, 481, "min", 25, 96)
WINDOWS = {w.name: w for w in (BF24H, AF2H, AF2TO8H)}


@dataclass(frozen=True)
class Observation:
    """A record of a patient seen through a window; ``hP.rCGM5Min.cBf24H`` in dotted form."""

    human: str
    record: str
    window: str | None = None
    recfeat: str | None = None

    @classmethod
    def parse(cls, name: str) -> "Observation":
        """Read the dotted name: h = human, r = record, f = tokens, c = window."""
        found: dict[str, str] = {}
        for part in name.split("."):
            found[part[:1]] = part[1:]
        if "h" not in found or "r" not in found:
            raise ValueError(f"observation name {name!r} needs h and r parts")
        return cls(found["h"], found["r"], found.get("c"), found.get("f"))


@dataclass(frozen=True)
class Cohort:
    """Where a cohort's sources lie, the label that starts its patient ids, an optional i/n slice."""

    name: str
    label: int
    folder: str
    source_method: str
    slice: str | None = None


@dataclass(frozen=True)
class Stage:
    """One step of case building: ``kind`` is tag, filter or features."""

    kind: str
    args: dict[str, Any] = field(default_factory=dict)


Rule = tuple[str, str, Any]
FrameFn = Callable[..., Any]
