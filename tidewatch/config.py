"""Job parameters.

Every operator takes these as keyword arguments; the defaults below are the
values the analyses are defined with.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


# Must stay equal to the defined behaviour.
WATERMARK_DELAY = "10 minutes"
TRENDING_WINDOW = "10 minutes"
TRENDING_SLIDE = "30 seconds"
SPIKE_WINDOW = "1 minute"
SPIKE_HISTORY = 10
SPIKE_MULTIPLIER = 5.0
SPIKE_TTL = "30 minutes"
EDITOR_IDLE = "1 hour"
EDIT_TYPE = "edit"
QUERY_NAMES = ("trending_articles", "active_editors", "edit_spike_detector")
TABLE_NAMES = ("trending_articles", "active_editors", "edit_spikes")


@dataclass(frozen=True)
class Params:
    watermark_delay: str = WATERMARK_DELAY
    trending_window: str = TRENDING_WINDOW
    trending_slide: str = TRENDING_SLIDE
    spike_window: str = SPIKE_WINDOW
    spike_history: int = SPIKE_HISTORY
    spike_multiplier: float = SPIKE_MULTIPLIER
    spike_ttl: str = SPIKE_TTL
    editor_idle: str = EDITOR_IDLE
    edit_type: str = EDIT_TYPE
    # Shuffle width set by the session factory; None leaves the cluster's own.
    # Streaming queries keep the value they were first started with (it is
    # stored in the checkpoint).
    shuffle_partitions: int | None = None

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULTS = Params()


_UNITS = {
    "microsecond": 1, "microseconds": 1,
    "millisecond": 1_000, "milliseconds": 1_000,
    "second": 1_000_000, "seconds": 1_000_000,
    "minute": 60_000_000, "minutes": 60_000_000,
    "hour": 3_600_000_000, "hours": 3_600_000_000,
    "day": 86_400_000_000, "days": 86_400_000_000,
}


def duration_us(text: str) -> int:
    """'10 minutes' -> 600000000. Accepts '<n> <unit>' pairs, e.g. '1 hour 30 minutes'."""
    parts = text.split()
    if len(parts) % 2:
        raise ValueError(f"bad duration {text!r}")
    total = 0
    for n, unit in zip(parts[::2], parts[1::2]):
        total += int(n) * _UNITS[unit.lower()]
    return total
