"""The tunable thresholds of the trip analytics."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rules:
    """Thresholds shared by the operators, the reports and the job.

    Duration bounds are minutes and speed is mph; all three are exclusive and
    apply to the two-decimal value a report would show.
    """

    placeholder_ratecode: int = 99
    default_payment_type: int = 0
    since: str = "2020-01-01"
    min_duration: float = 0
    max_duration: float = 300
    max_speed: float = 100
    transition_year: int = 2019

    def __post_init__(self) -> None:
        if self.max_speed <= 0:
            raise ValueError("max_speed must be positive")


DEFAULT_RULES = Rules()
