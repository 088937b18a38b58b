"""Settings with range checks."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Limits and thresholds of the three stages; values out of range raise ``ValueError``."""

    max_depth: int = 7
    timeout_s: float = 45.0
    verify_timeout_s: float = 10.0
    delay_s: float = 1.0
    save_interval: int = 200
    batch_size: int = 7
    batch_timeout_s: float = 120.0
    batch_gap_s: float = 2.0
    max_retries: int = 3
    fetch_retries: int = 2
    confidence: float = 0.5
    content_chars: int = 8000
    #: "Now" for two-digit years; a parameter, so that results do not depend on the day.
    current_year: int = 2025

    def __post_init__(self) -> None:
        for name in ("max_depth", "delay_s", "batch_gap_s", "max_retries", "fetch_retries"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} is negative")
        for name in ("timeout_s", "verify_timeout_s", "save_interval", "batch_size", "batch_timeout_s", "content_chars"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} is not positive")
        if not 0 <= self.confidence <= 1:
            raise ValueError("confidence is not between 0 and 1")
        if not 2000 <= self.current_year <= 2099:
            raise ValueError("current_year is not between 2000 and 2099")


DEFAULT = Settings()
