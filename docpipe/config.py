"""Settings from the environment, with defaults and bounds; all faults are reported together."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

# Variable, default, least and largest value of the scan's settings.
NUMBERS = {
    "rate_limit_seconds": ("RATE_LIMIT_SECONDS", 2.5, 1.0, 10.0),
    "max_retries": ("MAX_RETRIES", 3, 1, 10),
    "timeout_seconds": ("TIMEOUT_SECONDS", 30, 10, 120),
    "checkpoint_every": ("CHECKPOINT_EVERY", 1000, 100, 10_000),
}
TEXTS = {
    "index_url": ("INDEX_URL", ""), "index_user": ("INDEX_USER", ""), "index_password": ("INDEX_PASSWORD", ""),
    "knowledge_id": ("KNOWLEDGE_ID", "legal-norms"), "index_name": ("INDEX_NAME", "norms"), "checkpoint_table": ("CHECKPOINT_TABLE", "checkpoints"),
    "log_level": ("LOG_LEVEL", "INFO"), "log_format": ("LOG_FORMAT", "json"),
}
REQUIRED = ("index_url", "index_user", "index_password")


@dataclass(frozen=True)
class Config:
    rate_limit_seconds: float
    max_retries: int
    timeout_seconds: int
    checkpoint_every: int
    index_url: str
    index_user: str
    index_password: str
    knowledge_id: str
    index_name: str
    checkpoint_table: str
    log_level: str
    log_format: str

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Config:
        """Every setting from its variable or its default; ValueError names all numbers that can't be read or are out of bounds."""
        env = os.environ if env is None else env
        got: dict = {name: env.get(var, default) for name, (var, default) in TEXTS.items()}
        faults = []
        for name, (var, default, least, largest) in NUMBERS.items():
            try:
                got[name] = type(default)(env.get(var, default))
            except ValueError:
                faults.append(f"{var} is not a number")
                continue
            if not least <= got[name] <= largest:
                faults.append(f"{var} must lie between {least} and {largest}")
        if faults:
            raise ValueError("; ".join(faults))
        return cls(**{f.name: got[f.name] for f in fields(cls)})

    def validate_required(self) -> None:
        """ValueError names every required setting that is empty."""
        if missing := [TEXTS[n][0] for n in REQUIRED if not getattr(self, n)]:
            raise ValueError("; ".join(f"{v} is required" for v in missing))
