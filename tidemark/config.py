"""Settings, from arguments or from TIDEMARK_* environment variables."""

from __future__ import annotations

import os
import warnings
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    # Windows and time.
    window_seconds: int = 60
    lateness_seconds: int = 300
    idle_seconds: int = 30
    skew_seconds: int = 60
    #: Slices of a batch in which the watermark is worked out side by side; 0: as many as shuffle partitions.
    slices: int = 0
    # Throughput and durability: a micro-batch is a poll and a flush.
    flush_seconds: float = 5.0
    max_offsets_per_trigger: int = 500_000
    # The ledger of handled ids; older batches of it are purged now and then.
    ledger_hours: int = 48
    purge_seconds: int = 900
    strict_contract: bool = False
    # Where records come from and dead letters go to.
    bootstrap_servers: str = "localhost:9092"
    topic: str = "orders.v1"
    dlq_topic: str = "orders.v1.dlq"
    consumer_group: str = "tidemark"
    starting_offsets: str = "earliest"
    session_timeout_ms: int = 30_000
    max_poll_interval_ms: int = 300_000

    def __post_init__(self) -> None:
        least = {"window_seconds": 1, "lateness_seconds": 0, "idle_seconds": 1, "skew_seconds": 0, "slices": 0, "flush_seconds": 0.001, "max_offsets_per_trigger": 1, "ledger_hours": 1, "purge_seconds": 1}
        for name, low in least.items():
            if getattr(self, name) < low:
                raise ValueError(f"{name} is {getattr(self, name)}, must be {low} or more")
        if 0 < self.lateness_seconds < self.window_seconds:
            warnings.warn(f"lateness_seconds ({self.lateness_seconds}) is under window_seconds ({self.window_seconds}): windows close early", stacklevel=2)

    @classmethod
    def from_env(cls) -> Settings:
        given = {f: os.environ.get(f"TIDEMARK_{f.name.upper()}") for f in fields(cls)}
        read = {bool: lambda v: v.lower() in ("1", "true", "yes"), int: int, float: float, str: str}
        return cls(**{f.name: read[type(f.default)](v) for f, v in given.items() if v is not None})
