"""Run settings, read from the environment once per job."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    lake: str = "lake/ticks"
    tables: str = "lake/tables"
    checkpoints: str = "lake/checkpoints"
    bus_servers: str = ""
    bus_topic: str = "ticks"
    lookback_minutes: int = 10
    candle_seconds: int = 60
    top_k: int = 5
    retention_days: int = 7
    alert_threshold_pct: float = 2.0
    expected_records: int = 20
    repeat_minutes: int = 60  # a message sent again within this lands once; 0: not looked for
    candle_late_minutes: int = 0  # candles of the stream, closed so long after their end; 0: none
    publish_together: int = 0  # 1: the five results of a run become visible in one switch
    object_store_endpoint: str = ""
    object_store_key: str = ""
    object_store_secret: str = ""

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, prefix: str = "TICKLOOM_") -> Settings:
        env = os.environ if env is None else env
        given = {}
        for name, default in vars(cls()).items():
            text = env.get(prefix + name.upper())
            if text:
                given[name] = type(default)(text)
        return cls(**given)

    def spark_conf(self) -> dict[str, str]:
        """Object-store access for the session; nothing for a plain file system."""
        if not self.object_store_endpoint:
            return {}
        if not (self.object_store_key and self.object_store_secret):
            raise ValueError("an object store needs both a key and a secret")
        return {
            "spark.hadoop.fs.s3a.endpoint": self.object_store_endpoint,
            "spark.hadoop.fs.s3a.access.key": self.object_store_key,
            "spark.hadoop.fs.s3a.secret.key": self.object_store_secret,
            "spark.hadoop.fs.s3a.path.style.access": "true",
        }
