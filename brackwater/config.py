"""Typed configurations and results of the stages (D16, D17). Unknown keys are ignored."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields
from datetime import date
from pathlib import Path
from typing import Any, Self

from .functions.sensors import mission
from .sources.readers import toml


def data_path(*parts: str) -> Path:
    """A path below the data folder, which BRACKWATER_DATA sets."""
    return Path(os.environ.get("BRACKWATER_DATA", "data"), *parts)


@dataclass(frozen=True)
class Result:
    """What a stage says: status is complete, skipped or error."""

    status: str
    output_paths: tuple[str, ...] = ()
    error: str | None = None
    meta: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Config:
    @classmethod
    def of(cls, values: dict[str, Any]) -> Self:
        """From a flat dict: keys of other configurations are ignored, missing ones without default are a ValueError."""
        known = {f.name for f in fields(cls)}
        try:
            return cls(**{k: v for k, v in values.items() if k in known})
        except TypeError as e:
            raise ValueError(str(e)) from e

    @classmethod
    def load(cls, path: str) -> Self:
        return cls.of(toml(path))


@dataclass(frozen=True)
class DownloadConfig(Config):
    start_date: date
    end_date: date
    mission: tuple[str, ...] | list[str] | str
    geometry: str | None = None
    latitude: float | list[float] | None = None
    longitude: float | list[float] | None = None
    step_days: int = 16
    buffer_km: float = 1.0
    cloud_filter: float = 30.0
    days_before: int = 7
    days_after: int = 7
    samples: int = 1
    skip_download: bool = False

    def __post_init__(self):
        names = self.mission.split(",") if isinstance(self.mission, str) else self.mission
        object.__setattr__(self, "mission", tuple(mission(n.strip()).slug for n in names if n.strip()))
        if self.geometry is None and (self.latitude is None or self.longitude is None):
            raise ValueError("give geometry, or latitude and longitude")


@dataclass(frozen=True)
class SalinityConfig(Config):
    water_threshold: float = 0.2
    proxy_scale: float = 1.2
    proxy_threshold: float = 0.35
    chlorophyll_reference: float = 2.0
    cluster_buffer_m: float = 10_000.0
    granularity: str = "M"


@dataclass(frozen=True)
class TrendConfig(Config):
    class_value: float = 1.0
    alpha: float = 0.05
    name_contains: tuple[str, ...] = ("mask",)


@dataclass(frozen=True)
class WorkflowConfig:
    download: DownloadConfig
    salinity: SalinityConfig
    trend: TrendConfig

    @classmethod
    def of(cls, values: dict[str, Any]) -> WorkflowConfig:
        """From one flat dict for all stages."""
        return cls(DownloadConfig.of(values), SalinityConfig.of(values), TrendConfig.of(values))
